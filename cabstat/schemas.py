"""Declared schemas: nothing in the data path is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

# Ride message (JSON). Field order and types are fixed values of the feed.
RIDE_SCHEMA = T.StructType([
    T.StructField("rateCode", T.IntegerType()),
    T.StructField("storeAndForwardFlag", T.StringType()),
    T.StructField("dropoffTime", T.TimestampType()),
    T.StructField("passengerCount", T.IntegerType()),
    T.StructField("tripTimeInSeconds", T.DoubleType()),
    T.StructField("tripDistanceInMiles", T.DoubleType()),
    T.StructField("pickupLon", T.DoubleType()),
    T.StructField("pickupLat", T.DoubleType()),
    T.StructField("dropoffLon", T.DoubleType()),
    T.StructField("dropoffLat", T.DoubleType()),
    T.StructField("medallion", T.LongType()),
    T.StructField("hackLicense", T.LongType()),
    T.StructField("vendorId", T.StringType()),
    T.StructField("pickupTime", T.TimestampType()),
    T.StructField("errorMessage", T.StringType()),
    T.StructField("messageData", T.StringType()),
])

# Fare message (CSV after a header line). Pickup time stays a string here and
# is parsed by the classifier.
FARE_SCHEMA = T.StructType([
    T.StructField("medallion", T.LongType()),
    T.StructField("hackLicense", T.LongType()),
    T.StructField("vendorId", T.StringType()),
    T.StructField("pickupTimeString", T.StringType()),
    T.StructField("paymentType", T.StringType()),
    T.StructField("fareAmount", T.DoubleType()),
    T.StructField("surcharge", T.DoubleType()),
    T.StructField("mtaTax", T.DoubleType()),
    T.StructField("tipAmount", T.DoubleType()),
    T.StructField("tollsAmount", T.DoubleType()),
    T.StructField("totalAmount", T.DoubleType()),
])

# Keys shared by the two feeds; the join is USING these four.
TRIP_KEYS = ["medallion", "hackLicense", "vendorId", "pickupTime"]

# The 23 columns of a merged trip, in output order.
TRIP_COLUMNS = [
    "medallion", "hackLicense", "vendorId", "pickupTime", "rateCode",
    "storeAndForwardFlag", "dropoffTime", "passengerCount", "tripTimeInSeconds",
    "tripDistanceInMiles", "pickupLon", "pickupLat", "dropoffLon", "dropoffLat",
    "paymentType", "fareAmount", "surcharge", "mtaTax", "tipAmount",
    "tollsAmount", "totalAmount", "pickupNeighborhood", "dropoffNeighborhood",
]

# Keyed output table; primary key (neighborhood, window_end).
STATS_KEY = ["neighborhood", "window_end"]

# Streaming message feed: one binary payload per message.
MESSAGE_SCHEMA = T.StructType([
    T.StructField("body", T.BinaryType()),
    T.StructField("partitionKey", T.StringType()),
    T.StructField("enqueuedTime", T.TimestampType()),
])

# Polygon layer: feature position, NAME attribute, closed rings (x = lon, y = lat).
POINT_TYPE = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
POLYGON_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("rings", T.ArrayType(T.ArrayType(POINT_TYPE))),
])


def as_strings(schema: T.StructType) -> T.StructType:
    """Same field names, every field a string: the raw-token view of a CSV row."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
