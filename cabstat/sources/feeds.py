"""Ride and fare message feeds derived deterministically from ``events``.

The derivation is a projection (no shuffle): every event becomes one ride
message (JSON) and one fare message (header line, CRLF, one CSV line), keyed
``medallion_hackLicense_vendorId``. Faults are planted by event id so that
every decoder path is exercised on every run and scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.ingest import FARE_CSV_HEADER as FARE_HEADER

# ---- fixed values of the derived feeds -------------------------------------
# Fault moduli on event_id (first matching rule wins per feed).
RIDE_NOT_JSON = 97        # body is not JSON at all
RIDE_OTHER_SHAPE = 101    # valid JSON of another shape
RIDE_NO_PICKUP_LON = 61   # pickupLon absent from the JSON
FARE_BAD_TIME = 89        # pickup time cell is "bad"
FARE_HEADER_ONLY = 83     # message is the header line alone
FARE_BAD_AMOUNT = 79      # fare amount cell is "abc"
FARE_SHORT_ROW = 73       # last cell (total) missing: 10 tokens
NOT_JSON_TEXT = "meter offline; no reading"
OTHER_SHAPE_JSON = '{"depot": "north", "bays": 12, "open": true}'
RIDE_HEADER = ("medallion, hack_license, vendor_id, rate_code, store_and_fwd_flag, "
               "pickup_datetime, dropoff_datetime, passenger_count, trip_time_in_secs, "
               "trip_distance, pickup_longitude, pickup_latitude, dropoff_longitude, "
               "dropoff_latitude")
GRID = 64                 # coordinates are on a 1/64 degree lattice
ORIGIN_LON, ORIGIN_LAT = -74.0, 40.0
SURCHARGE_CENTS, MTA_TAX_CENTS = 50, 50
# -----------------------------------------------------------------------------


def _k() -> Column:
    return F.get_json_object("props", "$.k").try_cast("int")


def _cents(c: Column) -> Column:
    return F.round(c * 100).cast("bigint")


def trip_facts(events: DataFrame) -> DataFrame:
    """Typed trip attributes of each event (the content of both messages)."""
    eid = F.col("event_id")
    k = _k()
    fare_c = _cents(F.col("value"))
    tip_c = F.floor((fare_c * 2 + 5) / 10).cast("bigint")   # round half up of 20 %
    return events.select(
        F.col("user_id").alias("medallion"),
        eid.alias("hackLicense"),
        F.col("event_type").alias("vendorId"),
        F.col("ts"),
        (k % 6).alias("rateCode"),
        F.when(k % 10 == 0, "Y").otherwise("N").alias("storeAndForwardFlag"),
        (k % 5 + 1).alias("passengerCount"),
        (k * 10).cast("double").alias("tripTimeInSeconds"),
        (k / 8).alias("tripDistanceInMiles"),
        F.when(eid % RIDE_NO_PICKUP_LON != 0,
               ORIGIN_LON + (eid % GRID) / GRID).alias("pickupLon"),
        (ORIGIN_LAT + (F.floor(eid / GRID) % GRID) / GRID).alias("pickupLat"),
        (ORIGIN_LON + ((eid * 3 + 5) % GRID) / GRID).alias("dropoffLon"),
        (ORIGIN_LAT + ((F.floor(eid / GRID) * 5 + 11) % GRID) / GRID).alias("dropoffLat"),
        F.when(k % 2 == 0, "CRD").otherwise("CSH").alias("paymentType"),
        (fare_c / 100).alias("fareAmount"),
        (F.lit(SURCHARGE_CENTS) / 100).alias("surcharge"),
        (F.lit(MTA_TAX_CENTS) / 100).alias("mtaTax"),
        (tip_c / 100).alias("tipAmount"),
        F.lit(0.0).alias("tollsAmount"),
        ((fare_c + SURCHARGE_CENTS + MTA_TAX_CENTS + tip_c) / 100).alias("totalAmount"),
    )


def _partition_key() -> Column:
    return F.concat_ws("_", "medallion", "hackLicense", "vendorId")


def _pickup(fmt: str) -> Column:
    return F.date_format("ts", fmt)


def _ride_text() -> Column:
    """Ride message text over ``trip_facts`` columns, faults planted."""
    eid = F.col("hackLicense")
    drop = F.timestamp_add("SECOND", F.col("tripTimeInSeconds").cast("int"), F.col("ts"))
    iso = "yyyy-MM-dd'T'HH:mm:ss'+00:00'"
    ride = F.struct(
        "medallion", "hackLicense", "vendorId",
        _pickup(iso).alias("pickupTime"),
        "rateCode", "storeAndForwardFlag",
        F.date_format(drop, iso).alias("dropoffTime"),
        "passengerCount", "tripTimeInSeconds", "tripDistanceInMiles",
        "pickupLon", "pickupLat", "dropoffLon", "dropoffLat",
    )
    return (F.when(eid % RIDE_NOT_JSON == 0, F.lit(NOT_JSON_TEXT))
            .when(eid % RIDE_OTHER_SHAPE == 0, F.lit(OTHER_SHAPE_JSON))
            .otherwise(F.to_json(ride)))


def _envelope(text: Column) -> list[Column]:
    return [text.cast("binary").alias("body"), _partition_key().alias("partitionKey"),
            F.col("ts").cast("timestamp").alias("enqueuedTime")]


def ride_messages(events: DataFrame) -> DataFrame:
    """``body BINARY, partitionKey STRING, enqueuedTime TIMESTAMP`` ride feed."""
    return trip_facts(events).select(*_envelope(_ride_text()))


def fare_line() -> Column:
    """The CSV data line of a fare (over ``trip_facts`` columns), faults planted."""
    eid = F.col("hackLicense")
    time_cell = F.when(eid % FARE_BAD_TIME == 0, F.lit("bad")).otherwise(
        _pickup("yyyy-MM-dd HH:mm:ss"))
    fare_cell = F.when(eid % FARE_BAD_AMOUNT == 0, F.lit("abc")).otherwise(
        F.col("fareAmount").cast("string"))
    cells = [F.col("medallion").cast("string"), eid.cast("string"), F.col("vendorId"),
             time_cell, F.col("paymentType"), fare_cell,
             F.col("surcharge").cast("string"), F.col("mtaTax").cast("string"),
             F.col("tipAmount").cast("string"), F.col("tollsAmount").cast("string")]
    total = F.col("totalAmount").cast("string")
    return F.when(eid % FARE_SHORT_ROW == 0, F.concat_ws(",", *cells)).otherwise(
        F.concat_ws(",", *cells, total))


def _fare_text() -> Column:
    eid = F.col("hackLicense")
    return F.when(eid % FARE_HEADER_ONLY == 0, F.lit(FARE_HEADER + "\r\n")).otherwise(
        F.concat(F.lit(FARE_HEADER + "\r\n"), fare_line()))


def fare_messages(events: DataFrame) -> DataFrame:
    """``body BINARY, partitionKey STRING, enqueuedTime TIMESTAMP`` fare feed."""
    return trip_facts(events).select(*_envelope(_fare_text()))


def both_feeds(events: DataFrame) -> DataFrame:
    """Ride and fare messages of every event in one projection (``feed``
    column), so one scan of ``events`` yields both feeds."""
    msgs = F.array(F.struct(F.lit("rides").alias("feed"), *_envelope(_ride_text())),
                   F.struct(F.lit("fares").alias("feed"), *_envelope(_fare_text())))
    return trip_facts(events).select(F.explode(msgs).alias("m")).select("m.*")
