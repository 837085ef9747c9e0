"""Raw archive lines → typed records, and typed records → published messages.

Line parsing follows the producer's rules: exactly 14 (ride) or 11 (fare)
comma-separated tokens; ids, counts, times and (for rides) trip time and
distance are mandatory; coordinates (rides) and amounts (fares) fall back to
0.0 when unparsable. A rejected line keeps its text and a reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.timefmt import FEED_TIME_FORMAT, ISO_OFFSET_FORMAT

# Fixed token layouts of the archive files.
RIDE_TOKENS = ["medallion", "hackLicense", "vendorId", "rateCode", "storeAndForwardFlag",
               "pickupTime", "dropoffTime", "passengerCount", "tripTimeInSeconds",
               "tripDistanceInMiles", "pickupLon", "pickupLat", "dropoffLon", "dropoffLat"]
FARE_TOKENS = ["medallion", "hackLicense", "vendorId", "pickupTime", "paymentType", "fareAmount",
               "surcharge", "mtaTax", "tipAmount", "tollsAmount", "totalAmount"]
FARE_CSV_HEADER = ("medallion, hack_license, vendor_id, pickup_datetime, payment_type, "
                   "fare_amount, surcharge, mta_tax, tip_amount, tolls_amount, total_amount")


def partition_key(medallion: Column, hack_license: Column, vendor_id: Column) -> Column:
    """``medallion_hackLicense_vendorId``: the message key / bus partition key; a
    null part is empty and keeps its separator."""
    return F.concat_ws("_", *[F.coalesce(c.cast("string"), F.lit("")) for c in (medallion, hack_license, vendor_id)])


def _tok(i: int) -> Column:
    return F.trim(F.try_element_at(F.col("__tokens"), F.lit(i + 1)))


def _utc_time(c: Column) -> Column:
    return F.try_to_timestamp(c, F.lit(FEED_TIME_FORMAT))


def _parse(lines: DataFrame, line_col: str, n_tokens: int, fields: list[tuple[str, Column, bool]]) -> DataFrame:
    """Split, type every field, and explain the first failure in ``error``."""
    df = lines.withColumn("__tokens", F.split(F.col(line_col), ",", -1))
    df = df.select("*", *[expr.alias(name) for name, expr, _ in fields])
    mandatory = [(name, raw) for name, _, raw in [(n, e, m) for n, e, m in fields] if raw]
    err = (F.when(F.col(line_col).isNull() | F.col(line_col).rlike(r"^\s*$"), F.lit("empty line"))
           .when(F.size("__tokens") != n_tokens,
                 F.format_string("expected %d tokens, found %d", F.lit(n_tokens), F.size("__tokens"))))
    for name, _ in mandatory:
        err = err.when(F.col(name).isNull(), F.lit(f"invalid {name}"))
    df = df.withColumn("error", err)
    names = [n for n, _, _ in fields]
    # a rejected line carries no partial record
    return df.select(*[c for c in lines.columns], *[F.when(F.col("error").isNull(), F.col(n)).alias(n) for n in names],
                     "error")


def parse_ride_lines(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """14-token ride lines → typed rides plus ``error`` (null when accepted)."""
    zero = F.lit(0.0).cast("float")
    fields = [
        ("medallion", _tok(0).try_cast("bigint"), True),
        ("hackLicense", _tok(1).try_cast("bigint"), True),
        ("vendorId", F.try_element_at(F.col("__tokens"), F.lit(3)), False),
        ("rateCode", _tok(3).try_cast("int"), True),
        ("storeAndForwardFlag", F.try_element_at(F.col("__tokens"), F.lit(5)), False),
        ("pickupTime", _utc_time(_tok(5)), True),
        ("dropoffTime", _utc_time(_tok(6)), True),
        ("passengerCount", _tok(7).try_cast("int"), True),
        ("tripTimeInSeconds", _tok(8).try_cast("float"), True),
        ("tripDistanceInMiles", _tok(9).try_cast("float"), True),
        ("pickupLon", F.coalesce(_tok(10).try_cast("float"), zero), False),
        ("pickupLat", F.coalesce(_tok(11).try_cast("float"), zero), False),
        ("dropoffLon", F.coalesce(_tok(12).try_cast("float"), zero), False),
        ("dropoffLat", F.coalesce(_tok(13).try_cast("float"), zero), False),
    ]
    return _parse(lines, line_col, len(RIDE_TOKENS), fields)


def parse_fare_lines(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """11-token fare lines → typed fares plus ``error``; the original line is
    kept as ``csvLine`` (it is the payload of the published fare message)."""
    zero = F.lit(0.0).cast("float")
    amount = lambda i: F.coalesce(_tok(i).try_cast("float"), zero)
    fields = [
        ("medallion", _tok(0).try_cast("bigint"), True),
        ("hackLicense", _tok(1).try_cast("bigint"), True),
        ("vendorId", F.try_element_at(F.col("__tokens"), F.lit(3)), False),
        ("pickupTime", _utc_time(_tok(3)), True),
        ("paymentType", F.try_element_at(F.col("__tokens"), F.lit(5)), False),
        ("fareAmount", amount(5), False),
        ("surcharge", amount(6), False),
        ("mtaTax", amount(7), False),
        ("tipAmount", amount(8), False),
        ("tollsAmount", amount(9), False),
        ("totalAmount", amount(10), False),
        ("csvLine", F.col(line_col), False),
    ]
    return _parse(lines, line_col, len(FARE_TOKENS), fields)


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("error").isNull()).drop("error")


def rejected(parsed: DataFrame, line_col: str = "value") -> DataFrame:
    return parsed.filter(F.col("error").isNotNull()).select(line_col, "error")


RIDE_JSON_FIELDS = ["medallion", "hackLicense", "vendorId", "pickupTime", "rateCode",
                    "storeAndForwardFlag", "dropoffTime", "passengerCount", "tripTimeInSeconds",
                    "tripDistanceInMiles", "pickupLon", "pickupLat", "dropoffLon", "dropoffLat"]


def publish_rides(rides: DataFrame) -> DataFrame:
    """Typed rides → ``key, body`` messages: camelCase JSON, ISO times with offset."""
    body = F.to_json(F.struct(*RIDE_JSON_FIELDS), {"timestampFormat": ISO_OFFSET_FORMAT})
    return rides.select(partition_key(F.col("medallion"), F.col("hackLicense"), F.col("vendorId")).alias("key"),
                        body.cast("binary").alias("body"))


def publish_fares(fares: DataFrame, header: str = FARE_CSV_HEADER) -> DataFrame:
    """Typed fares (with their source ``csvLine``) → ``key, body``: the header
    line, CRLF, the data line."""
    body = F.concat(F.lit(header + "\r\n"), F.col("csvLine"))
    return fares.select(partition_key(F.col("medallion"), F.col("hackLicense"), F.col("vendorId")).alias("key"),
                        body.cast("binary").alias("body"))


def write_messages(messages: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Publish ``key, body`` messages. With ``fmt="kafka"`` (connector and
    options needed) the producer partitions by ``key``; Spark adds no shuffle,
    so a hot key never lands in a single task."""
    messages.write.mode("error").format(fmt).save(path)
