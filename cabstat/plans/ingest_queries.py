"""Archive-line parsing, archive scan and message publishing queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators import ingest as IG
from ..operators.quality import decode_rides
from ..session import ensure_utc, scratch_path
from ..sources import feeds as FD
from ..sources.archive import scan_archive
from ..sources.tables import table
from .catalog import register
from .oracle_sql import base_cte

# ---- fixed values of the line fixtures (event_id moduli) --------------------
LINE_SHORT, LINE_BAD_ID, LINE_BLANK = 31, 37, 43       # rides
FARE_LINE_LONG, FARE_LINE_BAD_TIME, FARE_LINE_BAD_AMOUNT = 31, 37, 41
ARCHIVE_FILES = 12
# ------------------------------------------------------------------------------


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    ev = table(spark, sf_dir, "events")
    return FD.trip_facts(ev).withColumn("event_id", F.col("hackLicense"))


def _ride_cells() -> list[Column]:
    drop = F.timestamp_add("SECOND", F.col("tripTimeInSeconds").cast("int"), F.col("ts"))
    lon = F.coalesce(F.col("pickupLon").cast("string"), F.lit("abc"))
    return [F.col("medallion").cast("string"), F.col("hackLicense").cast("string"), F.col("vendorId"),
            F.col("rateCode").cast("string"), F.col("storeAndForwardFlag"),
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.date_format(drop, "yyyy-MM-dd HH:mm:ss"),
            F.col("passengerCount").cast("string"), F.col("tripTimeInSeconds").cast("string"),
            F.col("tripDistanceInMiles").cast("string"), lon, F.col("pickupLat").cast("string"),
            F.col("dropoffLon").cast("string"), F.col("dropoffLat").cast("string")]


def ride_lines(spark, sf_dir, faults: bool = True) -> DataFrame:
    f = _facts(spark, sf_dir)
    cells = _ride_cells()
    e = F.col("event_id")
    line = F.concat_ws(",", *cells)
    if faults:
        line = (F.when(e % LINE_BLANK == 0, F.lit("  "))
                .when(e % LINE_SHORT == 0, F.concat_ws(",", *cells[:-1]))
                .when(e % LINE_BAD_ID == 0, F.concat_ws(",", F.lit("x"), *cells[1:]))
                .otherwise(line))
    return f.select("event_id", line.alias("value"))


def fare_lines(spark, sf_dir) -> DataFrame:
    f = _facts(spark, sf_dir)
    e = F.col("event_id")
    time_cell = F.when(e % FARE_LINE_BAD_TIME == 0, F.lit("bad")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    fare_cell = F.when(e % FARE_LINE_BAD_AMOUNT == 0, F.lit("abc")).otherwise(F.col("fareAmount").cast("string"))
    cells = [F.col("medallion").cast("string"), e.cast("string"), F.col("vendorId"), time_cell,
             F.col("paymentType"), fare_cell, F.col("surcharge").cast("string"), F.col("mtaTax").cast("string"),
             F.col("tipAmount").cast("string"), F.col("tollsAmount").cast("string"),
             F.col("totalAmount").cast("string")]
    line = F.when(e % FARE_LINE_LONG == 0, F.concat_ws(",", *cells, F.lit("extra"))).otherwise(F.concat_ws(",", *cells))
    return f.select("event_id", line.alias("value"))


def _oracle_ride_line(faults: bool = True) -> str:
    cells = ["CAST(medallion AS VARCHAR)", "CAST(hackLicense AS VARCHAR)", "vendorId", "CAST(rateCode AS VARCHAR)",
             "storeAndForwardFlag", "strftime(pt, '%Y-%m-%d %H:%M:%S')", "strftime(dropoff_pt, '%Y-%m-%d %H:%M:%S')",
             "CAST(passengerCount AS VARCHAR)", "CAST(tripTimeInSeconds AS VARCHAR)",
             "CAST(tripDistanceInMiles AS VARCHAR)", "coalesce(CAST(pickupLon AS VARCHAR), 'abc')",
             "CAST(pickupLat AS VARCHAR)", "CAST(dropoffLon AS VARCHAR)", "CAST(dropoffLat AS VARCHAR)"]
    line = f"concat_ws(',', {', '.join(cells)})"
    if not faults:
        return line
    return (f"CASE WHEN event_id % {LINE_BLANK} = 0 THEN '  ' "
            f"WHEN event_id % {LINE_SHORT} = 0 THEN concat_ws(',', {', '.join(cells[:-1])}) "
            f"WHEN event_id % {LINE_BAD_ID} = 0 THEN concat_ws(',', 'x', {', '.join(cells[1:])}) "
            f"ELSE {line} END")


RIDE_REJECT = (f"CASE WHEN event_id % {LINE_BLANK} = 0 THEN 'empty line' "
               f"WHEN event_id % {LINE_SHORT} = 0 THEN 'expected 14 tokens, found 13' "
               f"WHEN event_id % {LINE_BAD_ID} = 0 THEN 'invalid medallion' END")


def _ok(expr: str, reject: str) -> str:
    return f"CASE WHEN ({reject}) IS NULL THEN {expr} END"


@register("parse_ride_line", base_cte() + f"""
SELECT event_id, {RIDE_REJECT} AS error,
  {_ok('medallion', RIDE_REJECT)} AS medallion, {_ok('hackLicense', RIDE_REJECT)} AS hackLicense,
  {_ok('vendorId', RIDE_REJECT)} AS vendorId, {_ok('rateCode', RIDE_REJECT)} AS rateCode,
  {_ok('pt', RIDE_REJECT)} AS pickupTime, {_ok('dropoff_pt', RIDE_REJECT)} AS dropoffTime,
  {_ok('passengerCount', RIDE_REJECT)} AS passengerCount,
  {_ok('tripDistanceInMiles', RIDE_REJECT)} AS tripDistanceInMiles,
  {_ok('coalesce(pickupLon, 0.0)', RIDE_REJECT)} AS pickupLon, {_ok('pickupLat', RIDE_REJECT)} AS pickupLat
FROM f""")
def q_parse_ride_line(spark, sf_dir):
    """14-token lines: accepted rows typed, rejected rows with a reason."""
    p = IG.parse_ride_lines(ride_lines(spark, sf_dir))
    return p.select("event_id", "error", "medallion", "hackLicense", "vendorId", "rateCode",
                    F.col("pickupTime").cast("timestamp_ntz").alias("pickupTime"),
                    F.col("dropoffTime").cast("timestamp_ntz").alias("dropoffTime"), "passengerCount",
                    F.col("tripDistanceInMiles").cast("double").alias("tripDistanceInMiles"),
                    F.col("pickupLon").cast("double").alias("pickupLon"),
                    F.col("pickupLat").cast("double").alias("pickupLat"))


FARE_REJECT = (f"CASE WHEN event_id % {FARE_LINE_LONG} = 0 THEN 'expected 11 tokens, found 12' "
               f"WHEN event_id % {FARE_LINE_BAD_TIME} = 0 THEN 'invalid pickupTime' END")


@register("parse_fare_line", base_cte() + f"""
SELECT event_id, {FARE_REJECT} AS error,
  {_ok('medallion', FARE_REJECT)} AS medallion, {_ok('pt', FARE_REJECT)} AS pickupTime,
  {_ok('paymentType', FARE_REJECT)} AS paymentType,
  {_ok(f'CASE WHEN event_id % {FARE_LINE_BAD_AMOUNT} = 0 THEN 0.0 ELSE fareAmount END', FARE_REJECT)} AS fareAmount,
  {_ok('tipAmount', FARE_REJECT)} AS tipAmount
FROM f""")
def q_parse_fare_line(spark, sf_dir):
    """11-token lines: amounts default to 0.0, ids and time mandatory."""
    p = IG.parse_fare_lines(fare_lines(spark, sf_dir))
    return p.select("event_id", "error", "medallion",
                    F.col("pickupTime").cast("timestamp_ntz").alias("pickupTime"), "paymentType",
                    F.round(F.col("fareAmount").cast("double"), 2).alias("fareAmount"),
                    F.round(F.col("tipAmount").cast("double"), 2).alias("tipAmount"))


def write_archive(lines: DataFrame, directory: str, kind: str, n_files: int, header: str) -> None:
    """Lay lines out as ``<kind>_<n>.csv`` members, each part starting with a
    header line (fixture for the archive scan). Members are the folders Spark
    writes, renamed (metadata only, one rename a member)."""
    seq = (F.col("event_id") % n_files + 1).cast("int")
    staging = directory + "_staging"
    (lines.select(F.col("value").alias(header), seq.alias("n"))
          .write.option("header", True).option("sep", "\u0001").option("quote", "").option("emptyValue", "")
          .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
          .partitionBy("n").csv(staging))
    spark = lines.sparkSession
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = Path(staging).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(Path(directory))
    for n in range(1, n_files + 1):
        if fs.exists(Path(f"{staging}/n={n}")):
            fs.rename(Path(f"{staging}/n={n}"), Path(f"{directory}/{kind}_{n}.csv"))


@register("trip_archive_scan", base_cte() + f"""
SELECT CAST(event_id % {ARCHIVE_FILES} + 1 AS INTEGER) AS file_seq, {_oracle_ride_line()} AS value,
       {RIDE_REJECT} AS error
FROM f""")
def q_trip_archive_scan(spark, sf_dir):
    """Ride lines (some blank, some malformed) spread over trip_data_1 ..
    trip_data_12 with headers, scanned back with their sequence numbers, and
    the parser's finding for each."""
    d = scratch_path(spark, "archive")
    write_archive(ride_lines(spark, sf_dir), d, "trip_data", ARCHIVE_FILES, FD.RIDE_HEADER)
    return IG.parse_ride_lines(scan_archive(spark, d, "trip_data")).select("file_seq", "value", "error")


def _json_num(expr: str) -> str:
    return f"CAST({expr} AS VARCHAR)"


@register("publish_ride_json", base_cte() + f"""
SELECT partitionKey AS key,
  '{{"medallion":' || medallion || ',"hackLicense":' || hackLicense || ',"vendorId":"' || vendorId
  || '","pickupTime":"' || strftime(pt, '%Y-%m-%dT%H:%M:%S+00:00') || '","rateCode":' || rateCode
  || ',"storeAndForwardFlag":"' || storeAndForwardFlag || '","dropoffTime":"'
  || strftime(dropoff_pt, '%Y-%m-%dT%H:%M:%S+00:00') || '","passengerCount":' || passengerCount
  || ',"tripTimeInSeconds":' || {_json_num('CAST(tripTimeInSeconds AS FLOAT)')}
  || ',"tripDistanceInMiles":' || {_json_num('CAST(tripDistanceInMiles AS FLOAT)')}
  || ',"pickupLon":' || {_json_num('CAST(coalesce(pickupLon, 0.0) AS FLOAT)')}
  || ',"pickupLat":' || {_json_num('CAST(pickupLat AS FLOAT)')}
  || ',"dropoffLon":' || {_json_num('CAST(dropoffLon AS FLOAT)')}
  || ',"dropoffLat":' || {_json_num('CAST(dropoffLat AS FLOAT)')} || '}}' AS body
FROM f WHERE ({RIDE_REJECT}) IS NULL""")
def q_publish_ride_json(spark, sf_dir):
    """Accepted ride lines published as keyed JSON messages."""
    ok = IG.accepted(IG.parse_ride_lines(ride_lines(spark, sf_dir)))
    return IG.publish_rides(ok).select("key", F.col("body").cast("string").alias("body"))


@register("publish_fare_csv", base_cte() + f"""
SELECT partitionKey AS key,
  '{IG.FARE_CSV_HEADER}' || chr(13) || chr(10) || concat_ws(',', medallion, hackLicense, vendorId,
     strftime(pt, '%Y-%m-%d %H:%M:%S'), paymentType,
     CASE WHEN event_id % {FARE_LINE_BAD_AMOUNT} = 0 THEN 'abc' ELSE CAST(fareAmount AS VARCHAR) END,
     '0.5', '0.5', CAST(tipAmount AS VARCHAR), '0.0', 
     CAST((fare_c + 100 + (fare_c * 2 + 5) // 10) / 100 AS VARCHAR)) AS body
FROM f WHERE ({FARE_REJECT}) IS NULL""")
def q_publish_fare_csv(spark, sf_dir):
    """Accepted fare lines published as ``header CRLF line`` messages."""
    ok = IG.accepted(IG.parse_fare_lines(fare_lines(spark, sf_dir)))
    return IG.publish_fares(ok).select("key", F.col("body").cast("string").alias("body"))


@register("publish_read_back", base_cte() + f"""
SELECT partitionKey AS key, medallion, hackLicense, vendorId, pt AS pickupTime, passengerCount
FROM f WHERE ({RIDE_REJECT}) IS NULL""")
def q_publish_read_back(spark, sf_dir):
    """Accepted ride lines written as keyed messages, read back and decoded."""
    path = scratch_path(spark, "published")
    IG.write_messages(IG.publish_rides(IG.accepted(IG.parse_ride_lines(ride_lines(spark, sf_dir)))), path)
    sent = spark.read.parquet(path)
    rides = decode_rides(sent.withColumnRenamed("key", "partitionKey"))
    return rides.select(F.col("partitionKey").alias("key"), "ride.medallion", "ride.hackLicense", "ride.vendorId",
                        F.col("ride.pickupTime").cast("timestamp_ntz").alias("pickupTime"), "ride.passengerCount")
