"""Registered queries: name → (Spark builder, DuckDB oracle SQL or None).

Every builder takes ``(spark, sf_dir)`` and reads the given tables (or data
Spark derives from them) whole; every oracle recomputes the same result from
the raw tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..functions.tags import merge_tags
from ..functions.timefmt import parse_event_time, rfc1123
from ..operators import trips as TR
from ..operators.geo import tag_neighborhoods
from ..operators.quality import decode_fares, decode_rides, valid_fares, valid_rides
from ..schemas import TRIP_COLUMNS
from ..session import ensure_utc
from ..sources.feeds import FARE_HEADER, trip_facts
from ..sources.tables import table
from . import batch_job as P
from .oracle_sql import base_cte, money_sum

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Builder) -> Builder:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def ntz(c: str) -> F.Column:
    return F.col(c).cast("timestamp_ntz")


# ---------------------------------------------------------------- aggregates

STATS_ORACLE = base_cte() + f"""
SELECT pickupNeighborhood AS neighborhood,
       date_trunc('hour', pt) + INTERVAL 1 HOUR AS window_end,
       count(*) AS number_of_rides,
       {money_sum('fareAmount')} AS total_fare_amount,
       {money_sum('tipAmount')} AS total_tip_amount,
       {money_sum('fareAmount')} / count(*) AS average_fare_amount,
       {money_sum('tipAmount')} / count(*) AS average_tip_amount
FROM trips GROUP BY 1, 2
"""


@register("neighborhood_stats", STATS_ORACLE)
def q_neighborhood_stats(spark, sf_dir):
    """Flagship: rides ⋈ fares → per (1 h window, pickup neighbourhood) stats."""
    return P.stats(spark, sf_dir)


@register("neighborhood_stats_joined", STATS_ORACLE)
def q_neighborhood_stats_joined(spark, sf_dir):
    """Same result through the plain plan (join, then aggregate), as streamed."""
    return TR.neighborhood_stats(P.untagged_trips(spark, sf_dir, P.enriched_rides(spark, sf_dir, dropoff=False)))


@register("mean_over_all_rows", base_cte() + f"""
SELECT pickupNeighborhood AS neighborhood,
       date_trunc('hour', pt) + INTERVAL 1 HOUR AS window_end,
       count(*) AS number_of_rides,
       count(totalAmount) AS priced_rides,
       {money_sum('totalAmount')} / count(*) AS mean_total_all_rows,
       {money_sum('totalAmount')} / count(totalAmount) AS mean_total_priced
FROM trips GROUP BY 1, 2
""")
def q_mean_over_all_rows(spark, sf_dir):
    """sum / count(*): a null amount still counts in the denominator."""
    return TR.mean_over_all_rows(P.enriched_rides(spark, sf_dir, dropoff=False), P.fares(spark, sf_dir))


@register("tip_per_mile", base_cte() + f"""
SELECT pickupNeighborhood AS neighborhood,
       date_trunc('hour', pt) + INTERVAL 1 HOUR AS window_end,
       count(*) AS number_of_rides,
       {money_sum('tipAmount')} AS total_tip_amount,
       {money_sum('tripDistanceInMiles')} AS total_miles,
       {money_sum('tipAmount')} / nullif({money_sum('tripDistanceInMiles')}, 0) AS tip_per_mile
FROM trips GROUP BY 1, 2
""")
def q_tip_per_mile(spark, sf_dir):
    return TR.tip_per_mile(P.enriched_rides(spark, sf_dir, dropoff=False), P.fares(spark, sf_dir))


@register("tumbling_window", base_cte() + """
SELECT hackLicense, date_trunc('hour', pt) AS window_start,
       date_trunc('hour', pt) + INTERVAL 1 HOUR AS window_end
FROM trips
""")
def q_tumbling_window(spark, sf_dir):
    t = TR.with_window(P.untagged_trips(spark, sf_dir))
    return t.select("hackLicense", ntz("window.start").alias("window_start"),
                    ntz("window.end").alias("window_end"))


# ---------------------------------------------------------------- joins

@register("trip_join", base_cte() + """
SELECT medallion, hackLicense, vendorId, pt AS pickupTime, paymentType,
       fareAmount, tipAmount, totalAmount, pickupNeighborhood, dropoffNeighborhood
FROM trips
""")
def q_trip_join(spark, sf_dir):
    t = P.trips(spark, sf_dir)
    return t.select("medallion", "hackLicense", "vendorId", ntz("pickupTime").alias("pickupTime"),
                    "paymentType", "fareAmount", "tipAmount", "totalAmount",
                    "pickupNeighborhood", "dropoffNeighborhood")


@register("reproject_trip", base_cte() + """
SELECT medallion, hackLicense, vendorId, pt AS pickupTime, rateCode, storeAndForwardFlag,
       dropoff_pt AS dropoffTime, passengerCount, tripTimeInSeconds, tripDistanceInMiles,
       pickupLon, pickupLat, dropoffLon, dropoffLat, paymentType, fareAmount,
       0.5 AS surcharge, 0.5 AS mtaTax, tipAmount, 0.0 AS tollsAmount, totalAmount,
       pickupNeighborhood, dropoffNeighborhood
FROM trips
""")
def q_reproject_trip(spark, sf_dir):
    """The 23-column merged trip, reprojected by name (``selectExpr``)."""
    rides, fares = P.enriched_rides(spark, sf_dir), P.fares(spark, sf_dir)
    exprs = [f"CAST({c} AS TIMESTAMP_NTZ) AS {c}" if c in ("pickupTime", "dropoffTime") else c
             for c in TRIP_COLUMNS]
    return rides.join(fares, ["medallion", "hackLicense", "vendorId", "pickupTime"]).selectExpr(*exprs)


# ---------------------------------------------------------------- spatial

@register("point_in_polygon", base_cte() + """
SELECT event_id, pickupNeighborhood AS pickup_neighborhood, dropoffNeighborhood AS dropoff_neighborhood
FROM f
""")
def q_point_in_polygon(spark, sf_dir):
    """Every event's pickup and drop-off point tagged with its polygon."""
    ensure_utc(spark)
    pts = trip_facts(table(spark, sf_dir, "events"))
    tagged = tag_neighborhoods(pts, P.neighborhood_index(spark, sf_dir))
    return tagged.select(F.col("hackLicense").alias("event_id"),
                         F.col("pickupNeighborhood").alias("pickup_neighborhood"),
                         F.col("dropoffNeighborhood").alias("dropoff_neighborhood"))


@register("point_in_polygon_shuffled", base_cte() + """
SELECT event_id, pickupNeighborhood AS pickup_neighborhood, dropoffNeighborhood AS dropoff_neighborhood
FROM f
""")
def q_point_in_polygon_shuffled(spark, sf_dir):
    """The same tags through the salted shuffle join that large layers take."""
    ensure_utc(spark)
    pts = trip_facts(table(spark, sf_dir, "events"))
    tagged = tag_neighborhoods(pts, replace(P.neighborhood_index(spark, sf_dir), broadcastable=False))
    return tagged.select(F.col("hackLicense").alias("event_id"),
                         F.col("pickupNeighborhood").alias("pickup_neighborhood"),
                         F.col("dropoffNeighborhood").alias("dropoff_neighborhood"))


@register("neighborhood_tag", base_cte() + """
SELECT hackLicense, pickupLon, pickupLat, pickupNeighborhood, dropoffNeighborhood
FROM f WHERE NOT ride_bad
""")
def q_neighborhood_tag(spark, sf_dir):
    """Valid decoded rides enriched with both neighbourhoods."""
    r = P.enriched_rides(spark, sf_dir)
    return r.select("hackLicense", "pickupLon", "pickupLat", "pickupNeighborhood", "dropoffNeighborhood")


# ---------------------------------------------------------------- decoding & quality

@register("classify_ride_errors", base_cte() + """
SELECT partitionKey, CASE WHEN ride_bad THEN 'Error decoding JSON' END AS errorMessage FROM f
""")
def q_classify_ride_errors(spark, sf_dir):
    rides_msg, _ = P.feeds(spark, sf_dir)
    return decode_rides(rides_msg).select("partitionKey", "errorMessage")


@register("classify_fare_errors", base_cte() + """
SELECT partitionKey,
       CASE WHEN fare_bad THEN 'Error parsing pickupTime' END AS errorMessage,
       CASE WHEN fare_bad THEN NULL ELSE pt END AS pickupTime
FROM f
""")
def q_classify_fare_errors(spark, sf_dir):
    _, fares_msg = P.feeds(spark, sf_dir)
    return decode_fares(fares_msg).select("partitionKey", "errorMessage", ntz("pickupTime").alias("pickupTime"))


@register("valid_rows", base_cte() + """
SELECT medallion, hackLicense, vendorId, strftime(pt, '%Y-%m-%d %H:%M:%S') AS pickupTimeString,
       paymentType, fareAmount, 0.5 AS surcharge, 0.5 AS mtaTax, tipAmount, 0.0 AS tollsAmount,
       totalAmount, pt AS pickupTime
FROM f WHERE NOT fare_bad
""")
def q_valid_rows(spark, sf_dir):
    """Fares that passed classification (ragged 10-token rows kept, total null)."""
    return P.fares(spark, sf_dir).withColumn("pickupTime", ntz("pickupTime"))


@register("malformed_counts", base_cte() + """
SELECT count(*) FILTER (WHERE ride_bad) AS malformed_rides,
       count(*) FILTER (WHERE fare_bad) AS malformed_fares,
       count(*) AS messages
FROM f
""")
def q_malformed_counts(spark, sf_dir):
    """The ``observe`` counters of both decoders, read after a run over all messages."""
    rides_msg, fares_msg = P.feeds(spark, sf_dir)
    rides, fares = Observation("rides"), Observation("fares")
    for df in (valid_rides(rides_msg, rides), valid_fares(fares_msg, fares)):
        df.write.format("noop").mode("overwrite").save()
    return spark.range(1).select(F.lit(rides.get["malformed"]).cast("long").alias("malformed_rides"),
                                 F.lit(fares.get["malformed"]).cast("long").alias("malformed_fares"),
                                 F.lit(rides.get["messages"]).cast("long").alias("messages"))


@register("decode_json", base_cte() + """
SELECT partitionKey,
       CASE WHEN event_id % 97 = 0 OR event_id % 101 = 0 THEN NULL ELSE medallion END AS medallion,
       CASE WHEN event_id % 97 = 0 OR event_id % 101 = 0 THEN NULL ELSE rateCode END AS rateCode,
       CASE WHEN event_id % 97 = 0 OR event_id % 101 = 0 THEN NULL ELSE tripDistanceInMiles END AS tripDistanceInMiles,
       CASE WHEN event_id % 97 = 0 OR event_id % 101 = 0 THEN NULL ELSE pickupLon END AS pickupLon,
       CASE WHEN event_id % 97 = 0 OR event_id % 101 = 0 THEN NULL ELSE pt END AS pickupTime,
       CASE WHEN event_id % 97 = 0 OR event_id % 101 = 0 THEN NULL ELSE dropoff_pt END AS dropoffTime
FROM f
""")
def q_decode_json(spark, sf_dir):
    """Every ride message decoded to the declared struct (absent → null)."""
    rides_msg, _ = P.feeds(spark, sf_dir)
    d = decode_rides(rides_msg)
    return d.select("partitionKey", "ride.medallion", "ride.rateCode", "ride.tripDistanceInMiles",
                    "ride.pickupLon", F.col("ride.pickupTime").cast("timestamp_ntz").alias("pickupTime"),
                    F.col("ride.dropoffTime").cast("timestamp_ntz").alias("dropoffTime"))


@register("struct_expand", base_cte() + """
SELECT rateCode, storeAndForwardFlag, dropoff_pt AS dropoffTime, passengerCount, tripTimeInSeconds,
       tripDistanceInMiles, pickupLon, pickupLat, dropoffLon, dropoffLat, medallion, hackLicense,
       vendorId, pt AS pickupTime, CAST(NULL AS VARCHAR) AS errorMessage, CAST(NULL AS VARCHAR) AS messageData
FROM f WHERE NOT ride_bad
""")
def q_struct_expand(spark, sf_dir):
    """``ride.*`` of valid rides: all 16 schema fields as columns."""
    rides_msg, _ = P.feeds(spark, sf_dir)
    r = valid_rides(rides_msg)
    return r.withColumn("pickupTime", ntz("pickupTime")).withColumn("dropoffTime", ntz("dropoffTime"))


@register("parse_event_time", base_cte() + """
SELECT partitionKey,
       CASE WHEN event_id % 83 = 0 OR event_id % 79 = 0 THEN NULL
            WHEN event_id % 89 = 0 THEN 'bad' ELSE strftime(pt, '%Y-%m-%d %H:%M:%S') END AS pickupTimeString,
       CASE WHEN fare_bad THEN NULL ELSE pt END AS pickupTime
FROM f
""")
def q_parse_event_time(spark, sf_dir):
    _, fares_msg = P.feeds(spark, sf_dir)
    d = decode_fares(fares_msg)
    return d.select("partitionKey", "fare.pickupTimeString",
                    parse_event_time("fare.pickupTimeString").cast("timestamp_ntz").alias("pickupTime"))


@register("body_to_text", base_cte() + """
SELECT partitionKey,
  CASE WHEN event_id % 83 = 0 THEN '{hdr}' || chr(13) || chr(10)
  ELSE '{hdr}' || chr(13) || chr(10) || concat_ws(',', medallion, hackLicense, vendorId,
        CASE WHEN event_id % 89 = 0 THEN 'bad' ELSE strftime(pt, '%Y-%m-%d %H:%M:%S') END,
        paymentType,
        CASE WHEN event_id % 79 = 0 THEN 'abc' ELSE CAST(fareAmount AS VARCHAR) END,
        '0.5', '0.5', CAST(tipAmount AS VARCHAR), '0.0',
        CASE WHEN event_id % 73 = 0 THEN NULL ELSE CAST(totalAmount AS VARCHAR) END) END AS messageData
FROM f
""".replace("{hdr}", FARE_HEADER))
def q_body_to_text(spark, sf_dir):
    _, fares_msg = P.feeds(spark, sf_dir)
    return decode_fares(fares_msg).select("partitionKey", "messageData")


@register("partition_key", base_cte() + """
SELECT hackLicense, partitionKey, concat_ws('_', medallion, hackLicense, vendorId) AS partition_key
FROM f WHERE NOT ride_bad
""")
def q_partition_key(spark, sf_dir):
    """Message key rebuilt from the decoded ride equals the envelope key."""
    rides_msg, _ = P.feeds(spark, sf_dir)
    d = decode_rides(rides_msg).filter(F.col("errorMessage").isNull())
    from ..operators.ingest import partition_key
    return d.select("ride.hackLicense", "partitionKey",
                    partition_key(F.col("ride.medallion"), F.col("ride.hackLicense"),
                                  F.col("ride.vendorId")).alias("partition_key"))


# ---------------------------------------------------------------- telemetry helpers

@register("rfc1123_date", """
SELECT event_id, strftime(ts, '%a, %-d %b %Y %H:%M:%S GMT') AS date_value FROM events
""")
def q_rfc1123_date(spark, sf_dir):
    ensure_utc(spark)
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", rfc1123(F.col("ts")).alias("date_value"))


@register("metric_tags", """
SELECT event_id, k AS tag_key, v AS tag_value FROM (
  SELECT event_id, 'app' AS k, 'cabstat' AS v FROM events
  UNION ALL SELECT event_id, 'event_type', event_type FROM events
  UNION ALL SELECT event_id, 'user_id', CAST(user_id AS VARCHAR) FROM events
  UNION ALL SELECT event_id, 'value', CAST(value AS VARCHAR) FROM events)
""")
def q_metric_tags(spark, sf_dir):
    """Context tags (app, event_type=ctx) merged into per-event metric maps;
    the event's own ``event_type`` overrides the context's."""
    ev = table(spark, sf_dir, "events")
    ctx = F.create_map(F.lit("app"), F.lit("cabstat"), F.lit("event_type"), F.lit("ctx"))
    m = F.create_map(F.lit("event_type"), F.col("event_type"),
                     F.lit("user_id"), F.col("user_id").cast("string"),
                     F.lit("value"), F.col("value").cast("string"))
    merged = ev.select("event_id", merge_tags(ctx, m).alias("tags"))
    return merged.select("event_id", F.explode("tags").alias("tag_key", "tag_value"))


# query groups defined in sibling modules register themselves on import
from . import csv_queries  # noqa: E402,F401
from . import ingest_queries  # noqa: E402,F401
from . import stream_queries  # noqa: E402,F401
from . import geo_queries  # noqa: E402,F401
