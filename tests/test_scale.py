"""Plan-shape and skew behaviour that matters at scale."""

import datetime as dt
import re

from pyspark.sql import functions as F

from cabstat.operators import trips as TR
from cabstat.operators.ingest import publish_fares, write_messages
from cabstat.schemas import POLYGON_SCHEMA
from cabstat.session import scratch_path
from cabstat.sources.polygons import read_layer

T0 = dt.datetime(2024, 1, 1, 10)
KEYS = ["medallion", "hackLicense", "vendorId", "pickupTime"]


def rows_shuffled(df):
    """Rows written by every exchange of an executed DataFrame."""
    def walk(node, out):
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan(), out)
        if "QueryStageExec" in node.getClass().getSimpleName():
            return walk(node.plan(), out)
        if node.getClass().getSimpleName() == "ShuffleExchangeExec":
            out.append(node.metrics().apply("shuffleRecordsWritten").value())
        kids = node.children()
        for i in range(kids.size()):
            walk(kids.apply(i), out)
        return out
    return walk(df._jdf.queryExecution().executedPlan(), [])


def test_hot_key_is_not_multiplied(spark):
    """One key holds a third of all rides and fares: the stats plan joins
    pre-aggregated groups on both sides, so it never builds n x m rows."""
    n_hot, n_cold = 300, 600
    rides = spark.createDataFrame(
        [(1, 1, "H", T0, "A", 1.0)] * n_hot + [(i, i, "C", T0, "B", 2.0) for i in range(2, n_cold + 2)],
        "medallion BIGINT, hackLicense BIGINT, vendorId STRING, pickupTime TIMESTAMP, pickupNeighborhood STRING, "
        "tripDistanceInMiles DOUBLE")
    fares = spark.createDataFrame(
        [(1, 1, "H", T0, 2.0, 0.5, 3.0)] * n_hot + [(i, i, "C", T0, 4.0, 1.0, 5.0) for i in range(2, n_cold + 2)],
        "medallion BIGINT, hackLicense BIGINT, vendorId STRING, pickupTime TIMESTAMP, fareAmount DOUBLE, "
        "tipAmount DOUBLE, totalAmount DOUBLE")
    stats = {r["neighborhood"]: r for r in TR.neighborhood_stats_preaggregated(rides, fares).collect()}
    assert stats["A"]["number_of_rides"] == n_hot * n_hot
    assert stats["A"]["total_fare_amount"] == 2.0 * n_hot * n_hot
    assert stats["B"]["number_of_rides"] == n_cold
    # the join inside the plan sees one row per (key, neighbourhood) on each side
    plan = TR.trip_aggregates(rides, fares)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") >= 3
    tpm = {r["neighborhood"]: r["tip_per_mile"] for r in TR.tip_per_mile(rides, fares).collect()}
    assert tpm["A"] == 0.5 / 1.0


def test_write_messages_and_parquet_layer(spark):
    fares = spark.createDataFrame([(1, 2, "V", "1,2,V,2024-01-01 00:00:00,CRD,1,0,0,0,0,1")],
                                  "medallion BIGINT, hackLicense BIGINT, vendorId STRING, csvLine STRING")
    path = scratch_path(spark, "pub")
    write_messages(publish_fares(fares), path)
    back = spark.read.parquet(path).first()
    assert back["key"] == "1_2_V" and bytes(back["body"]).decode().endswith("\r\n1,2,V,2024-01-01 00:00:00,CRD,1,0,0,0,0,1")
    lay = spark.createDataFrame([(7, "Sq", [[{"x": 0.0, "y": 0.0}, {"x": 1.0, "y": 0.0}, {"x": 1.0, "y": 1.0}]])],
                                POLYGON_SCHEMA)
    lpath = scratch_path(spark, "layer-pq")
    lay.write.parquet(lpath)
    assert read_layer(spark, lpath, "parquet").first()["name"] == "Sq"


def test_stats_plan_shuffles(spark):
    """With broadcasts off (large feeds): both sides are partially aggregated
    before their first exchange; the join reuses the fare aggregate's
    partitioning and re-keys the (already aggregated) ride groups."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        # plain rows (no known unique key) with non-constant columns, so Catalyst
        # can neither fold a grouping key away nor skip an aggregate's shuffle
        rides = spark.createDataFrame(
            [(i % 20, i % 20, f"V{i % 2}", T0 + dt.timedelta(minutes=i % 20), f"N{i % 3}", 1.0) for i in range(50)],
            "medallion BIGINT, hackLicense BIGINT, vendorId STRING, pickupTime TIMESTAMP, "
            "pickupNeighborhood STRING, tripDistanceInMiles DOUBLE")
        fares = rides.select(*KEYS, F.lit(1.0).alias("fareAmount"), F.lit(0.1).alias("tipAmount"),
                             F.lit(1.1).alias("totalAmount"))
        df = TR.neighborhood_stats_preaggregated(rides, fares)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        # rides: aggregate + re-key, fares: 1, window aggregate: 1
        assert plan.count("Exchange hashpartitioning") == 4
        assert plan.count("partial_count") == 2                 # map-side combine on both sides
        assert "SortMergeJoin" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_key_collapses_before_the_shuffle(spark):
    """A key with a third of the rides reaches the join as a handful of rows:
    partial aggregation runs before the first exchange, so no task receives
    the hot key's rows."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hot = spark.range(3000).select(F.lit(1).cast("bigint").alias("medallion"),
                                       F.lit(1).cast("bigint").alias("hackLicense"), F.col("id"))
        cold = spark.range(2, 6002).select(F.col("id").alias("medallion"), F.col("id").alias("hackLicense"), "id")
        rides = hot.unionByName(cold).repartition(4).select(
            "medallion", "hackLicense", F.lit("V").alias("vendorId"), F.lit(T0).cast("timestamp").alias("pickupTime"),
            F.lit("A").alias("pickupNeighborhood"), (F.col("id") % 7 + 0.5).alias("tripDistanceInMiles"))
        fares = spark.range(1, 6002).select(F.col("id").alias("medallion"), F.col("id").alias("hackLicense"),
                                            F.lit("V").alias("vendorId"), F.lit(T0).cast("timestamp").alias("pickupTime"),
                                            F.lit(2.0).alias("fareAmount"), F.lit(0.5).alias("tipAmount"),
                                            F.lit(3.0).alias("totalAmount"))
        df = TR.neighborhood_stats_preaggregated(rides, fares)
        row = df.collect()[0]
        assert row["number_of_rides"] == 9000 and row["total_fare_amount"] == 2.0 * 9000
        # rows that the ride-side partial aggregate hands to its exchange: the hot
        # key's 3000 rides become one row per input partition
        written = rows_shuffled(df)
        written.remove(9000)     # the test's own repartition
        assert max(written) <= 6000 + 4 * 2, written
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_scans_read_only_referenced_columns(spark, sf_small):
    """Column pruning reaches the parquet scan: tagging reads events.event_id
    alone (coordinates derive from it), decoding the body and key of messages."""
    from cabstat.plans.catalog import QUERIES
    for name, file, expected in (("point_in_polygon", "events.parquet", "[event_id]"),
                                 ("classify_ride_errors", "feed=rides", "[body,partitionKey]")):
        df = QUERIES[name](spark, sf_small)
        plan = df._jdf.queryExecution().executedPlan().toString()
        scans = [re.sub(r"#\d+L?", "", ln) for ln in plan.split("\n") if "FileScan parquet" in ln]
        assert any(f"FileScan parquet {expected}" in ln for ln in scans), (file, scans)


def test_feeds_are_dealt_before_messages_are_built(spark, sf_small, monkeypatch):
    """The shuffle of the feeds carries events, not messages, and their files grow only beyond a number of them."""
    from cabstat.session import scratch_path
    from cabstat.sources.feeds import both_feeds
    from cabstat.sources.tables import table
    from cabstat.streaming import sources as S

    assert [S.feed_files(n) for n in (0, 1, 10_001, 2_000_000, 36_000_000, 100_000_000)] == [1, 1, 2, 200, 200, 500]
    monkeypatch.setattr(S, "FEED_FILE_ROWS", 100)
    events, dealt = table(spark, sf_small, "events"), []

    def messages(rows):
        dealt.append(rows)
        return both_feeds(rows)

    made = S.write_feeds_of(events, scratch_path(spark, "dealt"), "ts", messages)
    assert dealt[0].columns == events.columns and dealt[0].rdd.getNumPartitions() == 10
    plain = S.write_feeds(both_feeds(events), scratch_path(spark, "plain"))
    for a, b in zip(made, plain):
        got, want = (sorted(map(repr, spark.read.parquet(x).collect())) for x in (a, b))
        assert got == want and len(got) == 1000
