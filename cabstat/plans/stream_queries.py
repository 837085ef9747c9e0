"""Structured Streaming queries. Each run writes the derived feeds as message
files under the checkpoint root, runs the stream once (``availableNow``) with
a fresh checkpoint, and returns what the sink holds as a batch DataFrame."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import JobConfig
from ..operators.quality import decode_fares, decode_rides, valid_rides
from ..schemas import MESSAGE_SCHEMA
from ..session import ensure_utc, scratch_path
from ..sources.feeds import ride_messages
from ..sources.tables import table
from ..streaming import job as J
from ..streaming.checkpoints import batch_offsets, join_state_rows, late_rows
from ..streaming.counters import CounterSink, classified, read_counters
from ..streaming.message_log import append_messages, log_feed, run_until_caught_up
from ..streaming.row_sink import EpochRows, PartitionRows, read_epoch_rows, read_partition_rows, row_sink, start_rows
from ..streaming.sinks import KeyedUpsertSink, read_keyed_table
from ..streaming.sources import file_feed, files_per_trigger
from ..streaming.telemetry import MetricsListener, last_of_each_batch
from ..streaming.versioned import VersionedTable
from . import batch_job as P
from .catalog import STATS_ORACLE, register
from .oracle_sql import base_cte

CFG = JobConfig(neighborhood_layer="nation")


def _cores(spark: SparkSession) -> int:
    """State partitions for these runs: one per core of the application."""
    return spark.sparkContext.defaultParallelism


def _run(df: DataFrame, name: str, sink=None) -> str:
    spark = df.sparkSession
    out, ckpt = scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-ckpt")
    with J.state_partitions(spark, _cores(spark)):
        q = J.start(df, f"{name}_{ckpt[-12:]}", ckpt, sink=sink(out) if sink else None, path=out)
        J.run_to_end(q)
    return out


# windows closed by the final watermark: min over both valid feeds of max event time - 3 min
CLOSED = """
, wm AS (SELECT least((SELECT max(pt) FROM f WHERE NOT ride_bad),
                      (SELECT max(pt) FROM f WHERE NOT fare_bad)) - INTERVAL 3 MINUTE AS w)
SELECT * FROM stats WHERE window_end <= (SELECT w FROM wm)
"""
STREAM_STATS_ORACLE = STATS_ORACLE.replace("\nSELECT pickupNeighborhood AS neighborhood", ", stats AS (\nSELECT pickupNeighborhood AS neighborhood").rstrip() + "\n)" + CLOSED


def _feed(spark: SparkSession, folder: str) -> DataFrame:
    """A feed as a stream, in several micro-batches."""
    return file_feed(spark, folder, files_per_trigger(spark, folder))


def _both(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Both feeds as streams. They have the same cuts, so they take the same number of files per trigger."""
    ensure_utc(spark)
    folders = P.feed_folders(spark, sf_dir)
    files = min(files_per_trigger(spark, folder) for folder in folders)
    return [file_feed(spark, folder, files) for folder in folders]


@register("neighborhood_stats_stream", STREAM_STATS_ORACLE)
def q_neighborhood_stats_stream(spark, sf_dir):
    """The streaming job end to end, appended to parquet; closed windows only."""
    stats = J.stats_stream(*_both(spark, sf_dir), P.neighborhood_index(spark, sf_dir), CFG)
    return spark.read.parquet(_run(stats, "stats"))


@register("neighborhood_stats_stream_by_row", STREAM_STATS_ORACLE)
def q_neighborhood_stats_stream_by_row(spark, sf_dir):
    """The same over the joined trips: join state holds both feeds' rows."""
    stats = J.stats_stream_by_row(*_both(spark, sf_dir), P.neighborhood_index(spark, sf_dir), CFG)
    return spark.read.parquet(_run(stats, "stats-by-row"))


@register("keyed_upsert", STREAM_STATS_ORACLE)
def q_keyed_upsert(spark, sf_dir):
    """The streaming job into the keyed, versioned table: one version per micro-batch, last write wins."""
    stats = J.stats_stream(*_both(spark, sf_dir), P.neighborhood_index(spark, sf_dir), CFG)
    return read_keyed_table(spark, _run(stats, "upsert", KeyedUpsertSink))


@register("row_sink", STREAM_STATS_ORACLE)
def q_row_sink(spark, sf_dir):
    """The streaming job through open / process / close per (partition, epoch), with a commit per epoch."""
    stats = J.stats_stream(*_both(spark, sf_dir), P.neighborhood_index(spark, sf_dir), CFG)
    out = scratch_path(spark, "row-sink")
    form = row_sink(spark, EpochRows(out), "stats_rows")
    with J.state_partitions(spark, _cores(spark)):
        J.run_to_end(J.start(stats, f"rows_{out[-12:]}", scratch_path(spark, "row-sink-ckpt"), fmt=form))
    return read_epoch_rows(spark, out)


@register("row_sink_foreach", STREAM_STATS_ORACLE)
def q_row_sink_foreach(spark, sf_dir):
    """The same contract through ``writeStream.foreach``: rows are shown per partition."""
    stats = J.stats_stream(*_both(spark, sf_dir), P.neighborhood_index(spark, sf_dir), CFG)
    out = scratch_path(spark, "row-foreach")
    with J.state_partitions(spark, _cores(spark)):
        J.run_to_end(start_rows(stats, PartitionRows(out), f"foreach_{out[-12:]}", scratch_path(spark, "row-foreach-ckpt")))
    return read_partition_rows(spark, out)


@register("trip_join_stream", base_cte() + """
SELECT medallion, hackLicense, vendorId, pt AS pickupTime, fareAmount, tipAmount, totalAmount,
       pickupNeighborhood, dropoffNeighborhood
FROM trips
""")
def q_trip_join_stream(spark, sf_dir):
    """Stream-stream inner join under watermarks; every matching pair emitted."""
    trips = J.trip_stream(*_both(spark, sf_dir), P.neighborhood_index(spark, sf_dir), CFG).select(
        "medallion", "hackLicense", "vendorId", F.col("pickupTime").cast("timestamp_ntz").alias("pickupTime"),
        "fareAmount", "tipAmount", "totalAmount", "pickupNeighborhood", "dropoffNeighborhood")
    return spark.read.parquet(_run(trips, "tripjoin"))


@register("neighborhood_tag_stream", base_cte() + """
SELECT hackLicense, pickupNeighborhood, dropoffNeighborhood FROM f WHERE NOT ride_bad
""")
def q_neighborhood_tag_stream(spark, sf_dir):
    """Stream-static join of the ride stream with the tile table."""
    rides, _ = P.feed_folders(spark, sf_dir)
    r = J.watermarked_rides(_feed(spark, rides), P.neighborhood_index(spark, sf_dir))
    r = r.select("hackLicense", "pickupNeighborhood", "dropoffNeighborhood")
    return spark.read.parquet(_run(r, "tag"))


@register("stream_scan", base_cte() + """
SELECT partitionKey, CASE WHEN ride_bad THEN NULL ELSE hackLicense END AS hackLicense,
       CASE WHEN ride_bad THEN 'Error decoding JSON' END AS errorMessage
FROM f
""")
def q_stream_scan(spark, sf_dir):
    """Message files read as a stream from the start, some files per trigger."""
    rides, _ = P.feed_folders(spark, sf_dir)
    d = decode_rides(_feed(spark, rides))
    d = d.select("partitionKey", F.col("ride.hackLicense").alias("hackLicense"), "errorMessage")
    d = d.withColumn("hackLicense", F.when(F.col("errorMessage").isNull(), F.col("hackLicense")))
    return spark.read.parquet(_run(d, "scan"))


@register("message_log_scan", base_cte() + """
SELECT consumer_group, partitionKey, CASE WHEN ride_bad THEN NULL ELSE hackLicense END AS hackLicense, ride_bad AS bad
FROM f, (VALUES ('reports'), ('audit')) g(consumer_group)
""")
def q_message_log_scan(spark, sf_dir):
    """Ride messages through a partitioned log, read by two consumer groups: one takes a bounded number
    of messages per trigger, the other all at once."""
    ensure_utc(spark)
    path = scratch_path(spark, "ride-log")
    n = _cores(spark)
    rides = ride_messages(table(spark, sf_dir, "events"))
    append_messages(rides, path, n)
    limit = max(1, -(-rides.count() // (3 * n)))     # some three micro-batches
    found = []
    for group, most in (("reports", limit), ("audit", None)):
        d = decode_rides(log_feed(spark, path, group, max_messages_per_trigger=most))
        d = d.select(F.lit(group).alias("consumer_group"), "partitionKey",
                     F.when(F.col("errorMessage").isNull(), F.col("ride.hackLicense")).alias("hackLicense"),
                     F.col("errorMessage").isNotNull().alias("bad"))
        out, ckpt = scratch_path(spark, f"log-{group}"), scratch_path(spark, f"log-{group}-ckpt")
        run_until_caught_up(J.start(d, f"log_{ckpt[-12:]}", ckpt, path=out, available_now=False), (path, group))
        found.append(spark.read.parquet(out))
    return found[0].unionByName(found[1])


@register("upsert_versions", """
WITH o AS (SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice, year(o_orderdate) AS y,
                  dense_rank() OVER (ORDER BY year(o_orderdate)) AS made FROM orders),
v AS (SELECT DISTINCT made AS version FROM o),
r AS (SELECT version, o.*, row_number() OVER (PARTITION BY version, o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS k
      FROM o JOIN v ON made <= version)
SELECT CAST(version AS INTEGER) AS version, o_custkey, o_orderkey, o_totalprice FROM r WHERE k = 1
""")
def q_upsert_versions(spark, sf_dir):
    """Every customer's last order, upserted year by year into a keyed, versioned table and read back as
    of each version."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    years = sorted(r[0] for r in orders.select(F.year("o_orderdate")).distinct().collect())   # versions, a few
    held = VersionedTable(spark, scratch_path(spark, "last-orders"), ["o_custkey"], n_buckets=_cores(spark))
    for k, y in enumerate(years):
        held.merge(orders.filter(F.year("o_orderdate") == y), "orders", k, ["o_orderdate", "o_orderkey"])
    return reduce(DataFrame.unionByName, [
        held.read(v).select(F.lit(v).alias("version"), "o_custkey", "o_orderkey", "o_totalprice")
        for v in range(1, len(years) + 1)])


@register("progress_metrics", base_cte() + """
SELECT CAST(2 * count(*) AS BIGINT) AS input_rows, count(*) FILTER (WHERE ride_bad) AS rides_malformed,
       count(*) FILTER (WHERE fare_bad) AS fares_malformed
FROM f
""")
def q_progress_metrics(spark, sf_dir):
    """Totals over the progress rows of a streaming run (several micro-batches):
    input rows and the observed malformed counters."""
    listener = MetricsListener(spark, scratch_path(spark, "progress-rows"))
    spark.streams.addListener(listener)
    try:
        stats = J.stats_stream(*_both(spark, sf_dir), P.neighborhood_index(spark, sf_dir), CFG)
        out, ckpt = scratch_path(spark, "progress-out"), scratch_path(spark, "progress-ckpt")
        with J.state_partitions(spark, _cores(spark)):
            q = J.start(stats, f"progress_{ckpt[-12:]}", ckpt, path=out)
            J.run_to_end(q)
        listener.drain(q.runId)
    finally:
        spark.streams.removeListener(listener)
    rows = last_of_each_batch(listener.to_dataframe(spark))
    return rows.agg(F.sum("inputRows").alias("input_rows"),
                    F.sum(F.col("observed")["rides.malformed"]).alias("rides_malformed"),
                    F.sum(F.col("observed")["fares.malformed"]).alias("fares_malformed"))


@register("durable_counters", base_cte() + """
SELECT 'rides' AS feed, CAST(count(*) AS BIGINT) AS messages, count(*) FILTER (WHERE ride_bad) AS malformed FROM f
UNION ALL SELECT 'fares', count(*), count(*) FILTER (WHERE fare_bad) FROM f
""")
def q_durable_counters(spark, sf_dir):
    """Message and malformed counts of both feeds, recorded per (query, batch) with the batch itself."""
    path, ckpt = scratch_path(spark, "counters"), scratch_path(spark, "counters-ckpt")
    J.run_to_end(J.start(classified(*_both(spark, sf_dir)), f"counters_{ckpt[-12:]}", ckpt, sink=CounterSink(path)))
    return read_counters(spark, path).groupBy("feed").agg(F.sum("messages").alias("messages"), F.sum("malformed").alias("malformed"))


def _run_all(df: DataFrame, name: str) -> str:
    """Run a stream to its end; returns its checkpoint."""
    spark = df.sparkSession
    out, ckpt = scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-ckpt")
    with J.state_partitions(spark, _cores(spark)):
        J.run_to_end(J.start(df, f"{name}_{ckpt[-12:]}", ckpt, path=out))
    return ckpt


_WATERMARK = """
, wm AS (SELECT least((SELECT max(pt) FROM f WHERE NOT ride_bad),
                      (SELECT max(pt) FROM f WHERE NOT fare_bad)) - INTERVAL 3 MINUTE AS w)
"""


@register("combined_watermark", base_cte() + _WATERMARK + "SELECT w AS watermark FROM wm")
def q_combined_watermark(spark, sf_dir):
    """The watermark at which the job over both feeds ends: the smaller of the two feeds'."""
    stats = J.stats_stream(*_both(spark, sf_dir), P.neighborhood_index(spark, sf_dir), CFG)
    return batch_offsets(spark, _run_all(stats, "watermark")).agg(
        F.max("watermark").cast("timestamp_ntz").alias("watermark"))


@register("join_state_rows", base_cte() + _WATERMARK + """
SELECT 'rides' AS feed, CAST(count(*) AS BIGINT) AS before, count(*) FILTER (WHERE pt > w) AS after FROM f, wm WHERE NOT ride_bad
UNION ALL
SELECT 'fares', count(*), count(*) FILTER (WHERE pt > w) FROM f, wm WHERE NOT fare_bad
""")
def q_join_state_rows(spark, sf_dir):
    """Rows that the stream-stream join holds for each feed before and after the watermark has passed
    them, read from its state store."""
    ensure_utc(spark)
    feeds = [file_feed(spark, folder) for folder in P.feed_folders(spark, sf_dir)]     # one batch, then the watermark's
    ckpt = _run_all(J.stats_stream_by_row(*feeds, P.neighborhood_index(spark, sf_dir), CFG), "state")
    count = lambda side, batch, name: join_state_rows(spark, ckpt, batch, side).agg(F.count("*").alias(name))
    each = [count(side, 0, "before").crossJoin(count(side, 1, "after")).select(F.lit(feed).alias("feed"), "before", "after")
            for side, feed in (("left", "rides"), ("right", "fares"))]
    return each[0].unionByName(each[1])


#: Events with this remainder are delivered late, after all others.
LATE = 10


@register("late_rows", base_cte() + f"""
, w AS (SELECT max(pt) - INTERVAL 3 MINUTE AS watermark FROM f WHERE NOT ride_bad AND event_id % {LATE} <> 0),
late AS (SELECT hackLicense, pt AS pickupTime, watermark FROM f, w WHERE NOT ride_bad AND event_id % {LATE} = 0 AND pt <= watermark)
SELECT hackLicense, pickupTime, watermark, CAST(count(*) OVER () AS BIGINT) AS dropped FROM late
""")
def q_late_rows(spark, sf_dir):
    """Rides that come after the watermark has passed them: the rows, from the query's checkpoint and its
    input files, next to the number that its state operators say they dropped."""
    ensure_utc(spark)
    path, ckpt, out = (scratch_path(spark, f"late-{x}") for x in ("rides", "ckpt", "out"))
    events = table(spark, sf_dir, "events")
    listener = MetricsListener(spark, scratch_path(spark, "late-progress"))
    spark.streams.addListener(listener)
    try:
        for part in (F.col("event_id") % LATE != 0, F.col("event_id") % LATE == 0):     # on time, then late
            ride_messages(events.filter(part)).write.mode("append").parquet(path)
            rides = valid_rides(file_feed(spark, path)).withWatermark("pickupTime", CFG.ride_watermark_interval)
            with J.state_partitions(spark, _cores(spark)):
                q = J.start(rides.groupBy("hackLicense", "pickupTime").count(), f"late_{ckpt[-12:]}", ckpt, path=out)
                J.run_to_end(q)
            listener.drain(q.runId)
    finally:
        spark.streams.removeListener(listener)
    rows = spark.read.schema(MESSAGE_SCHEMA).parquet(path).withColumn("file_path", F.col("_metadata.file_path"))
    rides = decode_rides(rows).filter("errorMessage IS NULL").select("file_path", "ride.hackLicense", "ride.pickupTime")
    ntz = lambda c: F.col(c).cast("timestamp_ntz")
    late = late_rows(spark, ckpt, rides, F.col("pickupTime")).select(
        "hackLicense", ntz("pickupTime").alias("pickupTime"), ntz("late_watermark").alias("watermark"))
    said = last_of_each_batch(listener.to_dataframe(spark)).agg(F.sum("lateRows").alias("dropped"))
    return late.crossJoin(F.broadcast(said))      # one row


@register("termination_errors", base_cte() + """
SELECT 'rides' AS feed, bool_or(ride_bad) AS failed FROM f UNION ALL SELECT 'fares', bool_or(fare_bad) FROM f
""")
def q_termination_errors(spark, sf_dir):
    """Both feeds decoded strictly, by queries that a malformed message ends: what the listener recorded of
    their ends."""
    rides, fares = _both(spark, sf_dir)
    strict = lambda d: d.select(F.when(F.col("errorMessage").isNotNull(), F.raise_error(
        F.concat(F.lit("malformed: "), F.col("errorMessage")))).alias("nothing"))
    listener = MetricsListener(spark, scratch_path(spark, "ends"))
    spark.streams.addListener(listener)
    runs = {}
    try:
        for feed, decoded in (("rides", decode_rides(rides)), ("fares", decode_fares(fares))):
            q = J.start(strict(decoded), f"strict_{feed}_{scratch_path(spark, 'x')[-12:]}", scratch_path(spark, "strict"), fmt="noop")
            try:
                J.run_to_end(q)
            except Exception:      # what ended it is in the listener's rows
                pass
            runs[str(q.runId)] = feed
            listener.drain(q.runId)
    finally:
        spark.streams.removeListener(listener)
    listener.flush()
    ends = spark.createDataFrame([(k, v) for k, v in runs.items()], "run_id STRING, feed STRING")
    try:
        said = listener.to_dataframe(spark).filter("event = 'terminated' AND error LIKE '%malformed: %'").select("run_id").distinct()
        return ends.join(said.withColumn("failed", F.lit(True)), "run_id", "left").select("feed", F.coalesce("failed", F.lit(False)).alias("failed"))
    except AnalysisException:      # no row was ever written
        return ends.select("feed", F.lit(False).alias("failed"))


@register("configured_stats", STATS_ORACLE.replace("date_trunc('hour', pt) + INTERVAL 1 HOUR", "time_bucket(INTERVAL 30 MINUTE, pt) + INTERVAL 30 MINUTE"))
def q_configured_stats(spark, sf_dir):
    """The batch job with the window that its parameters set."""
    cfg = JobConfig.from_args(["-n", "nation", "--window-interval", "interval 30 minutes"]).validated(spark)
    return P.stats(spark, sf_dir, cfg.window_interval)
