"""The streaming job as an application.

    spark-submit --py-files cabstat.zip cabstat/__main__.py \\
        --neighborhood-file-url /layers/nyc.geojson \\
        --ride-feed kafka://broker:9092/taxi-ride --fare-feed kafka://broker:9092/taxi-fare \\
        --sink-path /warehouse/neighborhoodstats

(or ``python -m cabstat ...`` where the driver runs locally with pyspark)

Feeds are parquet message folders, ``log:<path>`` (a partitioned message log, read under the consumer
group) or ``kafka://servers/topic``; results are upserted into a keyed table at ``--sink-path`` (read it with
``streaming.sinks.read_keyed_table``); progress rows are appended next to it.
"""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from .config import JobConfig
from .operators.geo import NeighborhoodIndex
from .session import checkpoint_root, ensure_utc
from .sources.polygons import read_layer
from .streaming import job as J
from .streaming.message_log import log_feed
from .streaming.sinks import KeyedUpsertSink
from .streaming.sources import file_feed, kafka_feed
from .streaming.telemetry import MetricsListener


def open_feed(spark: SparkSession, spec: str, consumer_group: str | None = None):
    if spec.startswith("kafka://"):
        servers, topic = spec[len("kafka://"):].split("/", 1)
        return kafka_feed(spark, servers, topic, consumer_group=consumer_group)
    if spec.startswith("log:"):
        return log_feed(spark, spec[len("log:"):], consumer_group or "$Default")
    return file_feed(spark, spec)


_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_DEFAULT_PROVIDER = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"


def prefer_rocksdb_state(spark: SparkSession) -> None:
    """Join and window state off the JVM heap, committed as changelogs, unless
    the cluster already chose a provider. Must precede the first checkpoint."""
    if spark.conf.get(_PROVIDER, _DEFAULT_PROVIDER) == _DEFAULT_PROVIDER:
        spark.conf.set(_PROVIDER, _ROCKSDB)
        spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def run(spark: SparkSession, cfg: JobConfig, listener: MetricsListener | None = None):
    """Start the job; returns the running query (``availableNow`` ones finish)."""
    cfg = cfg.validated(spark)
    prefer_rocksdb_state(spark)
    if not (cfg.ride_feed and cfg.fare_feed and cfg.sink_path):
        raise ValueError("ride_feed, fare_feed and sink_path are required")
    ensure_utc(spark)
    index = NeighborhoodIndex.build(read_layer(spark, cfg.neighborhood_layer, cfg.layer_format))
    stats = J.stats_stream(open_feed(spark, cfg.ride_feed, cfg.ride_consumer_group),
                           open_feed(spark, cfg.fare_feed, cfg.fare_consumer_group), index, cfg)
    checkpoint = cfg.checkpoint_path or f"{checkpoint_root(spark)}/cabstat/neighborhood_stats"
    if listener is not None:
        spark.streams.addListener(listener)
    if cfg.state_partitions:
        # read when the first batch is planned (then kept by the checkpoint):
        # set for the job's lifetime, as this process runs only this job
        spark.conf.set("spark.sql.shuffle.partitions", str(cfg.state_partitions))
    return J.start(stats, "neighborhood_stats_upsert", checkpoint, sink=KeyedUpsertSink(cfg.sink_path),
                   available_now=cfg.available_now)


def main(argv: list[str] | None = None) -> None:
    cfg = JobConfig.from_args(sys.argv[1:] if argv is None else argv)
    spark = SparkSession.builder.appName("cabstat").getOrCreate()
    listener = MetricsListener(spark, (cfg.sink_path or "").rstrip("/") + "_progress")
    query = run(spark, cfg, listener)
    try:
        query.awaitTermination()
    finally:
        listener.drain(query.runId)
