"""Session helpers: tuned builder, UTC guard and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "cabstat") -> SparkSession:
    """Session with the settings the operators assume.

    On a cluster the master and most sizing come from spark-submit; this is
    what tests and the bench use.
    """
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("CABSTAT_DRIVER_MEMORY", "16g"))
        # large join / aggregation state lives off-heap in RocksDB
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        # commit a changelog per batch instead of uploading a snapshot each time
        .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Event times in the feeds are UTC wall clock; parse and bucket them in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names for checkpoints.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir).
    Only when neither is set and the master is ``local[...]`` is a private folder
    created and registered, so ``DataFrame.checkpoint()`` works too; on a
    cluster a missing setting is an error.
    """
    sc = spark.sparkContext
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None)
    if conf_dir:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(conf_dir)
        return conf_dir.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        # the context appends a random child; scratch lives next to it
        return current.rstrip("/").rsplit("/", 1)[0]
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="cabstat-ckpt-")
    sc.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path under the checkpoint root."""
    return f"{checkpoint_root(spark)}/cabstat/{label}-{uuid.uuid4().hex[:12]}"
