"""Message feeds as streaming DataFrames: ``body BINARY`` plus envelope."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schemas import MESSAGE_SCHEMA


def file_feed(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Parquet message files as a stream, read from the start. Progress (the
    consumer-group offset) is the query checkpoint."""
    r = spark.readStream.schema(MESSAGE_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def kafka_feed(spark: SparkSession, servers: str, topic: str, starting_offsets: str = "earliest",
               options: dict[str, str] | None = None, consumer_group: str | None = None) -> DataFrame:
    """Same envelope from a Kafka topic, read from the start (needs the Kafka
    connector on the classpath; it is not in this image, so only the file
    feed is tested). Progress lives in the query checkpoint; a consumer group
    other than the default is passed as ``kafka.group.id``."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", starting_offsets))
    if consumer_group and consumer_group != "$Default":
        r = r.option("kafka.group.id", consumer_group)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load().select(F.col("value").alias("body"), F.col("key").cast("string").alias("partitionKey"),
                           F.col("timestamp").alias("enqueuedTime"))


#: Messages a file, as a bus capture cuts them; files are what readers split over. A feed of more than so many
#: files gets larger ones, of up to so many messages; only then it gets more.
FEED_FILE_ROWS, FEED_FILES, LARGE_FILE_ROWS = 10_000, 200, 200_000


def feed_files(rows: int) -> int:
    """Files of a feed of so many messages."""
    return max(1, min(-(-rows // FEED_FILE_ROWS), FEED_FILES), -(-rows // LARGE_FILE_ROWS))


def write_feed(messages: DataFrame, path: str, partition: str | None = None, file_rows: int = FEED_FILE_ROWS) -> None:
    """Persist a (batch) message feed as parquet files for the file source."""
    w = messages.write.mode("error").option("maxRecordsPerFile", file_rows)
    if partition:
        w = w.partitionBy(partition)
    w.parquet(path)


#: Micro-batches that a backlog is taken in, the files one takes at least, and the bytes it takes for each core at most.
BACKLOG_BATCHES, LEAST_FILES, CORE_BYTES = 8, 4, 16 << 20


def files_per_trigger(spark: SparkSession, path: str) -> int:
    """Files of a backlog to take per trigger. What a micro-batch costs whatever its rows (its plan, its state
    stores' commits, its tasks' results) is then paid a few times, not once for every few files; a core's
    share of a micro-batch, and so of its state, stays bounded: a larger backlog takes more of them."""
    held = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = held.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(held)
    n, size = int(found.getFileCount()), int(found.getLength())
    room = spark.sparkContext.defaultParallelism * CORE_BYTES
    return max(LEAST_FILES, min(-(-n // BACKLOG_BATCHES), room * n // max(1, size)))


def stamp_in_order(spark: SparkSession, path: str) -> None:
    """File feeds take files by modification time; give a folder's files the order of their names."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files = sorted((f.getPath() for f in fs.listStatus(folder) if f.isFile()), key=lambda f: f.getName())
    first = (int(time.time()) - len(files)) * 1000
    for k, f in enumerate(files):
        fs.setTimes(f, first + 1000 * k, -1)


def write_feeds(messages: DataFrame, root: str) -> tuple[str, str]:
    """Write a two-feed message frame (``feed`` = rides / fares, e.g.
    ``sources.feeds.both_feeds``) partitioned by feed; returns the ride and fare folders for
    :func:`file_feed`. Files are cut by ``enqueuedTime`` at the same points in both
    feeds and taken in that order, so a job that reads a few of them per
    trigger sees event time advance in both, as it does behind a message bus."""
    return _write_dealt(messages, root, "enqueuedTime", -(-messages.count() // 2), lambda dealt: dealt)


def write_feeds_of(rows: DataFrame, root: str, at: str, messages: Callable[[DataFrame], DataFrame]) -> tuple[str, str]:
    """:func:`write_feeds` of the messages that a projection makes of rows, one a feed for each. ``at`` is what becomes
    ``enqueuedTime``: the rows are dealt by it first, so messages, which are several times larger, are not shuffled."""
    return _write_dealt(rows, root, at, rows.count(), messages)


def _write_dealt(rows: DataFrame, root: str, at: str, count: int, messages: Callable[[DataFrame], DataFrame]) -> tuple[str, str]:
    n = feed_files(count)
    # ranges are only about equal: a larger one is not cut for a few rows
    write_feed(messages(rows.repartitionByRange(n, at)), root, "feed", 2 * max(1, -(-count // n)))
    folders = f"{root}/feed=rides", f"{root}/feed=fares"
    for folder in folders:
        stamp_in_order(rows.sparkSession, folder)
    return folders
