"""Durable counters of messages and malformed messages, one record a (query, batch), last write wins.

The record is written as part of the micro-batch, before Spark commits it. A batch that is killed and
runs again replaces its own record, so totals are those of the committed input, however often a
job restarts; nothing is kept on the driver.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.quality import decode_fares, decode_rides
from .store import Folder

COUNTS_DDL = "query STRING, batch_id BIGINT, feed STRING, messages BIGINT, malformed BIGINT"


def classified(ride_msgs: DataFrame, fare_msgs: DataFrame) -> DataFrame:
    """``feed, malformed`` of every message of both feeds."""
    one = lambda df, feed: df.select(F.lit(feed).alias("feed"), F.col("errorMessage").isNotNull().alias("malformed"))
    return one(decode_rides(ride_msgs), "rides").unionByName(one(decode_fares(fare_msgs), "fares"))


class CounterSink:
    """``foreachBatch`` sink over :func:`classified` rows; records go to ``<path>/<query>-<batch>.json``.

    Put ``path`` next to the checkpoint: both must outlive the job together."""

    def __init__(self, path: str, query: str | None = None):
        self.path, self.query = path.rstrip("/"), query

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        query = self.query or batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"
        counts = batch.groupBy("feed").agg(F.count("*").alias("messages"), F.count_if("malformed").alias("malformed"))
        lines = [json.dumps({"query": query, "batch_id": batch_id, **r.asDict()}) for r in counts.collect()]   # a row a feed
        Folder(self.path).put(f"{query}-{batch_id:020d}.json", "\n".join(lines).encode())


def read_counters(spark: SparkSession, path: str) -> DataFrame:
    """All records: query, batch_id, feed, messages, malformed."""
    return spark.read.schema(COUNTS_DDL).json(path)
