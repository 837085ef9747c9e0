"""``foreachBatch`` sink into a keyed, versioned table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..schemas import STATS_KEY
from .versioned import VersionedTable


class KeyedUpsertSink:
    """Upserts every micro-batch by key into a :class:`VersionedTable`, one version a batch.

    The writer is the streaming query (its id outlives restarts of one checkpoint), so a
    replayed batch changes nothing and a new checkpoint, whose batch numbers start again, is
    another writer. Every ``vacuum_every`` batches versions before the last ``keep`` are deleted,
    so neither folders nor read cost grow with the life of the job.
    """

    def __init__(self, path: str, key: list[str] = STATS_KEY, order_by: tuple[str, ...] = (), n_buckets: int = 64,
                 writer: str | None = None, vacuum_every: int = 100, keep: int = 10):
        self.path, self.key, self.order_by, self.n_buckets = path.rstrip("/"), list(key), order_by, n_buckets
        self.vacuum_every, self.keep = vacuum_every, keep
        self._writer, self._own = writer, uuid.uuid4().hex
        self._table: VersionedTable | None = None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if self._table is None:
            self._table = VersionedTable(spark, self.path, self.key, self.n_buckets)
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        made = self._table.merge(batch, self._writer or query or self._own, batch_id, self.order_by)
        if made is not None and made.version % self.vacuum_every == 0:
            self._table.vacuum(self.keep)


def read_keyed_table(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Rows of the table's newest version, or of a given one."""
    return VersionedTable(spark, path).read(version)
