"""The per-row sink contract: ``open(partition, epoch)``, ``process(row)``, ``close(error)``.

Two ways to run an object with these methods, once per (partition, epoch):

* :func:`start_rows` hands it to ``writeStream.foreach``. There is no step for
  a whole epoch, so :class:`PartitionRows` shows a partition's rows when it is closed.
* :func:`row_sink` makes it a streaming data source with a commit on the driver:
  :class:`EpochRows` shows an epoch's rows all at once, when every partition has
  closed without an error and Spark commits the epoch.

In both, rows are staged under a name of their own first, so a task that fails, is
lost or runs twice leaves no row, and ``open`` refuses what is already shown, so a
replayed epoch writes nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery

from .store import Folder

# The columns a row is stored under, and where they are in a job's row
# of 8 (window start, window end, neighbourhood, values); a row of 7 has them in order.
COLUMNS = ["neighborhood", "window_end", "number_of_rides", "total_fare_amount", "total_tip_amount",
           "average_fare_amount", "average_tip_amount"]
WIDE = [2, 1, 3, 4, 5, 6, 7]
ROWS_DDL = ("neighborhood STRING, window_end TIMESTAMP_NTZ, number_of_rides BIGINT, total_fare_amount DOUBLE, "
            "total_tip_amount DOUBLE, average_fare_amount DOUBLE, average_tip_amount DOUBLE")


class RowWriter:
    """What a sink implements. An object is sent to every task, and used for one partition of one epoch."""

    def open(self, partition_id: int, epoch_id: int) -> bool:
        """False: the partition's rows are not wanted (again)."""
        return True

    def process(self, row) -> None:
        raise NotImplementedError

    def close(self, error: BaseException | None) -> None:
        """Called once after ``open``, with what went wrong, if anything did."""

    # only used by row_sink, on the driver: what the closed partitions of an epoch left
    def result(self):
        return None

    def commit(self, epoch_id: int, results: list) -> None:
        pass

    def abort(self, epoch_id: int, results: list) -> None:
        pass


class _StagedRows(RowWriter):
    """Rows as JSON lines in a staged file, columns taken by position."""

    def __init__(self, directory: str, columns: Sequence[str] = COLUMNS, wide: Sequence[int] = WIDE):
        self.folder = Folder(directory)
        self.columns, self.wide = list(columns), list(wide)

    def _stage(self, name: str) -> None:
        self.staged, self.rows = name, 0
        self.out = self.folder.create(name)

    def process(self, row) -> None:
        at = range(len(self.columns)) if len(row) == len(self.columns) else self.wide
        record = {name: row[k] for name, k in zip(self.columns, at) if row[k] is not None}
        self.out.write(json.dumps(record, default=lambda v: v.isoformat()).encode() + b"\n")
        self.rows += 1


class PartitionRows(_StagedRows):
    """Shows ``epoch=<e>/part-<p>.json`` when the partition is closed without an error."""

    def open(self, partition_id: int, epoch_id: int) -> bool:
        self.shown = f"epoch={epoch_id}/part-{partition_id:05d}.json"
        if self.folder.exists(self.shown):
            return False
        self._stage(f"_staged/{epoch_id}-{partition_id}-{uuid.uuid4().hex}")
        return True

    def close(self, error: BaseException | None) -> None:
        if getattr(self, "out", None) is None:    # never opened, or refused
            return
        self.out.close()
        if error is not None or not self.folder.move_if_absent(self.staged, self.shown):
            self.folder.delete(self.staged)


class EpochRows(_StagedRows):
    """Shows the rows of all partitions at once: an epoch's commit file names their files."""

    @staticmethod
    def _commit_file(epoch_id: int) -> str:
        return f"_commits/{epoch_id:020d}.json"

    def open(self, partition_id: int, epoch_id: int) -> bool:
        if self.folder.exists(self._commit_file(epoch_id)):
            return False
        self._stage(f"rows/{epoch_id}-{partition_id}-{uuid.uuid4().hex}.json")
        return True

    def close(self, error: BaseException | None) -> None:
        if getattr(self, "out", None) is None:
            return
        self.out.close()
        if error is not None or not self.rows:
            self.folder.delete(self.staged)

    def result(self):
        return (self.staged, self.rows) if getattr(self, "rows", 0) else None

    def commit(self, epoch_id: int, results: list) -> None:
        files = [name.rsplit("/", 1)[1] for name, _ in filter(None, results)]
        record = {"epoch": epoch_id, "files": files, "rows": sum(n for _, n in filter(None, results))}
        if not self.folder.put_if_absent(self._commit_file(epoch_id), json.dumps(record).encode()):
            self.abort(epoch_id, results)     # another run of the epoch was first

    def abort(self, epoch_id: int, results: list) -> None:
        for name, _ in filter(None, results):
            self.folder.delete(name)


def read_partition_rows(spark: SparkSession, directory: str, schema: str = ROWS_DDL) -> DataFrame:
    """What :class:`PartitionRows` shows."""
    return spark.read.schema(schema).json(directory).drop("epoch")


def read_epoch_rows(spark: SparkSession, directory: str, schema: str = ROWS_DDL) -> DataFrame:
    """What :class:`EpochRows` shows: rows of the files that commit files name."""
    folder = Folder(directory)
    if not folder.names("_commits") or not folder.names("rows"):
        return spark.createDataFrame([], schema)
    named = spark.read.schema("files ARRAY<STRING>").json(f"{directory}/_commits").select(F.explode("files").alias("file_"))
    rows = spark.read.schema(schema).json(f"{directory}/rows").withColumn("file_", F.col("_metadata.file_name"))
    return rows.join(named, "file_", "left_semi").drop("file_")


def start_rows(df: DataFrame, writer: RowWriter, name: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Run the writer on every row through ``writeStream.foreach``."""
    w = df.writeStream.queryName(name).outputMode("append").option("checkpointLocation", checkpoint).foreach(writer)
    return (w.trigger(availableNow=True) if available_now else w).start()


@dataclass
class _Closed(WriterCommitMessage):
    result: object = field(default=None)


def row_sink(spark: SparkSession, writer: RowWriter, name: str) -> str:
    """Register a streaming data source that runs the writer; returns its format name.

    ``write`` runs in tasks: open, process every row, close. ``commit`` and ``abort`` run
    on the driver, once per epoch, with the results of the partitions that closed.
    """
    class Runs(DataSourceStreamWriter):
        def write(self, iterator: Iterator) -> WriterCommitMessage:
            task = TaskContext.get()
            if not writer.open(task.partitionId(), int(task.getLocalProperty("streaming.sql.batchId"))):
                return _Closed()
            error: BaseException | None = None
            try:
                for row in iterator:
                    writer.process(row)
            except BaseException as e:
                error = e
                raise
            finally:
                writer.close(error)
            return _Closed(writer.result())

        def commit(self, messages, batchId: int) -> None:
            writer.commit(batchId, [m.result for m in messages if m is not None])

        def abort(self, messages, batchId: int) -> None:
            writer.abort(batchId, [m.result for m in messages if m is not None])

    class Sink(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def streamWriter(self, schema, overwrite) -> DataSourceStreamWriter:
            return Runs()

    spark.dataSource.register(Sink)
    return name
