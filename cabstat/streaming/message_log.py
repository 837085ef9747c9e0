"""A partitioned message log as a streaming source and a batch sink.

Layout: ``partition=<p>/<first>-<last>.parquet``; a file's rows are the messages with the offsets
first to last of that partition. ``groups/<name>.json`` holds what a consumer group has been handed
and has finished, per partition.

Writing (:func:`append_messages`): tasks write one file per log partition and stretch of time under staged
names, and the commit on the driver, which knows the number of rows of each, gives them the next offsets,
in the order of the stretches, by renaming. A file is taken whole or not at all; a key's messages keep their order within a batch.

Reading (``format("message_log")``): options

* ``path``;
* ``group``: consumer group (default ``$Default``). Groups do not know of each other;
* ``startingPosition``: where a query without a checkpoint starts: ``earliest`` (default), ``latest`` or
  ``stored``, what the group has finished (earliest for a new group). A query with a checkpoint goes on
  from that, exactly;
* ``maxMessagesPerTrigger``: messages a micro-batch takes from each log partition at most. The first batch
  after a start may also take what the group was handed before. An ``availableNow`` run takes what
  one trigger admits; :func:`run_until_caught_up` lets a query with the default trigger take all.

Each file of a micro-batch's range is one task's work, read by column and row range.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamReader, InputPartition, WriterCommitMessage)
from pyspark.sql.streaming import StreamingQuery

from .store import Folder

FORMAT = "message_log"
SCHEMA = "partition INT, offset BIGINT, body BINARY, partitionKey STRING, enqueuedTime TIMESTAMP"
_MESSAGE = pa.schema([("body", pa.binary()), ("partitionKey", pa.string()), ("enqueuedTime", pa.timestamp("us", "UTC"))])
_ROWS = pa.schema([("partition", pa.int32()), ("offset", pa.int64()), *_MESSAGE])
_FILE = re.compile(r"([0-9]+)-([0-9]+)\.parquet$")
#: Messages a file of a batch that is appended, and files from which they get larger instead, up to so many messages.
FILE_ROWS, FILES, LARGE_FILE_ROWS = 100_000, 200, 500_000
#: Messages handed to Spark at once.
BATCH_ROWS = 5_000


@dataclass
class Segment(InputPartition):
    """Messages ``start`` to ``end`` (exclusive) of one partition that are in one file."""

    partition: int
    file: str
    first: int
    start: int
    end: int


class MessageLog:
    """Files and offsets of a log."""

    def __init__(self, path: str):
        self.folder = Folder(path)

    def partitions(self) -> list[int]:
        return sorted(int(n.split("=")[1]) for n in self.folder.names() if n.startswith("partition="))

    def files(self, partition: int) -> list[tuple[int, int, str]]:
        """(first, last, name) of a partition's files, by offset."""
        found = ((_FILE.match(n), n) for n in self.folder.names(f"partition={partition}"))
        return sorted((int(m[1]), int(m[2]), f"partition={partition}/{n}") for m, n in found if m)

    def end(self, partition: int) -> int:
        """The offset after the last message."""
        return max((last + 1 for _, last, _ in self.files(partition)), default=0)

    def ends(self) -> dict[str, int]:
        return {str(p): self.end(p) for p in self.partitions()}

    def add(self, partition: int, staged: str, rows: int) -> int:
        """Give a staged file the next offsets of a partition; returns the first of them."""
        while True:
            first = self.end(partition)
            if self.folder.move_if_absent(staged, f"partition={partition}/{first:020d}-{first + rows - 1:020d}.parquet"):
                return first

    def segments(self, start: dict, end: dict) -> list[Segment]:
        out = []
        for p, stop in sorted(end.items(), key=lambda x: int(x[0])):
            begin = start.get(p, 0)
            if begin < stop:
                out += [Segment(int(p), name, first, max(begin, first), min(stop, last + 1))
                        for first, last, name in self.files(int(p)) if first < stop and last >= begin]
        return out

    def read(self, part: Segment) -> Iterator[pa.RecordBatch]:
        """The segment's messages; row groups that hold none of them are not read."""
        with self.folder.fs.open_input_file(self.folder.at(part.file)) as f:
            file, at = pq.ParquetFile(f), part.first
            for k in range(file.num_row_groups):
                n = file.metadata.row_group(k).num_rows
                if at < part.end and at + n > part.start:
                    here = at
                    for batch in file.iter_batches(BATCH_ROWS, row_groups=[k], columns=_MESSAGE.names):
                        a, b = max(part.start - here, 0), min(part.end - here, batch.num_rows)
                        if a < b:
                            cut = batch.slice(a, b - a)
                            yield pa.RecordBatch.from_arrays(
                                [pa.repeat(pa.scalar(part.partition, pa.int32()), b - a),
                                 pa.array(range(here + a, here + b), pa.int64()),
                                 *[cut.column(c.name).cast(c.type) for c in _MESSAGE]], schema=_ROWS)
                        here += batch.num_rows
                at += n

    # ---- consumer groups

    @staticmethod
    def _group(name: str) -> str:
        return f"groups/{re.sub('[^A-Za-z0-9_.-]', '_', name)}.json"

    def group(self, name: str) -> dict[str, dict[str, int]]:
        """``handed`` (planned for a micro-batch) and ``finished`` offsets of a group."""
        return self.folder.read_json(self._group(name)) or {"handed": {}, "finished": {}}

    def note(self, name: str, **offsets: dict[str, int]) -> None:
        self.folder.put(self._group(name), json.dumps(self.group(name) | offsets).encode())


class _StreamReader(DataSourceStreamReader):
    def __init__(self, log: MessageLog, group: str, starting: str, limit: int | None):
        self.log, self.group, self.starting, self.limit = log, group, starting, limit
        self.handed: dict[str, int] | None = None

    def initialOffset(self) -> dict:
        start = {"earliest": dict, "latest": self.log.ends, "stored": lambda: self.log.group(self.group)["finished"]}[self.starting]()
        self.handed = {p: start.get(p, 0) for p in self.log.ends()}
        self.log.note(self.group, handed=self.handed)
        return self.handed

    def latestOffset(self) -> dict:
        ends = self.log.ends()
        if self.limit:
            # After a restart the group's file says what was handed out last. It is written before
            # Spark logs a batch, so it is never behind the batch that Spark goes on from.
            handed = self.log.group(self.group)["handed"] if self.handed is None else self.handed
            ends = {p: max(handed.get(p, 0), min(end, handed.get(p, 0) + self.limit)) for p, end in ends.items()}
        if ends != self.handed:
            self.log.note(self.group, handed=ends)
            self.handed = ends
        return ends

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return self.log.segments(start, end)

    def read(self, partition: Segment) -> Iterator[pa.RecordBatch]:
        return self.log.read(partition)

    def commit(self, end: dict) -> None:
        self.log.note(self.group, finished=end)


class _BatchReader(DataSourceReader):
    def __init__(self, log: MessageLog):
        self.log = log

    def partitions(self) -> list[InputPartition]:
        return self.log.segments({}, self.log.ends()) or [Segment(0, "", 0, 0, 0)]

    def read(self, partition: Segment) -> Iterator[pa.RecordBatch]:
        return self.log.read(partition) if partition.file else iter([pa.RecordBatch.from_pylist([], schema=_ROWS)])


@dataclass
class _Staged(WriterCommitMessage):
    files: list[tuple[int, str, int]]


class _Writer(DataSourceArrowWriter):
    def __init__(self, log: MessageLog):
        self.log = log

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        open_files: dict[int, list] = {}
        try:
            for batch in iterator:
                parts = batch.column("partition")
                for p in sorted(set(parts.to_pylist())):
                    rows = batch.filter(pc.equal(parts, p))
                    if p not in open_files:
                        name = f"_staged/{p}-{uuid.uuid4().hex}.parquet"
                        out = self.log.folder.create(name)
                        open_files[p] = [pq.ParquetWriter(out, _MESSAGE), out, name, 0]
                    open_files[p][0].write_batch(pa.RecordBatch.from_arrays(
                        [rows.column(c.name).cast(c.type) for c in _MESSAGE], schema=_MESSAGE))
                    open_files[p][3] += rows.num_rows
        finally:
            for writer, out, _, _ in open_files.values():
                writer.close()
                out.close()
        return _Staged([(p, name, rows) for p, (_, _, name, rows) in sorted(open_files.items())])

    def commit(self, messages) -> None:
        for m in messages:
            for p, name, rows in m.files if m is not None else ():
                self.log.add(p, name, rows)

    def abort(self, messages) -> None:
        for m in messages:
            for _, name, _ in m.files if m is not None else ():
                self.log.folder.delete(name)


class MessageLogSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def _log(self) -> MessageLog:
        if not self.options.get("path"):
            raise ValueError("message_log needs a path")
        return MessageLog(self.options["path"])

    def streamReader(self, schema) -> DataSourceStreamReader:
        starting, limit = self.options.get("startingPosition", "earliest"), self.options.get("maxMessagesPerTrigger")
        if starting not in ("earliest", "latest", "stored"):
            raise ValueError(f"startingPosition is earliest, latest or stored, not {starting!r}")
        if limit is not None and int(limit) < 1:
            raise ValueError("maxMessagesPerTrigger is 1 or more")
        return _StreamReader(self._log(), self.options.get("group", "$Default"), starting, int(limit) if limit else None)

    def reader(self, schema) -> DataSourceReader:
        return _BatchReader(self._log())

    def writer(self, schema, overwrite) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("a message log is only appended to")
        return _Writer(self._log())


def append_messages(messages: DataFrame, path: str, n_partitions: int) -> None:
    """Append messages (body, partitionKey, enqueuedTime) to a log. Messages of one key go to one
    partition, in the order of ``enqueuedTime``; those without a key are spread by their body. A task sorts
    and writes a stretch of a partition's time, so its share does not grow with the partition."""
    spark = messages.sparkSession
    spark.dataSource.register(MessageLogSource)
    spread = F.when(F.col("partitionKey").isNotNull(), F.xxhash64("partitionKey")).otherwise(F.xxhash64("body"))
    at = F.pmod(spread, F.lit(n_partitions)).cast("int")
    dealt = messages.select(at.alias("partition"), "body", "partitionKey", F.col("enqueuedTime").cast("timestamp").alias("enqueuedTime"))
    count = messages.count()
    n = max(n_partitions, min(-(-count // FILE_ROWS), FILES), -(-count // LARGE_FILE_ROWS))
    # ranges are numbered in their order, and the commit takes the tasks' files in that of their numbers
    (dealt.repartitionByRange(n, "partition", "enqueuedTime", "partitionKey")
     .sortWithinPartitions("partition", "enqueuedTime", "partitionKey", "body")
     .write.format(FORMAT).mode("append").option("path", path).save())


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The whole log as a table."""
    spark.dataSource.register(MessageLogSource)
    return spark.read.format(FORMAT).option("path", path).load()


def log_feed(spark: SparkSession, path: str, group: str = "$Default", starting: str = "earliest",
             max_messages_per_trigger: int | None = None) -> DataFrame:
    """The log as a stream, with the envelope of the other feeds and partition and offset."""
    spark.dataSource.register(MessageLogSource)
    r = spark.readStream.format(FORMAT).option("path", path).option("group", group).option("startingPosition", starting)
    if max_messages_per_trigger:
        r = r.option("maxMessagesPerTrigger", max_messages_per_trigger)
    return r.load()


def run_until_caught_up(query: StreamingQuery, *logs: tuple[str, str], poll: float = 0.1) -> None:
    """Let a query take its feeds batch by batch until nothing is left, then stop it; re-raises its
    failure. ``logs``: path and group of every log that it reads."""
    at = [(MessageLog(path), group) for path, group in logs]
    while query.isActive:
        handed = all(log.group(group)["handed"] == log.ends() for log, group in at)
        if handed and query.status["message"] == "Waiting for data to arrive":
            break
        time.sleep(poll)
    query.stop()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
