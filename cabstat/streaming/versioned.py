"""A keyed table with versions: merges rewrite only the buckets they touch.

Layout: ``data/<commit>/bucket_=<b>/*.parquet`` and ``log/<version>.json``. A log entry names the
folder of every bucket, so it says by itself what its version holds. A merge writes new folders for
the buckets of its keys and then publishes the next log entry, which either appears whole or
not at all: a reader sees version n or n + 1. Of two writers that both made n + 1 from n, one publishes;
the other looks at what came between, keeps its folders if other buckets were touched, merges again if not,
and publishes after it.

An entry also carries the last batch of every writer (a streaming query), so a replayed batch is known
and changes nothing. Its size is that of the bucket count, whatever the table's.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .store import Folder

BUCKET = "bucket_"


@dataclass(frozen=True)
class Version:
    version: int
    schema: str
    key: list[str]
    n_buckets: int
    buckets: dict[str, str] = field(default_factory=dict)     # bucket -> folder below data/
    writers: dict[str, int] = field(default_factory=dict)     # writer -> last batch
    touched: list[int] = field(default_factory=list)          # buckets that this version rewrote

    @property
    def struct(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))


class VersionedTable:
    """``key``: columns that identify a row, nulls included. ``n_buckets``: over how many buckets keys are
    hashed when the table is new; a bucket is what one task rewrites, so size it to some 100 MB
    (:meth:`rebucket` as the table grows)."""

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str] = (), n_buckets: int = 64):
        self.spark, self.path = spark, path.rstrip("/")
        self.key, self.n_buckets = list(key), n_buckets
        self.folder = Folder(self.path)
        self._known = 0

    # ---- log

    @staticmethod
    def _entry(version: int) -> str:
        return f"log/{version:020d}.json"

    def latest(self) -> Version | None:
        """The newest version, None for a table without any. Looks for what follows the newest version
        seen before; only the first call lists the log."""
        if not self._known or not self.folder.exists(self._entry(self._known)):   # new here, or vacuumed meanwhile
            names = [n for n in self.folder.names("log") if not n.startswith(".")]
            self._known = int(names[-1].split(".")[0]) if names else 0
        while self.folder.exists(self._entry(self._known + 1)):
            self._known += 1
        return self.at(self._known) if self._known else None

    def at(self, version: int) -> Version:
        found = self.folder.read_json(self._entry(version))
        if found is None:
            raise ValueError(f"no version {version} in {self.path}")
        return Version(**found)

    def _publish(self, made: Version) -> bool:
        return self.folder.put_if_absent(self._entry(made.version), json.dumps(asdict(made)).encode())

    # ---- read

    def _rows(self, held: Version, buckets: Sequence[str] | None = None) -> DataFrame:
        folders = [f"{self.path}/data/{f}" for b, f in held.buckets.items() if buckets is None or b in buckets]
        if not folders:
            return self.spark.createDataFrame([], held.struct)
        return self.spark.read.schema(held.struct).parquet(*folders)

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version (default: the newest), whatever is merged meanwhile."""
        held = self.latest() if version is None else self.at(version)
        if held is None:
            raise ValueError(f"{self.path} has no version yet")
        return self._rows(held)

    # ---- merge

    def _bucket(self, key: list[str], n: int) -> Column:
        return F.pmod(F.xxhash64(*key), F.lit(n)).cast("int")

    def _write(self, rows: DataFrame, key: list[str], n_buckets: int) -> str:
        """Write rows by bucket into a folder of their own; returns its name."""
        made = uuid.uuid4().hex
        (rows.withColumn(BUCKET, self._bucket(key, n_buckets)).repartition(BUCKET)
         .write.partitionBy(BUCKET).parquet(f"{self.path}/data/{made}"))
        return made

    def merge(self, batch: DataFrame, writer: str, batch_id: int, order_by: Sequence[str] = ()) -> Version | None:
        """Upsert ``batch`` by key; returns the version made, None for a batch merged before.

        Of rows with one key the batch's replaces the table's. Inside the batch the one with the
        greatest ``order_by`` columns wins, and of equal ones that with the greatest of its
        other columns in their order (null is least): the result does not depend on the order of rows.
        """
        batch = batch.persist()
        try:
            return self._merge(batch, writer, batch_id, list(order_by))
        finally:
            batch.unpersist()

    def _merge(self, batch: DataFrame, writer: str, batch_id: int, order_by: list[str]) -> Version | None:
        made, used, touched = None, None, None
        while True:
            base = self.latest() or Version(0, batch.schema.json(), self.key, self.n_buckets)
            if base.writers.get(writer, -1) >= batch_id:
                self._forget(made)
                return None
            if [(f.name, f.dataType) for f in base.struct] != [(f.name, f.dataType) for f in batch.schema]:
                raise ValueError(f"columns {batch.schema.simpleString()} do not match {base.struct.simpleString()}")
            if touched is None or used.n_buckets != base.n_buckets:
                bucket = self._bucket(base.key, base.n_buckets)
                touched = sorted(r[0] for r in batch.select(bucket.alias("b")).distinct().collect())  # at most n_buckets
            if made is None or used.n_buckets != base.n_buckets or any(
                    used.buckets.get(str(b)) != base.buckets.get(str(b)) for b in touched):
                self._forget(made)
                made, used = self._rewrite(base, batch, touched, order_by), base
            after = Version(base.version + 1, base.schema, base.key, base.n_buckets,
                            base.buckets | {str(b): f"{made}/{BUCKET}={b}" for b in touched},
                            base.writers | {writer: batch_id}, touched)
            if self._publish(after):
                return after

    def _rewrite(self, base: Version, batch: DataFrame, touched: list[int], order_by: list[str]) -> str | None:
        if not touched:
            return None
        rest = [c for c in batch.columns if c not in base.key]
        order = [c for c in order_by if c in rest]
        ranked = lambda df, rank: df.select(
            *base.key, F.struct(F.lit(rank).alias("rank_"), F.struct(*order).alias("order_") if order else F.lit(0).alias("order_"),
                                F.struct(*rest).alias("rest_")).alias("row_"))
        rows = ranked(batch, 1).unionAll(ranked(self._rows(base, [str(b) for b in touched]), 0))
        # one shuffle, after copies of a key have been reduced where they are
        merged = rows.groupBy(*base.key).agg(F.max("row_").alias("row_")).select(
            *[F.col(c) if c in base.key else F.col("row_.rest_")[c].alias(c) for c in batch.columns])
        return self._write(merged, base.key, base.n_buckets)

    def _forget(self, made: str | None) -> None:
        if made:
            self.folder.delete(f"data/{made}")

    # ---- upkeep

    def rebucket(self, n_buckets: int) -> Version:
        """Deal the rows over another number of buckets, as a new version."""
        while True:
            base = self.latest()
            made = self._write(self._rows(base), base.key, n_buckets)
            held = [n for n in self.folder.names(f"data/{made}") if n.startswith(BUCKET)]
            buckets = {n.split("=")[1]: f"{made}/{n}" for n in held}
            after = Version(base.version + 1, base.schema, base.key, n_buckets, buckets, base.writers,
                            sorted(map(int, buckets)))
            if self._publish(after):
                return after
            self._forget(made)

    def vacuum(self, keep: int = 2) -> int:
        """Delete versions before the last ``keep``, and bucket folders that only they named; returns
        how many. Readers of deleted versions fail; unpublished folders of merges under way stay."""
        newest = self.latest()
        if newest is None:
            return 0
        names = [n for n in self.folder.names("log") if not n.startswith(".")]
        old = [v for v in (int(n.split(".")[0]) for n in names) if v <= newest.version - keep]
        wanted = {f for v in range(max(1, newest.version - keep + 1), newest.version + 1) for f in self.at(v).buckets.values()}
        gone = {f for v in old for f in self.at(v).buckets.values()} - wanted
        for v in old:
            self.folder.delete(self._entry(v))
        for f in gone:
            self.folder.delete(f"data/{f}")
        return len(gone)
