"""Exact dedup: binary-fuse filters over an immutable snapshot screen incoming digests.

A snapshot's distinct digests are dealt into shards of a bounded number of
keys; each shard gets one static three-wise binary fuse filter (Graf and
Lemire, 2022) with 16-bit fingerprints. A batch's digests are grouped first
(its own duplicates meet there, map-side combined), then screened shard by
shard. Only positives join the snapshot's exact buckets; the bytes of every
text in a group of two or more are then compared.

Defined results: null text counts as empty; equal means identical after
lower-casing A-Z; rows that repeat a doc_id are one document and are flagged
alike; a null doc_id loses to any other, and groups without any id keep all
rows; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import batches, map_arrow, materialise, mix, text_bytes

SHARD_KEYS = 16_384


class FuseFilter:
    """Static three-wise binary fuse filter over distinct 64-bit keys."""

    def __init__(self, seed: int, segment: int, count: int, table: np.ndarray):
        self.seed, self.segment, self.count, self.table = seed, segment, count, table

    @staticmethod
    def _places(keys: np.ndarray, seed: int, segment: int, count: int):
        h = mix(keys + np.uint64(seed))
        first = ((h >> np.uint64(32)) * np.uint64(count * segment)) >> np.uint64(32)
        mask = np.uint64(segment - 1)
        second = (first + np.uint64(segment)) ^ ((h >> np.uint64(18)) & mask)
        third = (first + np.uint64(2 * segment)) ^ (h & mask)
        prints = (mix(h) & np.uint64(0xFFFF)).astype(np.uint16)
        return np.stack([first, second, third], 1).astype(np.int64), prints

    @classmethod
    def build(cls, keys: np.ndarray) -> "FuseFilter":
        keys = np.unique(keys)
        n = max(2, len(keys))
        segment = 1 << max(2, int(math.log(n) / math.log(3.33) + 2.25))
        capacity = n * max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(n))
        count = max(1, math.ceil(capacity / segment) - 2)
        for seed in range(1, 1000):
            if (table := cls._peel(keys, seed, segment, count)) is not None:
                return cls(seed, segment, count, table)
            if seed % 20 == 0:  # unlucky tiny sets need more room
                count += 1
        raise RuntimeError("no binary fuse filter found")

    @classmethod
    def _peel(cls, keys, seed, segment, count):
        places, prints = cls._places(keys, seed, segment, count)
        size = (count + 2) * segment
        used = np.bincount(places.ravel(), minlength=size)
        owners = np.zeros(size, np.int64)
        index = np.arange(len(keys))
        for k in range(3):
            np.bitwise_xor.at(owners, places[:, k], index)
        rounds, left = [], len(keys)
        while left:
            slots = np.flatnonzero(used == 1)
            if not len(slots):
                return None
            picked, at = np.unique(owners[slots], return_index=True)
            rounds.append((picked, slots[at]))
            left -= len(picked)
            for k in range(3):
                np.subtract.at(used, places[picked, k], 1)
                np.bitwise_xor.at(owners, places[picked, k], picked)
        table = np.zeros(size, np.uint16)
        for picked, slots in reversed(rounds):
            others = table[places[picked, 0]] ^ table[places[picked, 1]] ^ table[places[picked, 2]]
            table[slots] ^= others ^ prints[picked]
        return table

    def contains(self, keys: np.ndarray) -> np.ndarray:
        places, prints = self._places(keys, self.seed, self.segment, self.count)
        t = self.table
        return (t[places[:, 0]] ^ t[places[:, 1]] ^ t[places[:, 2]]) == prints


def _digest_rows(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches(stream):
        digests = [hashlib.sha256(t.lower()).digest() for t in text_bytes(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(digests, pa.binary())], ["doc_id", "digest"])


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, digest): SHA-256 of each whole text after lower-casing A-Z."""
    ids = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return map_arrow(ids, _digest_rows, "doc_id long, digest binary")


def _text_rows(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per distinct text of a slice, so that a large group of copies is
    combined before it is shuffled."""
    for batch in batches(stream):
        distinct = list(dict.fromkeys(t.lower() for t in text_bytes(batch.column("text"))))
        yield pa.RecordBatch.from_arrays(
            [pa.array([hashlib.sha256(t).digest() for t in distinct], pa.binary()),
             pa.array(distinct, pa.binary())], ["digest", "bytes"])


def _key(column: pa.Array) -> np.ndarray:
    if not len(column):
        return np.zeros(0, np.uint64)
    return np.array([int.from_bytes(d[:8], "little") for d in column.to_pylist()], np.uint64)


def _build_filter(group: pa.Table) -> pa.Table:
    made = FuseFilter.build(_key(group.column("digest")))
    return pa.table({"shard": group.column("shard").slice(0, 1),
                     "seed": pa.array([made.seed], pa.int64()),
                     "segment": pa.array([made.segment], pa.int64()),
                     "segments": pa.array([made.count], pa.int64()),
                     "prints": pa.array([made.table.tobytes()], pa.binary())})


def _screen(incoming: pa.Table, filters: pa.Table) -> pa.Table:
    if not filters.num_rows:
        hit = np.zeros(incoming.num_rows, bool)
    else:
        f = filters.to_pylist()[0]
        made = FuseFilter(f["seed"], f["segment"], f["segments"], np.frombuffer(f["prints"], np.uint16))
        hit = made.contains(_key(incoming.column("digest")))
    return pa.table({"digest": incoming.column("digest"), "hit": pa.array(hit)})


def _shard(n_shards: int):
    return F.pmod(F.xxhash64("digest"), F.lit(n_shards)).cast("int").alias("shard")


def snapshot_filters(snapshot: DataFrame, n_shards: int) -> DataFrame:
    """One static filter per shard of the snapshot's distinct digests."""
    return snapshot.select("digest", _shard(n_shards)).groupBy("shard").applyInArrow(
        _build_filter, "shard int, seed long, segment long, segments long, prints binary")


def screen(incoming: DataFrame, filters: DataFrame, n_shards: int) -> DataFrame:
    """Distinct incoming digests with the filter's answer; a miss is certain."""
    return (incoming.select("digest", _shard(n_shards)).groupBy("shard")
            .cogroup(filters.groupBy("shard")).applyInArrow(_screen, "digest binary, hit boolean"))


def exact_dedup(docs: DataFrame, in_snapshot, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256.

    ``in_snapshot``: Boolean column over doc_id; true rows form the immutable
    snapshot, the others the incoming batch.
    """
    rows = materialise(digests(docs).withColumn("old", F.coalesce(in_snapshot, F.lit(True))), "op9-digests")
    grouped = materialise(rows.groupBy("digest", "old").agg(
        F.count("*").alias("n"), F.max("doc_id").alias("last")), "op9-groups")
    snapshot, incoming = grouped.filter("old").drop("old"), grouped.filter("not old").drop("old")
    n_shards = max(1, math.ceil(grouped.count() / shard_keys))
    screened = screen(incoming, snapshot_filters(snapshot, n_shards), n_shards)
    hits = screened.filter("hit").select("digest")
    matched = (snapshot.join(hits, "digest").join(
        incoming.select("digest", F.col("n").alias("m"), F.col("last").alias("latest")), "digest"))
    # exact buckets: snapshot digests met by the batch, then what only one side holds
    met = materialise(matched.select("digest", (F.col("n") + F.col("m")).alias("n"),
                                     F.greatest("last", "latest").alias("last")), "op9-met")
    alone = grouped.drop("old").join(met.select("digest"), "digest", "left_anti")
    groups = alone.unionByName(met)
    repeated = groups.filter("n > 1")
    texts = map_arrow(docs.select(F.col("text").cast("string")), _text_rows, "digest binary, bytes binary")
    checked = (texts.join(repeated.select("digest"), "digest", "left_semi").groupBy("digest")
               .agg((F.min("bytes") == F.max("bytes")).alias("same")))
    keep = groups.join(checked, "digest", "left").withColumn(
        "last", F.when(F.coalesce("same", F.lit(True)), F.col("last")).otherwise(
            F.raise_error(F.lit("different texts share a SHA-256 digest")).cast("long")))
    return rows.select("doc_id", "digest").join(keep, "digest").select(
        "doc_id", F.col("last").alias("keep_id"), F.col("n").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("last")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))
