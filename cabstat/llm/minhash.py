"""Near-duplicates by HyperMinHash registers, banding, estimation and verification.

A document's set is its distinct five-word shingles. Its smallest hash per
bucket is kept as a leading-zero count and ten mantissa bits (Yu and Weber,
2017); empty buckets borrow from others by fixed permutations. Forty bands of
four registers propose candidates: a pair of similarity 0.75 shares no band
with probability (1 - 0.75 ** 4) ** 40 = 3e-7. Candidate pairs pass a
collision-corrected Jaccard estimate and are then confirmed on full sets.

Equal sets are one class from the start. Within a band's bucket every document
is first tried against the smallest one only, in rounds: linked documents
become components, and pairs inside a component need no further look. Only buckets that still hold
several components are searched further: in blocks of bounded size, and only
pairs across components, so that no link between different texts is lost and
no group is spelled out into all pairs.

Defined results: words are `[^\\x20\\x09-\\x0D]+` after lower-casing A-Z; fewer
than five words are one shingle; without words or text the set is empty and
linked with nothing; rows that repeat a doc_id are one document; a null doc_id
is linked with nothing and is its own component (null) and kept; an empty
table gives an empty result; extra columns are ignored by ``near_duplicates``
and kept by ``keep_first``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import batches, map_arrow, materialise, mix, pack, rolling, split_words, unpacked, word_hashes
from .components import components

SHINGLE, REGISTERS, ROWS, MANTISSA = 5, 160, 4, 10
PERCENT = 75
#: Pairs estimated below it are not verified: the estimate's deviation at 0.75 is 0.034.
ESTIMATE_FROM = 0.6
#: Documents of a bucket's chunk; two chunks are compared at a time.
CHUNK = 2048
#: Rounds of trying a document against the smallest ones of its buckets.
STAR_TURNS = 3


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text."""
    words, starts = split_words(texts, lower=True)
    hashed = word_hashes(words)
    fives = rolling(hashed, SHINGLE)
    out = []
    for a, b in zip(starts[:-1], starts[1:]):
        if b - a >= SHINGLE:
            out.append(np.unique(fives[a: b - SHINGLE + 1]))
        elif b > a:
            out.append(mix(rolling(hashed[a:b], int(b - a))[:1] + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


_ORDER = np.stack([np.random.default_rng(k).permutation(REGISTERS) for k in range(REGISTERS)])


def registers(shingles: np.ndarray) -> np.ndarray:
    """Compressed registers of a set that is not empty."""
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(least, (shingles % np.uint64(REGISTERS)).astype(np.int64), mix(shingles + np.uint64(1)))
    full = least != np.iinfo(np.uint64).max
    if not full.all():
        lent = _ORDER[np.arange(REGISTERS), np.argmax(full[_ORDER], axis=1)]
        least = np.where(full, least, least[lent])
    bits = np.frexp((least >> np.uint64(11)).astype(np.float64))[1]  # exact below 2 ** 53
    zeros = (53 - bits).astype(np.uint64)
    mantissa = (least << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA)
    return ((zeros << np.uint64(MANTISSA)) | mantissa).astype("<u2")


def corrected(equal: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard estimate from equal registers, less the collisions expected of
    unrelated sets of these sizes (the paper's approximation)."""
    chance = 0.169919487159739 * 2.0 ** (1 - MANTISSA) * 4.0 * n * m / np.maximum(n + m, 1.0) ** 2
    return (equal / REGISTERS - chance) / (1 - chance)


def _sign(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import xxhash

    empty = bytes(2 * REGISTERS)
    for batch in batches(stream):
        sets = shingle_sets(batch.column("text"))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
             pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
             pa.array([registers(s).tobytes() if len(s) else empty for s in sets], pa.binary())],
            ["doc_id", "n_shingles", "same", "registers"])


def _sets(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in unpacked(stream):
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([s.tobytes() for s in shingle_sets(batch.column("text"))], pa.binary())],
            ["doc_id", "shingles"])


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, REGISTERS)


def _estimate(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in stream:
        if batch.num_rows:
            equal = (_matrix(batch.column("ra")) == _matrix(batch.column("rb"))).sum(1)
            n, m = (batch.column(c).to_numpy().astype(float) for c in ("na", "nb"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(corrected(equal, n, m))], ["a", "b", "estimate"])


def _similar(x: np.ndarray, y: np.ndarray) -> bool:
    """The full sets reach the similarity asked for."""
    if PERCENT * max(len(x), len(y)) > 100 * min(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both > 0 and 100 * both >= PERCENT * (len(x) + len(y) - both)


def _verify(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in stream:
        good = []
        for x, y in zip(batch.column("sa"), batch.column("sb")):
            good.append(_similar(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)))
        keep = pa.array(good, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("a", "b")], ["a", "b"])


def _near(key: tuple, group: pa.Table):
    """Candidates of a block: (row, rows to compare it with), across components,
    estimated high enough, and in the first band that the two share only."""
    one, two = key[1].as_py(), key[2].as_py()
    part, chunk, size = (group.column(c).to_numpy() for c in ("component", "chunk", "n_shingles"))
    regs, band = _matrix(group.column("registers")), group.column("band")[0].as_py()
    for i in np.flatnonzero(chunk == one):
        others = np.flatnonzero((part != part[i]) & ((chunk == two) if one != two else (np.arange(len(part)) > i)))
        if len(others):
            equal = regs[others] == regs[i]
            promising = corrected(equal.sum(1), size[others].astype(float), float(size[i])) >= ESTIMATE_FROM
            shared = equal[promising].reshape(-1, REGISTERS // ROWS, ROWS).all(2).argmax(1)
            near = others[promising][shared == band]
            if len(near):
                yield i, near


def _promising(key: tuple, group: pa.Table) -> pa.Table:
    """The documents of a block that have a candidate in it; not the pairs."""
    hit = np.zeros(group.num_rows, bool)
    for i, near in _near(key, group):
        hit[i] = hit[near] = True
    return group.select(["key", "one", "two", "doc"]).filter(pa.array(hit))


def _confirm(key: tuple, group: pa.Table) -> pa.Table:
    """Links of a block on full sets; what a link has joined is not compared again."""
    doc, part = group.column("doc").to_numpy(), group.column("component").to_numpy().copy()
    sets = [np.frombuffer(x, np.uint64) for x in group.column("shingles").to_pylist()]
    found: list[tuple[int, int]] = []
    for i, near in _near(key, group):
        for j in near:
            if part[i] != part[j] and _similar(sets[i], sets[j]):
                found.append((max(doc[i], doc[j]), min(doc[i], doc[j])))
                part[part == part[j]] = part[i]
    cols = list(zip(*found)) or [(), ()]
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip("ab", cols)})


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Links among ``pairs`` (a, b), on full sets; the hot side b is joined while rows are narrow."""
    sa = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa"))
    sb = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb"))
    return map_arrow(pairs.select("a", "b").join(sb, "b").join(sa, "a").select("a", "b", "sa", "sb"),
                     _verify, "a long, b long")


def _estimated(pairs: DataFrame, lone: DataFrame) -> DataFrame:
    """``pairs`` (a, b) whose registers promise enough similarity; b is the hot side."""
    regs = lambda x: lone.select(F.col("doc").alias(x), F.col("registers").alias(f"r{x}"),
                                 F.col("n_shingles").alias(f"n{x}"))
    joined = pairs.join(regs("b"), "b").join(regs("a"), "a").select("a", "b", "ra", "rb", "na", "nb")
    return map_arrow(joined, _estimate, "a long, b long, estimate double").filter(
        F.col("estimate") >= ESTIMATE_FROM).select("a", "b")


def _component_of(rows: DataFrame, parts: DataFrame, node: str, out: str = "component") -> DataFrame:
    """``rows`` with the component of column ``node``, which is its own where it has no link."""
    named = parts.select(F.col("node").alias(node), F.col("component").alias(out))
    return rows.join(named, node, "left").withColumn(out, F.coalesce(out, node))


def _apart(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """``pairs`` (a, b) across components, with b's component."""
    return _component_of(_component_of(pairs, parts, "a", "ca"), parts, "b", "cb").filter("ca <> cb").drop("ca")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    signed = materialise(map_arrow(rows, _sign, "doc_id long, n_shingles long, same binary, registers binary"),
                         "op6-signed")
    full = signed.filter("n_shingles > 0 and doc_id is not null")
    classes = materialise(full.groupBy("same").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")),
                          "op6-classes")
    # one document of each class of equal sets goes on
    lone = (full.join(classes.select("same", F.col("first").alias("doc_id")), ["same", "doc_id"])
            .dropDuplicates(["same", "doc_id"]).select(F.col("doc_id").alias("doc"), "n_shingles", "registers"))
    lone = materialise(lone, "op6-lone")
    band = F.transform(F.sequence(F.lit(0), F.lit(REGISTERS // ROWS - 1)), lambda b: F.xxhash64(
        b, F.substring(F.col("registers"), b * (2 * ROWS) + 1, F.lit(2 * ROWS))))
    banded = lone.select("doc", F.posexplode(band).alias("band", "key"))
    buckets = (banded.groupBy("key").agg(F.min("doc").alias("low"), F.max("doc").alias("high"),
                                         F.count("*").alias("n")).filter("low < high").drop("high"))
    members = materialise(banded.join(buckets, "key"), "op6-members")
    named = members.select(F.col("doc").alias("doc_id")).distinct()
    sets = materialise(map_arrow(pack(rows).join(named, "doc_id", "left_semi"), _sets, "doc_id long, shingles binary")
                       .dropDuplicates(["doc_id"]), "op6-sets")
    # each document against the smallest of its buckets: first the smallest of all,
    # then one in each other component, then every one that is still apart
    star = materialise(members.filter("doc <> low").select(F.col("doc").alias("a"), F.col("low").alias("b"))
                       .distinct(), "op6-star")
    links = parts = None
    for turn in range(STAR_TURNS):
        if parts is None:
            pairs = star.groupBy("a").agg(F.min("b").alias("b"))
        elif turn < STAR_TURNS - 1:
            pairs = _apart(star, parts).groupBy("a", "cb").agg(
                F.min_by("b", F.xxhash64("a", "b", F.lit(turn))).alias("b")).select("a", "b")
        else:
            pairs = _apart(star, parts).select("a", "b")
        found = _verified(_estimated(pairs, lone), sets)
        links = materialise(found if links is None else links.unionByName(found), "op6-links")
        parts = materialise(components(links), "op6-parts")
    # and what is still apart in a bucket, block by block
    parted = materialise(_component_of(members.select("key", "band", "doc", "n"), parts, "doc"), "op6-parted")
    split = (parted.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"))
             .filter("x < y").select("key"))
    chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    blocks = (parted.join(split, "key").join(lone, "doc")
              .withColumn("chunk", F.pmod(F.xxhash64("doc"), chunks).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1)))
              .withColumn("one", F.least("chunk", "other")).withColumn("two", F.greatest("chunk", "other")))
    blocks = blocks.select("key", "one", "two", "band", "doc", "component", "chunk", "n_shingles", "registers")
    named = materialise(blocks.groupBy("key", "one", "two").applyInArrow(
        _promising, "key long, one int, two int, doc long"), "op6-promising")
    full_blocks = blocks.join(named, ["key", "one", "two", "doc"]).join(
        sets.withColumnRenamed("doc_id", "doc"), "doc")
    across = full_blocks.select(*blocks.columns, "shingles").groupBy("key", "one", "two").applyInArrow(
        _confirm, "a long, b long")
    links = materialise(links.unionByName(across), "op6-links")
    found = _component_of(classes.select("same", F.col("first").alias("doc")), components(links), "doc")
    out = signed.join(found.select("same", "component"), "same", "left")
    component = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component")).otherwise(
        F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose document has the smallest id of its component."""
    gone = near_duplicates(docs).filter("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
