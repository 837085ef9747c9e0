"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Text handled at once inside a Python task; one longer text is handled alone.
SLICE_BYTES = 2 << 20
#: Rows that Spark hands to Python at once; whole texts may be long.
ARROW_ROWS = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the cluster's checkpoint folder and read it back.

    Cuts the lineage: lost executors re-read files instead of recomputing.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_arrow(df: DataFrame, fn, schema: str | T.StructType) -> DataFrame:
    """``mapInArrow`` with small batches, which bounds the memory of a worker."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    return df.mapInArrow(fn, schema)


def lower_ascii(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, UPPER, UPPER.lower())


def batches(stream: Iterator[pa.RecordBatch], text: str = "text",
            max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each holds at most ``max_bytes`` of text, or one row."""
    for batch in stream:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths.astype(np.int64))
        start, base = 0, 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
            yield batch.slice(start, stop - start)
            start, base = stop, int(ends[stop - 1])


def text_bytes(column: pa.Array) -> list[bytes]:
    """Texts as bytes; null counts as empty."""
    return pc.fill_null(column.cast(pa.binary()), b"").to_pylist()


def split_words(column: pa.Array, lower: bool = False) -> tuple[pa.Array, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of every text (null: none), and the start of
    each text's words in the flat array (one more entry than texts)."""
    column = pc.fill_null(column.cast(pa.string()), "")
    if lower:
        column = pc.ascii_lower(column)
    lists = pc.ascii_split_whitespace(column)
    words = lists.flatten()
    starts = lists.offsets.to_numpy().astype(np.int64)
    starts = starts - starts[0]
    full = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    before = np.concatenate([[0], np.cumsum(full)])
    return words.filter(pa.array(full)), before[starts]


def spaced(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all words with a space after each, and where each word starts
    (one more entry than words)."""
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset: words.offset + len(words) + 1].astype(np.int64)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[offsets[0]: offsets[-1]]
    starts = offsets - offsets[0] + np.arange(len(words) + 1)
    out = np.full(int(starts[-1]), 0x20, np.uint8)
    out[np.arange(len(data)) + np.repeat(np.arange(len(words)), np.diff(offsets))] = data
    return out, starts


#: Bytes of words hashed at once; a longer word is hashed alone.
_HASH_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def word_hashes(words: pa.Array, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each word: a polynomial over random values of its bytes,
    by running sums over many words at once, mixed with the length."""
    if not len(words):
        return np.zeros(0, np.uint64)
    values = np.random.default_rng(seed).integers(0, 2 ** 64, 256, np.uint64)
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset: words.offset + len(words) + 1].astype(np.int64)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    out = np.empty(len(words), np.uint64)
    longest = int(min(offsets[-1] - offsets[0], max(_HASH_BYTES, np.diff(offsets).max())))
    up, down = _powers(_BASE, longest + 1), _powers(pow(_BASE, -1, 1 << 64), longest + 1)
    at = 0
    while at < len(words):
        stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + _HASH_BYTES, side="right")) - 1)
        ends = offsets[at: stop + 1] - offsets[at]
        sums = np.zeros(int(ends[-1]) + 1, np.uint64)
        np.cumsum(values[data[offsets[at]: offsets[stop]]] * up[: len(sums) - 1], out=sums[1:])
        out[at:stop] = (sums[ends[1:]] - sums[ends[:-1]]) * down[ends[:-1]]
        at = stop
    return mix(out ^ (np.diff(offsets).astype(np.uint64) * np.uint64(_BASE)))


def mix(x: np.ndarray) -> np.ndarray:
    """Finalising 64-bit mixer."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def rolling(hashes: np.ndarray, width: int) -> np.ndarray:
    """Order-sensitive hash of every ``width`` consecutive entries, by doubling.

    The result is as long as the input; the last ``width - 1`` entries run
    over the end and are meaningless.
    """
    def joined(left, right, gap, right_width):
        out = left * np.uint64(pow(_BASE, right_width, 1 << 64))
        if gap < len(out):
            out[: len(out) - gap] += right[gap:]
        return out

    block, size, out, covered = hashes, 1, None, 0
    while True:
        if width & size:
            out, covered = (block, size) if out is None else (joined(out, block, covered, size), covered + size)
        if size * 2 > width:
            return mix(out)
        block, size = joined(block, block, size, size), size * 2


def pack(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the text compressed into binary ``packed``: less to shuffle. Null stays null."""
    def squeeze(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        for batch in batches(stream, text):
            made = zstandard.ZstdCompressor(level=1)
            column = [None if t is None else made.compress(t) for t in batch.column(text).cast(pa.binary()).to_pylist()]
            yield batch.drop_columns([text]).append_column("packed", pa.array(column, pa.binary()))

    schema = T.StructType([*[f for f in docs.schema.fields if f.name != text], T.StructField("packed", T.BinaryType())])
    return map_arrow(docs, squeeze, schema)


def unpacked(stream: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """Arrow batches with ``packed`` undone into ``text``, each with a bounded amount of it."""
    import zstandard

    for batch in stream:
        undo = zstandard.ZstdDecompressor()
        packed, start, size = batch.column("packed").to_pylist(), 0, 0
        texts: list[bytes | None] = []
        for k, p in enumerate([*packed, None]):
            if texts and (k == len(packed) or size >= SLICE_BYTES):
                part = batch.slice(start, len(texts)).drop_columns(["packed"])
                yield part.append_column(text, pa.array(texts, pa.binary()).cast(pa.string()))
                start, size, texts = k, 0, []
            if k < len(packed):
                texts.append(None if p is None else undo.decompress(p))
                size += len(texts[-1] or b"")
