"""Language-model scoring by context-tree weighting over bytes.

Texts are lower-cased (A-Z) and read as tokens: words, each spelt as its bytes
and a space, then one end, spelt as a line feed. A byte is eight binary
decisions. The context of a byte is the up to ``DEPTH`` bytes before it: with
``across`` those of the running text, over word ends, back to the text's start;
without, back to the space before its word. Every (context, decision) has the
Krichevsky-Trofimov estimate of its counts in training, and weighting mixes the
estimates of all depths: P(s) = KT(s) / 2 + P(children of s) / 2, and the share
KT(s) / 2 has in P(s) is the weight of stopping at s. At a start, contexts are a
space, then padding; along the padding all depths have equal counts, where
mixing changes nothing.

All distinct (context, byte) grams of the token stream are kept, counted in
the tasks and merged by bucket: the two last bytes of a context are its
bucket, so a bucket holds whole subtrees and is weighted by itself, as one row
of compressed arrays. It is weighted twice: once for the shallow depths, which
need all buckets, then for the values, which need the shallow depths. Grams are
packed so that sorting them sorts contexts by their nearest byte first: every
step is a sort and sums over runs, and a bucket's depths are got by sorting its
distinct (shorter context, byte) pairs once each.

A document's score adds up the values of its grams. The ``COMMON`` most
frequent grams at most, a bound that does not grow with the data, are broadcast;
the occurrences of the others go to their shard's values as one compressed row
a slice of documents and shard. There are as many shards as the number of grams asks for. Words only serve the counts and the add-one
base: the most frequent, ``COMMON_WORDS`` at most, are broadcast, the others joined.

Defined results: null text counts as empty, which is the end alone; rows that
repeat a doc_id are scored each and trained on each; a null doc_id is training
text; an empty table gives an empty result; extra columns are ignored. Where
nothing is known, a decision has probability one half.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from .common import batches, map_arrow, materialise, split_words

DEPTH = 7
#: Contexts of this depth are weighted by themselves; those above are few:
#: at most 256 ** SPLIT contexts of 255 decisions.
SPLIT = 2
COMMON, COMMON_WORDS = 2_000_000, 150_000
#: Distinct words that a counting task holds before it hands them on.
HELD_WORDS = 1_000_000
END = b""
#: Grams that a counting task sorts at once (8 bytes each), and combines at once.
HELD_GRAMS, COMBINED_GRAMS = 8_000_000, 1_000_000
#: Distinct grams that a merging task holds before it adds them up.
MERGED_GRAMS = 1_000_000
#: Text whose words are told apart at once.
WORD_BYTES = 8 << 20
#: Text whose grams are made at once: each byte takes about a hundred.
GRAM_BYTES = 1 << 19
#: Grams that one task weights, and that one shard of values holds, about; tasks that weight at most.
TASK_GRAMS, SHARD_GRAMS = 200_000, 250_000
TASKS = 4096


# ------------------------------------------------------------------ grams

#: Bytes as they are spelt: A-Z in lower case, white space as a space.
_SPELT = np.arange(256, dtype=np.uint8)
_SPELT[0x41:0x5B] += 0x20
_SPELT[0x09:0x0E] = 0x20


def spelt(texts: pa.Array, across: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts, the number of bytes by text, and by stretch that contexts stay in."""
    texts = pc.fill_null(texts.cast(pa.binary()), b"").cast(pa.large_binary())
    ended = pc.binary_join_element_wise(texts, pa.scalar(b" \n", pa.large_binary()), pa.scalar(b"", pa.large_binary()))
    bounds = np.frombuffer(ended.buffers()[1], np.int64)[ended.offset: ended.offset + len(ended) + 1]
    if not len(ended):
        return np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)
    flat = _SPELT[np.frombuffer(ended.buffers()[2], np.uint8)[bounds[0]: bounds[-1]]]
    starts, ends = bounds[:-1] - bounds[0], bounds[1:] - bounds[0] - 1
    flat[ends] = 0x0A
    # one space after each word: none at a start, none after a space
    word = (flat != 0x20) & (flat != 0x0A)
    keep = flat != 0x20
    keep[1:] |= word[:-1]
    sizes = np.add.reduceat(keep, starts, dtype=np.int64)
    flat = flat[keep]
    if across:
        return flat, sizes, sizes
    return flat, sizes, np.diff(np.flatnonzero((flat == 0x20) | (flat == 0x0A)), prepend=-1)


def byte_grams(flat: np.ndarray, stretches: np.ndarray) -> np.ndarray:
    """The gram of every byte: eight bytes packed, the context, its last byte
    uppermost, then the byte itself lowest."""
    n, low = len(flat), np.uint64(0xFF)
    padded = np.concatenate([np.zeros(8, np.uint8), flat])
    # the eight bytes before each byte as one little-endian number: the nearest is uppermost
    gram = np.ndarray(n, "<u8", padded, strides=(1,)).astype(np.uint64)
    gram &= ~low
    gram |= flat
    # the first DEPTH bytes of a stretch: what is before it is a space, then padding
    starts = np.cumsum(stretches) - stretches
    for place in range(min(DEPTH, int(stretches.max(initial=0)))):
        at = starts[stretches > place] + place
        own = np.uint64((1 << 64) - (1 << 64 - 8 * place))
        gram[at] = gram[at] & (own | low) | np.uint64(0x20 << 56 - 8 * place)
    return gram


def bucket_of(grams: np.ndarray) -> np.ndarray:
    """The last ``SPLIT`` bytes of the context; buckets are in the order of grams."""
    return (grams >> np.uint64(8 * (DEPTH + 1 - SPLIT))).astype(np.int64)


def shard_of(bucket, shards: int):
    """Shard of a bucket (array or Column)."""
    spread = bucket * 2654435761 + 40503
    if isinstance(bucket, Column):
        return F.pmod(F.shiftright(spread, 16), F.lit(shards))
    return (spread >> 16) % shards


def _runs(ordered: np.ndarray) -> np.ndarray:
    """Where runs of equal entries start."""
    return np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])[: len(ordered)])


def _combined(grams: np.ndarray, *counts: np.ndarray) -> list[np.ndarray]:
    """Distinct grams in order, with their counts added up; the given ones are in a few ordered runs."""
    order = np.argsort(grams, kind="stable")
    ordered = grams[order]
    first = _runs(ordered)
    return [ordered[first], *[np.add.reduceat(c[order], first) if len(first) else c for c in counts]]


def _width(x: np.ndarray) -> int:
    """Bytes that the whole numbers of a column take; 8 for floats and what has negative ones."""
    if x.dtype == np.float64 or not len(x) or x.min() < 0:
        return 8
    most = int(x.max())
    return 1 if most < 1 << 8 else 2 if most < 1 << 16 else 4 if most < 1 << 32 else 8


def _squeeze(keys: np.ndarray, *columns: np.ndarray) -> bytes:
    """Columns, compressed: keys (eight bytes, as differences), whole numbers in as few bytes as the largest
    takes, floats in eight. The first byte of each column but the keys says its width (8: as it is)."""
    import zstandard

    keys = keys.view(np.uint64)
    first = keys.copy()
    first[1:] -= keys[:-1]
    head, parts = bytearray(), [first]
    for x in columns:
        head.append(_width(x))
        parts.append(x.astype(f"u{head[-1]}") if head[-1] < 8 else x)
    return zstandard.ZstdCompressor(level=-1).compress(bytes(head) + b"".join(x.tobytes() for x in parts))


def _restore(blob: bytes, n: int, *types) -> list[np.ndarray]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(blob)
    at, out = len(types), [np.cumsum(np.frombuffer(raw, np.uint8, 8 * n, len(types)).view(np.uint64) if n else np.zeros(0, np.uint64),
                                     dtype=np.uint64)]
    at += 8 * n
    for width, kind in zip(raw, types):
        x = np.frombuffer(raw, kind if width == 8 else f"u{width}", n, at)
        out.append(x.astype(kind) if width < 8 else x)
        at += width * n
    return out


# ------------------------------------------------------------------ weighting

_SMALL = 1 << 14
#: Log gamma of k + 1/2 and of k + 1 for small counts.
_HALF, _WHOLE = (np.array([math.lgamma(k + x) for k in range(_SMALL)]) for x in (0.5, 1.0))


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log Krichevsky-Trofimov probability of a sequence with these counts."""
    return _lgamma(zeros, 0.5, _HALF) + _lgamma(ones, 0.5, _HALF) - _lgamma(zeros + ones, 1.0, _WHOLE) - np.log(np.pi)


def _lgamma(counts: np.ndarray, more: float, small: np.ndarray) -> np.ndarray:
    """Log gamma of counts + more; Stirling's series where the table ends."""
    out = small[np.minimum(counts, _SMALL - 1).astype(np.int64)]
    large = counts >= _SMALL
    if large.any():
        y = counts[large] + more
        out[large] = (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y ** 3)
    return out


class Level:
    """Decisions of one depth: key, counts, log weighted probability, weight of stopping."""

    def __init__(self, keys, zeros, ones, below=None):
        self.keys, self.zeros, self.ones = keys, zeros, ones
        own = log_kt(zeros, ones)
        self.weighted = own if below is None else np.logaddexp(own, below) + np.log(0.5)
        self.stop = np.ones(len(zeros)) if below is None else np.exp(own + np.log(0.5) - self.weighted)

    def chance(self, bit: int) -> np.ndarray:
        """The depth's own estimate of a decision."""
        return ((self.ones if bit else self.zeros) + 0.5) / (self.zeros + self.ones + 1.0)


def _sums(owner: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    return np.bincount(owner, weights=values, minlength=size).astype(float)


def _group(keys, *values):
    found, index = np.unique(keys, return_inverse=True)
    return found, index, [_sums(index, v, len(found)) for v in values]


def _shorter(keys: np.ndarray) -> np.ndarray:
    """The same bytes or decisions in contexts that are a byte shorter."""
    return (keys >> np.uint64(16)) << np.uint64(8) | (keys & np.uint64(0xFF))


def _depths(grams: np.ndarray, counts: np.ndarray, top: int) -> list[tuple]:
    """From depth ``DEPTH`` to ``top``: distinct (context << 8 | byte) in order, their counts, and by entry
    of the depth before where its shorter context is."""
    out = [(grams, counts, None)]
    for _ in range(DEPTH - top):
        shorter = _shorter(out[-1][0])
        order = np.argsort(shorter)
        ordered = shorter[order]
        first = _runs(ordered)
        up = np.empty(len(order), np.int32)
        up[order] = np.repeat(np.arange(len(first), dtype=np.int32), np.diff(np.append(first, len(order))))
        out.append((ordered[first], np.add.reduceat(out[-1][1][order], first), up))
    return out


def weigh(grams: np.ndarray, counts: np.ndarray, top: int = SPLIT, values: bool = True):
    """Weighting of all depths from ``DEPTH`` to ``top``, over whole subtrees; grams are distinct and in order.

    Returns by gram the probabilities of its eight decisions as seen at depth
    ``top`` (None unless ``values``), and that depth's (key, zeros, ones, weighted) rows, where a key is
    the context and the decision in two bytes or more: context << 8 | decision.
    """
    depths = _depths(grams, counts, top)
    places = [None]      # by gram, where its (shorter context, byte) is at each depth
    for _, _, up in depths[1:] if values else ():
        places.append(up if places[-1] is None else up[places[-1]])
    probabilities = np.empty((8, len(grams))) if values else None
    rows: list[tuple] = []
    for j in range(8):
        shift, seen, last = np.uint64(8 - j), None, None
        for depth, (keys, n, up) in enumerate(depths):
            # entries that share the decisions before are neighbours: byte prefixes in order
            first = _runs(keys >> shift)
            size = np.diff(np.append(first, len(keys)))
            bit = (keys >> np.uint64(7 - j)) & np.uint64(1) > 0
            total, ones = (np.add.reduceat(x, first) for x in (n, n * bit))
            node = np.repeat(np.arange(len(first), dtype=np.int32), size)
            below = None if last is None else _sums(node[up[last[0]]], last[1].weighted, len(first))
            level = Level(None, total - ones, ones, below)
            if values:
                own = np.where(bit, level.chance(1)[node], level.chance(0)[node])
                if seen is None:
                    seen = own
                else:
                    stop, here = level.stop[node], places[depth]
                    seen = (stop * own)[here] + (1 - stop)[here] * seen
            last = first, level
        if values:
            probabilities[j] = seen
        keys, (first, level) = depths[-1][0], last
        decision = np.uint64(1 << j) | ((keys[first] & np.uint64(0xFF)) >> shift)
        rows.append(((keys[first] >> np.uint64(8)) << np.uint64(8) | decision, level.zeros, level.ones, level.weighted))
    return probabilities, [np.concatenate(x) for x in zip(*rows)]


class Top:
    """The shallow depths, from the (key, zeros, ones, weighted) rows of depth ``SPLIT``."""

    def __init__(self, keys, zeros, ones, weighted):
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        rows = (self.keys, zeros[order], ones[order], weighted[order])
        self.up = []
        for _ in range(SPLIT):
            found, up, (n0, n1, below) = _group(_shorter(rows[0]), *rows[1:])
            level = Level(found, n0, n1, below)
            self.up.append((level, up))
            rows = (found, n0, n1, level.weighted)

    def log10(self, grams: np.ndarray, probabilities: np.ndarray) -> np.ndarray:
        """Log10 probability of each gram's byte in its context, for grams of one bucket."""
        total = np.zeros(len(grams))
        if not len(grams):
            return total
        context = grams[0] >> np.uint64(8 * (DEPTH + 1 - SPLIT)) << np.uint64(8)
        first, end = np.searchsorted(self.keys, [context, context + np.uint64(256)])
        # the bucket's decisions, 255 at most, and what the shallow depths make of them
        index, place = np.arange(first, end), np.zeros(256, np.int64)
        place[(self.keys[first:end] & np.uint64(0xFF)).astype(np.int64)] = np.arange(end - first)
        shallow = []
        for level, up in self.up:
            index = up[index]
            shallow.append((level.stop[index], np.stack([level.chance(bit)[index] for bit in (0, 1)])))
        byte = (grams & np.uint64(0xFF)).astype(np.int64)
        for j in range(8):
            bit, node = (byte >> 7 - j) & 1, place[1 << j | byte >> 8 - j]
            seen = probabilities[j]
            for stop, chance in shallow:
                seen = stop[node] * chance[bit, node] + (1 - stop[node]) * seen
            total += np.log10(seen)
        return total


# ------------------------------------------------------------------ counting

def _word_counts(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n_train, n_all), combined over many slices; the empty word stands for ends."""
    held: list[pa.Table] = []

    def combined() -> pa.Table:
        return pa.concat_tables(held).group_by("word").aggregate([("n_train", "sum"), ("n_all", "sum")]).rename_columns(
            ["word", "n_train", "n_all"])

    def told(parts: list[tuple]) -> None:
        words, use = pa.chunked_array([w for w, _, _ in parts], pa.string()), np.concatenate([u for _, u, _ in parts])
        ends = np.concatenate([t for _, _, t in parts])
        coded = words.combine_chunks().dictionary_encode()
        index = coded.indices.to_numpy()
        trained, every = (np.bincount(i, minlength=len(coded.dictionary)) for i in (index[use], index))
        held.append(pa.table({
            "word": pa.concat_arrays([coded.dictionary.cast(pa.binary()), pa.array([END], pa.binary())]),
            "n_train": pa.array(np.append(trained, ends.sum()), pa.int64()),
            "n_all": pa.array(np.append(every, len(ends)), pa.int64())}))

    parts, size = [], 0
    for batch in batches(stream):
        words, starts = split_words(batch.column("text"), lower=True)
        if parts and size + batch.column("text").nbytes > WORD_BYTES:
            told(parts)
            parts, size = [], 0
        train = batch.column("train").to_numpy(zero_copy_only=False).astype(bool)
        parts.append((words, np.repeat(train, np.diff(starts)), train))
        size += batch.column("text").nbytes
        if sum(t.num_rows for t in held) > HELD_WORDS:
            held = [combined()]
            if held[0].num_rows > HELD_WORDS // 2:
                yield from held.pop().to_batches(max_chunksize=50_000)
    if parts:
        told(parts)
    if held:
        yield from combined().to_batches(max_chunksize=50_000)


def _bucketed(gram: np.ndarray, n_train: np.ndarray, n_all: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(bucket, n, blob): the grams of every bucket in order with n_train and n_all; they come in order."""
    bucket = bucket_of(gram)
    first = _runs(bucket)
    ends = np.append(first[1:], len(bucket))
    yield pa.RecordBatch.from_arrays(
        [pa.array(bucket[first]), pa.array(ends - first),
         pa.array([_squeeze(gram[a:z], n_train[a:z], n_all[a:z]) for a, z in zip(first, ends)], pa.binary())],
        ["bucket", "n", "blob"])


class _Held:
    """Distinct grams with n_train and n_all, added up whenever many wait."""

    def __init__(self):
        self.parts: list[list[np.ndarray]] = []
        self.waiting, self.distinct = 0, 0

    def add(self, *part: np.ndarray) -> None:
        self.parts.append(list(part))
        self.waiting += len(part[0])
        # as much again as was distinct the last time, so adding up stays linear
        if self.waiting > 2 * max(MERGED_GRAMS // 2, self.distinct):
            self.whole()

    def whole(self) -> list[np.ndarray]:
        made = _combined(*[np.concatenate(x) for x in zip(*self.parts)]) if self.parts else [
            np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)]
        self.parts, self.waiting, self.distinct = [made], len(made[0]), len(made[0])
        return made


def _counted(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams and how often each occurs."""
    first = _runs(ordered)
    return ordered[first], np.diff(np.append(first, len(ordered)))


def _pile_counts(trained: np.ndarray, others: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The rows of ``_bucketed`` of grams inside and outside training, which are sorted in place."""
    trained.sort()
    others.sort()
    # whole buckets, some ``COMBINED_GRAMS`` at once
    low = np.uint64(8 * (DEPTH + 1 - SPLIT))
    cuts = np.unique([x[k] >> low << low for x in (trained, others) for k in range(COMBINED_GRAMS, len(x), COMBINED_GRAMS)])
    bounds = [[0, *np.searchsorted(x, cuts.astype(np.uint64)).tolist(), len(x)] for x in (trained, others)]
    for (a, b), (c, d) in zip(*(zip(x, x[1:]) for x in bounds)):
        (gram, times), (more, other) = _counted(trained[a:b]), _counted(others[c:d])
        gram, n_train, n_all = _combined(
            np.concatenate([gram, more]), np.concatenate([times, np.zeros_like(other)]), np.concatenate([times, other]))
        if len(gram):
            yield from _bucketed(gram, n_train, n_all)


def _gram_counts(across: bool):
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # grams of training texts from the front, others from the back
        pile, front, back = np.empty(0, np.uint64), 0, 0
        for batch in batches(stream, max_bytes=GRAM_BYTES):
            flat, sizes, stretches = spelt(batch.column("text"), across)
            gram = byte_grams(flat, stretches)
            if len(gram) > back - front:
                yield from _pile_counts(pile[:front], pile[back:])
                if len(gram) > len(pile):
                    pile = np.empty(max(HELD_GRAMS, len(gram)), np.uint64)
                front, back = 0, len(pile)
            train = np.repeat(batch.column("train").to_numpy(zero_copy_only=False).astype(bool), sizes)
            mine, rest = gram[train], gram[~train]
            pile[front: front + len(mine)] = mine
            pile[back - len(rest): back] = rest
            front, back = front + len(mine), back - len(rest)
        yield from _pile_counts(pile[:front], pile[back:])

    return run


def _merge(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row of a bucket out of all tasks' rows of it, which come one after another."""
    now, held = None, _Held()
    for batch in stream:
        for bucket, n, blob in zip(batch.column("bucket").to_pylist(), batch.column("n").to_pylist(), batch.column("blob")):
            if bucket != now and held.waiting:
                yield from _bucketed(*held.whole())
                held = _Held()
            now = bucket
            held.add(*_restore(blob.as_py(), n, np.int64, np.int64))
    if held.waiting:
        yield from _bucketed(*held.whole())


def _shallow(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The decisions of depth ``SPLIT``."""
    for batch in stream:
        for n, blob in zip(batch.column("n").to_pylist(), batch.column("blob")):
            gram, n_train, _ = _restore(blob.as_py(), n, np.int64, np.int64)
            _, (keys, zeros, ones, weighted) = weigh(gram, n_train.astype(float), values=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), pa.array(zeros), pa.array(ones), pa.array(weighted)],
                ["key", "zeros", "ones", "weighted"])


def gram_values(rows: DataFrame, across: bool) -> tuple[DataFrame, int]:
    """(bucket, n, blob): every gram of ``rows`` (text, train) with its log10
    probability and its number of occurrences, one row a bucket; and how many grams there are."""
    spark = rows.sparkSession
    kinds = "bucket long, n long, blob binary"
    spread = map_arrow(rows, _gram_counts(across), kinds).repartition("bucket").sortWithinPartitions("bucket")
    counted = materialise(map_arrow(spread, _merge, kinds), "op4-grams")
    total = counted.agg(F.sum("n")).first()[0] or 0
    dealt = counted.repartition(max(1, min(TASKS, -(-total // TASK_GRAMS))), "bucket")
    # at most 256 ** SPLIT contexts of 255 decisions, whatever the corpus
    shallow = map_arrow(dealt, _shallow, "key long, zeros double, ones double, weighted double").toArrow()
    top = spark.sparkContext.broadcast(Top(*(
        shallow.column(c).to_numpy().view(t) for c, t in (
            ("key", np.uint64), ("zeros", float), ("ones", float), ("weighted", float)))))

    def finish(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            blobs = []
            for n, blob in zip(batch.column("n").to_pylist(), batch.column("blob")):
                gram, n_train, n_all = _restore(blob.as_py(), n, np.int64, np.int64)
                seen, _ = weigh(gram, n_train.astype(float))
                blobs.append(_squeeze(gram, top.value.log10(gram, seen), n_all))
            yield pa.RecordBatch.from_arrays(
                [batch.column("bucket"), batch.column("n"), pa.array(blobs, pa.binary())], ["bucket", "n", "blob"])

    return materialise(map_arrow(dealt, finish, kinds), "op4-values"), total


class Frequent:
    """Frequent grams and their values, found by a table of slots; of grams that share a slot, it has the most
    frequent, and the others are found by their order."""

    def __init__(self, grams: np.ndarray, values: np.ndarray, sizes: np.ndarray):
        order = np.argsort(grams)
        self.grams, self.values, self.sizes = grams[order], values[order], sizes[order]
        self.bits = max(1, int(2 * len(grams)).bit_length())
        self.slots = np.zeros(1 << self.bits, np.int32)
        # of entries for one slot, the last stays
        rising = np.argsort(self.sizes, kind="stable").astype(np.int32)
        self.slots[self._slot(self.grams[rising])] = rising

    def __reduce__(self):
        return Frequent, (self.grams, self.values, self.sizes)

    def _slot(self, grams: np.ndarray) -> np.ndarray:
        return ((grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).view(np.int64)

    def in_slots(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether the slots have each gram, and its value there or zero."""
        if not len(self.grams):
            return np.zeros(len(grams), bool), np.zeros(len(grams))
        at = self.slots[self._slot(grams)]
        hit = self.grams[at] == grams
        return hit, np.where(hit, self.values[at], 0.0)

    def in_order(self, ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for any frequent gram, by search."""
        if not len(self.grams):
            return np.zeros(len(ordered), bool), np.zeros(len(ordered))
        at = np.minimum(np.searchsorted(self.grams, ordered), len(self.grams) - 1)
        hit = self.grams[at] == ordered
        return hit, np.where(hit, self.values[at], 0.0)


def _frequent(values: DataFrame) -> Frequent:
    """The most frequent grams, at most ``COMMON``."""
    def size(n):
        return np.floor(8 * np.log2(n)).astype(np.int64)

    def sizes(stream):
        for batch in stream:
            for n, blob in zip(batch.column("n").to_pylist(), batch.column("blob")):
                found, times = np.unique(size(_restore(blob.as_py(), n, float, np.int64)[2]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(times)], ["size", "times"])

    least, room = 1 << 30, COMMON
    for r in sorted(map_arrow(values, sizes, "size long, times long").groupBy("size").agg(
            F.sum("times").alias("times")).collect(), reverse=True):
        room -= r["times"]
        if room < 0:
            break
        least = r["size"]

    def chosen(stream):
        for batch in stream:
            for n, blob in zip(batch.column("n").to_pylist(), batch.column("blob")):
                gram, value, n_all = _restore(blob.as_py(), n, float, np.int64)
                sizes = size(n_all)
                use = sizes >= least
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gram[use].view(np.int64)), pa.array(value[use]), pa.array(sizes[use], pa.int16())],
                    ["gram", "value", "size"])

    table = map_arrow(values, chosen, "gram long, value double, size short").toArrow()
    gram, value, sizes = (table.column(c).to_numpy() for c in ("gram", "value", "size"))
    return Frequent(gram.view(np.uint64), value, sizes)


_DEALT = "shard long, kind int, slice long, n long, blob binary"


def _dealt(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                      ["shard", "kind", "slice", "n", "blob"])


def text_values(rows: DataFrame, across: bool) -> DataFrame:
    """(doc_id, version, value): log10 probability of every text of ``rows``
    (doc_id, version, text, train), trained on those with ``train``."""
    values, total = gram_values(rows.select("text", "train"), across)
    shards = max(1, -(-total // SHARD_GRAMS))
    shared = rows.sparkSession.sparkContext.broadcast(_frequent(values))

    def known(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """By slice a row of its documents with the sums over common grams, and one a shard of other grams."""
        from pyspark import TaskContext

        frequent = shared.value
        part = TaskContext.get().partitionId() << 32
        for part, batch in enumerate(batches(stream, max_bytes=2 * GRAM_BYTES), part):
            size = batch.num_rows
            flat, sizes, stretches = spelt(batch.column("text"), across)
            gram = byte_grams(flat, stretches)
            hit, worth = frequent.in_slots(gram)
            sums = np.add.reduceat(worth, np.cumsum(sizes) - sizes)     # no text is without bytes
            # the others, once each and in order
            gram, owner = gram[~hit], np.repeat(np.arange(size, dtype=np.int32), sizes)[~hit]
            order = np.argsort(gram)
            gram, owner = gram[order], owner[order]
            first = _runs(gram)
            names, times = gram[first], np.diff(np.append(first, len(gram)))
            hit, worth = frequent.in_order(names)
            sums += _sums(owner, np.repeat(worth, times), size)
            ids = batch.column("doc_id")
            out = [(-1 - part, 0, part, size, _squeeze(
                batch.column("version").to_numpy(), pc.fill_null(ids, 0).to_numpy(),
                ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64), sums))]
            rare = np.repeat(~hit, times)
            pair = np.sort(np.repeat(np.arange(len(names)), times)[rare] * size + owner[rare])
            first = _runs(pair)
            times, pair = np.diff(np.append(first, len(pair))), pair[first]
            gram, doc = names[pair // size], pair % size
            shard = shard_of(bucket_of(gram), shards)
            # grams stay in order inside a shard; few shards sort by their digits
            order = np.argsort(shard.astype(np.uint16) if shards < 1 << 16 else shard, kind="stable")
            gram, doc, times, shard = gram[order], doc[order], times[order], shard[order]
            first = _runs(shard)
            for x, a, z in zip(shard[first].tolist(), first, np.append(first[1:], len(shard))):
                out.append((x, 1, part, z - a, _squeeze(gram[a:z], doc[a:z], times[a:z])))
            yield _dealt(out)

    def add_up(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of documents as they are; a shard's values come first, then its grams, summed by document."""
        now, parts, table = None, [], None
        for batch in stream:
            out = []
            for shard, kind, part, n, blob in zip(*(batch.column(c).to_pylist() for c in (
                    "shard", "kind", "slice", "n", "blob"))):
                if shard < 0:
                    out.append((shard, kind, part, n, blob))
                elif kind == 0:
                    parts = [*(parts if shard == now else []), _restore(blob, n, float, np.int64)[:2]]
                    now, table = shard, None
                else:
                    if table is None:
                        gram, value = (np.concatenate(x) for x in zip(*parts))
                        order = np.argsort(gram)
                        table = gram[order], value[order]
                    gram, doc, times = _restore(blob, n, np.int64, np.int64)
                    own = np.flatnonzero(np.bincount(doc))
                    sums = _sums(doc, table[1][np.searchsorted(table[0], gram)] * times, 0)[own]
                    out.append((shard, kind, part, len(own), _squeeze(own, sums)))
            if out:
                yield _dealt(out)

    def whole(table: pa.Table) -> pa.Table:
        total, parts = None, []
        for shard, n, blob in zip(*(table.column(c).to_pylist() for c in ("shard", "n", "blob"))):
            if shard < 0:
                version, doc, null, total = _restore(blob, n, np.int64, np.int64, float)
                total = total.copy()
            else:
                parts.append(_restore(blob, n, float))
        for own, sums in parts:
            total[own.view(np.int64)] += sums
        return pa.table({"doc_id": pa.array(doc, mask=null > 0), "version": version.view(np.int64), "value": total})

    given = values.select(shard_of(F.col("bucket"), shards).alias("shard"), F.lit(0).alias("kind"),
                          F.lit(-1).cast("long").alias("slice"), "n", "blob")
    dealt = map_arrow(rows.select("doc_id", "version", "text"), known, _DEALT).unionByName(given)
    summed = map_arrow(dealt.repartition("shard").sortWithinPartitions("shard", "kind"), add_up, _DEALT)
    return summed.groupBy("slice").applyInArrow(whole, "doc_id long, version long, value double")


def _common(df: DataFrame, weight: str) -> DataFrame:
    """The rows of the greatest weights, ``COMMON_WORDS`` at most."""
    size = F.floor(8 * F.log2(weight))
    least, room = 1 << 30, COMMON_WORDS
    for r in sorted(df.groupBy(size.alias("size")).count().collect(), reverse=True):     # at most 8 x 64 sizes
        room -= r["count"]
        if room < 0:
            break
        least = r["size"]
    return df.filter(size >= least)


def score(docs: DataFrame, held_out, across: bool = False) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    n_bytes and bits_per_byte. ``held_out``: Boolean column over doc_id; ``across``:
    contexts go over word ends."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"),
                       F.coalesce(held_out, F.lit(False)).alias("held_out"))
    counts = map_arrow(rows.select("text", (~F.col("held_out")).alias("train")), _word_counts,
                       "word binary, n_train long, n_all long")
    words = materialise(counts.groupBy("word").agg(
        F.sum("n_train").alias("n_train"), F.sum("n_all").alias("n_all")), "op4-words")
    total, distinct = words.agg(F.sum("n_train"), F.sum((F.col("n_train") > 0).cast("long"))).first()
    total, distinct = total or 0, distinct or 0
    scored = materialise(words.select(
        "word", "n_train", "n_all",
        F.log10((F.col("n_train") + 1) / F.lit(float(total + distinct + 1))).alias("base")), "op4-scored")
    table = _common(scored, "n_all").select("word", "n_train", "base").toArrow()
    shared = spark.sparkContext.broadcast((
        table.column("word").combine_chunks().cast(pa.binary()),
        np.stack([np.append(x, np.nan) for x in (
            (table.column("n_train").to_numpy() > 0).astype(float), table.column("base").to_numpy())], 1)))

    def known(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row a document with the sums over its common words, and one for each rare word."""
        place, values = shared.value
        for batch in batches(stream):
            words, starts = split_words(batch.column("text"), lower=True)
            coded = words.dictionary_encode()
            names = coded.dictionary.cast(pa.binary())
            found = pc.fill_null(pc.index_in(names, value_set=place), -1).to_numpy()
            owner = np.repeat(np.arange(batch.num_rows), np.diff(starts))
            index = coded.indices.to_numpy()
            at = found[index] if len(index) else np.zeros(0, np.int64)
            hit, size = at >= 0, batch.num_rows
            ids = batch.column("row")
            sums = [_sums(owner[hit], values[at[hit], k], size) for k in range(2)]
            lengths = _sums(owner, pc.binary_length(words).to_numpy(), size)
            pair, times = np.unique(owner[~hit] * np.int64(len(names) + 1) + index[~hit], return_counts=True)
            rare, word = pair // (len(names) + 1), pair % (len(names) + 1)
            n = len(pair)
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([ids, ids.take(pa.array(rare))]),
                 pa.concat_arrays([pa.nulls(size, pa.binary()), names.take(pa.array(word))]),
                 pa.array(np.concatenate([np.diff(starts) + 1, times]), pa.int64()),
                 *[pa.array(np.concatenate([x, np.zeros(n)])) for x in (*sums, lengths + np.diff(starts) + 1)]],
                ["row", "word", "n", "n_known", "base", "n_bytes"])

    ends = scored.filter(F.col("word") == F.lit(END)).select("n_train", "base").first()
    end = (float(ends[0] > 0), ends[1]) if ends else (0.0, 0.0)
    rows = rows.withColumn("version", F.xxhash64("text"))
    row, nothing = F.struct("doc_id", "version").alias("row"), F.lit(0.0)
    parts = map_arrow(rows.select(row, "text"), known,
                      "row struct<doc_id:long,version:long>, word binary, n long, n_known double, base double, "
                      "n_bytes double").withColumn("value", nothing)
    rare = parts.filter("word is not null").select("row", "word", "n").join(
        scored.select("word", "n_train", F.col("base").alias("b")), "word").select(
        "row", F.lit(0).cast("long").alias("n"), (F.col("n") * (F.col("n_train") > 0).cast("int")).cast("double").alias("n_known"),
        (F.col("n") * F.col("b")).alias("base"), nothing.alias("n_bytes"), nothing.alias("value"))
    texts = text_values(rows.withColumn("train", ~F.col("held_out")), across).select(
        row, F.lit(0).cast("long").alias("n"), nothing.alias("n_known"), nothing.alias("base"),
        nothing.alias("n_bytes"), "value")
    whole = parts.filter("word is null").drop("word")
    return _finish(whole.unionByName(texts), rare, rows, held_out, end, total)


def _finish(whole: DataFrame, rare: DataFrame, rows: DataFrame, held_out, end, total: int) -> DataFrame:
    # rows that repeat a document add up in the same group: the number of copies divides them
    sums = whole.unionByName(rare).groupBy("row").agg(
        F.sum((F.col("n") > 0).cast("long")).alias("copies"), F.sum("n").alias("n"), F.sum("n_known").alias("n_known"),
        F.sum("base").alias("base"), F.sum("value").alias("value"), F.sum("n_bytes").alias("n_bytes"))
    each = sums.select(
        F.col("row.doc_id").alias("doc_id"), "copies",
        (F.col("n") / F.col("copies")).cast("long").alias("n_tokens"),
        (F.round(F.col("n_known") / F.col("copies")).cast("long") + int(end[0])).alias("n_known"),
        (F.col("base") / F.col("copies") + end[1]).alias("base_score"),
        (F.col("value") / F.col("copies")).alias("score"),
        (F.col("n_bytes") / F.col("copies")).cast("long").alias("n_bytes"))
    return each.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "n_tokens", "n_known",
        F.lit(total).cast("long").alias("train_tokens"), "base_score", "score", "n_bytes",
        (-F.col("score") / F.lit(float(np.log10(2))) / F.col("n_bytes")).alias("bits_per_byte"))
