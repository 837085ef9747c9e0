"""Line dedup by pairwise alignment.

Every key's hash knows the first document (smallest doc_id) that has it and its
number of documents. Keys are the lines, and from every line that is shorter
than ``MIN_WORDS`` words the run of lines that reaches them: whatever run can be
deleted starts with a key. A document is paired with the first documents of all
its shared keys, however common. A pair is always (later, first), so a key in
n documents gives n - 1 pairs at most. A first document of keys in more than
``DEALT`` documents is copied, and its pairs are dealt over the copies. Pairs are
aligned on line hashes by patience diff, and where a gap has no lines that are
unique on both sides, by its heaviest common subsequence; aligned runs of
``MIN_WORDS`` words or more are deleted from the later document. Each stretch that is left
is aligned with the first document again (without lines that were aligned in
shorter runs), until nothing more aligns, so a block that has moved goes too.

Defined results: lines are split at line feeds; lines without a word are never
a reason to pair, but go with a block that spans them; null text stays null and
has no lines; rows that repeat a doc_id with the same text are one document
(and lose the same lines); a null doc_id is left as it is; a document that
loses every line keeps its row with an empty text; an empty table gives an
empty result; extra columns are kept by ``drop_lines``.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import batches, map_arrow, materialise, pack, text_bytes, unpacked

MIN_WORDS = 5
#: Documents a copy of a first document is paired with, and rows of one key that a task joins, at most.
DEALT, HOT = 16, 2000


def _longest_increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest run of pairs (sorted by the first) that increases in the second."""
    tops: list[int] = []
    ends: list[int] = []
    back: list[int] = []
    for k, (_, j) in enumerate(pairs):
        at = bisect_left(tops, j)
        back.append(ends[at - 1] if at else -1)
        if at == len(tops):
            tops.append(j)
            ends.append(k)
        else:
            tops[at], ends[at] = j, k
    out, k = [], ends[-1] if ends else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def _row(one: list, places: dict, weights: np.ndarray) -> np.ndarray:
    """Weight of the heaviest common subsequence of ``one`` and each start of the other side."""
    row = np.zeros(len(weights) + 1, np.int64)
    for x in one:
        at = places.get(x)
        if at is not None:
            fresh = row.copy()
            fresh[at + 1] = np.maximum(fresh[at + 1], row[at] + weights[at])
            row = np.maximum.accumulate(fresh)
    return row


def _heaviest(one: list, two: list, weights: list[int]) -> list[tuple[int, int]]:
    """Index pairs of the heaviest common subsequence, by halving ``one``: memory for one row."""
    def places(side):
        out: dict = {}
        for j, x in enumerate(side):
            out.setdefault(x, []).append(j)
        return {x: np.array(j) for x, j in out.items()}

    found, todo = [], [(0, len(one), 0, len(two))]
    while todo:
        a, b, c, d = todo.pop()
        if b - a == 1:
            at = [j for j in range(c, d) if two[j] == one[a]]
            found.extend([(a, max(at, key=lambda j: weights[j]))] if at else [])
        elif b - a > 1 and c < d:
            middle, w = (a + b) // 2, np.array(weights[c:d], np.int64)
            upper = _row(one[a:middle], places(two[c:d]), w)
            lower = _row(one[middle:b][::-1], places(two[c:d][::-1]), w[::-1])[::-1]
            cut = c + int(np.argmax(upper + lower))
            todo += [(a, middle, c, cut), (middle, b, cut, d)]
    return found


def patience(one: list, two: list, weights: list[int] | None = None) -> list[tuple[int, int]]:
    """Aligned index pairs, in order: equal ends first, then lines that are unique
    on both sides, then the gaps between them in the same way. A gap without such
    lines takes its heaviest common subsequence by ``weights`` of the lines of ``two``."""
    found: list[tuple[int, int]] = []
    todo = [(0, len(one), 0, len(two))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and one[a] == two[c]:
            found.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and one[b - 1] == two[d - 1]:
            b, d = b - 1, d - 1
            found.append((b, d))
        if a == b or c == d:
            continue
        left, right = Counter(one[a:b]), Counter(two[c:d])
        place = {x: j for j, x in enumerate(two[c:d], c) if right[x] == 1}
        anchors = _longest_increasing([(i, place[x]) for i, x in enumerate(one[a:b], a) if left[x] == 1 and x in place])
        if not anchors:
            rows, columns = ([k for k in span if x[k] in other] for span, x, other in (
                (range(a, b), one, right), (range(c, d), two, left)))
            found.extend((rows[i], columns[j]) for i, j in _heaviest(
                [one[k] for k in rows], [two[k] for k in columns], [1 + weights[k] if weights else 1 for k in columns]))
            continue
        found.extend(anchors)
        for (i, j), (k, m) in zip([(a - 1, c - 1), *anchors], [*anchors, (b, d)]):
            todo.append((i + 1, k, j + 1, m))
    return sorted(found)


def runs_of(aligned: list[tuple[int, int]], weights: list[int], least: int = MIN_WORDS) -> list[tuple[int, int]]:
    """Ranges of the second side that are runs of aligned pairs with a weight of ``least`` or more."""
    out: list[tuple[int, int]] = []
    run: list[tuple[int, int]] = []
    for pair in [*aligned, (-1, -1)]:
        if run and pair != (run[-1][0] + 1, run[-1][1] + 1):
            begin, stop = run[0][1], run[-1][1] + 1
            if sum(weights[begin:stop]) >= least:
                out.append((begin, stop))
            run = []
        run.append(pair)
    return out


def _may_hold(two: list, weights: list[int], known: set, least: int) -> bool:
    """Some neighbouring lines that ``one`` has weigh enough."""
    held = 0
    for x, w in zip(two, weights):
        held = held + w if x in known else 0
        if held >= least:
            return True
    return False


def common_blocks(one: list, two: list, weights: list[int], least: int = MIN_WORDS) -> list[tuple[int, int]]:
    """Ranges of ``two`` that go: aligned runs, then those of each stretch that is left, aligned with all of
    ``one`` again, so blocks that have moved are found as well. Where a stretch's aligned lines make no
    run that is heavy enough, they are set aside and the rest of it is aligned without them."""
    found, todo, known = [], [(0, len(two))], set(one)
    while todo:
        a, b = todo.pop()
        stretch = list(two[a:b])
        while _may_hold(stretch, weights[a:b], known, least):
            aligned = patience(one, stretch, weights[a:b])
            runs = [(a + x, a + y) for x, y in runs_of(aligned, weights[a:b], least)]
            if runs:
                found += runs
                ends = [a, *[y for _, y in runs]]
                todo += [(x, y) for x, y in zip(ends, [*[x for x, _ in runs], b]) if x < y]
                break
            for _, j in aligned:
                stretch[j] = None
    return sorted(found)


def _line_arrays(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, version, and by line its hash and number of words."""
    import xxhash

    for batch in batches(stream):
        hashes, words, versions = [], [], []
        for text in text_bytes(batch.column("text")):
            lines = text.split(b"\n")
            words.append(np.array([len(x.split()) for x in lines], "<i4").tobytes())
            hashes.append(np.array([xxhash.xxh3_64_intdigest(x) for x in lines], np.uint64).tobytes())
            versions.append(xxhash.xxh3_64_intdigest(text) - (1 << 63))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(versions, pa.int64()), pa.array(hashes, pa.binary()),
             pa.array(words, pa.binary())], ["doc_id", "version", "hashes", "words"])


def _runs(hashes: bytes, words: np.ndarray) -> list[int]:
    """Keys of the runs of lines that reach ``MIN_WORDS`` words, from lines that do not."""
    import xxhash

    ends = np.cumsum(words)
    starts = np.flatnonzero((words > 0) & (words < MIN_WORDS))
    stops = np.searchsorted(ends, ends[starts] - words[starts] + MIN_WORDS) + 1
    return [xxhash.xxh3_64_intdigest(hashes[8 * a: 8 * z], 1) - (1 << 63)
            for a, z in zip(starts.tolist(), stops.tolist()) if z <= len(words)]


def _line_rows(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct keys, by document: lines with a word, and runs of short lines."""
    for batch in stream:
        lines, docs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for doc, hashes, words in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "hashes", "words"))):
            n_words = np.frombuffer(words, "<i4")
            own = np.unique(np.concatenate([np.frombuffer(hashes, np.int64)[n_words > 0],
                                            np.array(_runs(hashes, n_words), np.int64)]))
            lines.append(own)
            docs.append(np.full(len(own), doc, np.int64))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(lines)), pa.array(np.concatenate(docs))], ["line", "doc_id"])


def _align(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in stream:
        ids, versions, spans = [], [], []
        for doc, version, first, own, words in zip(*(batch.column(c).to_pylist() for c in (
                "doc_id", "version", "first_hashes", "hashes", "words"))):
            blocks = common_blocks(np.frombuffer(first, np.int64).tolist(), np.frombuffer(own, np.int64).tolist(),
                                   np.frombuffer(words, "<i4").tolist())
            if blocks:
                ids.append(doc)
                versions.append(version)
                spans.append(blocks)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(versions, pa.int64()),
             pa.array([[{"begin": a, "stop": b} for a, b in x] for x in spans],
                      pa.list_(pa.struct([("begin", pa.int32()), ("stop", pa.int32())])))],
            ["doc_id", "version", "spans"])


def deletions(docs: DataFrame) -> DataFrame:
    """(doc_id, version, spans): line ranges to delete, as lists by pair of documents."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).filter(
        "doc_id is not null and text is not null")
    arrays = materialise(map_arrow(rows, _line_arrays, "doc_id long, version long, hashes binary, words binary")
                         .dropDuplicates(["doc_id", "version"]), "op7-lines")
    lines = map_arrow(arrays.select("doc_id", "hashes", "words"), _line_rows, "line long, doc_id long").distinct()
    lines = materialise(lines, "op7-rows")
    shared = materialise(lines.groupBy("line").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).filter("n > 1"),
                         "op7-shared")
    # keys of many documents, at most one in HOT rows, are dealt over salts
    hot = F.broadcast(shared.filter(F.col("n") > HOT).select("line", F.ceil(F.col("n") / HOT).cast("int").alias("salts")))
    salts = F.coalesce("salts", F.lit(1))
    held = lines.join(hot, "line", "left").withColumn("salt", F.pmod(F.xxhash64("doc_id"), salts).cast("int")).drop("salts")
    dealt = shared.join(hot, "line", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("salts")
    partners = materialise(held.join(dealt, ["line", "salt"]).filter("first < doc_id").groupBy("doc_id", "first").agg(
        F.max("n").alias("n")), "op7-pairs")
    last = F.floor(F.col("n") / DEALT)
    copies = partners.groupBy("first").agg(F.max("n").alias("n")).select(
        "first", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("salt"))
    firsts = arrays.select(F.col("doc_id").alias("first"), F.col("hashes").alias("first_hashes")).join(copies, "first")
    dealt = partners.select("doc_id", "first", F.pmod(F.xxhash64("doc_id"), last + 1).alias("salt"))
    pairs = dealt.join(firsts, ["first", "salt"]).join(arrays, "doc_id")
    return map_arrow(pairs.select("doc_id", "version", "first_hashes", "hashes", "words"), _align,
                     "doc_id long, version long, spans array<struct<begin:int,stop:int>>")


def _cut(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import xxhash

    for batch in unpacked(stream):
        n_lines, n_deleted, kept = [], [], []
        for present, text, found in zip(batch.column("text").is_valid().to_pylist(), text_bytes(batch.column("text")),
                                        batch.column("found").to_pylist()):
            lines = text.split(b"\n") if present else []
            version = xxhash.xxh3_64_intdigest(text) - (1 << 63)
            gone = np.zeros(len(lines), bool)
            for f in found or ():
                if f["version"] == version:
                    for s in f["spans"]:
                        gone[s["begin"]: s["stop"]] = True
            n_lines.append(len(lines))
            n_deleted.append(int(gone.sum()))
            kept.append(b"\n".join(x for x, g in zip(lines, gone) if not g).decode() if present else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("boxed"), pa.array(n_lines, pa.int64()), pa.array(n_deleted, pa.int64()),
             pa.array(kept, pa.string())], ["boxed", "n_lines", "n_deleted", "kept"])


def cut_lines(docs: DataFrame, carry: list[str]) -> DataFrame:
    """boxed (the ``carry`` columns), n_lines, n_deleted and kept (the text left), by row of ``docs``."""
    found = materialise(deletions(docs), "op7-spans").groupBy(F.col("doc_id").alias("_id")).agg(
        F.collect_list(F.struct("version", "spans")).alias("found"))
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("text"),
                       F.struct(*[F.col(f"`{c}`") for c in carry]).alias("boxed"))
    joined = pack(rows).join(found, "_id", "left").select("boxed", "packed", "found")
    out = T.StructType([joined.schema["boxed"], T.StructField("n_lines", T.LongType()),
                        T.StructField("n_deleted", T.LongType()), T.StructField("kept", T.StringType())])
    return map_arrow(joined, _cut, out)


def digests(docs: DataFrame) -> DataFrame:
    return cut_lines(docs, ["doc_id"]).select(
        "boxed.doc_id", "n_lines", "n_deleted", F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"))


def drop_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the lines deleted from text; n_chars, where present, counts what is left."""
    carry = [c for c in docs.columns if c != "text"]
    cut = cut_lines(docs, carry)
    return cut.select(*[
        F.col("kept").alias(c) if c == "text" else
        F.when(F.col("n_deleted") > 0, F.char_length("kept")).otherwise(F.col("boxed.n_chars"))
        .cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(f"boxed.`{c}`")
        for c in docs.columns])
