"""Substring dedup with repeated-phrase automata.

A window is ``WINDOW`` consecutive words of one document. Its anchor is the
smallest hash among the ``PHRASE``-word phrases inside it, a function of the
window's content alone: equal windows have equal anchors.

1. Anchors found in two documents or more recur (an aggregation of one row per
   document and anchor). Only windows with a recurring anchor go on, as
   segments: maximal runs of windows with the same anchor.
2. Recurring windows are confirmed by an aggregation over (anchor, window
   hash): the smallest and largest document that hold it. The segments in which the smallest
   documents hold them are the recurring passages.
3. Shards of anchors compile the passages' phrases into Aho-Corasick automata, and stream every
   later document's segments through them. Where a phrase occurs, the words of segment and passage
   are compared to both sides; a common run of ``WINDOW`` words or more goes if the passage's document
   precedes the segment's. So the automata alone say where passages may be, and words, not hashes,
   what is removed. Segments of a hot anchor are dealt over salts before their words are moved, each salt with the
   same passages. Texts that repeat a phrase over and over (more than ``MOST_ALIGNED`` ways to lay
   one on the other) are compared by the hashes of all their windows instead.

Defined results: words are ``[^\\x20\\x09-\\x0D]+``, unchanged; null text has
none; a document shorter than a window loses nothing; rows that repeat a
doc_id are one document (no id precedes itself); a null doc_id precedes
nothing and loses nothing; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import batches, map_arrow, materialise, mix, pack, rolling, spaced, split_words, unpacked, word_hashes

WINDOW, PHRASE = 50, 12
#: Segments that one automaton streams, about.
SHARD_SEGMENTS = 20_000
#: Ways to lay a segment on a passage, phrase on phrase, that are tried one by one.
MOST_ALIGNED = 256


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of every ``width`` consecutive entries (shorter at the end)."""
    out, done = x.copy(), 1
    while done < width:
        step = min(done, width - done)
        out[: len(out) - step] = np.minimum(out[: len(out) - step], out[step:])
        done += step
    return out


def _flat_anchors(texts: pa.Array):
    """Words, document starts and each word's window anchor; those that run over
    a document's end are meaningless."""
    words, starts = split_words(texts)
    hashed = word_hashes(words)
    anchors = _least(rolling(hashed, PHRASE), WINDOW - PHRASE + 1) if len(hashed) else hashed
    return words, starts, anchors


def _anchor_rows(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches(stream):
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        _, starts, anchors = _flat_anchors(batch.column("text"))
        docs, found = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for k in range(batch.num_rows):
            own = np.unique(anchors[starts[k]: max(starts[k], starts[k + 1] - WINDOW + 1)])
            found.append(own)
            docs.append(np.full(len(own), ids[k], np.int64))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(found).view(np.int64)), pa.array(np.concatenate(docs))], ["anchor", "doc_id"])


def _segments(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of windows with one recurring anchor: anchor, doc_id, version, start, words,
    and whether the anchor has an earlier document (``later``)."""
    for batch in unpacked(stream):
        words, starts, anchors = _flat_anchors(batch.column("text"))
        if not len(words):
            continue
        letters, places = spaced(words)
        rows: list[tuple] = []
        for k, (doc, version, later, others) in enumerate(zip(
                *(batch.column(c).to_pylist() for c in ("doc_id", "version", "later", "firsts")))):
            first, n = int(starts[k]), int(starts[k + 1] - starts[k]) - WINDOW + 1
            if n <= 0 or not (later or others):
                continue
            behind = set(later)
            own = anchors[first: first + n]
            edges = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            hot = np.isin(own[edges].view(np.int64), np.array(later + others, np.int64))
            for a, b in zip(edges[hot], np.append(edges[1:], n)[hot]):
                cut = letters[places[first + a]: places[first + b + WINDOW - 1] - 1]
                anchor = int(own[a].astype(np.int64))
                rows.append((anchor, doc, version, int(a), cut.tobytes(), anchor in behind))
        cols = list(zip(*rows)) or [()] * 6
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.int32()))]
            + [pa.array(cols[4], pa.binary()).cast(pa.string()), pa.array(cols[5], pa.bool_())],
            ["anchor", "doc_id", "version", "start", "words", "later"])


def _window_rows(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor, window, least, most): a slice's windows with the documents that hold
    them, copies within the slice combined."""
    for batch in batches(stream, "words"):
        words, starts = split_words(batch.column("words"))
        hashed = rolling(word_hashes(words, seed=1), WINDOW)
        sizes = np.maximum(np.diff(starts) - WINDOW + 1, 0)
        row = np.repeat(np.arange(batch.num_rows), sizes)
        at = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + starts[:-1][row]
        anchor, doc = (batch.column(c).to_numpy()[row] for c in ("anchor", "doc_id"))
        window = hashed[at].view(np.int64)
        order = np.lexsort((doc, window, anchor))
        anchor, window, doc = anchor[order], window[order], doc[order]
        new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (window[1:] != window[:-1])])[: len(doc)]
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(doc))[: len(first)] - 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, pa.int64()) for x in (anchor[first], window[first], doc[first], doc[last])],
            ["anchor", "window", "least", "most"])


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint ranges that cover the same."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _equal(one: np.ndarray, two: np.ndarray) -> int:
    """Length of the common start."""
    n = min(len(one), len(two))
    apart = np.flatnonzero(one[:n] != two[:n])
    return int(apart[0]) if len(apart) else n


def _common_runs(own: np.ndarray, found: list[int], passage: np.ndarray, places: list[int]) -> list[tuple[int, int]]:
    """Ranges of ``own`` words, ``WINDOW`` or more, that ``passage`` has too, with a phrase at one of ``found`` there
    and at one of ``places`` here."""
    if len(found) * len(places) > MOST_ALIGNED:
        return _common_windows(own, passage)
    out, reached = [], {}
    for p in found:
        for h in places:
            if p < reached.get(p - h, 0):       # inside the run found on this diagonal
                continue
            a = _equal(own[:p][::-1], passage[:h][::-1])
            b = PHRASE + _equal(own[p + PHRASE:], passage[h + PHRASE:])
            reached[p - h] = p + b
            if a + b >= WINDOW:
                out.append((p - a, p + b))
    return out


def _common_windows(own: np.ndarray, passage: np.ndarray) -> list[tuple[int, int]]:
    """The same by the hashes of all windows."""
    ends = [max(0, len(x) - WINDOW + 1) for x in (own, passage)]
    one, two = (rolling(mix(x.astype(np.uint64) + np.uint64(1)), WINDOW)[:n] for x, n in zip((own, passage), ends))
    shared = np.flatnonzero(np.isin(one, two))
    return _merged([(int(k), int(k) + WINDOW) for k in shared])


def _locate(key: tuple, segments: pa.Table, passages: pa.Table) -> pa.Table:
    """Compile the phrases of a shard's passages and stream its segments through them."""
    import ahocorasick

    none = pa.table({"doc_id": pa.array([], pa.int64()), "version": pa.array([], pa.int64()),
                     "begin": pa.array([], pa.int32()), "stop": pa.array([], pa.int32())})
    if not segments.num_rows or not passages.num_rows:
        return none
    # equal texts are streamed once; words get codes that both sides share
    texts = segments.column("words").combine_chunks().dictionary_encode()
    words, starts = split_words(pa.concat_arrays([texts.dictionary, passages.column("words").combine_chunks()]))
    codes = words.dictionary_encode().indices.to_numpy().astype(np.int64)
    cut = [codes[a:b] for a, b in zip(starts[:-1], starts[1:])]
    own, held = cut[: len(texts.dictionary)], cut[len(texts.dictionary):]
    phrases = rolling(word_hashes(words), PHRASE).view(np.int64)
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    holders: dict[int, list] = {}       # by anchor: document, words, where the phrase is
    for k, (anchor, doc) in enumerate(zip(passages.column("anchor").to_pylist(), passages.column("doc_id").to_pylist())):
        first = starts[len(own) + k]
        places = np.flatnonzero(phrases[first: first + len(held[k]) - PHRASE + 1] == anchor).tolist()
        if anchor not in holders:
            automaton.add_word(tuple(held[k][places[0]: places[0] + PHRASE].tolist()), anchor)
        holders.setdefault(anchor, []).append((doc, held[k], places))
    automaton.make_automaton()
    which, docs = texts.indices.to_numpy(), segments.column("doc_id").to_numpy()
    latest = np.full(len(own), -(1 << 63), np.int64)
    np.maximum.at(latest, which, docs)
    matches: list[list[tuple[int, int, int]]] = []
    for k, code in enumerate(own):
        found: dict[int, list[int]] = {}
        for end, anchor in automaton.iter(tuple(code.tolist())):
            found.setdefault(anchor, []).append(end + 1 - PHRASE)
        matches.append([(a, b, doc) for anchor, at in found.items() for doc, passage, places in holders[anchor]
                        if doc < latest[k] for a, b in _common_runs(code, at, passage, places)])
    first_holder = [max((doc for _, _, doc in m), default=0) for m in matches]
    whole = [_merged([(a, b) for a, b, _ in m]) for m in matches]
    rows = [(doc, version, start + a, start + b) for doc, version, start, text in zip(
        docs.tolist(), segments.column("version").to_pylist(), segments.column("start").to_pylist(), which.tolist())
        for a, b in (whole[text] if first_holder[text] < doc else
                     _merged([(a, b) for a, b, holder in matches[text] if holder < doc]))]
    cols = list(zip(*rows)) or [(), (), (), ()]
    return pa.table({f.name: pa.array(c, f.type) for f, c in zip(none.schema, cols)})


def _apply(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in unpacked(stream):
        words, starts = split_words(batch.column("text"))
        counts, removed, kept = np.diff(starts), [], []
        letters, places = spaced(words) if len(words) else (np.zeros(0, np.uint8), np.zeros(1, np.int64))
        for k, spans in enumerate(batch.column("spans").to_pylist()):
            mask = np.zeros(counts[k] + 1, np.int32)
            for s in spans or ():
                mask[s["begin"]] += 1
                mask[s["stop"]] -= 1
            gone = np.cumsum(mask)[:-1] > 0
            removed.append(int(gone.sum()))
            own = places[starts[k]: starts[k + 1] + 1]
            text = letters[own[0]: own[-1]]
            kept.append((text[np.repeat(~gone, np.diff(own))] if removed[-1] else text)[:-1].tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "kept"])


def repeated_spans(rows: DataFrame) -> DataFrame:
    """(doc_id, version, begin, stop): word ranges to remove. ``rows``: doc_id, text, version."""
    anchors = map_arrow(rows.filter("doc_id is not null"), _anchor_rows, "anchor long, doc_id long")
    anchors = materialise(anchors.distinct(), "op3-anchors")
    recurring = (anchors.groupBy("anchor").agg(F.min("doc_id").alias("x"), F.max("doc_id").alias("y"))
                 .filter("x < y").drop("y"))
    wanted = anchors.join(recurring, "anchor").groupBy("doc_id").agg(
        F.collect_list(F.when(F.col("x") < F.col("doc_id"), F.col("anchor"))).alias("later"),
        F.collect_list(F.when(F.col("x") == F.col("doc_id"), F.col("anchor"))).alias("firsts"))
    segments = materialise(map_arrow(
        pack(rows).join(wanted, "doc_id").select("doc_id", "packed", "version", "later", "firsts"), _segments,
        "anchor long, doc_id long, version long, start int, words string, later boolean"), "op3-segments")
    windows = map_arrow(segments.select("anchor", "doc_id", "words"), _window_rows,
                        "anchor long, window long, least long, most long")
    confirmed = materialise(windows.groupBy("anchor", "window").agg(
        F.min("least").alias("least"), F.max("most").alias("most")).filter("least < most"), "op3-confirmed")
    # the recurring passages: segments in which the first holders of confirmed windows hold them
    first = confirmed.select("anchor", F.col("least").alias("doc_id")).distinct()
    passages = materialise(segments.join(first, ["anchor", "doc_id"], "left_semi").select(
        "anchor", "doc_id", "words").distinct(), "op3-passages")
    # hot anchors, at most 4 x total / SHARD_SEGMENTS of them, are dealt over salts before their words move
    counts = segments.filter("later").groupBy("anchor").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = F.broadcast(counts.filter(F.col("n") * 4 > SHARD_SEGMENTS).select(
        "anchor", F.ceil(F.col("n") * 4 / SHARD_SEGMENTS).cast("int").alias("salts")))
    salts = F.coalesce("salts", F.lit(1))
    later = segments.filter("later").join(hot, "anchor", "left").withColumn(
        "salt", F.pmod(F.xxhash64("doc_id", "start"), salts).cast("int")).drop("salts")
    each = lambda df: df.join(hot, "anchor", "left").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("salts")
    later = later.join(each(passages.select("anchor").distinct()), ["anchor", "salt"], "left_semi")
    shards = max(1, -(-total // SHARD_SEGMENTS) * 4)
    shard = F.pmod(F.xxhash64("anchor"), F.lit(shards)).cast("int")
    left = later.select(shard.alias("shard"), "salt", "anchor", "doc_id", "version", "start", "words")
    right = each(passages).select(shard.alias("shard"), "salt", "anchor", "doc_id", "words")
    return left.groupBy("shard", "salt").cogroup(right.groupBy("shard", "salt")).applyInArrow(
        _locate, "doc_id long, version long, begin int, stop int")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept (the words left, joined by one space)."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).withColumn(
        "version", F.xxhash64("text"))
    spans = materialise(repeated_spans(rows).distinct(), "op3-spans").groupBy("doc_id", "version").agg(
        F.collect_list(F.struct("begin", "stop")).alias("spans"))
    joined = pack(rows).join(spans, ["doc_id", "version"], "left").select("doc_id", "packed", "spans")
    return map_arrow(joined, _apply, "doc_id long, n_words long, n_removed long, kept string")


def digests(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
