"""Each operator against a plain version, on a given table and on odd rows."""

import itertools
import math
import os
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402

from cabstat.llm import bpe, chat, ctw, exact, lines, minhash, mixing, pii, quality, substring  # noqa: E402
from odd_rows import rows  # noqa: E402


def pairs():
    return [(r[0], r[1]) for r in rows()]


def key(doc, *rest):
    return (doc is None, doc or 0, *map(str, rest))


# ------------------------------------------------------------------ 1 mixing

def test_one_period_meets_every_window():
    weights = {f"s{k}": w for k, w in enumerate([500, 300, 3, 7, 11, 1, 1, 90, 2, 40])}
    quota = mixing.quotas(weights)
    period = sum(quota.values())
    slots = mixing.one_period(quota)
    assert sorted(s for v in slots.values() for s in v) == list(range(period))
    for name, own in slots.items():
        for i, slot in enumerate(own, 1):
            release, deadline = mixing.window(i, quota[name], period)
            assert release <= slot < deadline
            assert abs(i - quota[name] * (slot + 1) / period) < 1


def test_schedule_places_every_row_once_within_a_block_of_its_share(odd_docs, some_docs):
    docs, texts = some_docs
    out = mixing.schedule(docs).toPandas()
    assert sorted(out.doc_id) == sorted(texts) and out.position.is_unique
    assert ((out.slot >= out.release) & (out.slot < out.deadline)).all()
    quota = mixing.quotas(mixing.tempered(docs))
    blocks = out.groupby(["source", "block"]).slot.first().reset_index()
    end = blocks.groupby("source").slot.max().min()
    for name, q in quota.items():
        done = np.zeros(end + 1)
        done[blocks[(blocks.source == name) & (blocks.slot <= end)].slot] = 1
        assert np.abs(np.cumsum(done) - (np.arange(end + 1) + 1) * q / sum(quota.values())).max() < 1
    odd = mixing.schedule(odd_docs)
    assert odd.count() == len(rows()) and odd.filter("position is null").count() == 0


def test_mix_keeps_rows_and_columns(odd_docs, no_docs):
    out = mixing.mix(odd_docs, {"src0": 3.0, "src1": 1.0, "nowhere": 2.0})
    assert out.columns == odd_docs.columns
    got = out.collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, rows()))
    targets = [r["source"] in ("src0", "src1") for r in got]
    assert targets == sorted(targets, reverse=True)  # rows without a target come last
    assert mixing.mix(no_docs).count() == 0 and mixing.schedule(no_docs).count() == 0


# ------------------------------------------------------------------ 2 quality

def base_counts(r):
    return r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]


def test_quality_counts_and_verdicts(spark, some_docs):
    docs, texts = some_docs
    got = quality.judge(docs).collect()
    assert len(got) == len(texts)
    for r in got:
        n, *_, repeat = want = brute.quality(texts[r["doc_id"]])
        assert base_counts(r) == want
        assert r["base_failed"] == (n < 20 or 100 * repeat > 30 * n)
        assert not (r["kept"] and r["base_failed"])
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.001/labels.parquet").collect()}
    judged = [(r["kept"], labels[r["doc_id"]]) for r in got if r["doc_id"] in labels and not r["base_failed"]]
    assert sum(k == bool(q) for k, q in judged) >= 0.95 * len(judged)


def test_quality_odd_rows(odd_docs, no_docs):
    got = sorted((key(r["doc_id"], base_counts(r)) for r in quality.judge(odd_docs).collect()))
    assert got == sorted(key(d, brute.quality(t)) for d, t in pairs())
    kept = quality.keep_good(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert {3, 4, 18} <= ids and not ids & {1, 2, 8, 9, 12, 17}
    assert quality.judge(no_docs).count() == 0 and quality.keep_good(no_docs).count() == 0


def test_em_separates_two_classes():
    rng = np.random.default_rng(5)
    good = rng.random(4000) < 0.85
    votes = np.where(rng.random((4000, 6)) < np.where(good[:, None], 0.97, 0.35), 1, -1)
    votes[rng.random((4000, 6)) < 0.3] = 0
    patterns = sorted(Counter(map(tuple, votes.tolist())).items())
    model = quality.fit(patterns)
    said = np.array([quality.posterior_good(v, **model) > 0.5 for v in votes.tolist()])
    assert (said == good).mean() > 0.95 and abs(model["prior"] - 0.85) < 0.05


# ------------------------------------------------------------------ 3 substring

def test_repeated_windows_are_removed(some_docs):
    docs, texts = some_docs
    order = sorted(texts)
    want = dict(zip(order, brute.repeats([(d, texts[d]) for d in order])))
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substring.digests(docs).collect()}
    assert got == want and sum(v[1] for v in got.values()) > 0


def locate(later, passages):
    """Spans that one shard finds; both sides: (doc_id, words)."""
    import pyarrow as pa

    anchor = lambda text: int(substring._flat_anchors(pa.array([text]))[2][0].astype(np.int64))
    seg = pa.table({"anchor": pa.array([anchor(w) for _, w in later], pa.int64()), "doc_id": [d for d, _ in later],
                    "version": [0] * len(later), "start": pa.array([0] * len(later), pa.int32()), "words": [w for _, w in later]})
    held = pa.table({"anchor": pa.array([anchor(w) for _, w in passages], pa.int64()), "doc_id": [d for d, _ in passages],
                     "words": [w for _, w in passages]})
    return sorted((r["doc_id"], r["begin"], r["stop"]) for r in substring._locate((0, 0), seg, held).to_pylist())


def test_automata_find_what_words_confirm():
    shared = [f"w{k}" for k in range(70)]
    text = " ".join(shared[:60])
    # 55 words of a passage between others; the same cut to 49; a passage whose document does not precede
    inside = " ".join(shared[2:57])
    assert locate([(9, inside + " x y")], [(1, text)]) == [(9, 0, 55)]
    assert locate([(9, " ".join(shared[2:51]) + " x y")], [(1, text)]) == []
    assert locate([(9, inside)], [(9, text)]) == [] and locate([(9, inside)], [(12, text)]) == []
    # several holders: only those that precede a document count for it
    assert locate([(5, inside), (3, inside)], [(4, text)]) == [(5, 0, 55)]
    # phrases that occur over and over: all alignments, by words or by window hashes
    again = "a b c " * 40
    assert locate([(9, "q " + again)], [(1, again)]) == [(9, 1, 121)]
    assert locate([(9, "a b c " * 17 + "d")], [(1, again)]) == [(9, 0, 51)]
    assert locate([(9, "x " * 5000)], [(1, "x " * 400)]) == [(9, 0, 5000)]


def test_repeated_windows_odd_rows(odd_docs, no_docs, monkeypatch):
    monkeypatch.setattr(substring, "SHARD_SEGMENTS", 4)  # several shards, salted anchors
    got = sorted(key(r["doc_id"], (r["n_words"], r["n_removed"], r["kept_sha256"]))
                 for r in substring.digests(odd_docs).collect())
    assert got == sorted(key(d, w) for (d, _), w in zip(pairs(), brute.repeats(pairs())))
    assert substring.digests(no_docs).count() == 0


# ------------------------------------------------------------------ 4 context tree

def held_out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2


@pytest.mark.parametrize("common", [2_000_000, 5])
def test_scores_match_the_plain_tree(some_docs, monkeypatch, common):
    monkeypatch.setattr(ctw, "COMMON", common)  # 5: nearly all look-ups are joins
    monkeypatch.setattr(ctw, "COMMON_WORDS", min(common, ctw.COMMON_WORDS))
    docs, texts = some_docs
    docs = docs.filter("doc_id < 40")
    texts = {d: brute.lower(t).encode().split() + [b""] for d, t in texts.items() if d < 40}
    counts = Counter(w for d, t in texts.items() if zlib.crc32(str(d).encode()) % 7 != 2 for w in t)
    total, distinct = sum(counts.values()), len(counts)
    value = brute.context_tree(counts, {w for t in texts.values() for w in t})
    got = ctw.score(docs, held_out()).collect()
    assert len(got) == len(texts)
    for r in got:
        own = texts[r["doc_id"]]
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(own), sum(counts[w] > 0 for w in own), total)
        assert r["base_score"] == pytest.approx(sum(np.log10((counts[w] + 1) / (total + distinct + 1)) for w in own))
        assert r["score"] == pytest.approx(sum(value[w] for w in own), rel=1e-9)


def test_held_out_prose_costs_less_than_noise(spark, some_docs):
    docs, _ = some_docs
    noise = spark.range(2).select((F.lit(10_000) + F.col("id")).alias("doc_id"),
                                  F.expr("repeat('qzx kwv jjq ', 40)").alias("text"))
    out = ctw.score(docs.select("doc_id", "text").unionByName(noise), held_out() | (F.col("doc_id") >= 10_000))
    cost = {r["doc_id"]: r["bits_per_byte"] for r in out.filter("held_out and n_tokens > 20").collect()}
    prose = [v for d, v in cost.items() if d < 10_000]
    assert np.mean(prose) < 3.5 < 4.5 < min(v for d, v in cost.items() if d >= 10_000)


@pytest.mark.parametrize("across", [False, True])
def test_scores_odd_rows(odd_docs, no_docs, across):
    got = ctw.score(odd_docs, held_out(), across).collect()
    assert sorted(key(r["doc_id"], r["n_tokens"]) for r in got) == sorted(
        key(d, len(brute.words(t)) + 1) for d, t in pairs())
    assert all(r["score"] < 0 and r["base_score"] < 0 for r in got)
    by_id = defaultdict(set)
    for r in got:
        by_id[r["doc_id"]].add(round(r["score"], 9))
    assert len(by_id[11]) == 1 and by_id[1] == by_id[2]      # repeated rows; null counts as empty
    assert ctw.score(no_docs, held_out(), across).count() == 0


def test_grams_of_short_and_long_stretches():
    rng = np.random.default_rng(6)
    for across in (0, 1, 2):
        stretches = rng.integers(1, 4 if across else 30, 9 if across < 2 else 1)
        flat = rng.integers(1, 256, stretches.sum()).astype(np.uint8)
        want, at = [], 0
        for size in stretches.tolist():
            spelt = bytes(6) + b" " + flat[at: at + size].tobytes()
            want += [int.from_bytes(spelt[k: k + 7][::-1] + spelt[k + 7: k + 8], "big") for k in range(size)]
            at += size
        assert ctw.byte_grams(flat, stretches).tolist() == want
    assert ctw.byte_grams(np.zeros(0, np.uint8), np.zeros(0, np.int64)).tolist() == []


def test_a_task_hands_on_a_gram_once():
    # 1.2 MB of random letters, twice in training and once outside: some 1.2 million grams in each
    rng = np.random.default_rng(4)
    texts = [rng.integers(97, 123, 300_000, np.uint8).tobytes().decode() for _ in range(4)]
    stream = iter([pa.RecordBatch.from_pydict({"text": [t], "train": [use]}) for use in (True, False, True) for t in texts])
    out = pa.Table.from_batches(list(ctw._gram_counts(True)(stream)))
    grams, trained, every = (np.concatenate(x) for x in zip(*(
        ctw._restore(blob, n, np.int64, np.int64) for n, blob in zip(out["n"].to_pylist(), out["blob"].to_pylist()))))
    assert len(grams) == len(np.unique(grams)) > 1_000_000
    assert every.sum() == 3 * 4 * 300_002 and trained.sum() == 2 * 4 * 300_002
    assert (2 * every == 3 * trained).all()


def test_spelling_of_odd_texts():
    texts = [None, "", " \t ", "\n", "A\x1cB\x85\xe9 \x0b\r z", " one  Two\n", "\x00"]
    want = [" ".join([*brute.lower(" ".join(brute.words(t))).split(" "), "\n"]) if brute.words(t) else "\n" for t in texts]
    flat, sizes, stretches = ctw.spelt(pa.array(["before", *texts], pa.string()).slice(1), False)
    assert flat.tobytes() == "".join(want).encode()
    assert sizes.tolist() == [len(w.encode()) for w in want]
    assert stretches.tolist() == [len(x.encode()) for w in want for x in brute.re.findall("[^ \n]+ |\n", w)]


def test_every_frequent_gram_is_found():
    rng = np.random.default_rng(5)
    grams = np.unique(rng.integers(0, 1 << 63, 5000, np.uint64))
    values, sizes = -rng.random(len(grams)), rng.integers(0, 9, len(grams)).astype(np.int16)
    own = rng.permutation(len(grams))
    frequent = ctw.Frequent(grams[own], values[own], sizes[own])
    asked = np.sort(np.concatenate([grams, grams + np.uint64(1)]))
    known = np.isin(asked, grams)
    worth = np.where(known, values[np.minimum(np.searchsorted(grams, asked), len(grams) - 1)], 0)
    for hit, found in (frequent.in_slots(asked), frequent.in_order(asked)):
        assert not (hit & ~known).any() and (found[hit] == worth[hit]).all() and (found[~hit] == 0).all()
    assert (frequent.in_order(asked)[0] == known).all() and frequent.in_slots(grams)[0].mean() > 0.7
    assert not ctw.Frequent(grams[:0], values[:0], sizes[:0]).in_slots(grams)[0].any()


def test_counts_add_up_in_parts(some_docs, monkeypatch):
    """Tasks that hand on what they hold at once, many shards and split look-ups give the same scores."""
    docs, _ = some_docs
    docs = docs.filter("doc_id < 60").repartition(3)
    whole = {r["doc_id"]: r["score"] for r in ctw.score(docs, held_out(), True).collect()}
    for name, n in (("HELD_GRAMS", 500), ("GRAM_BYTES", 2000), ("SHARD_GRAMS", 300), ("TASK_GRAMS", 1000), ("COMMON", 50), ("COMMON_WORDS", 20)):
        monkeypatch.setattr(ctw, name, n)
    parts = {r["doc_id"]: r["score"] for r in ctw.score(docs, held_out(), True).collect()}
    assert parts == {d: pytest.approx(v, rel=1e-9) for d, v in whole.items()}


def running_tree(texts, train, depth=7):
    """Log10 probability of every text (token lists) by a tree over the bytes of the running texts."""
    kt = lambda a, b: math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)
    seen, below = defaultdict(lambda: [0, 0]), defaultdict(set)

    def steps(own):
        spelt = b"\0" * (depth - 1) + b" " + b"".join(w + b" " for w in own) + b"\n"
        for i in range(depth, len(spelt)):
            for j in range(8):
                yield [(spelt[i - d:i], spelt[i] + 256 >> 8 - j) for d in range(depth + 1)], spelt[i] >> 7 - j & 1

    for d, own in texts.items():
        for path, bit in steps(own):
            for key, deeper in zip(path, [*path[1:], None]):
                seen[key][bit] += d in train
                below[key].add(deeper)
    weighted, stop = {}, {}
    for key in sorted(seen, key=lambda k: -len(k[0])):
        own = weighted[key] = kt(*seen[key])
        stop[key] = 1.0
        if len(key[0]) < depth:
            weighted[key] = np.logaddexp(own, sum(weighted[k] for k in below[key])) - math.log(2)
            stop[key] = math.exp(own - math.log(2) - weighted[key])

    def chance(path, bit):
        p = 0.0
        for key in reversed(path):
            p = stop[key] * (seen[key][bit] + .5) / (sum(seen[key]) + 1) + (1 - stop[key]) * p
        return p

    return {d: sum(math.log10(chance(*x)) for x in steps(own)) for d, own in texts.items()}


@pytest.mark.parametrize("common", [2_000_000, 200])
def test_contexts_go_over_word_ends(spark, some_docs, monkeypatch, common):
    monkeypatch.setattr(ctw, "COMMON", common)
    docs, texts = some_docs
    given = [(d, " ".join(texts[d].split()[:60])) for d in sorted(texts)[:12]]
    given += [(100 + k, "the cat sat on the mat " * 6) for k in range(5)]
    given += [(200, "the cat sat on the mat"), (201, "mat the on sat cat the"), (202, None)]
    held = (F.col("doc_id") >= 200) | (F.col("doc_id") == given[0][0])
    out = ctw.score(spark.createDataFrame(given, "doc_id long, text string"), held, across=True).collect()
    tokens = {d: brute.lower(t or "").encode().split() for d, t in given}
    want = running_tree(tokens, {d for d, _ in given[1:] if d < 200})
    got = {r["doc_id"]: r["score"] for r in out}
    assert got == {d: pytest.approx(v, rel=1e-9) for d, v in want.items()}
    assert got[200] > got[201] + 5  # the order of words counts


# ------------------------------------------------------------------ 5 byte-level BPE

def reference_encoding():
    import public_tokenizers
    import tiktoken

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return path, public_tokenizers.PATTERN, tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})


def test_bpe_ids_equal_the_library(some_docs, odd_docs, no_docs):
    path, pattern, library = reference_encoding()
    docs, texts = some_docs
    for given, known in ((docs, list(texts.items())), (odd_docs, pairs())):
        want = sorted(key(d, (len(ids := library.encode_ordinary(t or "")),
                              brute.sha(np.array(ids, "<u4").tobytes()), brute.sha(t or ""))) for d, t in known)
        got = sorted(key(r["doc_id"], (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]))
                     for r in bpe.digests(given, path, pattern).collect())
        assert got == want
    assert bpe.digests(no_docs, path, pattern).count() == 0


def test_bpe_random_texts():
    path, pattern, library = reference_encoding()
    ranks = bpe.read_ranks(path)
    codec = bpe.Codec(bpe.sentencepiece_model(ranks), sorted(ranks, key=ranks.get), bpe.unicode_form(pattern),
                      bpe.ascii_form(pattern))
    rng = np.random.default_rng(3)
    marks = [*map(chr, range(128)), "\x85", "\xa0", " ", "▁", "é", "ſ", "²", "日本", "😀", "'s", "'LL", "  "]
    texts = ["".join(rng.choice(marks, rng.integers(1, 25))) for _ in range(3000)] + ["a" * 50_000]
    coded = codec.encode(texts)
    assert [np.frombuffer(c, "<u4").tolist() for c in coded] == [library.encode_ordinary(t) for t in texts]
    assert [codec.decode(c).decode() for c in coded] == texts


# ------------------------------------------------------------------ 6 near-duplicates

def test_near_duplicates(some_docs):
    docs, texts = some_docs
    want = brute.near(texts)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(docs).collect()}
    assert got == {d: (n, c, c == d) for d, (n, c) in want.items()}
    assert any(c != d for d, (_, c) in want.items())


def test_near_duplicates_odd_rows(odd_docs, no_docs):
    known = {d: t for d, t in pairs() if d is not None}
    want = brute.near(known)
    got = minhash.near_duplicates(odd_docs).collect()
    assert len(got) == len(rows())
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            n, c = want[r["doc_id"]]
            assert (r["n_shingles"], r["component_id"], r["kept"]) == (n, c, c == r["doc_id"])
    kept = minhash.keep_first(odd_docs)
    assert kept.columns == odd_docs.columns
    assert minhash.near_duplicates(no_docs).count() == 0


def test_chain_of_near_copies_is_one_component(spark, monkeypatch):
    """Neighbours are linked, ends are not; blocks of two documents a chunk."""
    monkeypatch.setattr(minhash, "CHUNK", 2)
    base = [f"w{k}" for k in range(400)]
    texts = {}
    for k in range(12):
        texts[100 - k] = " ".join(base)
        for j in range(4):
            base[(k * 31 + j * 7) % 400] = f"n{k}_{j}"
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    want = brute.near(texts)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(docs).collect()}
    assert got == want and len({c for _, c in want.values()}) == 1


def test_estimate_is_near_the_truth():
    rng = np.random.default_rng(1)
    for size in (3, 40, 900):
        pool = rng.integers(0, 2 ** 63, 2 * size).astype(np.uint64)
        errors = []
        for _ in range(30):
            a, b = (np.unique(rng.choice(pool, size, replace=False)) for _ in range(2))
            equal = (minhash.registers(a) == minhash.registers(b)).sum()
            errors.append(float(minhash.corrected(np.array(equal), np.array(len(a)), np.array(len(b))))
                          - len(np.intersect1d(a, b)) / len(np.union1d(a, b)))
        assert abs(np.mean(errors)) < 0.05 and np.std(errors) < 0.13


# ------------------------------------------------------------------ 7 lines

def test_patience_alignment():
    assert lines.patience(list("abcxdef"), list("abcydef")) == [(0, 0), (1, 1), (2, 2), (4, 4), (5, 5), (6, 6)]
    assert lines.patience(list("paqbr"), list("xaybz")) == [(1, 1), (3, 3)]
    assert lines.patience([], list("ab")) == [] and lines.patience(list("zz"), list("yy")) == []
    assert lines.common_blocks(list("abcd"), list("xabyd"), [9, 3, 3, 9, 9]) == [(1, 3), (4, 5)]
    rng = np.random.default_rng(2)
    for _ in range(200):
        one, two = (rng.integers(0, 12, rng.integers(0, 30)).tolist() for _ in range(2))
        aligned = lines.patience(one, two)
        assert all(one[i] == two[j] for i, j in aligned)
        assert all(i < k and j < m for (i, j), (k, m) in zip(aligned, aligned[1:]))


def test_lines_odd_rows(odd_docs, no_docs):
    out = lines.drop_lines(odd_docs)
    assert out.columns == odd_docs.columns and out.schema == odd_docs.schema
    got = out.collect()
    assert len(got) == len(rows())
    by_id = defaultdict(list)
    for r in got:
        by_id[r["doc_id"]].append(r)
    assert by_id[4][0]["text"] == "" and by_id[3][0]["text"] == rows()[2][1]
    assert by_id[14][0]["text"] == "new start here\nend" and by_id[14][0]["n_chars"] == len("new start here\nend")
    assert by_id[1][0]["text"] is None and [r["text"] for r in by_id[11]] == ["a b c d e"] * 2
    assert lines.drop_lines(no_docs).count() == 0


def plain_alignment(one, two, words):
    """Index pairs by the rules of the operator, written as plain recursion over slices."""
    def inner(a, b, c, d):
        if a < b and c < d and one[a] == two[c]:
            return [(a, c), *inner(a + 1, b, c + 1, d)]
        if a < b and c < d and one[b - 1] == two[d - 1]:
            return [*inner(a, b - 1, c, d - 1), (b - 1, d - 1)]
        left, right = one[a:b], two[c:d]
        once = [(a + i, c + right.index(x)) for i, x in enumerate(left) if left.count(x) == 1 and right.count(x) == 1]
        best = []    # longest increasing runs that end at each anchor; of equal ones, that with the earliest end
        length = lambda run: (len(run), -run[-1][1])
        for i, j in once:
            best.append([*max((run for run in best if run[-1][1] < j), key=length, default=[]), (i, j)])
        if not once:
            return heaviest(a, b, c, d)
        found = max(best, key=length)
        out = []
        for (i, j), (k, m) in zip([(a - 1, c - 1), *found], [*found, (b, d)]):
            out += [*inner(i + 1, k, j + 1, m), *([(k, m)] if k < b else [])]
        return out

    def heaviest(a, b, c, d):
        best = {}
        for i in range(b, a - 1, -1):
            for j in range(d, c - 1, -1):
                options = [(0, [])] if i == b or j == d else [best[i + 1, j], best[i, j + 1]]
                if i < b and j < d and one[i] == two[j]:
                    weight, rest = best[i + 1, j + 1]
                    options.append((weight + 1 + words[j], [(i, j), *rest]))
                best[i, j] = max(options, key=lambda o: o[0])
        return best[a, c][1]

    return inner(0, len(one), 0, len(two))


def whole_lines(docs):
    """Deleted line numbers by doc_id, with the first holders of all shared lines and runs as partners."""
    cut = {d: t.split("\n") for d, t in docs.items() if t is not None}
    first, keys = {}, {}
    for d in sorted(cut):
        own, keys[d] = cut[d], set()
        for i, x in enumerate(own):
            ends = [j for j in range(i + 1, len(own) + 1) if len(brute.words("\n".join(own[i:j]))) >= lines.MIN_WORDS]
            if brute.words(x):
                keys[d].update([(x,), tuple(own[i:min(ends, default=i + 1)])])
        for x in keys[d]:
            first.setdefault(x, d)
    out = {}
    for d, own in cut.items():
        words, out[d] = [len(brute.words(x)) for x in own], set()
        for f in {first[x] for x in keys[d]} - {d}:
            out[d] |= plain_blocks(cut[f], own, words)
    return out


def plain_blocks(one, two, words):
    """Line numbers of the aligned runs, then of those in what is left between them; where none is long
    enough, of those without the lines just aligned."""
    at, gone = {j: i for i, j in plain_alignment(one, two, words)}, set()
    for j in sorted(at):
        run = [j]
        while at.get(run[-1] + 1) == at[run[-1]] + 1:
            run.append(run[-1] + 1)
        if at.get(j - 1) != at[j] - 1 and sum(words[k] for k in run) >= lines.MIN_WORDS:
            gone.update(run)
    if at and not gone:
        return plain_blocks(one, [None if k in at else x for k, x in enumerate(two)], words)
    left = [list(g) for k, g in itertools.groupby(range(len(two)), key=gone.__contains__) if not k] if gone else []
    for rest in left:
        gone |= {rest[0] + x for x in plain_blocks(one, two[rest[0]: rest[-1] + 1], words[rest[0]: rest[-1] + 1])}
    return gone


def test_moved_blocks_go_too(spark):
    x, y, z = (" ".join(f"{c}{k}" for k in range(6)) for c in "xyz")
    texts = {1: f"{y}\n{x}", 2: f"{x}\n{y}", 3: f"{x}\n{y}", 4: f"own\n{x}\nmine\n{z}\n{y}", 5: f"{z}\n{y}\n{x}"}
    got = {r["doc_id"]: r["text"] for r in lines.drop_lines(
        spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert got == {1: texts[1], 2: "", 3: "", 4: f"own\nmine\n{z}", 5: ""}
    rng = np.random.default_rng(8)
    for _ in range(200):
        one, two = (rng.permutation(12)[: rng.integers(0, 12)].tolist() for _ in range(2))
        weights = rng.integers(1, 9, len(two)).tolist()
        blocks = lines.common_blocks(one, two, weights)
        gone = {k for a, b in blocks for k in range(a, b)}
        assert gone == plain_blocks(one, two, weights)
        assert {k for k, v in enumerate(two) if v in one and weights[k] >= lines.MIN_WORDS} <= gone


def test_lines_are_deleted_however_common(some_docs):
    docs, texts = some_docs
    want = whole_lines(texts)
    got = {r["doc_id"]: (r["n_deleted"], r["kept_sha256"]) for r in lines.digests(docs).collect()}
    assert got == {d: (len(want[d]), brute.sha("\n".join(
        x for k, x in enumerate(t.split("\n")) if k not in want[d]))) for d, t in texts.items()}


@pytest.mark.parametrize("n", [5, 40])
def test_common_passage_goes_beside_a_rarer_shared_line(spark, n):
    passage = " ".join(f"p{k}" for k in range(60))
    rare = "a rare line of six words"
    texts = {0: f"start\n{rare}\nother end", **{k: f"own{k}\n{passage}\ntail{k}" for k in range(1, n)},
             n: f"{rare}\nbetween\n{passage}\nlast"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in lines.drop_lines(docs).collect()}
    assert got[0] == texts[0] and got[1] == texts[1] and got[n] == "between\nlast"
    assert all(got[k] == f"own{k}\ntail{k}" for k in range(2, n))


def heaviest_weight(one, two, weights):
    best = [[0] * (len(two) + 1) for _ in range(len(one) + 1)]
    for i, x in enumerate(one):
        for j, y in enumerate(two):
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], (best[i][j] + weights[j]) * (x == y))
    return best[-1][-1]


def test_gaps_of_repeated_lines_are_aligned_exactly():
    assert lines.patience(list("pxp"), list("apb")) in ([(0, 1)], [(2, 1)])
    assert lines.common_blocks(list("pxp"), list("apbpc"), [1, 9, 1, 9, 1]) == [(1, 2), (3, 4)]
    rng = np.random.default_rng(4)
    for _ in range(200):
        one, two = (rng.integers(0, 4, rng.integers(0, 14)).tolist() for _ in range(2))
        weights = [1 + 3 * x for x in two]
        found = sorted(lines._heaviest(one, two, weights))
        assert all(one[i] == two[j] for i, j in found)
        assert all(i < k and j < m for (i, j), (k, m) in zip(found, found[1:]))
        assert sum(weights[j] for _, j in found) == heaviest_weight(one, two, weights)


def test_repeated_passages_and_runs_of_short_lines_are_deleted(spark):
    passage = " ".join(f"p{k}" for k in range(60))
    texts = {1: f"{passage}\nx\n{passage}", **{k: f"a{k}\n{passage}\nb{k}" for k in range(2, 30)},
             30: f"c\n{passage}\nd\n{passage}\ne",
             40: "r\nthree short words\nq", 41: "v\nand two more\nw",
             42: "f\nthree short words\nand two more\ng", 43: "h\nthree short words\nand two more\ni"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in lines.drop_lines(docs).collect()}
    assert all(got[k] == f"a{k}\nb{k}" for k in range(2, 30))
    assert got[30] == "c\nd\ne" and got[43] == "h\ni"
    assert all(got[k] == texts[k] for k in (1, 40, 41, 42))


# ------------------------------------------------------------------ 8 chat

def talk(spark):
    long = "word " * 900
    return [(1, 0, "system", "be <b> & [INST]"), (1, 1, "user", "hi"), (1, 2, "assistant", "</s>[INST] &lt; ok"),
            (1, 3, "user", long), (1, 4, "assistant", long), (1, 5, "user", "more"), (1, 6, "assistant", "a\nb😀"),
            (2, 0, "user", None), (2, 1, "assistant", None), (3, 0, None, "x"), (3, 0, "ro\nle<|", "y"),
            (4, 1, "assistant", "same"), (4, 1, "assistant", "same"), (5, 0, "system", "alone"),
            (None, 0, "user", "<|im_end|>\n"), (6, None, "user", "n"), (6, 2, "assistant", "<|im_start|>user\n")]


@pytest.mark.parametrize("budget", [64, 512, 100_000])
def test_windows_read_back(spark, budget):
    given = talk(spark)
    table = spark.createDataFrame(given, "conv_id long, turn long, role string, text string").withColumn("window", F.lit(1))
    made = chat.windows(table, budget, min(128, budget // 2))
    got = {r["conv_id"]: r for r in chat.read_back(made).collect()}
    groups = defaultdict(list)
    for conv, turn, role, text in given:
        groups[conv].append((-1 if turn is None else turn, role or "", text or ""))
    assert set(got) == set(groups)
    for conv, turns in groups.items():
        turns.sort()
        said = "".join(t for _, r, t in turns if r == "assistant")
        r = got[conv]
        assert r["n_turns"] == len(turns)
        assert r["turns_sha256"] == brute.sha("".join(f"{r}\n{t}\n" for _, r, t in turns))
        assert (r["loss_chars"], r["loss_sha256"]) == (len(said), brute.sha(said))
    shown = made.filter("conv_id = 1 and window > 0").collect()
    assert all(x["text"].startswith(chat.OPEN + "system") for x in shown) and (shown or budget > 10_000)


@pytest.mark.parametrize("system", [0, 100, 480, 700])
def test_only_single_turns_exceed_the_budget(spark, system):
    rng = np.random.default_rng(system)
    sizes = {1: [380] * 6, 2: rng.integers(5, 400, 60).tolist(), 3: [20, 600, 20, 511, 3, 3], 4: [10] * 100}
    given = [(c, 1 + k, "assistant" if k % 2 else "user", "x" * (4 * (n - 4))) for c, own in sizes.items()
             for k, n in enumerate(own)]
    given += [(c, 0, "system", "s" * (4 * (system - 4))) for c in sizes if system]
    made = chat.windows(spark.createDataFrame(given, "conv_id long, turn long, role string, text string")).collect()
    shown = defaultdict(list)
    for w in sorted(made, key=lambda w: (w["conv_id"], w["window"])):
        turns = [t.split("\n", 1) for t in w["text"].split(chat.CLOSE)[:-1]]
        tokens = [-(-len(t) // 4) + 4 for _, t in turns]
        own = [n for (r, _), n in list(zip(turns, tokens))[w["n_repeated"]:] if not r.endswith("system")]
        assert sum(tokens) <= chat.BUDGET or len(own) == 1
        if sum(tokens) > chat.BUDGET:
            assert sum(tokens) == own[0] + system  # nothing is repeated on top
        shown[w["conv_id"]] += own
    assert {c: [max(n, 4) for n in own] for c, own in sizes.items()} == shown


def test_budget_counts_the_formatted_text(spark):
    """Control characters cost what their escapes do; a column of token counts goes before the estimate."""
    given = [(1, k, "assistant" if k % 2 else "user", "&" * 600) for k in range(4)]
    given += [(2, k, "assistant" if k % 2 else "user", "<[" * 20) for k in range(30)]
    table = spark.createDataFrame(given, "conv_id long, turn long, role string, text string")
    for w in chat.windows(table).collect():
        turns = w["text"].split(chat.CLOSE)[:-1]
        tokens = sum(-(-len(x.split("\n", 1)[1]) // 4) + 4 for x in turns)
        assert tokens <= chat.BUDGET or len(turns) == 1 + w["n_repeated"]
    counted = table.filter("conv_id = 2").withColumn("cost", F.when(F.col("turn") != 3, F.lit(100)).otherwise(F.lit(None)))
    sizes = [len(w["text"].split(chat.CLOSE)) - 1 for w in chat.windows(counted, 500, 100, tokens="cost").orderBy("window").collect()]
    assert max(sizes) <= 6 and sum(sizes) > 30


def test_windows_of_nothing(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.windows(none)).count() == 0


# ------------------------------------------------------------------ 9 exact dedup

def test_exact_dedup_odd_rows(odd_docs, no_docs):
    groups = defaultdict(list)
    for d, t in pairs():
        groups[brute.lower(t)].append(d)
    want = []
    for d, t in pairs():
        own = groups[brute.lower(t)]
        keep = max((x for x in own if x is not None), default=None)
        want.append(key(d, (keep, len(own), d == keep, brute.sha(brute.lower(t)))))
    for old in (F.col("doc_id") % 2 == 0, F.lit(True), F.lit(False)):
        got = exact.exact_dedup(odd_docs, old, shard_keys=4).collect()
        assert sorted(key(r["doc_id"], tuple(r[1:])) for r in got) == sorted(want)
    assert exact.exact_dedup(no_docs, F.lit(True)).count() == 0


@pytest.mark.parametrize("n", [1, 2, 7, 1000, 60_000])
def test_fuse_filter(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64))
    made = exact.FuseFilter.build(keys)
    assert made.contains(keys).all()
    others = np.setdiff1d(rng.integers(0, 2 ** 63, 100_000).astype(np.uint64), keys)
    assert made.contains(others).mean() < 1e-3
    assert n < 1000 or len(made.table) < 1.5 * n


# ------------------------------------------------------------------ 10 personal data

def test_personal_data(some_docs, odd_docs, no_docs):
    docs, texts = some_docs
    for given, known in ((docs, list(texts.items())), (odd_docs, pairs())):
        want = []
        for d, t in known:
            spans = brute.personal(t)
            n = Counter(s.split(":")[0] for s in spans)
            want.append(key(d, (n["email"], n["ip"], n["card"], n["phone"], brute.sha(",".join(spans)))))
        got = pii.summary(given).collect()
        assert sorted(key(r["doc_id"], (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]))
                      for r in got) == sorted(want)
    assert pii.summary(no_docs).count() == 0


def test_personal_data_edges(spark):
    texts = ["a@b.c_d@e.f g@h", "a@b.c.d@e.f", "x" * 60_000 + "@a.b", "1 " * 30_000, "0001.002.3.255 1.2.3.4.5.6.7.8.9",
             "1.2.3.256", "4111-1111-1111-1111 4111 1111 1111 1112", "+1 (212) 555-0100. +12 3", "😀 a@b.cd 😀 é 9.9.9.9",
             " ".join(f"u{k}@x.org" for k in range(700)), "+" * 5000 + "1" * 5000, "ü@a.b..c@d.e", "12" * 40]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.summary(docs).collect():
        base = brute.personal(texts[r["doc_id"]])
        assert r["base_sha256"] == brute.sha(",".join(base)), texts[r["doc_id"]][:80]
        assert r["spans"] == ",".join(base)


def test_added_kinds_need_checksums_or_context(spark):
    texts = ["IBAN GB82 WEST 1234 5698 7654 32 end", "GB82WEST12345698765433", "ssn 123-45-6789", "code 123-45-6789",
             "DE89370400440532013000"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in pii.summary(docs).collect()}
    assert got[0].startswith("iban:5:32") and "iban" not in got[1] and got[4] == "iban:0:22"
    assert got[2] == "ssn:4:15" and got[3] == ""


@pytest.mark.parametrize("text, want", [
    ("GB82 WEST 1234 5698 7654 32 BIC DEUTDEFF", ["0:27"]), ("GB82 WEST 1234 5698 7654 32 2024", ["0:27"]),
    ("pay GB82WEST12345698765432 NOW 12", ["4:26"]), ("é GB82 WEST 1234 5698 7654 32, DE89370400440532013000 X1", ["2:29", "31:53"]),
    ("GB82 WEST 1234 5698 7654 33 BIC", []), ("GB82 WEST 1234 5698 7654 32X", []), ("NO93 8601 1117 947 A B C", ["0:18"]),
])
def test_account_numbers_end_where_their_checksum_holds(spark, text, want):
    spans = pii.summary(spark.createDataFrame([(0, text)], "doc_id long, text string")).first()["spans"]
    assert [s[5:] for s in spans.split(",") if s.startswith("iban:")] == want
