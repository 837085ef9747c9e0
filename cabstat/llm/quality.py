"""Quality rules as weak supervision: rules vote or abstain, expectation-maximisation
estimates how far each can be trusted, and the posterior decides.

Every rule votes good (1), bad (-1) or abstains (0) on features of the whole
text. Two latent classes with class-wise vote probabilities are fitted on the
counts of vote patterns (at most 3 ** rules rows whatever the corpus), so the
driver sees no documents. A document is kept when its posterior quality
probability reaches the threshold and no base rule failed.

Defined results: null or empty text has no words, fails the base rules and is
not kept; an empty table gives an empty result; each row is judged by itself,
repeated or not; extra columns are ignored by ``judge`` and kept by
``keep_good``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from .common import UPPER, materialise

SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
PRIOR_GOOD = 0.9
KEEP_FROM = 0.5


def let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _without(c: Column, chars: str) -> Column:
    return F.translate(c, chars, "")


def _count_of(c: Column, chars: str) -> Column:
    return (F.char_length(c) - F.char_length(_without(c, chars))).cast("long")


def _covered(windows: Column) -> Column:
    """Words covered by windows whose hash occurs twice or more."""
    def runs(s):
        twice = F.filter(s, lambda e, k: F.coalesce(e["h"] == F.get(s, k + 1)["h"], F.lit(False))
                         | F.coalesce(e["h"] == F.get(s, k - 1)["h"], F.lit(False)))
        return let(F.sort_array(F.transform(twice, lambda e: e["at"])), lambda at: F.aggregate(
            F.transform(at, lambda p, k: F.least(F.coalesce(F.get(at, k + 1) - p, F.lit(WINDOW)), F.lit(WINDOW))),
            F.lit(0).cast("long"), lambda a, x: a + x))

    placed = F.sort_array(F.transform(windows, lambda h, k: F.struct(h.alias("h"), k.alias("at"))))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(
        let(placed, runs))


def _word_features(words: Column) -> Column:
    def inner(h):
        windows = F.when(F.size(h) < WINDOW, F.array().cast("array<bigint>")).otherwise(
            F.transform(F.sequence(F.lit(0), F.greatest(F.size(h) - WINDOW, F.lit(0))),
                        lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)])))
        return F.struct(F.size(h).cast("long").alias("n_words"),
                        F.size(F.filter(h, lambda x, k: F.coalesce(x == F.get(h, k - 1), F.lit(False))))
                        .cast("long").alias("n_echoes"),
                        let(windows, _covered).alias("n_repeat_words"))

    return let(F.transform(words, lambda w: F.xxhash64(w)), inner)


def features(docs: DataFrame, *carry: str) -> DataFrame:
    """doc_id (and ``carry``) with the counts that the rules look at."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.filter(F.split("t", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split("t", "\n"), lambda x: _without(x, SPACE) != "")
    rows = docs.select(F.col("doc_id").cast("long"), *carry, text.alias("t"))
    return rows.select(
        "doc_id", *carry,
        _word_features(words).alias("w"),
        let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"),
                                      (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"))).alias("l"),
        F.char_length(_without(F.col("t"), SPACE)).cast("long").alias("word_chars"),
        _count_of(F.col("t"), SYMBOLS).alias("n_symbols"),
        _count_of(F.col("t"), "|").alias("n_bars"),
        _count_of(F.col("t"), "!").alias("n_exclaims"),
        _count_of(F.col("t"), UPPER).alias("n_upper"),
        _count_of(F.col("t"), ".?").alias("n_stops"),
    ).select("doc_id", *carry, "w.n_words", "w.n_echoes", "w.n_repeat_words", F.col("l.n").alias("n_lines"),
             F.col("l.dup").alias("n_dup_lines"), "word_chars", "n_symbols", "n_bars", "n_exclaims",
             "n_upper", "n_stops")


def _vote(bad: Column, good: Column) -> Column:
    return F.when(F.col("n_words") == 0, 0).when(bad, -1).when(good, 1).otherwise(0)


def rules() -> dict[str, Column]:
    """Votes by rule, over the columns of ``features``."""
    n, share = F.col("n_words"), lambda c: F.col(c) / F.col("n_words")
    mean = F.col("word_chars") / n
    return {
        "length": _vote(n < 20, n >= 50),
        "symbols": _vote(share("n_symbols") > 0.25, share("n_symbols") < 0.1),
        "symbol_chars": _vote(F.col("n_symbols") / F.col("word_chars") > 0.05,
                              F.col("n_symbols") / F.col("word_chars") < 0.02),
        "bars": _vote(share("n_bars") > 0.1, share("n_bars") < 0.02),
        "capitals": _vote(F.col("n_upper") / F.col("word_chars") > 0.4, F.col("n_upper") / F.col("word_chars") < 0.2),
        "exclaims": _vote(share("n_exclaims") > 0.2, share("n_exclaims") < 0.05),
        "repeats": _vote(share("n_repeat_words") > 0.3, share("n_repeat_words") < 0.1),
        "echoes": _vote(share("n_echoes") > 0.3, share("n_echoes") < 0.05),
        "lines": F.when(F.col("n_lines") < 4, 0).otherwise(
            _vote(F.col("n_dup_lines") / F.col("n_lines") > 0.5, F.col("n_dup_lines") / F.col("n_lines") < 0.3)),
        "word_length": _vote((mean < 2.5) | (mean > 12), (mean > 3.5) & (mean < 9)),
        "sentences": F.when(n < 50, 0).otherwise(_vote(share("n_stops") < 0.01, share("n_stops") > 0.03)),
    }


def fit(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 100) -> dict:
    """Expectation-maximisation over (votes, count) rows.

    Returns the prior of good and, by rule, P(vote good | class, no abstention)
    as ``(given good, given bad)``. It starts from the belief that one bad vote
    of a rule outweighs its good votes; small counts lean on that start.
    """
    width = len(patterns[0][0]) if patterns else 0
    start, weight = (0.98, 0.6), 10.0
    prior, accuracy = PRIOR_GOOD, [start] * width
    total = sum(n for _, n in patterns)
    for _ in range(rounds if patterns else 0):
        posterior = [posterior_good(votes, prior, accuracy) for votes, _ in patterns]
        good = sum(p * n for p, (_, n) in zip(posterior, patterns))
        fresh = []
        for j in range(width):
            ends = []
            for side in (0, 1):
                mass = [(n * (p if side == 0 else 1 - p), votes[j]) for p, (votes, n) in zip(posterior, patterns)]
                up = sum(m for m, v in mass if v > 0) + weight * start[side]
                cast = sum(m for m, v in mass if v) + weight
                ends.append(up / cast)
            fresh.append((ends[0], min(ends[1], ends[0])))  # a rule is never worse than a coin
        moved = max((abs(a - b) for x, y in zip(accuracy, fresh) for a, b in zip(x, y)), default=0)
        prior = (good + weight * PRIOR_GOOD) / (total + weight)
        accuracy = fresh
        if moved < 1e-9:
            break
    return {"prior": prior, "accuracy": accuracy}


def _parts(prior: float, accuracy) -> tuple[float, list[tuple[float, float]]]:
    """Log odds of good: the prior's, and by rule those of a good and of a bad vote."""
    tiny = 1e-12
    log = lambda a, b: math.log(max(a, tiny) / max(b, tiny))
    return log(prior, 1 - prior), [(log(g, b), log(1 - g, 1 - b)) for g, b in accuracy]


def posterior_good(votes, prior: float, accuracy) -> float:
    base, parts = _parts(prior, accuracy)
    odds = base + sum(up if v > 0 else down for v, (up, down) in zip(votes, parts) if v)
    return 1 / (1 + math.exp(min(700, max(-700, -odds))))


def judge(docs: DataFrame, keep_from: float = KEEP_FROM) -> DataFrame:
    """Features, base_failed, the posterior ``quality`` and kept, by row."""
    return _judged(materialise(features(docs), "op2-features"), keep_from)


def _judged(seen: DataFrame, keep_from: float) -> DataFrame:
    votes = rules()
    voted = seen.select("*", *[c.alias(f"vote_{k}") for k, c in votes.items()])
    names = [f"vote_{k}" for k in votes]
    counted = voted.groupBy(*names).agg(F.count("*").alias("n")).collect()  # at most 3 ** rules rows
    model = fit(sorted((tuple(r[k] for k in names), r["n"]) for r in counted))
    base, parts = _parts(model["prior"], model["accuracy"])
    odds = F.lit(base)
    for name, (up, down) in zip(names, parts):
        odds = odds + F.when(F.col(name) > 0, F.lit(up)).when(F.col(name) < 0, F.lit(down)).otherwise(F.lit(0.0))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return (voted.withColumn("base_failed", failed)
            .withColumn("quality", 1 / (1 + F.exp(-odds)))
            .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= keep_from)))


def keep_good(docs: DataFrame, keep_from: float = KEEP_FROM) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    own = [c for c in docs.columns]
    boxed = docs.select(F.col("doc_id"), F.col("text"), F.struct(*[F.col(f"`{c}`") for c in own]).alias("row"))
    seen = materialise(features(boxed, "row"), "op2-kept")
    return _judged(seen, keep_from).filter("kept").select("row.*")
