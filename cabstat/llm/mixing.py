"""Mixing sources to target weights by Pfair scheduling.

Each source is cut into blocks of documents. Block ``i`` (from 1) of a source
of weight ``w`` may start at slot ``floor((i - 1) / w)`` and must be placed
before ``ceil(i / w)``; earliest deadline first among the released blocks
keeps every source within less than one block of its share at every slot, as
long as no source has run out. Weights are quotas of a period of ``PERIOD``
slots, so one period (a function of the weights alone, not of the data) is
scheduled once and every block's slot follows by arithmetic. The interleave
itself is DataFrame expressions: ranks come from counts by (source, bucket),
so a source with a third of all rows is spread over ``BUCKETS`` groups.

Defined results: a null source is a source of its own; a null doc_id ranks
first in its bucket; rows that tie (same id) take neighbouring ranks; no row
is dropped or repeated, a source that runs out early leaves its slots empty;
an empty table gives an empty result; extra columns are ignored by
``schedule`` and kept by ``mix``. Targets name sources; one that has no rows
counts for nothing, and rows of a source without a target go last of all.
"""

from __future__ import annotations

import heapq
import math

from pyspark.sql import Column, DataFrame, functions as F, Window

BLOCK_ROWS = 8
PERIOD = 1000
BUCKETS = 4096


def quotas(weights: dict, period: int = PERIOD) -> dict:
    """Slots of a period by source: proportional, largest remainder, at least one."""
    weights = {k: w for k, w in weights.items() if w > 0}
    if not weights:
        return {}
    period = max(period, 50 * len(weights))
    total = math.fsum(weights.values())
    free = period - len(weights)
    exact = {k: free * w / total for k, w in weights.items()}
    out = {k: 1 + int(x) for k, x in exact.items()}
    order = sorted(exact, key=lambda k: (-(exact[k] - int(exact[k])), str(k)))
    for k in order[: period - sum(out.values())]:
        out[k] += 1
    return out


def window(i: int, quota: int, period: int) -> tuple[int, int]:
    """Release slot and deadline of block ``i`` (from 1)."""
    return (i - 1) * period // quota, -(-i * period // quota)


def one_period(quota: dict) -> dict:
    """Slots of each source's blocks in one period, earliest deadline first."""
    period, names = sum(quota.values()), sorted(quota, key=str)
    slots: dict = {k: [] for k in names}
    waiting = [(0, rank) for rank in range(len(names))]  # by release
    ready: list[tuple[int, int]] = []                    # by deadline
    for slot in range(period):
        while waiting and waiting[0][0] <= slot:
            rank = heapq.heappop(waiting)[1]
            name = names[rank]
            heapq.heappush(ready, (window(len(slots[name]) + 1, quota[name], period)[1], rank))
        rank = heapq.heappop(ready)[1]
        name = names[rank]
        slots[name].append(slot)
        if len(slots[name]) < quota[name]:
            heapq.heappush(waiting, (window(len(slots[name]) + 1, quota[name], period)[0], rank))
    return slots


def tempered(docs: DataFrame, exponent: float = 0.5) -> dict:
    """Target weights rows ** exponent, by source (one row a source reaches the driver)."""
    counts = docs.groupBy(F.col("source").cast("string").alias("s")).count().collect()
    return {r["s"]: r["count"] ** exponent for r in counts}


def _named(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def _per_source(values: dict, otherwise: Column) -> Column:
    if not values:
        return otherwise
    pairs = [F.lit(x) for k, v in sorted(values.items()) for x in (k, v)]
    return F.coalesce(F.element_at(F.create_map(*pairs), F.col("_source")), otherwise)


def _placed(rows: DataFrame, weights: dict, block_rows: int) -> DataFrame:
    """``rows`` (doc_id, _source, ...) with rank, block, release, deadline, slot and position."""
    quota = quotas(weights)
    period = sum(quota.values())
    named = {"" if k is None else "=" + str(k): v for k, v in quota.items()}
    slots = {"" if k is None else "=" + str(k): v for k, v in one_period(quota).items()} if quota else {}
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64("doc_id"), F.lit(BUCKETS)).cast("int"))
    counts = rows.groupBy("_source", "_bucket").agg(F.count("*").alias("_n"))
    before = counts.select("_source", "_bucket", (F.sum("_n").over(
        Window.partitionBy("_source").orderBy("_bucket")) - F.col("_n")).alias("_before"))
    ranked = rows.withColumn("_row", F.row_number().over(
        Window.partitionBy("_source", "_bucket").orderBy("doc_id")))
    ranked = ranked.join(before, ["_source", "_bucket"]).withColumn("rank", F.col("_before") + F.col("_row") - 1)
    q = _per_source(named, F.lit(None).cast("int"))
    block = F.floor(F.col("rank") / block_rows).cast("long")
    at = F.element_at(_per_source(slots, F.array().cast("array<int>")), (F.col("block") % F.col("_q") + 1).cast("int"))
    out = (ranked.withColumn("_q", q).withColumn("block", block)
           .withColumn("slot", F.when(F.col("_q").isNotNull(), F.floor(F.col("block") / F.col("_q")) * period + at)))
    return (out.withColumn("release", F.expr(f"block * {period}L div _q"))
            .withColumn("deadline", F.expr(f"((block + 1) * {period}L + _q - 1) div _q"))
            .withColumn("position", F.col("slot") * block_rows + F.col("rank") % block_rows))


def schedule(docs: DataFrame, weights: dict | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Per row: doc_id, source, block, release, deadline, slot, position; no text is moved."""
    weights = tempered(docs) if weights is None else weights
    rows = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"),
                       _named(F.col("source")).alias("_source"))
    return _placed(rows, weights, block_rows).select(
        "doc_id", "source", "block", "release", "deadline", "slot", "position")


def mix(docs: DataFrame, weights: dict | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """All rows and columns of ``docs``, ordered by position."""
    weights = tempered(docs) if weights is None else weights
    boxed = docs.select(F.col("doc_id").cast("long"), _named(F.col("source")).alias("_source"),
                        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row_"))
    placed = _placed(boxed, weights, block_rows)
    return placed.orderBy(F.col("position").asc_nulls_last(), "_source", "rank").select("_row_.*")
