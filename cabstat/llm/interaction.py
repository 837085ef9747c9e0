"""Filter interaction audit: what every filter removes, at every place of every order.

Each document has a mask of the filters that it fails. The masks are counted by part; an order of
filters needs nothing but these cells. A recursive common table expression enumerates the orders as
prefixes: it starts with every mask and no filter, and each level extends every prefix by each letter
not used in it, carrying the bits applied before, so that level k emits what its step does to every
mask: kept, removed here, or removed before. Prefixes are shared by the orders that begin with them
(325 for five filters, not 600), and the recursion has at most 2^filters masks, whatever the input;
its rows are then joined with the cells of the parts.

Copies are found by the SHA-256 of the whole text, equal digests standing for identical texts. Rows
of one digest are first counted by (part, labels), which is done in the tasks that hold them, so a
text with a third of all rows reaches any one task as a few rows.

Defined results: null text counts as empty, null lang is the part ''; a document with several label
rows has a label if any of them has; repeated rows count each, and rows of one doc_id and text are
copies of smaller ids only, not of each other; a row with a null doc_id has no labels and is no copy,
nor does it make others copies; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import SLICE_BYTES, batches, map_arrow, materialise, text_bytes

# The filters' letters, and the characters that filter D takes.
FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, SYMBOLS = 100, 80, 10, b"#$%&*|"

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_CAPITALS, _INNER = bytes(range(0x41, 0x5B)), bytes(range(0x80, 0xC0))
METRICS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]


def own_mask(text: bytes) -> int:
    """Bits of the filters A to D, which a text fails by itself."""
    # bytes.split() cuts at exactly \x20 and \x09-\x0D; a text longer than a slice is read word by word
    words = text.split() if len(text) <= SLICE_BYTES else (m[0] for m in _WORD.finditer(text))
    n, seen = 0, set()
    if isinstance(words, list):
        n, seen = len(words), set(words)
    else:
        for w in words:
            n += 1
            seen.add(w)
    points = len(text.translate(None, _INNER))
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    return ((n < LEAST_WORDS) | (100 * len(seen) < LEAST_DISTINCT * n) << 1
            | (100 * capitals > MOST_CAPITALS * points) << 2 | (len(text.translate(None, SYMBOLS)) < len(text)) << 3)


def judged(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, part, own mask (A to D) and digest of the text."""
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(stream):
            texts = text_bytes(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("part"), pa.array(map(own_mask, texts), pa.int32()),
                 pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())],
                ["doc_id", "part", "mask", "digest"])

    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
                                 F.col("text").cast("string")), run, "doc_id long, part string, mask int, digest binary")


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents by (part, mask): n, those labelled good, those labelled toxic."""
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    same = ["digest", "part", "mask", "good", "toxic"]
    # rows without an id are spread by their text; they get no labels
    key = F.coalesce("doc_id", F.xxhash64("digest"))
    rows = judged(docs).withColumn("key", key).join(marks.withColumnRenamed("doc_id", "key"), "key", "left").select(
        "key", "doc_id", *same[:3], *[(F.col("doc_id").isNotNull() & F.coalesce(c, F.lit(False))).alias(c) for c in same[3:]])
    # repeated rows are counted where the join put them; then a group's rows go by their labels and part
    held = rows.groupBy("key", "doc_id", *same).agg(F.count("*").alias("n")).groupBy(
        *same, F.col("doc_id").isNull().alias("nameless")).agg(
        F.sum("n").alias("n"), F.min("doc_id").alias("least"), F.min_by("n", "doc_id").alias("at_least"))
    first = F.min("least").over(Window.partitionBy("digest"))
    split = held.withColumn("firsts", F.when(F.col("nameless"), F.col("n")).when(
        F.col("least") == first, F.col("at_least")).otherwise(0))
    copy = 1 << FILTERS.index("E")
    each = split.select("part", "good", "toxic", F.explode(F.array(
        F.struct(F.col("mask").alias("mask"), F.col("firsts").alias("n")),
        F.struct(F.col("mask").bitwiseOR(F.lit(copy)).alias("mask"), (F.col("n") - F.col("firsts")).alias("n")))).alias("c"))
    return each.select("part", "good", "toxic", "c.*").filter("n > 0").groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"))


_WALK = f"""
WITH RECURSIVE walk(prefix, step, before, bit, mask) AS (
    SELECT CAST('' AS STRING), 0, 0, 0, mask FROM {{masks}}
    UNION ALL
    SELECT concat(prefix, substring('{FILTERS}', k + 1, 1)), step + 1, before | bit, shiftleft(1, k), mask
    FROM walk LATERAL VIEW explode(filter(sequence(0, {len(FILTERS) - 1}), k -> ((before | bit) & shiftleft(1, k)) = 0)) t AS k
)
SELECT prefix, step, bit, mask, mask & before = 0 AS reached, mask & bit != 0 AS fails FROM walk WHERE step > 0
"""


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, filter_order and step with what the step's filter does there."""
    spark = docs.sparkSession
    counted = materialise(cells(docs, labels), "interaction-cells")
    # one row per prefix and mask: at most 325 x 32
    walk = materialise(spark.sql(_WALK, masks=counted.select("mask").distinct()), "interaction-walk")
    here = F.col("reached") & F.col("fails")
    total = lambda when, what: F.sum(F.when(when, F.col(what)).otherwise(0))
    per_prefix = counted.join(F.broadcast(walk), "mask").groupBy("part", "prefix").agg(
        total(F.col("reached") & ~F.col("fails"), "n").alias("kept"), total(here, "n").alias("removed"),
        total(~F.col("reached") & F.col("fails"), "n").alias("redundant"),
        total(F.col("mask") == F.col("bit"), "n").alias("unique_fails"),
        total(here, "good").alias("good_lost"), total(here, "toxic").alias("toxic_lost"))
    # every whole order with its prefixes: 600 rows
    orders = walk.filter(F.col("step") == len(FILTERS)).select(F.col("prefix").alias("filter_order")).distinct()
    steps = orders.select("filter_order", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step")).withColumn(
        "prefix", F.substring("filter_order", F.lit(1), F.col("step")))
    whole = per_prefix.join(F.broadcast(steps), "prefix")
    shares = Window.partitionBy("part", F.substring("filter_order", F.col("step"), F.lit(1)))
    return whole.select("part", "filter_order", "step", *METRICS, F.sum("removed").over(shares).alias("shapley"))
