"""A corpus pipeline: quality rules, line dedup, near-dedup, mixing, byte-level BPE.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``. All but the
last return the columns of ``documents``. Whatever columns ``documents`` has go
through; empty tables, null and empty texts and repeated rows are handled as
each operator's docstring says.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cabstat.llm import bpe, lines, minhash, mixing, quality
from cabstat.llm.common import materialise, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules accept."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the blocks of lines that an earlier one has."""
    return lines.drop_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return minhash.keep_first(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order that interleaves sources to their target weights."""
    return mixing.mix(docs)


def written_position(docs: DataFrame) -> Column:
    """Where a row of a written table is: number of its part file, then its row there.

    Spark packs files into tasks by size, so reading alone does not keep the
    order. A table that is not read from files has the order of its partitions.
    """
    try:
        docs.select("_metadata.row_index").schema
    except AnalysisException:
        return F.monotonically_increasing_id()
    number = lambda pattern: F.coalesce(F.regexp_extract(
        "_metadata.file_name", pattern, 1).try_cast("long"), F.lit(0))
    return (F.shiftleft(number("^part-([0-9]+)"), 42) + F.shiftleft(number("-c([0-9]+)[.]"), 32)
            + F.col("_metadata.row_index"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document, and position: the
    order of the mix, with gaps."""
    import public_tokenizers

    return bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
                       written_position(docs))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("mix sources", mix_sources),
    ("byte-level BPE", encode),
]

#: Expectation-maximisation, patience alignment and BPE merges are beyond plain SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{k}")
    return docs
