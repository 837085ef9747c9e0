"""The pipeline's stages one by one against plain versions, and whole."""

import os
import sys

import numpy as np
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402
import corpus_pipeline  # noqa: E402
from test_operators import reference_encoding, whole_lines  # noqa: E402

SMALL = "/root/testdata/sf0.001"


def test_stages_in_turn_equal_the_plain_pipeline(spark):
    """Verdicts of the first stage are its own; every other stage is redone in Python."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    kept = corpus_pipeline.quality_rules(spark, docs, SMALL).checkpoint()
    assert kept.columns == columns
    texts = {r["doc_id"]: r["text"] for r in kept.collect()}
    for doc, text in texts.items():
        n, *_, repeat = brute.quality(text)
        assert n >= 20 and 100 * repeat <= 30 * n
    gone = whole_lines(texts)
    cut = {d: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[d]) for d, t in texts.items()}
    near = brute.near(cut)
    left = {d: t for d, t in cut.items() if near[d][1] == d}
    _, _, library = reference_encoding()
    want = {d: (len(ids := library.encode_ordinary(t)), brute.sha(np.array(ids, "<u4").tobytes()), brute.sha(t))
            for d, t in left.items()}
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"])
           for r in corpus_pipeline.run(spark, SMALL).collect()}
    assert got == want


def test_stages_keep_columns_and_take_odd_rows(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, SMALL).checkpoint()
            if k < len(corpus_pipeline.STAGES) - 1:
                assert out.columns == odd_docs.columns and out.schema == odd_docs.schema
            docs = out if k < len(corpus_pipeline.STAGES) - 1 else docs


def test_the_mix_decides_the_position_of_the_result(spark):
    from cabstat.llm import mixing
    from cabstat.llm.common import materialise

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    # part files of very different sizes, which Spark does not read in turn
    wide = docs.withColumn("text", F.when(F.col("doc_id") % 3 == 0, F.repeat("text", 9)).otherwise(F.col("text")))
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "7"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        mixed = materialise(corpus_pipeline.mix_sources(spark, wide, SMALL), "test-mixed")
        assert len(mixed.inputFiles()) > 1
        got = corpus_pipeline.encode(spark, mixed, SMALL).orderBy("position").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    placed = mixing.schedule(docs).orderBy("position").collect()
    assert len({r["position"] for r in got}) == len(placed)
    assert [r["doc_id"] for r in got] == [r["doc_id"] for r in placed]
