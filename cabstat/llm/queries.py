"""Registered queries of this subpackage and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import UPPER, table

Query = Callable[[SparkSession, str], DataFrame]


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .exact import exact_dedup

    return exact_dedup(table(spark, sf_dir, "documents"), F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0)


def op4_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ctw import score

    return score(table(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2,
                 across=True)


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .bpe import digests

    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                   public_tokenizers.PATTERN)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import judge

    return judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "quality")


def op1_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import schedule

    return schedule(table(spark, sf_dir, "documents"))


def op3_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substring import digests

    return digests(table(spark, sf_dir, "documents"))


def op6_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .minhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op7_line_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lines import digests

    return digests(table(spark, sf_dir, "documents"))


def op8_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .chat import read_back, windows

    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit("</s>[INST] ok [/INST]")
    planted = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                    F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                    said.alias("text"))
    return read_back(windows(rows.unionByName(planted)))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import summary

    return summary(table(spark, sf_dir, "documents"))


def op11_fim_exceptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .fim import digests

    return digests(table(spark, sf_dir, "documents"))


def op12_assignment_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secret_scan import summary

    return summary(table(spark, sf_dir, "documents"))


def op13_interaction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .interaction import audit

    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Query] = {
    "op1_pfair_mixing": op1_pfair_mixing,
    "op2_quality_rules": op2_quality_rules,
    "op3_phrase_automata": op3_phrase_automata,
    "op4_context_tree": op4_context_tree,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_hyperminhash": op6_hyperminhash,
    "op7_line_alignment": op7_line_alignment,
    "op8_chat_windows": op8_chat_windows,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_pii": op10_pii,
    "op11_fim_exceptions": op11_fim_exceptions,
    "op12_assignment_secrets": op12_assignment_secrets,
    "op13_interaction_audit": op13_interaction_audit,
}

_OP3_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
           FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS k
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
low AS (SELECT k, min(doc_id) AS least FROM win GROUP BY k),
gone AS (SELECT DISTINCT doc_id, i + j AS p
         FROM (SELECT doc_id, i FROM win JOIN low USING (k) WHERE least < doc_id), range(0, 50) r(j)),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT word.doc_id, string_agg(x, ' ' ORDER BY p) AS t FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY 1),
cut AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN cut USING (doc_id)
"""

_OP6_SQL = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, g FROM (
        SELECT doc_id, array_to_string(w[i:i + 4], ' ') AS g
        FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0))),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
          FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
         WHERE 100 * shared >= 75 * (x.n + y.n - shared)),
step AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(node, root) AS (SELECT doc_id, doc_id FROM documents
                      UNION SELECT step.b, reach.root FROM reach JOIN step ON step.a = reach.node WHERE step.b > reach.root),
part AS (SELECT node, min(root) AS component_id FROM reach GROUP BY 1)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents LEFT JOIN n USING (doc_id) JOIN part ON part.node = doc_id
"""

_OP11_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS w, CAST('0x' || h[1:8] AS UBIGINT) AS h1,
             CAST('0x' || h[9:16] AS UBIGINT) AS h2, CAST('0x' || h[17:24] AS UBIGINT) AS h3,
             CAST('0x' || h[25:32] AS UBIGINT) AS h4 FROM d),
c AS (SELECT doc_id, t, w, len(w) AS n, least(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS a,
             greatest(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS b,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                  WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, array_to_string(w[1:CAST(a AS BIGINT)], '') AS pre, array_to_string(w[CAST(a AS BIGINT) + 1:CAST(b AS BIGINT)], '') AS mid,
             array_to_string(w[CAST(b AS BIGINT) + 1:n], '') AS suf FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
              ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256
FROM p
"""

_OP13_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
first AS (SELECT t, min(doc_id) AS least FROM d GROUP BY t),
mark AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
             CASE WHEN len(w) < 100 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 2 ELSE 0 END
             + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 4 ELSE 0 END
             + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN doc_id > least THEN 16 ELSE 0 END AS mask
      FROM d JOIN first USING (t) LEFT JOIN mark USING (doc_id)),
letter AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(letter, bit)),
walk(prefix, step, before, bit) AS (
  SELECT '', 0, 0, 0
  UNION ALL
  SELECT prefix || letter.letter, step + 1, before | walk.bit, letter.bit
  FROM walk JOIN letter ON ((before | walk.bit) & letter.bit) = 0),
cell AS (SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
         FROM m GROUP BY 1, 2),
seen AS (SELECT part, prefix, step,
                sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
                sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS removed,
                sum(CASE WHEN mask & before <> 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS redundant,
                sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
                sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN good ELSE 0 END) AS good_lost,
                sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN toxic ELSE 0 END) AS toxic_lost
         FROM cell, walk WHERE step > 0 GROUP BY 1, 2, 3),
whole AS (SELECT o.prefix AS filter_order, seen.* FROM walk o JOIN seen ON o.step = 5 AND seen.prefix = o.prefix[1:seen.step])
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, filter_order[step]) AS BIGINT) AS shapley
FROM whole
"""

ORACLES: dict[str, str] = {
    "op11_fim_exceptions": _OP11_SQL,
    "op13_interaction_audit": _OP13_SQL,
    "op3_phrase_automata": _OP3_SQL,
    "op6_hyperminhash": _OP6_SQL,
    "op9_exact_dedup": f"""
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM t WINDOW w AS (PARTITION BY t)
""",
}
