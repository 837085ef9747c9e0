"""CSV decoder queries over ``orders`` encoded to text and decoded back.

Faults are planted by ``o_orderkey`` so every row is processed and the
oracle states the expected decode for each row.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from ..functions import decode as D
from ..session import ensure_utc, scratch_path
from ..sources.csvfiles import drop_comment_and_blank, drop_malformed, read_csv
from ..sources.tables import table
from .catalog import register

# ---- fixed values of the CSV fixtures --------------------------------------
ORDERS_FIELDS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                 "o_orderpriority"]
ORDERS_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderdate", T.DateType()), T.StructField("o_orderpriority", T.StringType()),
])
ORDERS_DDL = ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate DATE, o_orderpriority STRING")
ORDERS_HEADER = ",".join(ORDERS_FIELDS)
SHORT_ROW, LONG_ROW, BAD_CELL = 5, 7, 9          # o_orderkey moduli
NULL_PRIORITY, EMPTY_STATUS = 7, 11
NAN_PRICE, INF_PRICE, NEG_INF_PRICE = 11, 13, 17
UPPER_HEADER, RENAMED_HEADER, SHORT_HEADER, PADDED_HEADER = 3, 4, 5, 7
COMMENT_EVERY, BLANK_EVERY, TRAILING_RECORD, NEWLINE_CELL = 6, 8, 4, 10
# ------------------------------------------------------------------------------

ORACLE_COLS = ("o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, "
               "o_orderpriority")
ORACLE_LINE = ("concat_ws(',', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), o_orderstatus, "
               "CAST(o_totalprice AS VARCHAR), strftime(o_orderdate, '%Y-%m-%d'), o_orderpriority)")


def _orders(spark, sf_dir):
    ensure_utc(spark)
    return table(spark, sf_dir, "orders")


def _cells() -> list[Column]:
    return [F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"),
            F.col("o_orderstatus"), F.col("o_totalprice").cast("string"),
            F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderpriority")]


def _line() -> Column:
    return F.concat_ws(",", *_cells())


def _flat(struct_col: str, extra: list[str] | None = None):
    return [*(extra or []), *[F.col(f"{struct_col}.{f}").alias(f) for f in ORDERS_FIELDS]]


@register("encode_csv", f"SELECT o_orderkey AS src_key, {ORACLE_LINE} AS line FROM orders")
def q_encode_csv(spark, sf_dir):
    o = _orders(spark, sf_dir)
    rec = F.struct(F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus"),
                   F.col("o_totalprice"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("d"),
                   F.col("o_orderpriority"))
    return o.select(F.col("o_orderkey").alias("src_key"), D.encode_csv(rec).alias("line"))


@register("decode_csv", f"SELECT {ORACLE_COLS} FROM orders")
def q_decode_csv(spark, sf_dir):
    o = _orders(spark, sf_dir).select(_line().alias("line"))
    return o.select(D.decode_csv("line", ORDERS_SCHEMA).alias("r")).select(*_flat("r"))


@register("decode_csv_ddl", f"SELECT {ORACLE_COLS} FROM orders")
def q_decode_csv_ddl(spark, sf_dir):
    """Schema given as a DDL string, options as a map (``;`` separator)."""
    o = _orders(spark, sf_dir).select(F.concat_ws(";", *_cells()).alias("line"))
    return o.select(D.decode_csv("line", ORDERS_DDL, {"sep": ";"}).alias("r")).select(*_flat("r"))


@register("decode_csv_header", f"SELECT {ORACLE_COLS} FROM orders")
def q_decode_csv_header(spark, sf_dir):
    """Header line, CRLF, the record; some messages have an empty line before it,
    some a later record that must be ignored."""
    extra = F.when(F.col("o_orderkey") % TRAILING_RECORD == 0, F.lit("\r\n0,0,X,0.0,2000-01-01,junk")).otherwise("")
    o = _orders(spark, sf_dir).select(F.concat(
        F.lit(ORDERS_HEADER + "\r\n"), F.when(F.col("o_orderkey") % BLANK_EVERY == 0, F.lit("\r\n")).otherwise(""),
        _line(), extra).alias("msg"))
    return o.select(D.decode_csv_with_header("msg", ORDERS_SCHEMA, {"header": "true", "multiLine": "true"})
                    .alias("r")).select(*_flat("r"))


DIALECT = {"sep": "|", "quote": "'", "escape": "\\", "quoteAll": "true",
           "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"}


@register("csv_dialect", f"SELECT {ORACLE_COLS} FROM orders")
def q_csv_dialect(spark, sf_dir):
    """Round trip through a custom dialect: ``|`` separator, ``'`` quote, all
    quoted, padded with spaces that the reader trims."""
    o = _orders(spark, sf_dir)
    rec = F.struct(*[c.alias(n) for c, n in zip(_cells(), ORDERS_FIELDS)])
    line = F.concat(F.lit("  "), D.encode_csv(rec, DIALECT), F.lit("  "))
    return o.select(line.alias("line")).select(
        D.decode_csv("line", ORDERS_SCHEMA, DIALECT).alias("r")).select(*_flat("r"))


#: Encodings of message bodies, by order key.
ENCODINGS = ("UTF-8", "ISO-8859-1", "UTF-16LE", "UTF-16BE")
_ENCODED = {"quoteAll": "true", "escape": "|", "charToEscapeQuoteEscaping": "~"}


@register("csv_encoded_bodies", f"""
SELECT o_orderkey, CASE o_orderkey % {len(ENCODINGS)} {' '.join(f"WHEN {k} THEN '{e}'" for k, e in enumerate(ENCODINGS))} END AS encoding,
       chr(233) || '"' || o_orderpriority || '|" ' || chr(252) AS note FROM orders""")
def q_csv_encoded_bodies(spark, sf_dir):
    """Binary bodies in several encodings with quotes, the escape character and its own escape in a cell:
    encoded, decoded by their encoding and parsed in that dialect."""
    note = F.concat(F.lit("\u00e9\""), F.col("o_orderpriority"), F.lit("|\" \u00fc"))
    coded = lambda make: F.coalesce(*[F.when(F.col("encoding") == e, make(e)) for e in ENCODINGS])
    kind = F.element_at(F.array(*map(F.lit, ENCODINGS)), (F.col("o_orderkey") % len(ENCODINGS) + 1).cast("int"))
    o = _orders(spark, sf_dir).select("o_orderkey", kind.alias("encoding"), note.alias("note"))
    o = o.withColumn("line", D.encode_csv(F.struct("o_orderkey", "note"), _ENCODED))
    o = o.withColumn("body", coded(lambda e: F.encode("line", e)))
    text = coded(lambda e: D.body_to_text("body", e))
    return o.select("encoding", D.decode_csv(text, "o_orderkey BIGINT, note STRING", _ENCODED).alias("r")).select("r.o_orderkey", "encoding", "r.note")


@register("csv_null_tokens", f"""
SELECT o_orderkey,
       CASE WHEN o_orderkey % {EMPTY_STATUS} = 0 THEN '' ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderkey % {NULL_PRIORITY} = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority
FROM orders""")
def q_csv_null_tokens(spark, sf_dir):
    """``nullValue=NA``: NA cells are null, a quoted empty cell stays ''."""
    o = _orders(spark, sf_dir)
    status = F.when(F.col("o_orderkey") % EMPTY_STATUS == 0, F.lit("")).otherwise(F.col("o_orderstatus"))
    prio = F.when(F.col("o_orderkey") % NULL_PRIORITY != 0, F.col("o_orderpriority"))
    rec = F.struct("o_orderkey", status.alias("s"), prio.alias("p"))
    opts = {"nullValue": "NA"}
    line = D.encode_csv(rec, opts)
    r = D.decode_csv(line, "o_orderkey BIGINT, o_orderstatus STRING, o_orderpriority STRING", opts)
    return o.select(r.alias("r")).select("r.*")


TYPED_OPTS = {"nanValue": "NaN", "positiveInf": "Inf", "negativeInf": "-Inf", "dateFormat": "dd/MM/yyyy"}


@register("csv_typed_cells", f"""
SELECT o_orderkey, CAST(o_custkey AS INTEGER) AS cust,
  CASE WHEN o_orderkey % {NAN_PRICE} = 0 THEN 'nan' WHEN o_orderkey % {INF_PRICE} = 0 THEN 'inf'
       WHEN o_orderkey % {NEG_INF_PRICE} = 0 THEN '-inf' ELSE 'num' END AS price_kind,
  CASE WHEN o_orderkey % {NAN_PRICE} = 0 OR o_orderkey % {INF_PRICE} = 0 OR o_orderkey % {NEG_INF_PRICE} = 0
       THEN NULL ELSE o_totalprice END AS price,
  o_orderstatus = 'F' AS is_final,
  CAST(o_totalprice AS DECIMAL(12,2)) AS price_dec,
  CAST(o_orderdate AS DATE) AS order_date
FROM orders""")
def q_csv_typed_cells(spark, sf_dir):
    """int, double with NaN/Inf tokens, boolean, decimal with thousands
    separators, date by pattern."""
    o = _orders(spark, sf_dir)
    k = F.col("o_orderkey")
    price_tok = (F.when(k % NAN_PRICE == 0, "NaN").when(k % INF_PRICE == 0, "Inf")
                 .when(k % NEG_INF_PRICE == 0, "-Inf").otherwise(F.col("o_totalprice").cast("string")))
    rec = F.struct(k.alias("k"), F.col("o_custkey").alias("c"), price_tok.alias("p"),
                   (F.col("o_orderstatus") == "F").alias("b"),
                   F.format_number("o_totalprice", 2).alias("d"),
                   F.date_format("o_orderdate", "dd/MM/yyyy").alias("t"))
    line = D.encode_csv(rec)
    r = D.decode_csv(line, "o_orderkey BIGINT, cust INT, p DOUBLE, is_final BOOLEAN, "
                           "price_dec DECIMAL(12,2), order_date DATE", TYPED_OPTS)
    p = F.col("r.p")
    kind = F.when(F.isnan(p), "nan").when(p == float("inf"), "inf").when(p == float("-inf"), "-inf").otherwise("num")
    return o.select(r.alias("r")).select(
        "r.o_orderkey", "r.cust", kind.alias("price_kind"),
        F.when(~F.isnan(p) & (F.abs(p) != float("inf")), p).alias("price"),
        "r.is_final", "r.price_dec", "r.order_date")


def _faulty_line() -> Column:
    k = F.col("o_orderkey")
    cells = _cells()
    bad = [cells[0], F.lit("x1"), *cells[2:]]
    return (F.when(k % SHORT_ROW == 0, F.concat_ws(",", *cells[:4]))
            .when(k % LONG_ROW == 0, F.concat_ws(",", *cells, F.lit("x"), F.lit("y")))
            .when(k % BAD_CELL == 0, F.concat_ws(",", *bad))
            .otherwise(F.concat_ws(",", *cells)))


def _oracle_faulty_line() -> str:
    c = ["CAST(o_orderkey AS VARCHAR)", "CAST(o_custkey AS VARCHAR)", "o_orderstatus",
         "CAST(o_totalprice AS VARCHAR)", "strftime(o_orderdate, '%Y-%m-%d')", "o_orderpriority"]
    return (f"CASE WHEN o_orderkey % {SHORT_ROW} = 0 THEN concat_ws(',', {', '.join(c[:4])}) "
            f"WHEN o_orderkey % {LONG_ROW} = 0 THEN concat_ws(',', {', '.join(c)}, 'x', 'y') "
            f"WHEN o_orderkey % {BAD_CELL} = 0 THEN concat_ws(',', {c[0]}, 'x1', {', '.join(c[2:])}) "
            f"ELSE concat_ws(',', {', '.join(c)}) END")


SHORT = f"o_orderkey % {SHORT_ROW} = 0"
LONG = f"(o_orderkey % {SHORT_ROW} <> 0 AND o_orderkey % {LONG_ROW} = 0)"
BAD = f"(o_orderkey % {SHORT_ROW} <> 0 AND o_orderkey % {LONG_ROW} <> 0 AND o_orderkey % {BAD_CELL} = 0)"
VOIDED = f"""CASE WHEN {BAD} THEN NULL ELSE o_orderkey END AS o_orderkey,
  CASE WHEN {BAD} THEN NULL ELSE o_custkey END AS o_custkey,
  CASE WHEN {BAD} THEN NULL ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN {BAD} THEN NULL ELSE o_totalprice END AS o_totalprice,
  CASE WHEN {BAD} OR {SHORT} THEN NULL ELSE CAST(o_orderdate AS DATE) END AS o_orderdate,
  CASE WHEN {BAD} OR {SHORT} THEN NULL ELSE o_orderpriority END AS o_orderpriority"""


@register("csv_ragged_rows", f"""
SELECT o_orderkey AS src_key, {VOIDED}
FROM orders""")
def q_csv_ragged_rows(spark, sf_dir):
    """Short rows padded with null, long rows truncated; a bad cell voids its row."""
    o = _orders(spark, sf_dir).select(F.col("o_orderkey").alias("src_key"), _faulty_line().alias("line"))
    return o.select("src_key", D.decode_csv("line", ORDERS_SCHEMA).alias("r")).select("src_key", *_flat("r"))


@register("csv_bad_cell", f"""
SELECT o_orderkey AS src_key, {VOIDED},
  {BAD} AS void
FROM orders""")
def q_csv_bad_cell(spark, sf_dir):
    """One bad cell voids the whole row; ragged rows without one are kept. A
    void row is a struct whose fields are all null, not a null struct."""
    o = _orders(spark, sf_dir).select(F.col("o_orderkey").alias("src_key"), _faulty_line().alias("line"))
    s = o.select("src_key", D.decode_csv("line", ORDERS_SCHEMA).alias("r"))
    return s.select("src_key", *_flat("r"),
                    (F.col("r").isNotNull() & F.coalesce(*[F.col(f"r.{f}").cast("string") for f in ORDERS_FIELDS])
                     .isNull()).alias("void"))


CORRUPT = "_corrupt_record"


@register("csv_mode_permissive", f"""
SELECT o_orderkey AS src_key, {VOIDED},
  ({SHORT} OR {LONG} OR {BAD}) AS malformed
FROM orders""")
def q_csv_mode_permissive(spark, sf_dir):
    """PERMISSIVE keeps every row; malformed ones are flagged."""
    o = _orders(spark, sf_dir).select(F.col("o_orderkey").alias("src_key"), _faulty_line().alias("line"))
    r = D.decode_csv("line", ORDERS_SCHEMA, corrupt=CORRUPT)
    return o.select("src_key", r.alias("r")).select(
        "src_key", *_flat("r"), F.col(f"r.{CORRUPT}").isNotNull().alias("malformed"))


@register("csv_mode_drop", f"""
SELECT {ORACLE_COLS} FROM orders WHERE NOT ({SHORT} OR {LONG} OR {BAD})""")
def q_csv_mode_drop(spark, sf_dir):
    """DROPMALFORMED: malformed records yield no row."""
    o = _orders(spark, sf_dir).select(_faulty_line().alias("line"))
    r = o.select(D.decode_csv("line", ORDERS_SCHEMA, corrupt=CORRUPT).alias("r")).select("r.*")
    return drop_malformed(r)


@register("csv_corrupt_record", f"""
SELECT o_orderkey AS src_key, {VOIDED},
  CASE WHEN {SHORT} OR {LONG} OR {BAD} THEN {_oracle_faulty_line()} END AS _corrupt_record
FROM orders""")
def q_csv_corrupt_record(spark, sf_dir):
    """The text of a malformed record lands in ``_corrupt_record``: next to the cells
    of a ragged row, alone when a cell failed."""
    o = _orders(spark, sf_dir).select(F.col("o_orderkey").alias("src_key"), _faulty_line().alias("line"))
    r = D.decode_csv("line", ORDERS_SCHEMA, corrupt=CORRUPT)
    return o.select("src_key", r.alias("r")).select("src_key", *_flat("r"), f"r.{CORRUPT}")


@register("csv_header_check", f"""
SELECT o_orderkey,
  CASE WHEN o_orderkey % {SHORT_HEADER} = 0 THEN 'header has 5 columns, schema has 6'
       WHEN o_orderkey % {RENAMED_HEADER} = 0 THEN 'column 2: expected o_custkey but found cust'
       WHEN o_orderkey % {UPPER_HEADER} <> 0 AND o_orderkey % {PADDED_HEADER} = 0
       THEN 'column 2: expected o_custkey but found  o_custkey'
  END AS header_error
FROM orders""")
def q_csv_header_check(spark, sf_dir):
    """Header names (some quoted, some padded, which counts) vs schema names in
    order, case-insensitive."""
    k = F.col("o_orderkey")
    names = list(ORDERS_FIELDS)
    header = (F.when(k % SHORT_HEADER == 0, F.lit(",".join(names[:5])))
              .when(k % RENAMED_HEADER == 0, F.lit(",".join([names[0], "cust", *names[2:]])))
              .when(k % UPPER_HEADER == 0, F.lit(",".join(f'"{n.upper()}"' for n in names)))
              .when(k % PADDED_HEADER == 0, F.lit(ORDERS_HEADER.replace(",o_custkey", ", o_custkey")))
              .otherwise(F.lit(ORDERS_HEADER)))
    o = _orders(spark, sf_dir).select(k, F.concat(header, F.lit("\r\n"), _line()).alias("msg"))
    return o.select("o_orderkey", D.header_mismatch("msg", names).alias("header_error"))


@register("csv_comment_filter", f"SELECT {ORACLE_COLS} FROM orders")
def q_csv_comment_filter(spark, sf_dir):
    """Comment and blank lines interleaved with records are dropped."""
    o = _orders(spark, sf_dir)
    k = F.col("o_orderkey")
    lines = o.select(F.explode(F.array(
        F.when(k % COMMENT_EVERY == 0, F.concat(F.lit("# note "), k.cast("string"))),
        F.when(k % BLANK_EVERY == 0, F.lit(" \t ")),
        _line())).alias("value")).filter(F.col("value").isNotNull())
    kept = drop_comment_and_blank(lines)
    return kept.select(D.decode_csv("value", ORDERS_SCHEMA).alias("r")).select(*_flat("r"))


@register("csv_file_read", f"""
SELECT {ORACLE_COLS.replace('o_orderpriority', f"CASE WHEN o_orderkey % {NEWLINE_CELL} = 0 THEN o_orderpriority || chr(10) || 'second line' ELSE o_orderpriority END AS o_orderpriority")}
FROM orders""")
def q_csv_file_read(spark, sf_dir):
    """Orders written as CSV files with a header (some cells span two lines),
    read back with a declared schema, ``header`` and ``multiLine``."""
    o = _orders(spark, sf_dir)
    prio = F.when(F.col("o_orderkey") % NEWLINE_CELL == 0,
                  F.concat(F.col("o_orderpriority"), F.lit("\nsecond line"))).otherwise(F.col("o_orderpriority"))
    out = scratch_path(spark, "csv_file_read")
    (o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
              F.to_date("o_orderdate").alias("o_orderdate"), prio.alias("o_orderpriority"))
      .write.option("header", True).csv(out))
    return read_csv(spark, out, ORDERS_SCHEMA, header=True, multi_line=True)


@register("csv_split_read", f"SELECT {ORACLE_COLS} FROM orders")
def q_csv_split_read(spark, sf_dir):
    """Orders written as CSV files with a header and read back without
    ``multiLine``, so that a large file is split over tasks."""
    out = scratch_path(spark, "csv_split_read")
    (_orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                   F.to_date("o_orderdate").alias("o_orderdate"), "o_orderpriority")
     .write.option("header", True).csv(out))
    return read_csv(spark, out, ORDERS_SCHEMA, header=True)
