"""Message decoders as Column functions (JSON, header-bearing CSV, plain CSV).

All of them are built from Spark's own ``from_json`` / ``from_csv`` /
``to_csv`` and string expressions, so they run in the JVM for batch and
streaming alike.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F, types as T

from ..schemas import as_strings

# A line break ends the header. The header line is removed whole.
_FIRST_LINE = r"^[^\r\n]*+(?:\r\n|\n|\r|$)"
_CORRUPT = "__corrupt_record"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def body_to_text(body: Column | str = "body", encoding: str = "UTF-8") -> Column:
    """Binary payload as text (the raw message, kept as messageData). ``encoding``: UTF-8, US-ASCII,
    ISO-8859-1, UTF-16, UTF-16BE, UTF-16LE or UTF-32; bytes that are not of it raise, except in UTF-8,
    where they stay as they are."""
    return _col(body).cast("string") if encoding.upper() in ("UTF-8", "UTF8") else F.decode(_col(body), encoding)


def decode_json(text: Column | str, schema: T.StructType | str,
                options: dict[str, str] | None = None) -> Column:
    """JSON text to a declared struct; absent fields are null."""
    return F.from_json(_col(text), schema, options or {})


def strip_first_line(text: Column | str) -> Column:
    """Drop the first line (the header) and its line break."""
    return F.regexp_replace(_col(text), _FIRST_LINE, "")


def first_record(text: Column | str, options: dict[str, str] | None = None) -> Column:
    """Only the first CSV record of a text: empty lines before it are skipped,
    later records ignored. A quoted cell (the options' ``quote`` and
    ``escape``) may span lines."""
    opts = options or {}
    q, e = _regex_literal(opts.get("quote", '"')), _regex_literal(opts.get("escape", "\\"))
    inside = f"{e}.|{q}{q}|[^{q}{e}]"
    return F.regexp_extract(_col(text), rf"^[\r\n]*+((?:[^{q}\r\n]|{q}(?s:{inside})*+{q}?+)*+)", 1)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def decode_csv(text: Column | str, schema: T.StructType | str, options: dict[str, str] | None = None,
               corrupt: str | None = None) -> Column:
    """CSV record to a struct; one cell that fails to convert voids the row.

    A short row is padded with null and a long one truncated, but when any
    present token fails to convert, every field is null (the struct itself
    stays non-null). ``corrupt`` names an extra field that holds the text of a
    malformed record (wrong token count or a failed cell). Null text gives null.

    A clean record is parsed once: only where the typed decode reports a
    malformed record is the record decoded again as raw strings, to tell a
    failed cell from a ragged row.
    """
    if not isinstance(schema, T.StructType):
        schema = T.StructType.fromDDL(schema)
    fields = [f for f in schema.fields if f.name != corrupt]
    opts = options or {}
    lenient = {**opts, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}

    def shaped(typed: Column, keep: bool) -> Column:
        cells = [(typed[f.name] if keep else F.lit(None).cast(f.dataType)).alias(f.name) for f in fields]
        return F.struct(*cells, *([typed[_CORRUPT].alias(corrupt)] if corrupt else []))

    def decoded(record: Column) -> Column:
        raw = F.from_csv(record, _ddl(as_strings(T.StructType(fields))), opts)

        def judged(typed: Column) -> Column:
            failed = F.exists(F.array(raw), lambda r: reduce(
                lambda a, b: a | b, [r[f.name].isNotNull() & typed[f.name].isNull() for f in fields]))
            return (F.when(record.isNull(), F.lit(None)).when(typed[_CORRUPT].isNull(), shaped(typed, True))
                    .when(failed, shaped(typed, False)).otherwise(shaped(typed, True)))

        return _let(F.from_csv(record, _ddl(T.StructType(fields)) + f", `{_CORRUPT}` string", lenient), judged)

    return _let(_col(text), decoded)


def decode_csv_with_header(text: Column | str, schema: T.StructType,
                           options: dict[str, str] | None = None) -> Column:
    """Header-bearing CSV message: skip line 1, decode only the first record
    after it with all-or-nothing cells. Header only or a lone line leaves no
    record: the result is a struct of nulls. Null text gives null."""
    return decode_csv(first_record(strip_first_line(text), options), schema, options)


def header_names(line: Column | str, sep: str = ",", quote: str = '"') -> Column:
    """Names of a header line; a quoted name loses its quotes, nothing is trimmed."""
    s, q = _regex_literal(sep), _regex_literal(quote)
    cells = F.regexp_extract_all(_col(line), F.lit(rf"(?:^|{s})({q}(?:[^{q}]|{q}{q})*+{q}|[^{s}]*+)"), F.lit(1))
    return F.transform(cells, lambda c: F.when(
        F.startswith(c, F.lit(quote)) & F.endswith(c, F.lit(quote)) & (F.length(c) > 1),
        F.replace(F.substring(c, F.lit(2), F.length(c) - 2), F.lit(quote * 2), F.lit(quote))).otherwise(c))


def header_mismatch(text: Column | str, field_names: list[str], sep: str = ",",
                    case_sensitive: bool = False) -> Column:
    """Compare the header line's names with the schema's, in order.

    Null when they conform; otherwise a finding: a column-count mismatch, or the
    first position whose names differ.
    """
    first = F.regexp_extract(_col(text), r"^[^\r\n]*+", 0)
    header = header_names(first, sep)
    expected = F.array(*[F.lit(n) for n in field_names])
    norm = (lambda x: x) if case_sensitive else F.lower
    diffs = F.filter(
        F.sequence(F.lit(1), F.lit(len(field_names))),
        lambda i: norm(F.try_element_at(header, i)) != norm(F.try_element_at(expected, i)),
    )
    pos = F.try_element_at(diffs, F.lit(1))
    return (
        F.when(_col(text).isNull(), F.lit(None))
        .when(F.size(header) != len(field_names),
              F.format_string("header has %d columns, schema has %d", F.size(header),
                              F.lit(len(field_names))))
        .when(F.size(diffs) > 0,
              F.format_string("column %d: expected %s but found %s", pos,
                              F.try_element_at(expected, pos), F.try_element_at(header, pos)))
    )


def strict_header(text: Column | str, field_names: list[str], sep: str = ",",
                  case_sensitive: bool = False) -> Column:
    """``enforceSchema=false``: a non-conforming header raises at run time."""
    finding = header_mismatch(text, field_names, sep, case_sensitive)
    return F.when(finding.isNotNull(), F.raise_error(F.concat(F.lit("CSV header: "), finding)))


def encode_csv(struct: Column | str, options: dict[str, str] | None = None) -> Column:
    """Struct to one CSV line (quoteAll, escapeQuotes, nullValue, ... as options)."""
    return F.to_csv(_col(struct), options or {})


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _regex_literal(s: str) -> str:
    import re
    return re.escape(s)
