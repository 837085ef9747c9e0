"""Personal data: expressions propose spans, checksums confirm them, context words
adjust the score. DataFrame functions only.

A pattern's matches come from ``regexp_extract_all`` and the text between them
from ``split``; running lengths of the two give code-point offsets. The
patterns use possessive repeats, so very long matches need no deep recursion.

Defined results: null text counts as empty and has no spans; an empty table
gives an empty result; each row is judged by itself, repeated or not; extra
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from .quality import let

#: Characters looked at on either side of a match for context words.
NEAR = 40
THRESHOLD = 0.5
PREFIX_BLOCK = 256


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    valid: Callable[[Column], Column]
    score: float
    context: str
    base: bool = True
    needs: str | None = None
    cut: Callable[[Column], Column] | None = None   # the part of a match that counts, null if none


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _chars(c: Column) -> Column:
    return F.filter(F.split(c, ""), lambda x: x != "")


def luhn(digits: Column) -> Column:
    """The checksum of payment cards holds."""
    def worth(c, k):
        d = c.cast("int") * (1 + k % 2)
        return F.when(d > 9, d - 9).otherwise(d)

    chars = _chars(F.reverse(digits))
    return F.aggregate(F.transform(chars, worth), F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(iban: Column) -> Column:
    """The checksum of international bank account numbers holds (ISO 7064)."""
    turned = F.concat(F.substring(iban, 5, 64), F.substring(iban, 1, 4))
    worth = F.transform(_chars(turned), lambda c: F.ascii(c))
    return F.aggregate(worth, F.lit(0), lambda r, a: F.when(a < 58, (r * 10 + a - 48) % 97).otherwise(
        (r * 100 + a - 55) % 97)) == 1


def _ip_parts(m: Column) -> Column:
    parts = F.transform(F.split(m, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
    return F.forall(parts, lambda p: F.when(F.length(p) > 3, False).otherwise(p.cast("int") <= 255))


def _card(m: Column) -> Column:
    d = _digits(m)
    return F.when(F.length(d).between(12, 19), luhn(d)).otherwise(False)


def _iban(m: Column) -> Column:
    bare = F.replace(m, F.lit(" "), F.lit(""))
    return F.when(F.length(bare).between(15, 34), mod97(bare)).otherwise(False)


def _iban_part(m: Column) -> Column:
    """The longest start of a match, up to a space or its end, that is an IBAN: capitals and digits that
    follow one are taken for more of it by the expression."""
    groups = F.split(m, " ")
    starts = F.transform(F.sequence(F.lit(1), F.size(groups)), lambda k: F.array_join(F.slice(groups, F.lit(1), k), " "))
    return F.try_element_at(F.filter(starts, _iban), F.lit(-1))


_MAIL = "[A-Za-z0-9._%+-]"
KINDS = (
    Kind("email", rf"(?:\G|(?<!{_MAIL})){_MAIL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         lambda m: F.lit(True), 0.8, r"e-?mail|contact|write to", needs="@"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", _ip_parts, 0.6, r"\bip\b|address|server|host"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", _card, 0.7, r"card|visa|credit|payment"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: F.length(_digits(m)).between(9, 15), 0.6,
         r"phone|call|mobile|\btel", needs="+"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])", lambda m: m.isNotNull(), 0.8,
         r"iban|bank|account", base=False, cut=_iban_part),
    Kind("ssn", r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
         lambda m: F.lit(True), 0.3, r"\bssn\b|social security", base=False, needs="-"),
)


def _running(lengths: Column) -> Column:
    """Sums of all entries before each entry, and of all; in blocks, as appending is quadratic."""
    def chain(x, first):
        return F.aggregate(x, F.array(first), lambda a, v: F.concat(a, F.array(F.element_at(a, -1) + v)))

    def blocked(x):
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(x) - 1) / PREFIX_BLOCK).cast("int")),
                             lambda b: F.slice(x, b * PREFIX_BLOCK + 1, PREFIX_BLOCK))
        return let(blocks, lambda bs: let(
            chain(F.transform(bs, lambda b: F.aggregate(b, F.lit(0), lambda a, v: a + v)), F.lit(0)),
            lambda firsts: F.concat(F.flatten(F.transform(bs, lambda b, k: F.slice(
                chain(b, F.get(firsts, k)), 1, F.size(b)))), F.array(F.element_at(firsts, -1)))))

    return let(lengths, lambda x: F.when(F.size(x) <= PREFIX_BLOCK, chain(x, F.lit(0))).otherwise(blocked(x)))


def _spans(text: Column, order: int, kind: Kind) -> Column:
    """Valid matches of a kind as structs (start, order, end, kind, score)."""
    none = F.array().cast("array<struct<start:int,order:int,end:int,kind:string,score:double>>")

    def placed(found):
        def inner(gaps):
            lengths = F.zip_with(gaps, found, lambda g, m: F.char_length(g) + F.coalesce(F.char_length(m), F.lit(0)))
            def build(ends):
                def one(m, k):
                    near = F.lower(F.concat(F.right(F.get(gaps, k), F.lit(NEAR)), F.lit(" \n "),
                                            F.left(F.get(gaps, k + 1), F.lit(NEAR))))
                    # ends[k]: where the gap before match k starts
                    start = F.get(ends, k) + F.char_length(F.get(gaps, k))
                    made = lambda part: F.struct(
                        start.cast("int").alias("start"), F.lit(order).alias("order"),
                        (start + F.coalesce(F.char_length(part), F.lit(0))).cast("int").alias("end"), F.lit(kind.name).alias("kind"),
                        F.when(kind.valid(part), F.least(F.lit(1.0), F.lit(kind.score) + F.when(
                            near.rlike(kind.context), 0.2).otherwise(0.0))).otherwise(-1.0).alias("score"))
                    return let(kind.cut(m), made) if kind.cut else made(m)
                return F.filter(F.transform(found, one), lambda s: s["score"] >= (0 if kind.base else THRESHOLD))
            return let(_running(lengths), build)
        return F.when(F.size(found) == 0, none).otherwise(let(F.split(text, kind.pattern, -1), inner))

    out = let(F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)), placed)
    return F.when(F.contains(text, F.lit(kind.needs)), out).otherwise(none) if kind.needs else out


def find(docs: DataFrame) -> DataFrame:
    """doc_id and spans: array of (start, order, end, kind, score) by start, then kind."""
    text = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))
    each = text.select("doc_id", *[_spans(F.col("t"), k, kind).alias(kind.name) for k, kind in enumerate(KINDS)])
    return each.select("doc_id", F.sort_array(F.concat(*[F.col(k.name) for k in KINDS])).alias("spans"))


def summary(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, their digest and all spans as text."""
    base = [k.name for k in KINDS if k.base]
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda name: F.size(F.filter("spans", lambda s: s["kind"] == name)).cast("long")
    return find(docs).select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in base],
        F.sha2(listed(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0)).alias("top_score"))
