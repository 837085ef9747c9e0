"""Rows that every operator must take: nulls, empty and long texts, ties, copies."""

from pyspark.sql import types as T

#: Columns whose names operators use inside.
CLASHING = ["n_chars", "row", "words", "version", "anchor", "component", "kept", "position", "boxed", "t", "_id",
            "found", "n", "digest", "block"]
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       *[T.StructField(c, T.LongType()) for c in CLASHING]])

PROSE = " ".join(f"word{k % 97}x{k * k % 89}" for k in range(160))
OTHER = " ".join(f"other{k % 83} item{k * 7 % 61}" for k in range(90))


def rows():
    """Nulls, empty and long texts, ties, repeated rows, near and exact copies, a hot source."""
    texts = [
        (1, None, "src0"), (2, "", "src0"), (3, PROSE, "src0"), (4, PROSE, "src1"), (5, PROSE.upper(), None),
        (6, PROSE + " and a tail", "src0"), (7, OTHER + "\n" + PROSE, "src0"), (8, " \t\n\x0b ", "src1"),
        (9, "one two three", "src0"), (10, "One  two\tthree", "src0"), (11, "a b c d e", "src0"),
        (11, "a b c d e", "src0"), (None, PROSE, "src0"), (None, None, None), (12, "x " * 20_000, "src1"),
        (13, "line one of five words\nsecond line has words too\nthird\n" + OTHER, "src0"),
        (14, "new start here\nline one of five words\nsecond line has words too\nthird\nend", "src2"),
        (15, "é ü 日本語 😀 " * 30, "src2"), (16, "mail a.b@c.de_f@g.hi 1.2.3.4 999.1.1.1 4539 1488 0343 6467", "src2"),
        (17, "!!! ### " * 40, "src0"), (18, OTHER, "src0"), (19, " ".join(OTHER.split()[:-3]), "src0"),
    ]
    return [(i, t, "en", s, *([len(t or "")] + [7] * (len(CLASHING) - 1))) for i, t, s in texts]
