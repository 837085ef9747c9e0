"""CSV files and CSV text lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True,
             multi_line: bool = False, options: dict[str, str] | None = None) -> DataFrame:
    """Declared-schema CSV read. Single-line files split freely across tasks;
    ``multiLine`` files (quoted cells spanning lines) are read whole per file."""
    r = spark.read.schema(schema).option("header", header).option("multiLine", multi_line)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.csv(path)


def drop_comment_and_blank(lines: DataFrame, col: str = "value", comment: str = "#") -> DataFrame:
    """Keep lines that are neither blank nor start with the comment character."""
    c = F.col(col)
    return lines.filter(~c.rlike(r"^\s*$") & ~c.startswith(comment))


def drop_malformed(decoded: DataFrame, corrupt_col: str = "_corrupt_record") -> DataFrame:
    """DROPMALFORMED for column decoders: rows whose record was malformed go."""
    return decoded.filter(F.col(corrupt_col).isNull()).drop(corrupt_col)
