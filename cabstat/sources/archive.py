"""Trip archive scan: ``trip_data_N`` / ``trip_fare_N`` members of a directory."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window, functions as F


def _file_system(spark: SparkSession, directory: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(directory)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def archive_members(spark: SparkSession, directory: str, kind: str) -> list[tuple[int, str]]:
    """``(seq, name)`` of members whose base name contains ``kind``, by the
    integer after the last ``_`` (2 before 10). A member is a file, or a folder
    of part files. A non-numeric suffix or no match at all is an error."""
    fs, path = _file_system(spark, directory)
    members = []
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        base = name.rsplit(".", 1)[0] if "." in name else name
        if kind not in base or name.startswith((".", "_")):
            continue
        suffix = base[base.rfind("_") + 1:]
        if not re.fullmatch(r"[+-]?\d+", suffix):
            raise ValueError(f"{kind} member must be named {kind}_<n>: {name}")
        members.append((int(suffix), name))
    if not members:
        raise ValueError(f"no {kind} members in {directory}")
    return sorted(members)


def scan_archive(spark: SparkSession, directory: str, kind: str = "trip_data",
                 ordered: bool = False) -> DataFrame:
    """Lines of every member with ``file_seq``, header lines dropped.

    A member's header is the first line of its first part. The first line of a file is
    dropped where it is that header (each part of a folder may repeat it); all other lines are kept
    whole, blank ones and later copies of the header too, for the line parsers to accept or reject.
    Members are read as plain text, so large files are split over tasks. One aggregate over
    all members finds the first lines: a row a file.
    """
    directory = directory.rstrip("/")
    members = archive_members(spark, directory, kind)
    path = F.col("_metadata.file_path")
    member = F.regexp_extract(path, rf"/([^/]*{re.escape(kind)}[^/]*)(?:/[^/]*)?$", 1)
    seq = F.regexp_extract(F.regexp_replace(member, r"\.[^.]*$", ""), r"_([^_]*)$", 1).try_cast("int")
    lines = spark.read.text([f"{directory}/{name}" for _, name in members])
    # a task reads pieces of files, each from its start to its end; both uses of this scan cut the same pieces
    placed = lines.select("value", path.alias("path_"), F.col("_metadata.file_block_start").alias("at_"),
                          F.monotonically_increasing_id().alias("row_"), member.alias("file_name"), seq.alias("file_seq"))
    firsts = placed.groupBy("file_name", "path_").agg(F.min(F.struct("at_", "row_", "value")).alias("first_"))
    header = F.min_by("first_.value", "path_").over(Window.partitionBy("file_name"))
    headers = firsts.withColumn("header_", header).filter("first_.value = header_").select("path_", "first_.row_")
    out = placed.join(headers, ["path_", "row_"], "left_anti").select("value", "file_name", "file_seq")
    return out.orderBy("file_seq") if ordered else out
