"""What a streaming query's checkpoint says: watermarks, state, and the rows that came too late."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F


def batch_offsets(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Per micro-batch: ``batch_id``, ``watermark`` (behind which its state is final; null before the first),
    ``late_watermark`` (behind which its input is late: the watermark of the batch before) and ``sources``,
    the offset of each source as JSON text."""
    # Fixed format of an offset file: version, metadata as JSON, one offset a source.
    files = spark.read.text(f"{checkpoint}/offsets", wholetext=True).select(
        F.regexp_extract("_metadata.file_name", "^([0-9]+)$", 1).try_cast("bigint").alias("batch_id"),
        F.split("value", "\n").alias("lines"))
    ms = F.get_json_object(F.get("lines", F.lit(1)), "$.batchWatermarkMs").cast("bigint")
    marks = files.filter("batch_id IS NOT NULL").select(
        "batch_id", F.when(ms > 0, F.timestamp_millis(ms)).alias("watermark"), F.slice("lines", 3, 1000).alias("sources"))
    before = Window.orderBy("batch_id")     # one row a batch
    return marks.withColumn("late_watermark", F.lag("watermark").over(before))


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``operatorId``, ``operatorName`` and stores of a query's stateful operators."""
    return spark.read.format("state-metadata").load(checkpoint)


def join_state_rows(spark: SparkSession, checkpoint: str, batch_id: int, side: str) -> DataFrame:
    """The rows that a stream-stream join holds for one side (``left`` or ``right``) after a batch."""
    joins = [r[0] for r in state_operators(spark, checkpoint).filter("operatorName = 'symmetricHashJoin'").select(
        "operatorId").distinct().collect()]
    if len(joins) != 1:
        raise ValueError(f"{checkpoint} has {len(joins)} stream-stream joins")
    return (spark.read.format("statestore").option("batchId", batch_id).option("operatorId", joins[0])
            .option("joinSide", side).load(checkpoint))


def files_read(spark: SparkSession, checkpoint: str, source: int = 0) -> DataFrame:
    """Files that a file source handed to each micro-batch: ``file_path``, ``batch_id``, ``late_watermark``."""
    # Fixed format of the source's log: version, then a JSON record a file; compacted files repeat earlier ones.
    log = spark.read.text(f"{checkpoint}/sources/{source}").filter(F.col("value").startswith("{")).select(
        F.get_json_object("value", "$.path").alias("file_path"),
        F.get_json_object("value", "$.batchId").cast("bigint").alias("entry")).distinct()
    at = F.get_json_object(F.get("sources", F.lit(source)), "$.logOffset").cast("bigint")
    batches = batch_offsets(spark, checkpoint).withColumn("last", at).filter("last IS NOT NULL")
    batches = batches.withColumn("first", F.coalesce(F.lag("last").over(Window.orderBy("batch_id")), F.lit(-1)) + 1)
    entries = batches.filter("first <= last").select(
        "batch_id", "late_watermark", F.explode(F.sequence("first", "last")).alias("entry"))
    return log.join(entries, "entry").select("file_path", "batch_id", "late_watermark")


def late_rows(spark: SparkSession, checkpoint: str, files: DataFrame, event_time: Column, source: int = 0) -> DataFrame:
    """Quarantine of a file source: the rows that its query has dropped as late.

    ``files`` are rows of the source's files read as a batch, decoded and filtered as the query does before its
    watermark, with ``file_path`` (of ``_metadata``). Adds ``batch_id`` and the ``late_watermark`` that the
    row was not after.
    """
    one_form = lambda df: df.withColumn("file_path", F.regexp_replace("file_path", "^([a-z0-9]+):/+", "$1:/"))
    read = one_form(files_read(spark, checkpoint, source))
    return one_form(files).join(read, "file_path").filter(event_time <= F.col("late_watermark")).drop("file_path")
