"""Text and JSON-lines files: order files in, topic copies out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from topicflow.functions.records import strip
from topicflow.schema import ORDER_FILE
from topicflow.session import checkpoint_base


def read_jsonl(spark: SparkSession, path: str, streaming: bool = False,
               options: dict | None = None) -> DataFrame:
    """Lines of JSON-lines files as records: trimmed, blank lines dropped, no key, value as
    text (not parsed), plus the source file. A stream picks up new files dropped into the
    directory (lines appended to a file already read are not seen)."""
    reader = (spark.readStream if streaming else spark.read).options(**(options or {}))
    lines = reader.text(path).select(strip("value").alias("line"),
                                     F.col("_metadata.file_path").alias("file"))
    return lines.where(F.col("line") != "").select(
        F.lit(None).cast("binary").alias("key"), F.col("line").cast("binary").alias("value"),
        "file")


def read_numbered_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """:func:`read_jsonl` in batch with ``line_no``, the 1-based line of each record in its file.

    Lines are counted per file split, a prefix sum per file gives each split's first number, and a line adds its
    place in the split; no file is read in one task. The lines are checkpointed so that places can't change.
    """
    checkpoint_base(spark)
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_pos")).checkpoint(eager=True)
    splits = lines.groupBy("file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first"))
    before = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    numbered = lines.join(splits, ["file", "_block"]).withColumn(
        "line_no", F.col("_before") + F.col("_pos") - F.col("_first") + 1).withColumn("line", strip("value"))
    return numbered.where(F.col("line") != "").select(
        F.lit(None).cast("binary").alias("key"), F.col("line").cast("binary").alias("value"), "file", "line_no")


def read_order_file(spark: SparkSession, path: str) -> DataFrame:
    """The order-file shape with its declared schema (never inferred)."""
    return spark.read.schema(ORDER_FILE).json(path)
