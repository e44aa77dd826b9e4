"""Reader progress: totals, rates, progress points, order checks, first-n and sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicflow.functions.rates import rate, seconds_between
from topicflow.operators.ranking import range_row_number

# Reading order of one reader across its partitions: by record time, then log position.
READ_ORDER = ("timestamp", "topic", "partition", "offset")
# Fixed values of the demo readers.
PROGRESS_EVERY = 5000
FIRST_N = 5
SAMPLE_EVERY_OFFSETS = 3000


def consumed_total(summary: DataFrame, by: Sequence[str] = ("group",)) -> DataFrame:
    """Records per reader, from the consumed rows of :func:`topicflow.operators.groups.fan_out_summary`."""
    return summary.groupBy(*by).agg(F.sum("records").alias("records"))


def throughput(summary: DataFrame, by: Sequence[str] = ("group",)) -> DataFrame:
    """Records, first/last record time, seconds between and cumulative rate per reader, from the consumed rows of
    :func:`topicflow.operators.groups.fan_out_summary`. A zero-length span reports the count itself."""
    agg = summary.groupBy(*by).agg(F.sum("records").alias("records"),
                                   F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"))
    secs = seconds_between("first_ts", "last_ts")
    return agg.select(*by, "records", "first_ts", "last_ts", secs.alias("seconds"),
                      rate(F.col("records"), secs).alias("rate"))


def read_sequence(consumed: DataFrame, by: Sequence[str] = ("group",),
                  ts: str = "timestamp", out: str = "n") -> DataFrame:
    """Number each reader's records 1, 2, … in reading order (time, then log position),
    without sorting a reader's records — or a burst of equal timestamps — in one task.
    Keeps the reader and position columns only."""
    narrow = consumed.select(*by, ts, "topic", "partition", "offset")
    return range_row_number(narrow, by, [ts, "topic", "partition", "offset"], out=out)


def progress_points(consumed: DataFrame, every: int = PROGRESS_EVERY,
                    by: Sequence[str] = ("group",), ts: str = "timestamp") -> DataFrame:
    """Every ``every``-th record of a reader, with its position and the rate so far
    (records ÷ seconds since the reader's first record)."""
    numbered = read_sequence(consumed, by, ts)
    firsts = numbered.groupBy(*by).agg(F.min(ts).alias("_first"))  # of the checkpointed rows: no second scan
    pts = numbered.where(F.col("n") % every == 0).join(firsts, list(by))
    secs = seconds_between("_first", ts)
    return pts.select(*by, "n", "topic", "partition", "offset",
                      rate(F.col("n"), secs).alias("rate"))


def first_n(consumed: DataFrame, n: int = FIRST_N, by: Sequence[str] = ("group",)) -> DataFrame:
    """The first ``n`` records of each reader in reading order (planned as a group limit, so
    each task keeps at most ``n`` rows per reader before the shuffle)."""
    w = Window.partitionBy(*by).orderBy(*READ_ORDER)
    return (consumed.withColumn("n", F.row_number().over(w).cast("bigint"))
            .where(F.col("n") <= n))


def limit_n(records: DataFrame, n: int) -> DataFrame:
    """Exactly ``n`` records (or all when fewer), the first in reading order."""
    return records.orderBy(*READ_ORDER).limit(n)


def every_nth_offset(records: DataFrame, n: int = SAMPLE_EVERY_OFFSETS) -> DataFrame:
    """Sampling by position: records whose offset is a multiple of ``n``."""
    return records.where(F.col("offset") % n == 0)


def order_check(records: DataFrame) -> DataFrame:
    """Per topic partition: are offsets dense and unique from begin to end?

    Checked by aggregation, so a partition is never sorted in one task: dense ⇔ distinct = count =
    end − begin. Distinct offsets are bits of one bitmap for each 32,768 of them, made before the shuffle.
    """
    parts = records.groupBy("topic", "partition", F.bitmap_bucket_number("offset").alias("_bucket")).agg(
        F.count(F.lit(1)).alias("_n"),
        F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position("offset"))).alias("_distinct"),
        F.min("offset").alias("_first"), F.max("offset").alias("_last"))
    agg = parts.groupBy("topic", "partition").agg(
        F.sum("_n").alias("records"), F.sum("_distinct").alias("distinct_offsets"),
        F.min("_first").alias("begin_offset"), (F.max("_last") + 1).alias("end_offset"))
    return agg.withColumn(
        "dense", (F.col("records") == F.col("distinct_offsets"))
        & (F.col("records") == F.col("end_offset") - F.col("begin_offset")))


def rate_window(records: DataFrame, size: str = "1 hour", by: Sequence[str] = ("topic",),
                ts: str = "timestamp") -> DataFrame:
    """Records per tumbling event-time window (the batch twin of the streaming rate)."""
    return (records.groupBy(*by, F.window(F.col(ts), size).alias("w"))
            .agg(F.count(F.lit(1)).alias("records"))
            .select(*by, F.col("w.start").alias("window_start"),
                    F.col("w.end").alias("window_end"), "records"))
