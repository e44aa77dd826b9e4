"""Dense per-group numbering that does not put a whole group into one task.

``row_number() OVER (PARTITION BY g ORDER BY k)`` sorts each group in a single task, so one hot topic
partition (or one busy consumer group) would serialise the job. Here rows are range-partitioned on the
group and its whole sort key, which Spark samples: a hot group, a sparse key and a key that half of the
rows share are spread over many tasks. Each row's task and place are fixed by a reliable checkpoint, and a
small table (a row per task and group in it) gives each task's first number per group.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicflow.session import checkpoint_base

MOST_BROADCAST = 1_000_000  # rows of a few numbers and a group's name
STAGED = {"compression": "zstd", "parquet.block.size": 8 << 20}  # row groups that many tasks can share
PID, POS, TIE = "_tf_pid", "_tf_pos", "_tf_tie"
BASE, FIRST, COUNT = "_tf_base", "_tf_first", "_tf_n"


def place_rows(df: DataFrame, by: Sequence[str], order: Sequence[str] | None,
               then: Callable[[DataFrame], DataFrame] | None = None, stage: str | None = None) -> DataFrame:
    """``df`` sorted by (``by``, ``order``) over range partitions, checkpointed, with each row's task and place.

    Rows that agree in all of these are spread, too: their place in the input decides among them. Adaptive
    execution merges small partitions; nulls sort first. ``then``, a projection that keeps ``by``, is made of the sorted
    rows: what it adds is made once and what it drops is not stored. Without ``order``, rows keep the order of the input:
    tasks have it as they are, and nothing is sampled or shuffled. ``stage`` is a folder that takes the rows as compressed
    Parquet in place of a checkpoint, which holds them as they are in memory; the caller removes it.
    """
    checkpoint_base(df.sparkSession)
    keys = [*by, *(order or ()), TIE]
    tied = df.withColumn(TIE, F.monotonically_increasing_id())
    ranged = (tied if order is None else tied.repartitionByRange(*keys)).sortWithinPartitions(*keys).drop(TIE)
    placed = ((ranged if then is None else then(ranged))
              .withColumn(PID, F.spark_partition_id()).withColumn(POS, F.monotonically_increasing_id()))
    if stage is None:
        return placed.checkpoint(eager=True)
    placed.write.options(**STAGED).parquet(stage)
    return df.sparkSession.read.schema(placed.schema).parquet(stage)


def task_starts(placed: DataFrame, by: Sequence[str], *more: Column) -> DataFrame:
    """Per task and group: the first row's place, the number of rows, the group's rows in earlier tasks, and ``more``
    aggregates of the same pass.

    Tasks hold ranges of the groups' order, so this has at most one row per task and one per group.
    """
    per_task = placed.groupBy(PID, *by).agg(F.count(F.lit(1)).alias(COUNT), F.min(POS).alias(FIRST), *more)
    before = Window.partitionBy(*by).orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    return per_task.withColumn(BASE, F.coalesce(F.sum(COUNT).over(before), F.lit(0)))


def number_rows(placed: DataFrame, starts: DataFrame, by: Sequence[str], out: str,
                offset: Column | None = None, size: int | None = None) -> DataFrame:
    """Number placed rows from 1 (or from ``offset``, a column of ``starts``) within their group.

    ``starts`` has one row per task and per group, whatever the number of rows; it is broadcast when counted to be at most
    ``MOST_BROADCAST``. Pass its ``size`` if known, else pass it checkpointed.
    """
    small = starts.select(*[F.col(c).alias(f"_s{c}") for c in [PID, *by]], FIRST,
                          (F.col(BASE) + (F.lit(1) if offset is None else offset)).alias(BASE))
    if (starts.count() if size is None else size) <= MOST_BROADCAST:
        small = F.broadcast(small)
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_s{c}")) for c in [PID, *by]])
    joined = placed.join(small, same)
    number = (F.col(BASE) + F.col(POS) - F.col(FIRST)).cast("bigint")
    return joined.select(*[c for c in placed.columns if c not in (PID, POS)], number.alias(out))


def range_row_number(df: DataFrame, by: Sequence[str], order: Sequence[str], *,
                     out: str = "row_number") -> DataFrame:
    """Add ``out`` = 1-based row number within ``by`` in ``order`` order, for any sort key.

    Pass only the columns needed: the checkpoint writes what ``df`` holds.
    """
    placed = place_rows(df, by, order)
    return number_rows(placed, task_starts(placed, by).checkpoint(eager=True), by, out)
