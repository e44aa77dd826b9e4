"""Committed offsets that may be out of order, as ranges: what has not been seen, and what is safe to commit."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _bitmaps(committed: DataFrame, by: Sequence[str]) -> DataFrame:
    """One bitmap for each 32,768 offsets of a reader's partition, made before the shuffle: order and copies of a
    commit don't matter."""
    return committed.where("offset is not null and offset >= 0").groupBy(
        *by, F.bitmap_bucket_number("offset").alias("_bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("offset")).alias("_bitmap"))


def _inner_gaps(bitmaps: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per bitmap: the first and last committed offset and the gaps between them."""
    gap = T.StructType([T.StructField("from_offset", T.LongType()), T.StructField("to_offset", T.LongType())])
    schema = T.StructType([*[bitmaps.schema[c] for c in by], T.StructField("_first", T.LongType()),
                           T.StructField("_last", T.LongType()), T.StructField("_gaps", T.ArrayType(gap))])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, last, gaps = [], [], []
            for bucket, raw in zip(batch.column("_bucket").to_pylist(), batch.column("_bitmap").to_pylist()):
                # bit 0 of a bucket is the offset of its number: buckets begin at 1, but for the one of offset 0
                at = np.flatnonzero(np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little")) + _begin(bucket)
                hole = np.flatnonzero(np.diff(at) > 1)
                first.append(int(at[0]))
                last.append(int(at[-1]))
                gaps.append([{"from_offset": a, "to_offset": b} for a, b in
                             zip((at[hole] + 1).tolist(), at[hole + 1].tolist())])
            kind = pa.list_(pa.struct([("from_offset", pa.int64()), ("to_offset", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in by], pa.array(first, pa.int64()), pa.array(last, pa.int64()), pa.array(gaps, kind)],
                schema.names)

    return bitmaps.mapInArrow(find, schema)


def _begin(bucket: int) -> int:
    """The offset of a bucket's bit 0, as ``bitmap_bucket_number`` and ``bitmap_bit_position`` deal them."""
    return (bucket - 1) * 32768 + 1 if bucket > 0 else bucket * 32768


def unseen_ranges(committed: DataFrame, bounds: DataFrame, by: Sequence[str] = ("group", "topic", "partition")) -> DataFrame:
    """(by…, from_offset, to_offset, records): each stretch of offsets between a reader's begin and end that it has not
    committed, one row per gap; ``to_offset`` is one past its last offset.

    ``committed`` has a row per committed offset, in any order, repeated or not; ``bounds`` (by…, begin_offset,
    end_offset) what each reader has to read. Commits outside the bounds don't count, readers without any commit have
    one gap. No reader's offsets are sorted: the gaps within 32,768 offsets come from their bitmap, those between bitmaps
    from their first and last offsets.
    """
    by = list(by)
    limits = bounds.select(*[F.col(c).alias(f"_b_{c}") for c in by], "begin_offset", "end_offset")
    same = [F.col(c).eqNullSafe(F.col(f"_b_{c}")) for c in by]
    inside = committed.select(*by, "offset").join(limits, same).where("offset >= begin_offset and offset < end_offset")
    parts = _inner_gaps(_bitmaps(inside, by), by)
    gap = lambda a, b: F.struct(a.cast("bigint").alias("from_offset"), b.cast("bigint").alias("to_offset"))
    w = Window.partitionBy(*by).orderBy("_first")  # a row for each 32,768 offsets
    between = parts.withColumn("_before", F.lag("_last").over(w)).withColumn(
        "_gaps", F.when(F.col("_before") + 1 < F.col("_first"), F.concat(
            F.array(gap(F.col("_before") + 1, F.col("_first"))), "_gaps")).otherwise(F.col("_gaps")))
    ends = parts.groupBy(*by).agg(F.min("_first").alias("_first"), F.max("_last").alias("_last"))
    outer = limits.join(ends, [ends[c].eqNullSafe(F.col(f"_b_{c}")) for c in by], "left").select(
        *[F.col(f"_b_{c}").alias(c) for c in by], F.when(
            F.col("_first").isNull(), F.array(gap(F.col("begin_offset"), F.col("end_offset")))).otherwise(
                F.array(gap(F.col("begin_offset"), F.col("_first")), gap(F.col("_last") + 1, F.col("end_offset")))).alias("_gaps"))
    every = between.select(*by, "_gaps").unionByName(outer).select(*by, F.explode("_gaps").alias("g")).select(*by, "g.*")
    return every.where("from_offset < to_offset").withColumn("records", F.col("to_offset") - F.col("from_offset"))


def safe_positions(gaps: DataFrame, bounds: DataFrame, by: Sequence[str] = ("group", "topic", "partition")) -> DataFrame:
    """(by…, committed): the position up to which a reader has committed everything, so that a restart there loses no
    record: the begin of its first gap, or its end."""
    first = gaps.groupBy(*by).agg(F.min("from_offset").alias("_from"))
    limits = bounds.select(*[F.col(c).alias(f"_b_{c}") for c in by], "end_offset")
    return limits.join(first, [first[c].eqNullSafe(F.col(f"_b_{c}")) for c in by], "left").select(
        *[F.col(f"_b_{c}").alias(c) for c in by], F.coalesce("_from", "end_offset").alias("committed"))
