"""Best-fit-decreasing packing of pieces into sequences of fixed capacity, for any number of pieces.

Pieces of one length are interchangeable, and so are sequences with one remaining capacity. Best fit
decreasing over all pieces is therefore decided on the counts of the lengths, at most ``capacity`` of
them: a segment tree over remaining capacities yields the tightest open sequence for a length in
logarithmic time, and a whole run of pieces goes there at once. The outcome equals that of taking the
pieces one by one. The plan has a row for each run (never more than two for each pair of a length and a
remaining capacity, in practice a few thousand), and pieces find their place in it by their rank among
the pieces of their length. Ranks come from counts per length and partition, so that a length held by a
third of all pieces is split over the partitions.

Defined results: an empty table gives no rows; a null text is an empty one, which still has its end id;
repeated rows are packed each; pieces without length, or of length 0, raise; longer than the capacity, too.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicflow.llm.common import free_name, materialize
from topicflow.llm.tokens import encoder, tokenizer_json

CAPACITY = 2048


class OpenSequences:
    """Segment tree over remaining capacities: whether any sequence is open at each."""

    def __init__(self, capacity: int):
        self.width = 1 << capacity.bit_length()
        self.tree = np.zeros(2 * self.width, bool)
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # (first sequence, count)

    def add(self, left: int, first: int, count: int) -> None:
        runs = self.runs[left]
        if runs and sum(runs[-1]) == first:
            runs[-1] = (runs[-1][0], runs[-1][1] + count)
        else:
            runs.append((first, count))
        self._set(left, True)

    def take(self, left: int) -> tuple[int, int]:
        run = self.runs[left].pop()
        if not self.runs[left]:
            self._set(left, False)
        return run

    def _set(self, left: int, value: bool) -> None:
        node = left + self.width
        self.tree[node] = value
        while node > 1:
            node //= 2
            self.tree[node] = self.tree[2 * node] or self.tree[2 * node + 1]

    def tightest(self, length: int) -> int | None:
        """The smallest remaining capacity of at least ``length`` at which a sequence is open."""
        node = length + self.width
        if self.tree[node]:
            return length
        while node > 1:
            if node % 2 == 0 and self.tree[node + 1]:
                node += 1
                while node < self.width:
                    node = 2 * node if self.tree[2 * node] else 2 * node + 1
                return node - self.width
            node //= 2
        return None


def plan(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Rows (length, first rank, first sequence, pieces of the run in each sequence, offset there)."""
    if any(not 0 < length <= capacity for length in counts):
        raise ValueError(f"lengths must lie in 1 to {capacity}: {sorted(counts)[:3]} to {max(counts)}")
    open_, rows, sequences = OpenSequences(capacity), [], 0
    for length in sorted(counts, reverse=True):
        rank, rest = 0, counts[length]
        while rest:
            left = open_.tightest(length)
            if left is None:
                left, first, count = capacity, sequences, -(-rest // (capacity // length))
                sequences += count
            else:
                first, count = open_.take(left)
            each = left // length
            full = min(count, rest // each)
            rows.append((length, rank, first, each, capacity - left))
            if full:
                open_.add(left - each * length, first, full)
                rank, rest = rank + full * each, rest - full * each
            if full < count and rest:  # the last sequence gets what is left
                open_.add(left - rest * length, first + full, 1)
                rank, rest, full = rank + rest, 0, full + 1
            if full < count:
                open_.add(left, first + full, count - full)
    return np.array(rows, np.int64).reshape(len(rows), 5)


def pack(pieces: DataFrame, length_col: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: best fit decreasing by ``length_col``."""
    if {"sequence_id", "offset"} & {c.lower() for c in pieces.columns}:
        raise ValueError("the pieces have a column named sequence_id or offset already")
    part, row, rank = (free_name(pieces.columns, c) for c in ("part", "row", "rank"))
    length = F.coalesce(F.col(length_col).cast("long"), F.lit(0))
    fixed = materialize(pieces)
    fixed = fixed.withColumns({part: F.spark_partition_id(), row: F.monotonically_increasing_id()})
    counts = materialize(fixed.groupBy(length.alias("length"), F.col(part).alias("part")).count())
    totals = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("count")).collect()}  # capacity rows at most
    rows = plan(totals, capacity)
    base = counts.withColumn("before", F.coalesce(F.sum("count").over(
        W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    base = base.select(F.col("length").alias("_length"), F.col("part").alias("_part"), "before")
    within = F.row_number().over(W.partitionBy(length_col, part).orderBy(row)) - 1
    ranked = fixed.withColumn(rank, within).join(
        base, (F.col(length_col).cast("long") == F.col("_length")) & (F.col(part) == F.col("_part")))
    ranked = ranked.withColumn(rank, (F.col(rank) + F.col("before")).cast("long"))
    ranked = ranked.select(*pieces.columns, rank)
    sent = pieces.sparkSession.sparkContext.broadcast(rows)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = sent.value
        span = int(runs[:, 1].max(initial=0)) + 1 if len(runs) else 1
        turn = np.lexsort((runs[:, 1], runs[:, 0]))
        runs = runs[turn]
        for batch in batches:
            n = batch.column(length_col).cast(pa.int64()).to_numpy(zero_copy_only=False)
            at = batch.column(rank).to_numpy(zero_copy_only=False)
            run = np.searchsorted(runs[:, 0] * span + runs[:, 1], n * span + np.minimum(at, span - 1), "right") - 1
            _, first, sequence, each, begin = runs[run].T
            batch = batch.drop_columns([rank])
            batch = batch.append_column("sequence_id", pa.array(sequence + (at - first) // each, pa.int64()))
            yield batch.append_column("offset", pa.array(begin + (at - first) % each * n, pa.int64()))

    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])
    return ranked.mapInArrow(place, schema)


PIECE = [T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
         T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())]


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
                 capacity: int = CAPACITY, with_ids: bool = False, special_tokens: bool = False) -> DataFrame:
    """Documents' ids, each with the end id, cut into pieces of at most ``capacity``: the id column, piece,
    start, length, ids_crc32 and, if asked for, ids (unsigned 32 bits, little-endian). With ``special_tokens``,
    strings of special tokens are their one id."""
    json = docs.sparkSession.sparkContext.broadcast(tokenizer_json(tokenizer))
    fields = [docs.schema[id_col], *PIECE] + [T.StructField("ids", T.BinaryType())] * with_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(json.value, end_id, special_tokens)
        for batch in batches:
            keys = batch.column(id_col)
            for first, ids, offsets in own.documents(batch.column(text_col)):
                n = np.diff(offsets)
                parts = -(-n // capacity)
                doc = np.repeat(np.arange(len(n)), parts)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
                start = piece * capacity
                length = np.minimum(n[doc] - start, capacity)
                raw, at = ids.astype("<u4", copy=False), offsets[doc] + start
                data = [raw[a:b].tobytes() for a, b in zip(at.tolist(), (at + length).tolist())]
                columns = [keys.take(pa.array(doc + first)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                           pa.array(length, pa.int64()), pa.array([zlib.crc32(x) for x in data], pa.int64())]
                names = [id_col, "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns, names = [*columns, pa.array(data, pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(id_col, text_col).mapInArrow(cut, T.StructType(fields))


def packed_sequences(pieces: DataFrame) -> DataFrame:
    """The sequences themselves from packed pieces with ids: sequence_id, length, ids (binary), documents'
    bounds (offsets). A sequence is bounded by the capacity."""
    rows = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    joined = pieces.groupBy("sequence_id").agg(rows.alias("rows"))
    return joined.select(
        "sequence_id", F.aggregate("rows", F.lit(0).cast("long"), lambda n, r: n + r.length).alias("length"),
        F.aggregate("rows", F.lit(b""), lambda x, r: F.concat(x, r.ids)).alias("ids"),
        F.col("rows.offset").alias("offsets"))
