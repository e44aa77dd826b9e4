"""Vector code compression: product codebooks over integers, distances from per-dimension value dictionaries.

Each component becomes the integer ``floor(scale * x)``. Vectors are kept in chunks of one Arrow batch or less, dictionary
coded by dimension: the distinct integers of the chunk and a code for each vector. The squared differences of every
distinct integer to all codebook entries are tabulated once per chunk and dimension; the distances of a part are then
gathers from those tables by code, added up over the part's dimensions. The chunks are checkpointed once and read
by every round; a round sends the codebooks out and brings back one sum per codebook cell, added up by Spark, so what
reaches the driver (``entries * (dimensions + parts)`` numbers) doesn't depend on the number of vectors.

Defined results: rows whose vector is null or holds null or non-finite components are dropped; an empty vector is kept.
The dimension is that of the longest vector, rounded up to a multiple of ``parts``; shorter vectors end in zeros.
Integers beyond 2**26 in size are held at that bound (so that distances over 1,024 dimensions are exact in 64 bits).
Repeated ids and rows each have a row; of equal ids the smaller vector comes first in the initial codebook, rows
without id come last. With fewer vectors than entries, the codebook has as many entries as vectors. Equal entries: the
lower index is used. A label's error that exceeds 64 bits is null. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicflow.llm.common import materialize

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
BOUND = 1 << 26
CHUNK_CELLS = 1 << 20
_BLOCK = 2048


@dataclass
class Chunk:
    """Vectors by dimension: ``values[d][codes[d]]`` are the integers of dimension d."""

    values: list[np.ndarray]
    codes: np.ndarray  # dimensions x vectors

    @classmethod
    def of(cls, vectors: np.ndarray) -> Chunk:
        found = [np.unique(column, return_inverse=True) for column in vectors.T]
        codes = np.array([c for _, c in found], np.int32).reshape(vectors.shape[1], len(vectors))
        return cls([v for v, _ in found], codes)

    def widened(self, width: int) -> Chunk:
        """With dimensions of zeros behind."""
        more = width - len(self.values)
        zeros = np.zeros((more, self.codes.shape[1]), np.int32)
        return Chunk([*self.values, *[np.zeros(1, np.int64)] * more], np.concatenate([self.codes, zeros]))

    def nearest(self, book: np.ndarray, first: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        """The entry of ``book`` (entries x dimensions) nearest to each vector in the dimensions first to end - 1,
        the lowest of equally near ones, and its squared distance."""
        n, entries = self.codes.shape[1], len(book)
        index, least = np.zeros(n, np.int64), np.zeros(n, np.int64)
        if first == end or not n:
            return index, least
        widest = max(int(np.abs(v).max()) for v in self.values[first:end]) + int(np.abs(book[:, first:end]).max())
        kind = np.int32 if widest * widest * (end - first) < 1 << 31 else np.int64
        total = np.zeros((n, entries), kind)
        room = np.empty((min(n, _BLOCK), entries), kind)
        for d in range(first, end):
            table = np.square(self.values[d][:, None] - book[None, :, d]).astype(kind)
            for a in range(0, n, _BLOCK):
                code = self.codes[d, a: a + _BLOCK]
                total[a: a + _BLOCK] += np.take(table, code, axis=0, out=room[: len(code)], mode="clip")
        index = total.argmin(axis=1)
        return index, total[np.arange(n), index].astype(np.int64)


def integers(vectors: np.ndarray, scale: float = SCALE) -> np.ndarray:
    return np.floor(np.clip(vectors * scale, -BOUND, BOUND)).astype(np.int64)


def _part_bounds(width: int, parts: int) -> list[tuple[int, int]]:
    return [(p * width // parts, (p + 1) * width // parts) for p in range(parts)]


def _kept(rows: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return rows.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"), vector.alias("vector")) \
        .where(F.coalesce(finite, F.lit(False)))


def _chunks(kept: DataFrame, scale: float) -> DataFrame:
    """Rows of chunks: id and label of each vector, width, the dictionaries and the codes (dimension by dimension)."""
    schema = T.StructType([
        T.StructField("id", T.ArrayType(kept.schema["id"].dataType)),
        T.StructField("label", T.ArrayType(kept.schema["label"].dataType)), T.StructField("width", T.IntegerType()),
        T.StructField("values", T.ArrayType(T.ArrayType(T.LongType()))), T.StructField("codes", T.BinaryType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("vector").value_lengths().to_numpy(zero_copy_only=False)
            step = max(1, CHUNK_CELLS // max(1, int(sizes.max(initial=0))))
            for a in range(0, batch.num_rows, step):
                part, size = batch.slice(a, step), sizes[a: a + step]
                width = int(size.max())
                vectors = np.zeros((len(size), width))
                vectors[np.arange(width) < size[:, None]] = part.column("vector").flatten().to_numpy(zero_copy_only=False)
                chunk = Chunk.of(integers(vectors, scale))
                ends = pa.array([0, len(size)], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(ends, part.column("id")), pa.ListArray.from_arrays(ends, part.column("label")),
                     pa.array([width], pa.int32()), pa.array([chunk.values], pa.list_(pa.list_(pa.int64()))),
                     pa.array([chunk.codes.astype("<i4").tobytes()], pa.binary())], schema.names)

    return materialize(kept.mapInArrow(cut, schema))


def _read(batch: pa.RecordBatch, i: int, width: int) -> Chunk:
    values = [np.array(v, np.int64) for v in batch.column("values")[i].as_py()]
    codes = np.frombuffer(batch.column("codes")[i].as_py(), "<i4").reshape(len(values), -1) if values else \
        np.zeros((0, len(batch.column("id")[i])), np.int32)
    return Chunk(values, codes).widened(width)


def _improved(chunks: DataFrame, book: np.ndarray, parts: int) -> np.ndarray:
    """The codebooks after one round: each entry the floor of the mean of its parts, unused entries as they were."""
    entries, width = book.shape
    bounds = _part_bounds(width, parts)
    sent = chunks.sparkSession.sparkContext.broadcast(book)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, counts = np.zeros((width, entries), np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                chunk = _read(batch, i, width)
                for p, (first, end) in enumerate(bounds):
                    index, _ = chunk.nearest(sent.value, first, end)
                    counts[p] += np.bincount(index, minlength=entries)
                    for d in range(first, end):  # exact: below 2**53
                        own = np.bincount(index, chunk.values[d][chunk.codes[d]].astype(float), entries)
                        totals[d] += own.astype(np.int64)
        cells = np.concatenate([totals, counts]).reshape(-1)
        some = np.flatnonzero(cells)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(cells[some])], ["cell", "total"])

    summed = chunks.select("id", "width", "values", "codes").mapInArrow(add, "cell long, total long") \
        .groupBy("cell").agg(F.sum("total").alias("total")).collect()  # a row for each cell of the codebooks
    sent.unpersist()
    cells = np.zeros((width + parts) * entries, np.int64)
    cells[[r.cell for r in summed]] = [r.total for r in summed]
    totals, counts = cells[: width * entries].reshape(width, entries), cells[width * entries:].reshape(parts, entries)
    new = book.copy()
    for p, (first, end) in enumerate(bounds):
        used = counts[p] > 0
        new[used, first:end] = (totals[first:end, used] // counts[p][used]).T
    return new


def compress(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
             scale: float = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
             ) -> tuple[DataFrame, np.ndarray]:
    """A row of ``id_col``, ``label_col``, code (bytes, one for each part) and error for each kept vector, and the
    codebooks (entries x dimensions; part p has the p-th of ``parts`` equal stretches of dimensions)."""
    if not 1 <= entries <= 256:
        raise ValueError("an entry's index must fit in a byte")
    kept = _kept(rows, id_col, vector_col, label_col)
    chunks = _chunks(kept, scale)
    widest = chunks.agg(F.max("width").alias("width")).first().width or 0
    width = -(-widest // parts) * parts
    first = kept.orderBy(F.asc_nulls_last("id"), "vector").limit(entries).collect()
    book = np.zeros((len(first), width), np.int64)
    for i, r in enumerate(first):
        book[i, : len(r.vector)] = integers(np.array(r.vector, float), scale)
    for _ in range(rounds if len(first) else 0):
        book = _improved(chunks, book, parts)
    bounds = _part_bounds(width, parts)
    sent = rows.sparkSession.sparkContext.broadcast(book)
    schema = T.StructType([
        T.StructField("id", kept.schema["id"].dataType), T.StructField("label", kept.schema["label"].dataType),
        T.StructField("code", T.BinaryType()), T.StructField("error", T.LongType())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                chunk = _read(batch, i, width)
                found = [chunk.nearest(sent.value, a, b) for a, b in bounds]
                codes = np.column_stack([index for index, _ in found]).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id")[i].values, batch.column("label")[i].values,
                     pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(sum(least for _, least in found))],
                    schema.names)

    return chunks.mapInArrow(encode, schema).select(
        F.col("id").alias(id_col), F.col("label").alias(label_col), "code", "error"), book


def with_label_error(coded: DataFrame, label_col: str = "label") -> DataFrame:
    """``coded`` with ``label_error``, the errors summed over equal labels (nulls together)."""
    coded = materialize(coded)
    totals = coded.groupBy(F.col(label_col).alias("same_label")).agg(F.try_sum("error").alias("label_error"))
    return coded.join(totals, F.col(label_col).eqNullSafe(F.col("same_label"))).drop("same_label")


def listed(book: np.ndarray, parts: int = PARTS) -> str:
    """All components in decimal by part, entry and position, comma-joined."""
    return ",".join(str(x) for a, b in _part_bounds(book.shape[1], parts) for x in book[:, a:b].reshape(-1).tolist())
