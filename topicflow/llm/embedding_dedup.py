"""Embedding near-duplicates: p-stable hashing of normalised vectors, exact cosine within buckets.

``TABLES`` tables of ``PROJECTIONS`` Gaussian projections each, quantised in steps of ``STEP``, put vectors of
one label and dimension into buckets. For unit vectors at the distance of cosine 0.93 (0.374) two share a
bucket of some table with probability 0.97, at 0.97 (0.245) with 0.999. Equal vectors of a label are one
class before hashing, with its number of members. A pair is verified in the first table in which it meets,
so each link counts once without listing pairs: a bucket gives link counts per vector and a chain of links
that connects what is connected. A bucket of more than ``TILE`` vectors is cut into chunks by a hash, and each
pair of chunks is a task's run of its own: no bucket is capped, and none is held whole.

Defined results: vectors that are null, empty, zero, or hold null or non-finite numbers, rows without label or
without id link with nothing (their own component; kept, but null for both without id); repeated rows are
vectors of their own; an empty table gives no rows; vectors of different length are not compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicflow.llm.common import materialize
from topicflow.llm.components import connected_components
from topicflow.llm.runs import Sets, whole_runs

TABLES, PROJECTIONS, STEP, TILE = 16, 10, 2.0, 1024
_PAIRS = 16_384


def signatures(vectors: np.ndarray, tables: int = TABLES, projections: int = PROJECTIONS, step: float = STEP) -> np.ndarray:
    """For each row, one bucket number per table."""
    rng = np.random.default_rng([20, vectors.shape[1]])
    planes = rng.standard_normal((vectors.shape[1], tables * projections))
    shift = rng.uniform(0, step, tables * projections)
    factors = rng.integers(1, 2**63, tables * projections, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    cell = np.floor((vectors @ planes + shift) / step).astype(np.int64).view(np.uint64)
    cell = (cell + np.uint64(0x9E3779B97F4A7C15)) * factors
    return (cell ^ (cell >> np.uint64(29))).reshape(len(vectors), tables, projections).sum(axis=2).view(np.int64)


def _unit(batch: pa.RecordBatch) -> np.ndarray:
    """The vectors of a batch in which all have one length, normalised in double precision."""
    lists = batch.column("vector")
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return _normalised(values.reshape(batch.num_rows, -1))


def _normalised(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors; dividing by the largest component first keeps squares of any finite numbers in range."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _verify(x: np.ndarray, sig: np.ndarray, table: np.ndarray, chunk: np.ndarray, tiled: np.ndarray, bounds: np.ndarray,
            least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows (i, j) of one run that are linked and meet nowhere before."""
    size = np.diff(bounds)
    run = np.repeat(np.arange(len(size)), size)
    before = np.arange(sig.shape[1])
    out_i, out_j = [np.empty(0, np.int64)], [np.empty(0, np.int64)]

    def keep(i: np.ndarray, j: np.ndarray) -> None:
        for a in range(0, len(i), _PAIRS):
            p, q = i[a: a + _PAIRS], j[a: a + _PAIRS]
            near = np.einsum("ij,ij->i", x[p], x[q]) >= least
            p, q = p[near], q[near]
            met = ((sig[p] == sig[q]) & (before < table[p, None])).any(axis=1)
            met |= tiled[p] & (chunk[p] == chunk[q])
            out_i.append(p[~met])
            out_j.append(q[~met])

    small = np.flatnonzero(size[run] <= 32)
    for step in range(1, int(size[run[small]].max()) if len(small) else 1):
        i = small[:-step]
        keep(i[run[i] == run[small[step:]]], small[step:][run[i] == run[small[step:]]])
    for r in np.flatnonzero(size > 32).tolist():
        a, b = int(bounds[r]), int(bounds[r + 1])
        for lo in range(a, b, 256):
            hi = min(lo + 256, b)
            near = x[lo:hi] @ x[lo:b].T >= least - 1e-9
            i, j = np.nonzero(np.triu(near, 1))
            keep(i + lo, j + lo)
    return np.concatenate(out_i), np.concatenate(out_j)


def near_duplicates(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    least: float = 0.93, tile: int = TILE) -> DataFrame:
    """Per row: the id column, n_links, component_id, kept."""
    label, vector = F.col(label_col), F.col(vector_col)
    exact = isinstance(rows.schema[label_col].dataType, T.IntegralType)
    own = rows.select(
        F.col(id_col).cast("long").alias("id"),
        (label.cast("long") if exact else F.when(label.isNotNull(), F.xxhash64(label))).alias("label"),
        vector.cast(T.ArrayType(rows.schema[vector_col].dataType.elementType)).alias("vector"))
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    zero = F.forall("vector", lambda v: v == 0)
    valid = F.coalesce(F.col("id").isNotNull() & F.col("label").isNotNull() & finite & ~zero, F.lit(False))
    own = own.withColumn("valid", valid)
    good = own.where("valid").drop("valid")
    classes = good.groupBy("label", "vector").agg(F.min("id").alias("rep"), F.count("*").alias("members"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("vector").value_lengths().to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                sig = pa.array(list(signatures(_unit(part))), pa.list_(pa.int64()))
                yield part.append_column("dim", pa.array([int(dim)] * part.num_rows, pa.int64())).append_column("sig", sig)

    signed = materialize(classes.mapInArrow(sign, T.StructType(
        [*classes.schema.fields, T.StructField("dim", T.LongType()), T.StructField("sig", T.ArrayType(T.LongType()))])))
    keys = ["label", "dim", "table", "bucket"]
    full = signed.select("label", "dim", F.posexplode("sig").alias("table", "bucket")).groupBy(*keys).count()
    full = full.where(F.col("count") > tile).withColumn("chunks", F.ceil(F.col("count") / tile)).drop("count")
    entries = signed.select("*", F.posexplode("sig").alias("table", "bucket")).join(full, keys, "left")
    entries = entries.withColumn("chunk", F.coalesce(F.pmod(F.xxhash64("rep"), "chunks"), F.lit(0)).cast("long"))
    others = F.sequence(F.lit(0).cast("long"), F.coalesce("chunks", F.lit(1)) - 1)
    entries = entries.withColumn("other", F.explode(others))
    entries = entries.withColumns({"low": F.least("chunk", "other"), "high": F.greatest("chunk", "other")})
    cut = [*keys, "low", "high"]

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, bounds in whole_runs(batches, cut, 1 << 62):
            size = np.diff(bounds)
            part = part.filter(pa.array(np.repeat(size > 1, size)))  # a vector alone in its bucket
            size = size[size > 1]
            if not len(size):
                continue
            bounds = np.concatenate([[0], np.cumsum(size)])
            part = part.combine_chunks()
            batch = part.to_batches(max_chunksize=part.num_rows)[0]
            rep, members = (batch.column(c).to_numpy() for c in ("rep", "members"))
            table, chunk, low, high, dims = (batch.column(c).to_numpy() for c in ("table", "chunk", "low", "high", "dim"))
            width = int(dims.max())
            flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            x = np.zeros((len(rep), width))
            x[np.arange(width) < dims[:, None]] = flat
            x = _normalised(x)
            sig = batch.column("sig").flatten().to_numpy().reshape(len(rep), -1)
            i, j = _verify(x, sig, table, chunk, low != high, bounds, least)
            n = np.bincount(i, members[j], len(rep)) + np.bincount(j, members[i], len(rep))
            sets = Sets(len(rep))
            chain = [(a, b) for a, b in zip(i.tolist(), j.tolist()) if sets.unite(a, b)]
            a, b = (np.array([c[k] for c in chain], np.int64) for k in (0, 1))
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([rep[some], rep[a]])),
                 pa.array(np.concatenate([rep[some], rep[b]])),
                 pa.array(np.concatenate([n[some].astype(np.int64), np.zeros(len(chain), np.int64)]))], ["a", "b", "n"])

    sent = entries.select(*cut, "chunk", "rep", "members", "vector", "sig") \
        .withColumn("table", F.col("table").cast("long"))
    found = materialize(sent.repartition(*cut).sortWithinPartitions(*cut).mapInArrow(link, "a long, b long, n long"))
    counts = found.groupBy("a").agg(F.sum("n").alias("outside")).select(F.col("a").alias("rep"), "outside")
    roots = connected_components(found.where("a != b").select("a", "b"))
    named = signed.select("label", "vector", "rep", "members").join(counts, "rep", "left") \
        .join(roots, F.col("rep") == F.col("node"), "left") \
        .select("label", "vector", (F.coalesce("outside", F.lit(0)) + F.col("members") - 1).alias("n_links"),
                F.coalesce("root", "rep").alias("component_id"))
    linked = good.join(named, ["label", "vector"]).select("id", "n_links", "component_id")
    alone = own.where(~F.col("valid")).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("id").alias(id_col), "n_links", "component_id", (F.col("id") == F.col("component_id")).alias("kept"))
