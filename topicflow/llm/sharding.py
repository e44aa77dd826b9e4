"""Sharding by extendible hashing, in DataFrame functions only.

A row's key hashes to 60 bits. The directory starts with one bucket; a bucket that exceeds the byte limit
splits on its next bit, and only such buckets do, until every shard fits. The directory is computed from
byte counts per hash prefix (a few bits more than the total needs), aggregated before they are shuffled; rows
whose prefix is still too heavy go on for eight more bits, and those alone. Rows with one key that together
exceed the limit have no further key bits: they split on the bits of a hash of the row itself, so that a key that
holds a third of all rows makes many shards. A single row above the limit is a shard of its own.

Defined results: a null size counts as 0 bytes, a null key is a key; repeated rows are placed each; an empty table
gives no rows. A shard is named by its bits; the name of the only shard of a small table is empty. ``write_shards``
writes rows by their shard, the limit counting the bytes of all columns.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicflow.llm.common import free_name, materialize

BITS = 60
LIMIT = 16 << 20


def _hash(key: Column) -> Column:
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("null"))), 1, BITS // 4), 16, 10).cast("long")


def _bits(value: Column, n: Column) -> Column:
    return F.when(n == 0, F.lit("")).otherwise(F.lpad(F.conv(value.cast("string"), 10, 2), n, F.lit("0")))


def assign_shards(rows: DataFrame, key_col: str, size: Column, limit: int = LIMIT) -> DataFrame:
    """Columns of ``rows``, then ``shard`` (bits), ``n_bytes``, ``shard_bytes``. Pass narrow rows: they are
    checkpointed."""
    taken = rows.columns
    if {c.lower() for c in taken} & {"shard", "n_bytes", "shard_bytes"}:
        raise ValueError("the rows have a column named shard, n_bytes or shard_bytes already")
    key, row, g, fine, depth, prefix, n = (free_name(taken, c) for c in ("key", "row", "g", "fine", "depth", "prefix", "n"))
    todo = materialize(rows.withColumns({
        "n_bytes": F.coalesce(size.cast("long"), F.lit(0)), key: _hash(F.col(f"`{key_col}`"))}))
    todo = todo.withColumns({row: _hash(F.monotonically_increasing_id()), g: F.lit("")})
    total = todo.agg(F.sum("n_bytes")).first()[0] or 0
    bit, step = 0, max(0, math.ceil(math.log2(max(1, total / limit)))) + 4
    out = None
    while True:
        source, used = (key, bit) if bit < BITS else (row, bit - BITS)
        step = min(step, BITS - used)
        own = F.shiftright(source, BITS - used - step).bitwiseAND((1 << step) - 1)
        now = todo.withColumn(fine, own)
        cells = materialize(now.groupBy(g, fine).agg(F.sum("n_bytes").alias("shard_bytes"), F.count("*").alias(n)))
        every = cells.withColumn(depth, F.explode(F.sequence(F.lit(0), F.lit(step)))) \
            .withColumn(prefix, F.expr(f"shiftright(`{fine}`, {step} - `{depth}`)"))
        levels = every.groupBy(g, depth, prefix).agg(F.sum("shard_bytes").alias("shard_bytes"), F.sum(n).alias(n))
        fits = levels.where((F.col("shard_bytes") <= limit) | (F.col(n) == 1)).drop(n)
        above = fits.select(g, (F.col(depth) + 1).alias(depth), F.col(prefix).alias("above"))
        leaves = fits.withColumn("above", F.shiftright(prefix, 1)).join(above, [g, depth, "above"], "left_anti").drop("above")
        placed = every.drop("shard_bytes", n).join(leaves, [g, depth, prefix])
        found = now.join(placed, [g, fine])
        found = found.select(*taken, F.concat(g, _bits(F.col(prefix), F.col(depth))).alias("shard"), "n_bytes", "shard_bytes")
        out = found if out is None else out.unionByName(found)
        todo = materialize(now.join(placed.select(g, fine), [g, fine], "left_anti").withColumn(
            g, F.concat(g, _bits(F.col(fine), F.lit(step)))).drop(fine))
        if todo.isEmpty():
            return out
        bit, step = bit + step, 8
        if bit < BITS and todo.groupBy(g).agg((F.min(key) != F.max(key)).alias("differ")).where("differ").isEmpty():
            bit = BITS  # only repeated keys are left: no further key bit tells their rows apart


def row_bytes(rows: DataFrame) -> Column:
    """Bytes of a row's values: text and bytes by their length, numbers by their width, others by their JSON text."""
    widths = {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "bigint": 8, "float": 4, "double": 8, "date": 4,
              "timestamp": 8, "timestamp_ntz": 8}
    total = F.lit(0).cast("long")
    for name, kind in rows.dtypes:
        value = F.col(f"`{name}`")
        if kind in ("string", "binary"):
            size = F.octet_length(value)
        elif kind in widths:
            size = F.lit(widths[kind])
        else:
            size = F.octet_length(F.to_json(F.struct(value)))
        total = total + F.coalesce(size, F.lit(0))
    return total


def write_shards(rows: DataFrame, path: str, key_col: str, limit: int = LIMIT) -> DataFrame:
    """Write whole rows under ``path/shard=<s…>``, one folder for each shard (``s`` and its bits), and return the
    manifest: shard, n_rows, n_bytes, counted on the rows read back.

    Raises if a shard of several rows exceeds ``limit``. The rows are checkpointed once and shuffled once, by shard, so
    that each shard is written by one task; a shard is at most ``limit`` bytes, or one row."""
    names = rows.columns
    placed = assign_shards(rows, key_col, row_bytes(rows), limit).select(
        *[F.col(f"`{c}`") for c in names], F.concat(F.lit("s"), "shard").alias("shard"))
    placed.repartition("shard").write.partitionBy("shard").parquet(path)
    back = rows.sparkSession.read.schema(placed.schema).parquet(path)
    manifest = back.groupBy("shard").agg(
        F.count("*").alias("n_rows"), F.sum(row_bytes(back.drop("shard"))).alias("n_bytes"))
    over = manifest.where((F.col("n_bytes") > limit) & (F.col("n_rows") > 1))
    if not over.isEmpty():
        raise RuntimeError(f"shards above {limit} bytes: {[r.shard for r in over.limit(5).collect()]}")
    return manifest
