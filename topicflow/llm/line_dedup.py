"""Line deduplication by overlapping three-line windows.

Lines are compared without white space (ASCII) at their ends; blank lines are passed over. Every three
consecutive lines are a window, known by a 128-bit hash. Of a window that occurs more than once, the first
occurrence stays (the smallest id, then the earliest line); the lines that later ones cover are removed, each
line once. A blank line goes with the line before it.

Windows are aggregated before they are shuffled, to one row for each window and task; only windows that
repeat are joined back, and adaptive execution splits one that a third of the documents share. Texts are shuffled
once, to meet their covered positions.

Defined results: a null text stays null and has no lines; texts of fewer than three lines stay; rows with one id
and one text count as one document, each gets the same result; rows without id come first; an empty table gives
no rows; texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicflow.llm.common import free_name, materialize

WINDOW = 3


def _stripped(text: bytes) -> list[bytes]:
    return [x for x in (line.strip() for line in text.split(b"\n")) if x]


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests, sizes = [], []
        for text in batch.column("text").cast(pa.binary()).to_pylist():
            lines = _stripped(text or b"")
            own = [xxhash.xxh3_128_digest(b"\n".join(lines[i: i + WINDOW])) for i in range(len(lines) - WINDOW + 1)]
            digests += own
            sizes.append(len(own))
        words = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(words[:, k].copy(), pa.int64())) for k in (0, 1)]
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("mark"), *lists], ["id", "mark", "w1", "w2"])


def remove_lines(text: str, begins: list[int]) -> tuple[str, int, int]:
    """``text`` without the lines covered by windows that begin at ``begins`` (counted over non-blank lines);
    the number of its non-blank lines and of those removed."""
    covered = {i + k for i in begins for k in range(WINDOW)}
    kept, at, gone = [], -1, 0
    for line in text.split("\n"):
        if line.strip(" \t\r\x0b\x0c"):
            at += 1
            gone += at in covered
        if at not in covered:
            kept.append(line)
    return "\n".join(kept), at + 1, gone


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counts: tuple[str, str] | None = None
                ) -> DataFrame:
    """``docs`` with shortened texts; ``counts`` names two more columns, in place of columns of these names: non-blank
    lines, and those removed."""
    taken = {c.lower() for c in counts or ()}
    if taken & {id_col.lower(), text_col.lower()}:
        raise ValueError("the counts can't take the place of the id or the text")
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in taken])
    id_, text = F.col(id_col), F.col(text_col).cast("string")
    own = docs.select(id_.alias("id"), F.xxhash64(text).alias("mark"), text.alias("text"))
    listed = materialize(own.mapInArrow(_windows, T.StructType([
        T.StructField("id", docs.schema[id_col].dataType), T.StructField("mark", T.LongType()),
        T.StructField("w1", T.ArrayType(T.LongType())), T.StructField("w2", T.ArrayType(T.LongType()))])))
    every = listed.select("id", "mark", "w2", F.posexplode("w1").alias("at", "w1")) \
        .select("id", "mark", "at", "w1", F.get("w2", F.col("at")).alias("w2"))
    repeated = every.groupBy("w1", "w2").agg(F.min(F.struct("id", "mark", "at")).alias("first"), F.count("*").alias("n"))
    repeated = repeated.where("n > 1").drop("n")
    later = every.join(repeated, ["w1", "w2"]).where(F.struct("id", "mark", "at") != F.col("first"))
    names = {n: free_name(docs.columns, n) for n in ("dedup_id", "dedup_mark", "dedup_begins")}
    begins = later.groupBy("id", "mark").agg(F.collect_set("at").alias(names["dedup_begins"])).withColumnsRenamed(
        {"id": names["dedup_id"], "mark": names["dedup_mark"]})
    found = docs.join(begins, id_.eqNullSafe(F.col(names["dedup_id"])) & (F.xxhash64(text) == F.col(names["dedup_mark"])),
                      "left").select(*docs.columns, names["dedup_begins"])
    fields = [T.StructField(text_col, T.StringType()) if f.name == text_col else f for f in docs.schema.fields]
    fields += [T.StructField(c, T.LongType()) for c in counts or ()]

    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(None, 0, 0) if t is None else remove_lines(t, b or []) for t, b in zip(
                batch.column(text_col).to_pylist(), batch.column(names["dedup_begins"]).to_pylist())]
            batch = batch.drop_columns([names["dedup_begins"]])
            batch = batch.set_column(batch.schema.get_field_index(text_col), text_col,
                                     pa.array([r[0] for r in rows], pa.string()))
            for k, c in enumerate(counts or (), 1):
                batch = batch.append_column(c, pa.array([r[k] for r in rows], pa.int64()))
            yield batch

    return found.withColumn(text_col, F.col(text_col).cast("string")).mapInArrow(shorten, T.StructType(fields))
