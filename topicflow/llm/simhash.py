"""SimHash near-duplicates: fingerprints of word shingles, pigeonhole blocks, Hamming verification.

A fingerprint's 64 bits fall into ``max_bits + 3`` blocks. Two fingerprints that differ in at most
``max_bits`` bits agree in at least three whole blocks, so they meet under one of the keys made of three
blocks (20 keys of about 32 bits for 3 differing bits). Only distinct fingerprints are compared. Those
under one key are a sorted run in one task, where a chain of verified links that connects what is
connected is kept instead of all pairs. A run of more than ``MOST`` fingerprints is not held together:
its rows get three further blocks of the bits that are still free, which halves those bits each time; once
12 bits are free a run has at most 4096 members. So hot keys are split without losing a link, in at most
three rounds.

Defined results: a text without words (null, empty, white space) has fingerprint 0 and is linked like any
other; fewer words than a shingle are one shingle; repeated rows and equal texts share a component;
rows without id get a fingerprint and their component's smallest id (null if no row of it has one); an empty
table gives no rows; texts of any length are read whole.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicflow.llm.common import free_name, materialize, utf8_column
from topicflow.llm.components import connected_components
from topicflow.llm.runs import Sets, whole_runs

MOST = 4096
_CHUNK = 1 << 15


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """The SimHash of UTF-8 text: words between ASCII white space, A-Z in lower case, XXH64 with seed 42."""
    words = text.lower().split()  # of bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    begin = np.cumsum(size) - size
    n = max(1, len(words) - shingle + 1)
    first, end = begin[:n].tolist(), (begin + size - 1)[-n:].tolist()
    digest, count = xxhash.xxh64_digest, np.zeros(64, np.int64)
    for i in range(0, n, _CHUNK):
        raw = b"".join([digest(joined[a:b], 42) for a, b in zip(first[i: i + _CHUNK], end[i: i + _CHUNK])])
        bits = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1)
        count += bits.sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * count > n).tobytes(), "big", signed=True)


def with_fingerprint(docs: DataFrame, text_col: str = "text", shingle: int = 3, into: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint as a signed 64-bit number."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = utf8_column(batch.column(text_col))
            data = raw.tobytes()
            found = [fingerprint(data[a:b], shingle) for a, b in zip(offsets[:-1], offsets[1:])]
            yield batch.append_column(into, pa.array(found, pa.int64()))

    return docs.mapInArrow(add, T.StructType([*docs.schema.fields, T.StructField(into, T.LongType())]))


def _submasks(mask: int, max_bits: int) -> list[int]:
    """``mask`` with three more of ``max_bits + 3`` blocks of its free bits, in all ways."""
    free = [i for i in range(64) if not mask >> i & 1]
    blocks = [sum(1 << int(i) for i in part) for part in np.array_split(np.array(free, np.int64), max_bits + 3)]
    return sorted({mask | sum(chosen) for chosen in itertools.combinations(blocks, 3)})


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _linked_runs(values: np.ndarray, bounds: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that connect, within each run, what pairs of at most ``max_bits`` differing bits connect."""
    out: list[tuple[int, int]] = []
    size = np.diff(bounds)
    run = np.repeat(np.arange(len(size)), size)
    small = np.flatnonzero(size[run] <= 16)
    if len(small):
        x, r = values[small], run[small]
        sets = Sets(len(x))
        for step in range(1, int(size[r].max())):
            near = np.flatnonzero((r[step:] == r[:-step]) & (np.bitwise_count(x[step:] ^ x[:-step]) <= max_bits))
            for i in near.tolist():
                if sets.unite(i, i + step):
                    out.append((int(x[i]), int(x[i + step])))
    for i in np.flatnonzero(size > 16).tolist():
        rest = values[bounds[i]: bounds[i + 1]]
        while len(rest):
            queue, rest = [rest[0]], rest[1:]
            while queue and len(rest):
                at = queue.pop()
                near = np.bitwise_count(rest ^ at) <= max_bits
                found = rest[near]
                out += [(int(at), x) for x in found.tolist()]
                queue += list(found)
                rest = rest[~near]
    return out


def fingerprint_links(fingerprints: DataFrame, max_bits: int = 3, most: int = MOST) -> DataFrame:
    """Links (a, b) among distinct fingerprints (column ``fp``) that connect exactly those that pairs of at most
    ``max_bits`` differing bits connect."""
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, bounds in whole_runs(batches, ["mask", "block"], most):
            fp, mask = rows.column("fp").to_numpy(), rows.column("mask").to_numpy()
            long_ = np.ones(len(fp), bool) if bounds is None else np.repeat(np.diff(bounds) > most, np.diff(bounds))
            pairs = []
            if bounds is not None:
                size = np.diff(bounds)
                keep = np.repeat((size > 1) & (size <= most), size)
                size = size[(size > 1) & (size <= most)]
                pairs = _linked_runs(fp[keep], np.concatenate([[0], np.cumsum(size)]), max_bits) if len(size) else []
            a = np.concatenate([np.array([p[0] for p in pairs], np.int64), fp[long_]])
            b = np.concatenate([np.array([p[1] for p in pairs], np.int64), fp[long_]])
            m = np.concatenate([np.zeros(len(pairs), np.int64), mask[long_]])
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(m)], ["a", "b", "mask"])

    first = F.array(*[F.lit(_signed(m)) for m in _submasks(0, max_bits)])
    keyed = fingerprints.select("fp", F.explode(first).alias("mask"))
    links = None
    while True:
        keyed = keyed.withColumn("block", F.col("fp").bitwiseAND(F.col("mask")))
        sorted_ = keyed.repartition("mask", "block").sortWithinPartitions("mask", "block", "fp")
        found = materialize(sorted_.mapInArrow(link, "a long, b long, mask long"))
        new = found.where("mask = 0").select("a", "b")
        links = new if links is None else links.unionByName(new)
        todo = found.where("mask != 0").select(F.col("a").alias("fp"), "mask")
        masks = [r.mask % (1 << 64) for r in todo.select("mask").distinct().collect()]
        if not masks:
            return links.distinct()
        table = fingerprints.sparkSession.createDataFrame(  # of 20 rows, then 400: whatever the data
            [(_signed(m), [_signed(x) for x in _submasks(m, max_bits)]) for m in masks], "mask long, finer array<long>")
        keyed = todo.join(F.broadcast(table), "mask").select("fp", F.explode("finer").alias("mask")).distinct()


def _roots(fingerprints: DataFrame, max_bits: int = 3, most: int = MOST) -> DataFrame:
    """A materialized table of distinct ``fp`` with ``root``, the same for all of a component."""
    found = connected_components(fingerprint_links(fingerprints.select("fp"), max_bits, most))
    return fingerprints.join(found, fingerprints.fp == found.node, "left").select(
        *fingerprints.columns, F.coalesce("root", "fp").alias("root"))


def components(fingerprints: DataFrame, id_col: str, max_bits: int = 3, most: int = MOST) -> DataFrame:
    """For each distinct ``fp`` of a materialized table (id_col, fp): the smallest id of its component."""
    least = materialize(fingerprints.groupBy("fp").agg(F.min(id_col).alias("least")))
    named = _roots(least, max_bits, most)
    roots = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return named.join(roots, "root").select("fp", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    max_bits: int = 3) -> DataFrame:
    """The id column, ``fingerprint`` (signed 64 bits) and ``component_id`` (smallest id of the group)."""
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = materialize(with_fingerprint(own, "text", shingle, "fp").drop("text"))
    found = rows.join(components(rows, "id", max_bits), "fp", "left")
    return found.select(F.col("id").alias(id_col), F.col("fp").alias("fingerprint"), "component_id")


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                      max_bits: int = 3) -> DataFrame:
    """``docs`` with one row of each group, that of the smallest id and, under one id, of the smallest hash of the
    text; same columns. Rows without id don't stand for rows with one, nor the other way round: of a group's rows
    without id, one stays as well."""
    unnamed = F.col("id").isNull().alias("unnamed")
    own = with_fingerprint(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "text", shingle, "fp")
    rows = own.select("id", "fp", F.xxhash64("text").alias("hash"))
    least = materialize(rows.groupBy("fp", unnamed).agg(F.min(F.struct("id", "hash")).alias("least")))
    roots = _roots(materialize(least.select("fp").distinct()), max_bits)
    one = least.join(roots, "fp").groupBy("root", "unnamed").agg(F.min("least").alias("least"))
    kept, hashed, at = (free_name(docs.columns, c) for c in ("kept", "hashed", "at"))
    stays = one.select(F.col("least.id").alias(kept), F.col("least.hash").alias(at))
    first = docs.withColumn(hashed, F.xxhash64(text_col)).join(
        stays, F.col(id_col).eqNullSafe(F.col(kept)) & (F.col(hashed) == F.col(at)), "left_semi")
    return first.dropDuplicates([id_col, hashed]).drop(hashed)
