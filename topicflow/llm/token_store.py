"""Token ids in compact binary files: canonical length-limited Huffman codes from global counts.

The store is a folder of two Parquet tables. ``code`` has a row for each used id: its code length, at most
``longest`` bits (package-merge, so the lengths are the best within that limit); the codes are canonical,
given by lengths and ids. ``blocks`` has a row for each independent block of whole documents, in ascending
order of the documents: ``start`` (ids before the block), ``doc`` and ``n_tokens`` of its documents,
``payload`` (the codes, first bit first) and ``checkpoints`` (the bit at which every 256th id of the block
begins). A block is decoded with a table of 2 ** longest entries, all its checkpoints side by side.

Documents are range-partitioned by their id, so that each task writes one run of the order. The ids are
checkpointed in compressed form between counting and coding. To the driver come one count for each id of
the vocabulary and one total for each partition.

Defined results: a null text is an empty one and has its end id; documents without id come first; repeated
rows are stored each, rows of one id in the order of the input; an empty table gives an empty store. A very long
document is a block of its own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicflow.llm.common import free_name, materialize, text_or_empty
from topicflow.llm.tokens import encoder, tokenizer_json

LONGEST = 16
BLOCK_TOKENS = 1 << 19
EVERY = 256


def code_lengths(counts: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Lengths of the best prefix code in which none exceeds ``longest`` bits (package-merge)."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.int64)
    if len(used) > 2**longest:
        raise ValueError(f"{len(used)} ids need codes of more than {longest} bits")
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    turn = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[turn].astype(np.int64)
    levels, items = [], leaves
    is_leaf = np.ones(len(leaves), bool)
    for _ in range(longest):
        levels.append(is_leaf)
        pairs = items[: len(items) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaves, pairs])
        order = np.argsort(both, kind="stable")
        items, is_leaf = both[order], order < len(leaves)
    take = 2 * len(leaves) - 2
    for is_leaf in reversed(levels):
        n = int(is_leaf[:take].sum())
        lengths[turn[:n]] += 1
        take = 2 * (take - n)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in the order of (length, id), each the next free one."""
    used = np.flatnonzero(lengths)
    turn = used[np.lexsort((used, lengths[used]))]
    size = lengths[turn]
    steps = np.left_shift(np.int64(1), int(size.max(initial=0)) - size)
    codes = np.zeros(len(lengths), np.int64)
    codes[turn] = (np.cumsum(steps) - steps) >> (int(size.max(initial=0)) - size)
    return codes


def encode(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray, every: int = EVERY) -> tuple[bytes, np.ndarray]:
    """The codes one after the other, and the bits at which every ``every``-th id begins."""
    if not len(ids):
        return b"", np.empty(0, np.int64)
    longest, group = int(lengths.max()), 1
    while 2 * group * longest <= 64:
        group *= 2
    points = np.arange(0, len(ids), every)
    single, value = np.zeros((2, -(-len(ids) // group) * group), np.uint64)
    lengths.astype(np.uint64).take(ids, out=single[: len(ids)], mode="clip")
    codes.astype(np.uint64).take(ids, out=value[: len(ids)], mode="clip")
    size = single
    while len(value) * group > len(single):  # codes side by side, as many as always fit in 64 bits
        value, size = (value[::2] << size[1::2]) | value[1::2], size[::2] + size[1::2]
    ends = np.cumsum(size.astype(np.int64))
    at = ends - size.astype(np.int64)
    word, bit = at >> 6, (at & 63).astype(np.uint64)
    value <<= np.uint64(64) - size
    first = np.flatnonzero(np.diff(word, prepend=-1))  # codes don't overlap: their union fills a word
    out = np.zeros(int(ends[-1] >> 6) + 2, np.uint64)
    out[word[first]] = np.bitwise_or.reduceat(value >> bit, first)
    last = np.append(first[1:] - 1, len(word) - 1)  # only a word's last group goes on in the next
    out[word[last] + 1] |= value[last] << (np.uint64(63) - bit[last]) << np.uint64(1)
    inner = single.reshape(-1, group)[points // group].astype(np.int64)
    before = np.where(np.arange(group) < (points % group)[:, None], inner, 0).sum(axis=1)
    return out.astype(">u8").tobytes()[: -(-int(ends[-1]) // 8)], at[points // group] + before


def decode_table(lengths: np.ndarray, longest: int) -> np.ndarray:
    """For each run of ``longest`` bits, the id that begins there and, in the last 6 bits, the length of its code."""
    used = np.flatnonzero(lengths)
    turn = used[np.lexsort((used, lengths[used]))]
    span = np.left_shift(np.int64(1), longest - lengths[turn])
    table = np.ones(2**longest, np.int64)
    table[: span.sum()] = np.repeat(turn << 6 | lengths[turn], span)
    return table


def decode(payload: bytes, checkpoints: np.ndarray, n: int, table: np.ndarray, longest: int, every: int = EVERY) -> np.ndarray:
    """The ``n`` ids of a block: at each step one more id after every checkpoint."""
    data = payload + b"\0" * (every * longest // 8 + 12)  # what follows the last id is read too
    window = np.empty(len(data) // 4 * 4 - 4, np.int64)
    for k in range(4):
        window[k::4] = np.frombuffer(data, ">u4", len(window) // 4, k)
    out = np.zeros((min(every, n), len(checkpoints)), np.int64)
    at = checkpoints.astype(np.int64)
    mask, shift = 2**longest - 1, 32 - longest
    for step in out:
        found = window.take(at >> 3)
        found >>= shift - (at & 7)
        found &= mask
        table.take(found, out=step, mode="clip")
        at += step & 63
    return (out >> 6).astype(np.uint32).T.reshape(-1)[:n]


def _pack_ids(ids: np.ndarray) -> bytes:
    small = len(ids) == 0 or ids.max() < 1 << 16
    return zstandard.compress((b"\2" if small else b"\4") + ids.astype("<u2" if small else "<u4").tobytes(), 3)


def _unpack_ids(data: bytes) -> np.ndarray:
    raw = zstandard.decompress(data)
    return np.frombuffer(raw, "<u2" if raw[0] == 2 else "<u4", offset=1)


def _tokenized(docs: DataFrame, tokenizer: str, end_id: int, id_col: str, text_col: str, block_tokens: int,
               special_tokens: bool) -> DataFrame:
    """Runs of documents in ascending order: part, doc (ids), n_tokens, ids (compressed)."""
    spark = docs.sparkSession
    json = spark.sparkContext.broadcast(tokenizer_json(tokenizer))
    tie = free_name(docs.columns, "tie")  # the place in the input: equal ids are spread, and bounds are sampled without texts
    narrow = docs.select(id_col, text_or_empty(text_col).alias(text_col)).withColumn(tie, F.monotonically_increasing_id())
    ordered = narrow.repartitionByRange(id_col, tie).sortWithinPartitions(id_col, tie).drop(tie)
    kind = docs.schema[id_col].dataType
    schema = T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("doc", T.ArrayType(kind)),
        T.StructField("n_tokens", T.ArrayType(T.LongType())), T.StructField("ids", T.BinaryType())])

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part = encoder(json.value, end_id, special_tokens), TaskContext.get().partitionId()

        def row(doc: pa.Array, sizes: list[int], ids: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.ListArray.from_arrays(pa.array([0, len(doc)], pa.int32()), doc),
                 pa.array([sizes], pa.list_(pa.int64())), pa.array([_pack_ids(ids)], pa.binary())],
                ["part", "doc", "n_tokens", "ids"])

        for batch in batches:
            keys = batch.column(id_col)
            for first, ids, offsets in own.documents(batch.column(text_col)):
                a, n = 0, len(offsets) - 1
                while a < n:  # blocks of whole documents
                    b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + block_tokens, "right")) - 1)
                    yield row(keys.slice(first + a, b - a), np.diff(offsets[a: b + 1]).tolist(), ids[offsets[a]: offsets[b]])
                    a = b

    return materialize(ordered.mapInArrow(tokenize, schema))


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
          longest: int = LONGEST, block_tokens: int = BLOCK_TOKENS, special_tokens: bool = False) -> None:
    """Encode the texts, each followed by ``end_id``, and write them to the store at ``path``; with
    ``special_tokens``, strings of special tokens are their one id."""
    spark = docs.sparkSession
    tokens = _tokenized(docs, tokenizer, end_id, id_col, text_col, block_tokens, special_tokens)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for x in batch.column("ids"):
                own = np.bincount(_unpack_ids(x.as_py()), minlength=len(total))
                own[: len(total)] += total
                total = own
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])

    counted = tokens.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    rows = counted.collect()  # at most one for each id of the vocabulary
    counts = np.zeros(max((r.id for r in rows), default=0) + 1, np.int64)
    counts[[r.id for r in rows]] = [r.n for r in rows]
    lengths = code_lengths(counts, longest)
    per_part = {r.part: r.n for r in tokens.groupBy("part").agg(F.sum(
        F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n")).collect()}
    before, total = {}, 0
    for part in sorted(per_part):
        before[part], total = total, total + per_part[part]
    sent = spark.sparkContext.broadcast((canonical_codes(lengths), lengths, before))
    kind = tokens.schema["doc"].dataType
    schema = T.StructType([
        T.StructField("start", T.LongType()), T.StructField("doc", kind),
        T.StructField("n_tokens", T.ArrayType(T.LongType())), T.StructField("payload", T.BinaryType()),
        T.StructField("checkpoints", T.ArrayType(T.LongType()))])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, lengths, before = sent.value
        start = None
        for batch in batches:
            for i in range(batch.num_rows):
                if start is None:
                    start = before[batch.column("part")[i].as_py()]
                ids = _unpack_ids(batch.column("ids")[i].as_py())
                payload, points = encode(ids, codes, lengths)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([start], pa.int64()), batch.column("doc").slice(i, 1), batch.column("n_tokens").slice(i, 1),
                     pa.array([payload], pa.binary()), pa.array([points], pa.list_(pa.int64()))], schema.names)
                start += len(ids)

    tokens.mapInArrow(code, schema).write.parquet(f"{path}/blocks")
    used = np.flatnonzero(lengths)
    spark.createDataFrame([(int(i), int(lengths[i])) for i in used], "id long, length int").coalesce(1) \
        .write.parquet(f"{path}/code")


def read(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Per document of the store: doc, start, n_tokens, ids_crc32 and the ids (little-endian, 32 bits)."""
    code = spark.read.parquet(f"{path}/code").collect()  # at most one row for each id of the vocabulary
    lengths = np.zeros(max((r.id for r in code), default=0) + 1, np.int64)
    lengths[[r.id for r in code]] = [r.length for r in code]
    longest = max(1, int(lengths.max()))
    sent = spark.sparkContext.broadcast(decode_table(lengths, longest))
    blocks = spark.read.parquet(f"{path}/blocks")
    schema = T.StructType([
        T.StructField("doc", blocks.schema["doc"].dataType.elementType), T.StructField("start", T.LongType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType()),
        *[T.StructField("ids", T.BinaryType())] * with_ids])

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                sizes = batch.column("n_tokens")[i].values.to_numpy()
                points = batch.column("checkpoints")[i].values.to_numpy()
                ids = decode(batch.column("payload")[i].as_py(), points, int(sizes.sum()), sent.value, longest)
                ends = np.cumsum(sizes)
                data = [ids[a:b].astype("<u4").tobytes() for a, b in zip(ends - sizes, ends)]
                columns = [batch.column("doc")[i].values, pa.array(ends - sizes + batch.column("start")[i].as_py()),
                           pa.array(sizes), pa.array([zlib.crc32(x) for x in data], pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, *[pa.array(data, pa.binary())] * with_ids], schema.names)

    return blocks.mapInArrow(documents, schema)
