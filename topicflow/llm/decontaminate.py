"""Benchmark decontamination with suffix arrays over the training words.

Every task cuts its documents into shards of about ``shard_words`` words, sorts the suffixes of each
shard (prefix doubling, to a depth of 16 words and at least the window), and binary-searches every
distinct window of ``width`` benchmark words in it. An interval of the suffix array is the list of all places
where that window occurs; however many items hold the window, it is searched and marked once, and a place has one
window at most (and those of shorter items). From each first place the longest verbatim match follows by a search in
the suffix array of the items themselves; the matches of a document cover all its hits and are compared word by word.

Documents are never shuffled: a shard lies inside one input partition, its size is bounded (one document may exceed
it, and is then a shard of its own). The benchmark is fetched and broadcast in blocks of about ``block_words`` words,
one at a time: the next block is fetched when the one before has been searched and released. With more than one block, the
documents are checkpointed once with a row number, and each block's finds are checkpointed as narrow rows.

Defined results: a null text has no words; an empty table of documents gives no rows, an empty
benchmark no hits; repeated document rows each give their row; items with one id count as one item, an
item without id counts as one (its id is null in the list); a document of any length is searched whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicflow.llm.common import Words, free_name, materialize, utf8_column

SHARD_WORDS = 1 << 20
BLOCK_WORDS = 1 << 19

FOUND = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("hits", T.ArrayType(T.StructType([
        T.StructField("first", T.LongType()), T.StructField("end", T.LongType())]))),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("matches", T.ArrayType(T.StructType([
        T.StructField("item_id", T.StringType()), T.StructField("item_word", T.LongType()),
        T.StructField("doc_word", T.LongType()), T.StructField("n_words", T.LongType())]))),
])
_MATCH = pa.struct([("item_id", pa.string()), ("item_word", pa.int64()), ("doc_word", pa.int64()),
                    ("n_words", pa.int64())])
_HIT = pa.struct([("first", pa.int64()), ("end", pa.int64())])
_FOUND = pa.struct([("n_words", pa.int64()), ("hits", pa.list_(_HIT)), ("items", pa.list_(pa.string())),
                    ("matches", pa.list_(_MATCH))])


def suffix_array(words: np.ndarray, depth: int) -> np.ndarray:
    """Places of ``words`` in the order of the up to ``depth`` words that begin there."""
    _, rank = np.unique(words, return_inverse=True)
    order, step = np.argsort(rank, kind="stable"), 1
    while step < depth and len(words) > 1:
        key = (rank + 1) * (int(rank.max()) + 2)
        key[:-step] += rank[step:] + 1
        order = np.argsort(key)
        key = key[order]
        rank = np.empty(len(words), np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        if rank[order[-1]] == len(words) - 1:
            break
        step *= 2
    return order


def _compare(words: np.ndarray, at: np.ndarray, sought: np.ndarray, size: np.ndarray) -> np.ndarray:
    """-1, 0 or 1: the suffix at each place against the sought row's first ``size`` words."""
    take = at[:, None] + np.arange(sought.shape[1])
    there = np.where(take < len(words), words[np.minimum(take, len(words) - 1)], np.iinfo(np.int64).min)
    differ = (there != sought) & (np.arange(sought.shape[1]) < size[:, None])
    which = differ.argmax(axis=1)
    rows = np.arange(len(at))
    return np.where(differ[rows, which], np.sign((there[rows, which] > sought[rows, which]) * 2 - 1), 0)


def search(words: np.ndarray, order: np.ndarray, sought: np.ndarray, size: np.ndarray
           ) -> tuple[np.ndarray, np.ndarray]:
    """For each sought row, the interval of the suffix array whose suffixes begin with it."""
    def bisect(rows: np.ndarray, past: int) -> np.ndarray:
        low, high = np.zeros(len(rows), np.int64), np.full(len(rows), len(order))
        while (open_ := np.flatnonzero(low < high)).size:
            mid = (low[open_] + high[open_]) // 2
            before = _compare(words, order[mid], sought[rows[open_]], size[rows[open_]]) < past
            low[open_] = np.where(before, mid + 1, low[open_])
            high[open_] = np.where(before, high[open_], mid)
        return low

    every = np.arange(len(sought))
    low = bisect(every, 0)
    high = low.copy()
    inside = np.flatnonzero(low < len(order))
    equal = inside[_compare(words, order[low[inside]], sought[inside], size[inside]) == 0]
    high[equal] = bisect(equal, 1)
    return low, high


class Block:
    """Distinct windows of some benchmark items, and the items' own suffix array."""

    def __init__(self, ids: list[str | None], texts: list[str | None], width: int):
        self.ids, self.width = ids, width
        words = Words(*utf8_column(pa.array(texts, pa.string())))
        self.words = [words.words(a, b) for a, b in zip(words.first[:-1], words.first[1:])]
        n, items = np.diff(words.first), np.arange(len(ids))
        count = np.where(n >= width, n - width + 1, n > 0)
        item = np.repeat(items, count)
        at = np.arange(len(item)) - np.repeat(np.cumsum(count) - count, count)
        size = np.minimum(n, width)[item]
        step = np.arange(width)
        there = (words.first[:-1][item] + at)[:, None] + step
        live = step < size[:, None]
        hashes = np.append(words.hash, 0)
        rows = np.where(live, hashes[np.where(live, there, len(words.hash))], 0)
        keys = np.ascontiguousarray(np.column_stack([rows, size])).view([("", np.int64)] * (width + 1)).reshape(-1)
        _, first, own = np.unique(keys, return_index=True, return_inverse=True)
        self.sought, self.size = rows[first], size[first]
        pairs = np.unique(own * max(1, len(ids)) + item)  # window, item
        self.holders = pairs % max(1, len(ids))
        self.first_holder = np.searchsorted(pairs // max(1, len(ids)), np.arange(len(first) + 1))
        # all items' words, each item followed by a word that equals no other
        self.stream = np.empty(len(words.hash) + len(ids), np.int64)
        self.begin = words.first[:-1] + items
        self.stream[np.arange(len(words.hash)) + np.repeat(items, n)] = words.hash
        self.stream[words.first[1:] + items] = -1 - items
        self.order = suffix_array(self.stream, int(n.max(initial=1)))

    def items_with(self, windows: np.ndarray) -> np.ndarray:
        """Numbers of the items that hold any of the windows."""
        return np.unique(np.concatenate([self.holders[self.first_holder[w]: self.first_holder[w + 1]] for w in windows.tolist()]))

    def longest(self, run: np.ndarray) -> tuple[int, int, int]:
        """(item, its word, length) of the longest beginning of ``run`` that some item holds."""
        low, high, best = 0, len(self.order), (0, 0)
        while low < high:
            mid = (low + high) // 2
            at = int(self.order[mid])
            other = self.stream[at: at + len(run)]
            differ = np.flatnonzero(other != run[: len(other)])
            k = int(differ[0]) if len(differ) else len(other)
            best = max(best, (k, at))
            if k == len(run):
                break
            if k < len(other) and other[k] < run[k]:
                low = mid + 1
            else:
                high = mid
        k, at = best
        item = int(np.searchsorted(self.begin, at, "right")) - 1
        return item, at - int(self.begin[item]), k


def _found_in(words: Words, block: Block) -> dict[int, tuple[list[tuple[int, int, int, int]], np.ndarray]]:
    """For each text of a shard with a hit: verbatim matches (item, item_word, doc_word, n_words) that cover all hits,
    each as long as any item goes on, and the numbers of all items that share a window with it."""
    n = len(words.first) - 1
    if not len(words.hash) or not len(block.sought):
        return {}
    # one word between texts that equals no other, so that no match runs across them
    row = np.repeat(np.arange(n), np.diff(words.first))
    stream = np.empty(len(words.hash) + n, np.int64)
    stream[np.arange(len(row)) + row] = words.hash
    stream[words.first[1:] + np.arange(n)] = -1 - len(block.ids) - np.arange(n)
    order = suffix_array(stream, max(16, block.width))
    low, high = search(stream, order, block.sought, block.size)
    count = high - low
    if not count.any():
        return {}
    window = np.repeat(np.arange(len(low)), count)
    place = order[np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + low[window]]
    begins = words.first[:-1] + np.arange(n)
    doc = np.searchsorted(begins, place, "right") - 1
    turn = np.lexsort((place, doc))
    doc, place, window = doc[turn], place[turn], window[turn]
    cuts = np.flatnonzero(np.diff(doc, prepend=-1, append=n))
    out = {}
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        d = int(doc[a])
        end = int(begins[d] + words.first[d + 1] - words.first[d])
        matches, past = [], -1
        for at, w in zip(place[a:b].tolist(), window[a:b].tolist()):
            size = int(block.size[w])
            if size < block.width:
                item = int(block.holders[block.first_holder[w]])
                matches.append((item, 0, at, size))
            elif at >= past:
                item, word, size = block.longest(stream[at:end])
                matches.append((item, word, at, size))
                past = at + size - block.width + 1  # the first window that isn't inside this match
        matches = [(i, x, at - int(begins[d]), k) for i, x, at, k in matches
                   if words.words(at - d, at - d + k) == block.words[i][x: x + k]]  # equal hashes, equal words?
        if matches:
            out[d] = matches, block.items_with(np.unique(window[a:b]))
    return out


def _union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _row(n_words: int, spans: list[tuple[int, int]], items: set, matches: list[dict]) -> dict:
    return {"n_words": n_words, "hits": [{"first": s, "end": e} for s, e in _union(spans)],
            "items": sorted(items, key=lambda x: (x is None, x or "")), "matches": matches}


def _annotated(texts: pa.Array, block: Block, shard_words: int) -> list[dict]:
    raw, offsets = utf8_column(texts)
    # about five bytes a word: the shard's bytes bound its words
    cuts = np.flatnonzero(np.diff(offsets[:-1] // (5 * shard_words), prepend=-1)).tolist() + [len(texts)]
    rows = []
    for a, b in zip(cuts[:-1], cuts[1:]):
        words = Words(raw[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a])
        found = _found_in(words, block)
        for i, n in enumerate(np.diff(words.first).tolist()):
            matches, items = found.get(i, ([], ()))
            rows.append(_row(n, [(w, w + k) for _, _, w, k in matches], {block.ids[x] for x in items}, [
                {"item_id": block.ids[x], "item_word": at, "doc_word": w, "n_words": k} for x, at, w, k in matches]))
    return rows


def blocks(benchmark: DataFrame, id_col: str, text_col: str, width: int, block_words: int) -> Iterator[tuple[Block, bool]]:
    """The benchmark in blocks of about ``block_words`` words, fetched row by row, each with whether it is the last; there
    is one at least. A block is made when it is asked for."""
    rows = benchmark.select(F.col(f"`{id_col}`").cast("string"), F.col(f"`{text_col}`").cast("string")).toLocalIterator()
    row = next(rows, None)
    while True:
        ids, texts, size = [], [], 0
        while row is not None and size < block_words:
            ids.append(row[0])
            texts.append(row[1])
            size += len(row[1] or "") // 5 + 1
            row = next(rows, None)
        yield Block(ids, texts, width), row is None
        if row is None:
            return


def find_matches(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
                 item_text_col: str = "text", width: int = 10, shard_words: int = SHARD_WORDS,
                 block_words: int = BLOCK_WORDS, into: str = "found") -> DataFrame:
    """``docs`` with a struct column ``into``: n_words, hits (spans of hit words, end exclusive), items
    (all ids found) and matches (verbatim matches of at least ``width`` words, or whole shorter items, that cover the
    hits). ``into`` must not be a column of ``docs``.
    """
    spark, number = docs.sparkSession, free_name([*docs.columns, into], "number")
    base, parts = None, []
    for block, last in blocks(benchmark, item_id_col, item_text_col, width, block_words):
        sent = spark.sparkContext.broadcast(block)
        if last and base is None:
            def annotate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    yield batch.append_column(into, pa.array(_annotated(batch.column(text_col), sent.value, shard_words), _FOUND))

            return docs.mapInArrow(annotate, T.StructType([*docs.schema.fields, T.StructField(into, FOUND)]))
        first = base is None
        if first:
            base = materialize(docs.withColumn(number, F.monotonically_increasing_id()))

        def narrow(batches: Iterator[pa.RecordBatch], sent=sent, first=first) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = _annotated(batch.column("text"), sent.value, shard_words)
                keep = [i for i, r in enumerate(rows) if first or r["hits"]]
                yield pa.RecordBatch.from_arrays([batch.column("number").take(pa.array(keep, pa.int64())),
                                                  pa.array([rows[i] for i in keep], _FOUND)], ["number", "found"])

        texts = base.select(F.col(number).alias("number"), F.col(f"`{text_col}`").cast("string").alias("text"))
        parts.append(materialize(texts.mapInArrow(narrow, T.StructType(
            [T.StructField("number", T.LongType()), T.StructField("found", FOUND)]))))
        sent.destroy()  # its finds are checkpointed
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_row(found[0]["n_words"], [(h["first"], h["end"]) for f in found for h in f["hits"]],
                         {x for f in found for x in f["items"]}, [m for f in found for m in f["matches"]])
                    for found in batch.column("found").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("number"), pa.array(rows, _FOUND)], [number, into])

    merged = every.groupBy("number").agg(F.collect_list("found").alias("found")).mapInArrow(merge, T.StructType(
        [T.StructField(number, T.LongType()), T.StructField(into, FOUND)]))
    return base.join(merged, number).drop(number)


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents in which any window of the benchmark occurs; same columns."""
    into = free_name(docs.columns, "found")
    found = find_matches(docs, benchmark, into=into, **options)
    return found.where(F.size(F.col(f"`{into}`.hits")) == 0).drop(into)
