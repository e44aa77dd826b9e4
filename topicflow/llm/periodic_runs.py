"""Periodic run detection: all maximal repetitions of words, by suffix trees, constant-time LCE and Lyndon roots.

Per text, Ukkonen's algorithm builds the suffix trees of the words and of their reversal. A tour of each tree gives the
order of the suffixes and, between neighbouring leaves, the depth of the highest node passed; a sparse table over those
depths answers the lowest common ancestor of two leaves, and with it the longest common extension of two places, in
constant time. The longest Lyndon word at each place, under the order of the words and under its inverse, is a root
candidate; every run has such a root. Candidates are extended in both directions at once, in numpy.

Trees are built where runs can be: a run of period q and at least max(6, 4q) words holds, from q words on, 5-grams that
each occurred at most q places before. So stretches of m places in a row whose 5-grams occurred before are kept as
long as no place's last occurrence is farther than (m + 4) / 3; stretches are cut until that holds, and the trees are
built over what is left with the period's words before it. This leaves out no run (the argument is in ``_stretches``), and
a text without such a stretch has none.

Each text is one row's work: memory follows the longest periodic stretch of one text (about 700 bytes per word).

Defined results: a null or empty text has no words and no runs; texts of any length are read whole; repeated rows
each have their result; ids aren't read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicflow.llm.common import free_name, utf8_column

LEAST, EXPONENT, GRAM = 6, 4, 5
_FACTORS = np.random.default_rng(11).integers(1, 2**63, GRAM, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class SuffixTree:
    """Ukkonen's tree of ``letters`` (0, 1, ...) with an end that is smaller than all."""

    def __init__(self, letters: list[int]):
        text = [x + 1 for x in letters] + [0]
        n, base = len(text), max(text) + 1
        child: dict[int, int] = {}  # by node * base + first letter of the edge
        begin, end, link = [0], [0], [0]  # edge into each node, as places of text; suffix links
        leaf_of: list[int] = []  # the i-th leaf made is that of suffix i
        node, edge, length, left = 0, 0, 0, 0
        for i, letter in enumerate(text):
            left += 1
            waiting = 0
            while left:
                if not length:
                    edge = i
                key = node * base + text[edge]
                below = child.get(key)
                if below is None:
                    child[key] = len(begin)
                    leaf_of.append(len(begin))
                    begin.append(i)
                    end.append(n)
                    link.append(0)
                    if waiting:
                        link[waiting] = node
                    waiting = 0
                else:
                    span = end[below] - begin[below]
                    if length >= span:
                        edge += span
                        length -= span
                        node = below
                        continue
                    middle = begin[below] + length
                    if text[middle] == letter:
                        length += 1
                        if waiting:
                            link[waiting] = node
                        break
                    split = len(begin)
                    begin.append(begin[below])
                    end.append(middle)
                    link.append(0)
                    child[key] = split
                    begin[below] = middle
                    child[split * base + text[middle]] = below
                    child[split * base + letter] = split + 1
                    leaf_of.append(split + 1)
                    begin.append(i)
                    end.append(n)
                    link.append(0)
                    if waiting:
                        link[waiting] = split
                    waiting = split
                left -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - left + 1
        self.n, self.nodes = n, len(begin)
        keys = np.fromiter(child.keys(), np.int64, len(child))
        below = np.fromiter(child.values(), np.int64, len(child))
        self._edge = np.array(end) - np.array(begin)
        self._letter, self._above, self._below = keys % base, keys // base, below
        self._suffix = np.full(self.nodes, -1, np.int64)
        self._suffix[leaf_of] = np.arange(n)

    def tour(self, inverse: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes in the order of their leaves, and before each the depth of the highest node passed since the last
        one; ``inverse`` takes the letters in the opposite order (the end stays first)."""
        letter = np.where(self._letter > 0, -self._letter, -self.n - 2) if inverse else self._letter
        turn = np.lexsort((-letter, self._above))  # last child first, as a stack gives them back
        below = self._below[turn].tolist()
        first = np.searchsorted(self._above[turn], np.arange(self.nodes + 1)).tolist()
        suffix, edge = self._suffix.tolist(), self._edge.tolist()
        order, highest, passed = [], [], 0
        stack, depths = [0], [0]
        while stack:
            node, above = stack.pop(), depths.pop()
            if above < passed:
                passed = above
            a, b = first[node], first[node + 1]
            if a == b:
                order.append(suffix[node])
                highest.append(passed)
                passed = self.n
                continue
            depth = above + edge[node]
            stack += below[a:b]
            depths += [depth] * (b - a)
        return np.array(order), np.array(highest)


class Extensions:
    """Longest common extension of any two suffixes, as the least depth between their leaves."""

    def __init__(self, order: np.ndarray, highest: np.ndarray):
        self.rank = np.empty(len(order), np.int64)
        self.rank[order] = np.arange(len(order))
        self.levels = [highest.astype(np.int32)]
        while 2 << (len(self.levels) - 1) <= len(highest):
            last, step = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-step], last[step:]))

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        a, b = self.rank[i], self.rank[j]
        a, b = np.minimum(a, b) + 1, np.maximum(a, b) + 1
        level = np.frexp((b - a).astype(float))[1] - 1
        out = np.empty(len(a), np.int64)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            table = self.levels[k]
            out[at] = np.minimum(table[a[at]], table[b[at] - (1 << int(k))])
        return out


def lyndon_ends(rank: list[int]) -> list[int]:
    """The end of the longest Lyndon word at each place: the next smaller suffix."""
    n = len(rank)
    out = [n] * n
    for i in range(n - 2, -1, -1):
        j, own = i + 1, rank[i]
        while j < n and rank[j] > own:
            j = out[j]
        out[i] = j
    return out


def runs_of(letters: list[int], least: int = LEAST, exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of at least max(least, exponent * period) letters; exponent >= 2."""
    n = len(letters)
    if n < least:
        return []
    tree, back = SuffixTree(letters), SuffixTree(letters[::-1])
    order, highest = tree.tour()
    ahead, behind = Extensions(order, highest), Extensions(*back.tour())
    inverse = np.empty(n + 1, np.int64)
    inverse[tree.tour(inverse=True)[0]] = np.arange(n + 1)
    place = np.arange(n)
    ends = [np.array(lyndon_ends(rank[:n].tolist()), np.int64) for rank in (ahead.rank, inverse)]
    i = np.concatenate([place, place])
    j = np.concatenate(ends)
    whole, period = i, j - i
    right = ahead(i, j)  # the suffix at n is the end alone
    left = behind(n - i, n - j)
    start, length = whole - left, left + period + right
    good = length >= np.maximum(least, exponent * period)
    found = np.unique(np.column_stack([start[good], period[good], length[good]]), axis=0)
    return [(s, size, q) for s, q, size in found.tolist()]


def _stretches(letters: np.ndarray, least: int, exponent: int) -> list[tuple[int, int]]:
    """Disjoint stretches of places, ascending, such that each run lies within one.

    From its period q on, a run of L words holds L - q - 4 places in a row (at least max(1, 3q - 4) for L >= max(6, 4q)) whose
    5-grams occurred q places before, so that their last occurrence is at most q places back. They lie in one stretch of m
    >= 3q - 4 marked places; none of them is farther than (m + 4) / 3 from its last occurrence, and so none is
    unmarked. The run begins q <= (m + 4) / 3 places before the first of them.
    """
    n = len(letters)
    if n < GRAM + 1 or least < LEAST or exponent < EXPONENT:
        return [(0, n)] if n >= least else []
    x = letters.astype(np.uint64) + np.uint64(1)
    grams = np.zeros(n - GRAM + 1, np.uint64)
    for k in range(GRAM):
        grams += x[k: n - GRAM + 1 + k] * _FACTORS[k] ^ (x[k: n - GRAM + 1 + k] * _FACTORS[k] >> np.uint64(31))
    turn = np.argsort(grams, kind="stable")
    same = np.flatnonzero(grams[turn[1:]] == grams[turn[:-1]])
    if not len(same):
        return []
    at, back = turn[same + 1], turn[same + 1] - turn[same]
    turn = np.argsort(at)
    at, back = at[turn], back[turn]
    while len(at):
        new = np.flatnonzero(np.diff(at, prepend=-2) != 1)
        size = np.repeat(np.diff(np.append(new, len(at))), np.diff(np.append(new, len(at))))
        near = back <= (size + GRAM - 1) // 3
        if near.all():
            break
        at, back = at[near], back[near]
    if not len(at):
        return []
    new = np.flatnonzero(np.diff(at, prepend=-2) != 1)
    size = np.diff(np.append(new, len(at)))
    first = np.maximum(at[new] - (size + GRAM - 1) // 3, 0)
    out: list[tuple[int, int]] = []
    for a, b in zip(first.tolist(), (at[new] + size + GRAM - 1).tolist()):
        while out and a < out[-1][1]:  # overlapping ones are one
            a = min(a, out.pop()[0])
        out.append((a, b))
    return out


def runs_of_words(words: list[bytes], least: int = LEAST, exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """The runs of a text's words by start and period."""
    number: dict[bytes, int] = {}
    letters = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    out = []
    for a, b in _stretches(letters, least, exponent):
        _, own = np.unique(letters[a:b], return_inverse=True)
        out += [(a + start, length, q) for start, length, q in runs_of(own.tolist(), least, exponent)]
    return sorted(out, key=lambda r: (r[0], r[2]))


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Whether each word stays: no run contains it after that run's first period."""
    edges = np.zeros(n + 1, np.int64)
    for start, length, q in runs:
        edges[start + q] += 1
        edges[start + length] -= 1
    return np.cumsum(edges[:-1]) == 0


def find_runs(docs: DataFrame, text_col: str = "text", least: int = LEAST, exponent: int = EXPONENT,
              into: tuple[str, str, str] = ("n_words", "runs", "collapsed")) -> DataFrame:
    """``docs`` with the number of words between ASCII white space, the runs (start, length, period; by start, then
    period) and the text of the kept words, joined by single spaces. ``into`` names the new columns, which take the
    place of columns of the same names."""
    if exponent < 2:
        raise ValueError("a run has at least two periods")
    taken = {c.lower() for c in into}
    body = free_name([*docs.columns, *into], "body")
    docs = docs.withColumn(body, F.col(f"`{text_col}`").cast("string"))
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in taken])
    run = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
    schema = T.StructType([*docs.drop(body).schema.fields, T.StructField(into[0], T.LongType()),
                           T.StructField(into[1], T.ArrayType(run)), T.StructField(into[2], T.StringType())])
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = utf8_column(batch.column(body))
            counts, found, collapsed = [], [], []
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                words = raw[a:b].tobytes().split()  # of bytes: ASCII white space only
                runs = runs_of_words(words, least, exponent)
                if runs:
                    keep = kept_words(len(words), runs).tolist()
                    words_left = [w for w, k in zip(words, keep) if k]
                else:
                    words_left = words
                counts.append(len(words))
                found.append([dict(zip(("start", "length", "period"), r)) for r in runs])
                collapsed.append(b" ".join(words_left))
            own = batch.drop_columns([body])
            texts = pa.array(collapsed, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [*own.columns, pa.array(counts, pa.int64()), pa.array(found, kind), texts], schema.names)

    return docs.mapInArrow(add, schema)
