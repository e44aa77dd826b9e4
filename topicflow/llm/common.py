"""Helpers shared by the operators: checkpoints, column checks, vectorised word splitting."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicflow.session import checkpoint_base


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(df: DataFrame) -> DataFrame:
    """Compute once and cut lineage: a reliable checkpoint in the shared folder."""
    checkpoint_base(df.sparkSession)
    return df.checkpoint(eager=True)


def free_name(taken: list[str], name: str) -> str:
    """``name``, with underscores in front until no column has it (names match in any case)."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name = f"_{name}"
    return name


def text_or_empty(col: str) -> F.Column:
    return F.coalesce(F.col(f"`{col}`").cast("string"), F.lit(""))


def utf8_column(array: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column (nulls: empty), one after the other, and len + 1 offsets."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    array = array.cast(pa.large_binary())
    if array.null_count:
        array = array.fill_null(b"")
    _, offsets, data = array.buffers()
    off = np.frombuffer(offsets, np.int64)[array.offset: array.offset + len(array) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[off[0]: off[-1]], off - off[0]


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By byte: A-Z to a-z; whether it belongs to ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` then; a
    random odd 64-bit factor."""
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    word = np.zeros(256, bool)
    word[0x30:0x3A] = word[0x61:0x7B] = word[0x80:] = True
    mix = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return lower, word, mix


LOWER, IS_WORD, _MIX = _tables()
_BASE = np.uint64(0x9E3779B97F4A7C15)


class Words:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of lower-cased (A-Z only) texts.

    ``data`` holds all texts, each followed by a space; ``start`` and ``end`` are the words' places
    in it, ``first[i] : first[i + 1]`` the words of text ``i``, ``hash`` a 62-bit hash of each word.
    """

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, hashed: bool = True):
        n = len(offsets) - 1
        self.data = np.full(len(raw) + n, 32, np.uint8)
        place = np.arange(len(raw)) + np.repeat(np.arange(n), np.diff(offsets))
        self.data[place] = LOWER[raw]
        del place
        inside = np.zeros(len(self.data) + 2, np.int8)
        inside[1:-1] = IS_WORD[self.data]
        edge = np.diff(inside)
        self.start, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.first = np.searchsorted(self.start, offsets + np.arange(n + 1))
        self.hash = self._hashes() if hashed else None

    def _hashes(self) -> np.ndarray:
        size = self.end - self.start
        if not len(size):
            return np.empty(0, np.int64)
        powers = np.cumprod(np.full(int(size.max()), _BASE, np.uint64))
        begin = np.cumsum(size) - size
        letter = np.arange(int(size.sum())) - np.repeat(begin, size)
        value = _MIX[self.data[letter + np.repeat(self.start, size)]] * powers[letter]
        return finish(np.add.reduceat(value, begin))

    def words(self, i: int, j: int) -> list[bytes]:
        """The words i to j - 1, counted over all texts."""
        data = self.data
        return [data[a:b].tobytes() for a, b in zip(self.start[i:j], self.end[i:j])]


def finish(h: np.ndarray) -> np.ndarray:
    """Mix the bits of 64-bit hashes; the result lies in 0 .. 2**62 - 1."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return ((h ^ (h >> np.uint64(32))) >> np.uint64(2)).view(np.int64)
