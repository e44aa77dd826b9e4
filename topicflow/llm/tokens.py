"""Token ids of whole texts, by the tokenizers library, fast where words recur.

Neither byte-level BPE nor word BPE joins anything across the place before a space that follows a
character other than white space. Texts are therefore cut there, the cuts of a batch are made distinct
in Arrow, and the library encodes each distinct piece once. A bounded column per Python worker keeps the
first pieces it meets: they go in front of a later batch's pieces before these are made distinct, so that the
new ones stand behind them (of a batch smaller than the column, in front go only as many as it has itself). The
ids of a piece are one binary value; those of a text are taken from these by Arrow. New pieces go to the library
as one text, a thousand at a time: they may stand one after the other just as they do in a document. Which ids
are whose follows from the bytes that the ids stand for; runs where these don't end where the pieces do are
encoded piece by piece. Ids are those of the library for the whole text. Strings of special tokens within a text
are ordinary text, or their one id with ``special_tokens``, as by the library's default. A null text is an empty one.
"""

from __future__ import annotations

import functools
import itertools
import os
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

KEPT_PIECES = 800_000
KEPT_LENGTH = 64
SLICE_PIECES = 100_000
BATCH_BYTES = 16_000_000
JOINED_PIECES = 1000
_CUT = re.compile(r"(?<=\S)(?= )")
_PLAIN = r"\A[!-~]+\z"
_SPACE_LAST = r"[\pZ\s\x0b\x1c-\x1f\x{85}]\z"


def _id_column(ids: np.ndarray, size: np.ndarray) -> pa.LargeBinaryArray:
    """Ids (32 bits each) that stand one after the other, ``size`` of them in a row."""
    offsets = 4 * np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
    return pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(ids.astype(np.uint32))])


def tokenizer_json(path: str) -> str:
    """The tokenizer's file, to be sent to the executors (its size doesn't depend on the data)."""
    return Path(path).read_text(encoding="utf-8")


@functools.cache
def encoder(json: str, end_id: int, special_tokens: bool = False) -> Encoder:
    """One encoder for each Python worker and tokenizer."""
    return Encoder(json, end_id, special_tokens)


class Encoder:
    def __init__(self, json: str, end_id: int, special_tokens: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(json)
        self.tokenizer.encode_special_tokens = not special_tokens
        spec = self.tokenizer.to_str()
        self.lossless = '"normalizer":null' in spec.replace(" ", "") and '"ByteLevel"' in spec
        self.special = "|".join(re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values())
        names = self.tokenizer.get_vocab(with_added_tokens=True)
        self.bytes = np.zeros(max(names.values(), default=-1) + 1, np.int64)  # that each id stands for
        for name, i in names.items():
            self.bytes[i] = len(name.removesuffix("</w>"))
        self.end = _id_column(np.array([end_id], np.uint32), np.array([1]))
        # the pieces kept and their ids; those at a text's begin and those after a space are apart
        empty = pa.array([], pa.large_string()), pa.array([], pa.large_binary())
        self.known = [empty, empty]

    def _each(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids: list[list[int]] = []
        for i in range(0, len(pieces), 20_000):
            ids += [e.ids for e in self.tokenizer.encode_batch_fast(pieces[i: i + 20_000], add_special_tokens=False)]
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(itertools.chain.from_iterable(ids), np.uint32, int(size.sum())), size

    def _joinable(self, pieces: pa.LargeStringArray) -> np.ndarray:
        """Whether a piece's bytes are those of its ids, and a space after it is a place to cut."""
        joinable = pc.match_substring_regex(pieces, _PLAIN)
        if self.lossless:
            no_cut = pc.or_(pc.equal(pc.binary_length(pieces), 0), pc.match_substring_regex(pieces, _SPACE_LAST))
            joinable = pc.or_(joinable, pc.invert(no_cut))
        if self.special:
            joinable = pc.and_not(joinable, pc.match_substring_regex(pieces, self.special))
        return joinable.to_numpy(zero_copy_only=False)

    def _encode(self, pieces: pa.LargeStringArray, spaced: bool) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the pieces, one after the other, and how many each has."""
        if not spaced:
            return self._each(pieces.to_pylist())
        plain = self._joinable(pieces)
        own = pieces.filter(pa.array(plain))
        bounds = np.append(np.arange(0, len(own), JOINED_PIECES), len(own))
        texts = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(bounds), own), pa.scalar(" ", pa.large_string())).to_pylist()
        length = pc.binary_length(own).to_numpy(zero_copy_only=False) + self.lossless
        flats, sizes = [], []
        for i in range(0, len(texts), 20):
            found = self.tokenizer.encode_batch_fast([f" {x}" for x in texts[i: i + 20]], add_special_tokens=False)
            for a, b, one in zip(bounds[i:], bounds[i + 1:], found):
                ids = np.array(one.ids, np.uint32)
                ends, reached = np.cumsum(length[a:b]), np.cumsum(self.bytes[ids])
                last = np.searchsorted(reached, ends)
                if len(ids) and last[-1] == len(ids) - 1 and (reached[last] == ends).all():
                    flats.append(ids)
                    sizes.append(np.diff(last, prepend=-1))
                else:
                    flat, size = self._each([f" {p}" for p in own.slice(a, b - a).to_pylist()])
                    flats.append(flat)
                    sizes.append(size)
        flat, size = self._each([f" {p}" for p in pieces.filter(pa.array(~plain)).to_pylist()])
        flat, every = np.concatenate([*flats, flat]), np.concatenate([*sizes, size])
        if plain.all():
            return flat, every
        # in the order of the pieces
        place = np.empty(len(pieces), np.int64)
        place[plain], place[~plain] = np.arange(len(own)), np.arange(len(own), len(pieces))
        start = (np.cumsum(every) - every)[place]
        size = every[place]
        at = np.arange(int(size.sum())) + np.repeat(start - (np.cumsum(size) - size), size)
        return flat[at], size

    def _coded(self, values: pa.LargeStringArray, spaced: bool) -> tuple[np.ndarray, pa.LargeBinaryArray]:
        """For each piece its place among distinct ones, and the ids of these."""
        known, ids = self.known[spaced]
        used = min(len(known), len(values))  # the first are the most frequent
        coded = pa.chunked_array([known.slice(0, used), values]).dictionary_encode().chunks[-1]
        new = coded.dictionary.slice(used)
        found = _id_column(*self._encode(new, spaced))
        if used == len(known):
            short = pc.less_equal(pc.binary_length(new), KEPT_LENGTH).to_numpy(zero_copy_only=False)
            keep = pa.array(np.flatnonzero(short)[: KEPT_PIECES - used])
            self.known[spaced] = pa.concat_arrays([known, new.take(keep)]), pa.concat_arrays([ids, found.take(keep)])
        return coded.indices.to_numpy(), pa.concat_arrays([ids.slice(0, used), found])

    def documents(self, texts: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Ids of the texts, each with the end id, in runs of texts: (first text, ids, len + 1 offsets)."""
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        a = 0
        while a < len(texts):  # bounded memory: about BATCH_BYTES of text at a time, or one longer text
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + BATCH_BYTES, "right")))
            for first, ids, offsets in self._documents(texts.slice(a, b - a)):
                yield a + first, ids, offsets
            a = b

    def _documents(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        unsafe = np.flatnonzero(pc.match_substring_regex(texts, r"[\pZ\s\x1c-\x1f\x{85}] ").to_numpy(zero_copy_only=False))
        pieces = pc.split_pattern(texts, " ")
        if len(unsafe):
            lists = pieces.to_pylist()
            for i in unsafe.tolist():
                first, *rest = _CUT.split(texts[i].as_py())
                lists[i] = [first, *(p[1:] for p in rest)]
            pieces = pa.array(lists, pa.large_list(pa.large_string()))
        offsets = pieces.offsets.to_numpy().astype(np.int64)
        values = pieces.values.slice(offsets[0], offsets[-1] - offsets[0])
        offsets -= offsets[0]
        heads = values.take(pa.array(offsets[:-1]))
        index, tail_ids = self._coded(values, True)
        head_index, head_ids = self._coded(heads, False)
        ids = pa.concat_arrays([tail_ids, head_ids, self.end])
        del pieces, values, heads

        n, a = len(texts), 0
        ends = offsets[1:] + np.arange(n)  # the end entry after each text
        inside = np.ones(len(index) + n, bool)
        inside[ends] = False
        entry = np.empty(len(inside), np.int32)
        entry[inside], entry[ends] = index, len(ids) - 1
        entry[offsets[:-1] + np.arange(n)] = len(tail_ids) + head_index
        while a < n:
            b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + SLICE_PIECES, "right")) - 1)
            first, last = int(offsets[a]) + a, int(offsets[b]) + b
            _, at, data = ids.take(pa.array(entry[first:last])).buffers()
            reached = np.frombuffer(at, np.int64, last - first + 1) // 4
            yield a, np.frombuffer(data, np.uint32, int(reached[-1])), np.concatenate([[0], reached[ends[a:b] + 1 - first]])
            a = b
