"""Periodic runs (11): against all periods tried one by one."""

import hashlib
import zlib
from fractions import Fraction

import numpy as np
import plain
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from topicflow.llm import periodic_runs as runs
from topicflow.llm import queries


def repetitions(words, least=6, exponent=4):
    """(start, length, period) by comparing the words with themselves at each distance."""
    number = {}
    x, out = np.array([number.setdefault(w, len(number)) for w in words], np.int64), []
    for q in range(1, len(x) // exponent + 1):
        same = np.concatenate([[False], x[q:] == x[:-q], [False]])
        edge = np.flatnonzero(same[1:] != same[:-1]).tolist()
        for a, b in zip(edge[::2], edge[1::2]):
            own = x[a: b + q]
            if len(own) >= max(least, exponent * q) and not any((own[d:] == own[:-d]).all() for d in range(1, q)):
                out.append((a, len(own), q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def digest(doc_id, text):
    words = [w.decode() for w in (text or "").encode().split()]
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is not None and h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = repetitions(words)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {i for s, size, q in found for i in range(s + q, s + size)}
    left = " ".join(w for i, w in enumerate(words) if i not in gone)
    listed = "".join("%d,%d,%d\n" % r for r in found)
    return (doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(left.encode()).hexdigest())


def test_query_against_brute_force(spark, sf, documents):
    got = plain.rows_of(queries.op11_periodic_runs(spark, sf))
    expected = sorted((digest(d, t) for d, t, _ in documents), key=repr)
    assert got == expected and sum(r[1] for r in got) > 10


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=1, max_size=40), st.integers(1, 7), st.integers(0, 40), st.lists(st.integers(0, 3), max_size=6))
def test_all_runs_of_random_words(head, period, more, tail):
    own = head + [head[-period:][k % len(head[-period:])] for k in range(more)] + tail
    words = [b"w%d" % x for x in own]
    assert runs.runs_of_words(words) == repetitions(words)
    assert sorted(runs.runs_of(own, 2, 2), key=lambda r: (r[0], r[2])) == repetitions(words, 2, 2)


@pytest.mark.parametrize("period", [1, 2, 3, 7, 500])
def test_long_runs_and_their_neighbours(period):
    root = [b"r%d" % i for i in range(period)]
    words = [b"x", *(root * (3000 // period))[:2999], b"y", *root * 4, b"z", b"z"]
    assert runs.runs_of_words(words) == repetitions(words)


def test_extensions_are_those_of_the_text():
    rng = np.random.default_rng(3)
    text = rng.integers(0, 2, 60).tolist()
    ahead = runs.Extensions(*runs.SuffixTree(text).tour())
    i, j = np.triu_indices(61, 1)
    for a, b, got in zip(i, j, ahead(i, j)):
        same = next((k for k in range(60 - b) if text[a + k] != text[b + k]), 60 - b)
        assert got == same


def test_awkward_rows(tables):
    some, none = tables
    got = runs.find_runs(some.withColumnsRenamed({"label": "body", "n": "RUNS"}), into=("n_words", "found", "left"))
    assert got.columns == [*(c for c in some.withColumnsRenamed({"label": "body", "n": "RUNS"}).columns if c != "found"),
                           "n_words", "found", "left"]
    assert got.count() == some.count()
    by_text = {r.text: r for r in got.collect()}
    assert by_text[None].n_words == 0 and by_text[None].found == [] and by_text[None].left == ""
    for text, r in by_text.items():
        words = (text or "").encode().split()
        assert r.n_words == len(words) and [tuple(x) for x in r.found] == (repetitions(words) if len(words) < 5000 else [])
    assert runs.find_runs(none).count() == 0
