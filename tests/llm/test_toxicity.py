"""Toxicity (12): gradients, windows, held-out accuracy, awkward rows."""

import zlib

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

from topicflow.llm import queries, toxicity
from topicflow.llm.common import Words


def laid(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(1)
    clean = [" ".join(rng.choice(["one", "two", "three", "four", "five"], rng.integers(5, 90))) for _ in range(300)]
    toxic = [f"{t} vile vilely {t}" for t in clean[:100]]
    return toxicity.fit(clean + toxic, np.repeat([0.0, 1.0], [300, 100]))


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(2)
    words = Words(*laid(["some words of a text", "and a few others"]))
    _, which, number = np.unique(words.hash, return_index=True, return_inverse=True)
    grams, _ = toxicity.grams_of(words, which)
    known = [toxicity.Vocabulary.of(x) for x in (np.unique(words.hash)[:4], np.unique(grams)[:30])]
    inputs = toxicity.Inputs.of(words, which, *known)
    w = {k: v.astype(float) for k, v in toxicity._new_weights(rng, np.ones(4), np.ones(30)).items()}
    _, first, size = toxicity.windows_of(words.first)
    index, live = toxicity._laid_out(first, size, number, len(which))
    y, share = np.array([0.0, 1.0]), np.array([1.0, 2.0])

    def loss():
        z = toxicity.log_odds(w, inputs.vectors(w), index, live)
        return float((share * (np.log1p(np.exp(z)) - y * z)).sum() / share.sum())

    g = toxicity.gradients(w, inputs, index, live, y, share)
    for k, v in w.items():
        for at in rng.integers(0, v.size, 5):
            place, step = np.unravel_index(at, v.shape), 1e-2
            kept = v[place]
            v[place] = kept + step
            above = loss()
            v[place] = kept - step
            below = loss()
            v[place] = kept
            assert np.isclose(g[k][place], (above - below) / (2 * step), rtol=0.05, atol=2e-4), (k, place)


def test_windows_cover_all_words_and_overlap():
    first = np.cumsum([0, 0, 1, toxicity.WINDOW, toxicity.WINDOW + 1, 1000])
    text, start, size = toxicity.windows_of(first)
    for i in range(5):
        own = [(a, a + n) for t, a, n in zip(text, start, size) if t == i]
        assert {w for a, b in own for w in range(a, b)} == set(range(first[i], first[i + 1])) and own
        assert all(b > c for (_, b), (c, _) in zip(own, own[1:]))
        assert all(b - a == toxicity.WINDOW for a, b in own) or len(own) == 1


def test_scores_do_not_depend_on_the_run(model):
    texts = ["one two vile three", "", "one " * 500, "two three " * 300 + "vilely vile " + "four " * 200, "vile"]
    whole = model.scores(*laid(texts))
    assert np.allclose(whole, [model.scores(*laid([t]))[0] for t in texts], atol=1e-5)
    assert whole[0] > 0.7 and whole[3] > 0.7 and whole[1] < 0.7 and whole[2] < 0.7


def test_unknown_words_are_read_by_their_letters(model):
    assert model.scores(*laid(["one two viley three four five"]))[0] > model.scores(*laid(["one two kraut three four five"]))[0]


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.op12_toxicity(spark, sf)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = got.join(labels, "doc_id").where("held_out").select("toxic", "predicted").collect()
    assert sum(r.toxic == r.predicted for r in rows) >= 0.97 * len(rows)
    clean = [r.predicted for r in rows if not r.toxic]
    assert sum(clean) <= 0.01 * len(clean)


def test_awkward_rows(spark, tables):
    some, none = tables
    labels = spark.createDataFrame(
        [(r[0], int(i % 3 > 0)) for i, r in enumerate(plain.awkward())] + [(1, None), (1, 0), (1, 1), (999, 1)],
        "doc_id long, toxic int")
    for own in (labels, labels.limit(0), labels.where("toxic = 1"), labels.where("toxic = 0")):
        model = toxicity.train(some, own, max_chars=10_000_000)
        for into in ("value", "score"):  # one new, one in place of a column
            got = toxicity.score(some, model, into=into)
            assert got.columns == [*(c for c in some.columns if c != into), into]
            assert got.where(f"{into} is null or {into} < 0 or {into} > 1").isEmpty() and got.count() == some.count()
            assert toxicity.score(none, model, into=into).count() == 0
        assert got.groupBy("text").agg(F.max("score") - F.min("score")).where("`(max(score) - min(score))` > 0.001").isEmpty()
    assert toxicity.train(none, labels.limit(0)).constant == 0.5
    rows = some.select("doc_id", toxicity.held_out("doc_id").alias("out")).collect()
    assert all(r.out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
