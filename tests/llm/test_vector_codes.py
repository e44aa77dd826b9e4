"""Vector codes (13): against plain integers."""

import numpy as np
import pytest

from topicflow.llm import queries, vector_codes


def coded(rows, entries=256, rounds=4, parts=4):
    """{id: (code, error)} and the codebooks, one integer at a time; rows of (id, integers) in order of the codebook."""
    k = len(rows[0][1]) // parts
    pieces = [[tuple(x[p * k: p * k + k]) for _, x in rows] for p in range(parts)]
    books = [own[:entries] for own in pieces]

    def distance(x, y):
        return sum((a - b) ** 2 for a, b in zip(x, y))

    def nearest(p):
        return [min((distance(x, c), e) for e, c in enumerate(books[p])) for x in pieces[p]]

    for _ in range(rounds):
        for p in range(parts):
            found, new = nearest(p), list(books[p])
            for e in range(len(new)):
                own = [x for x, (_, f) in zip(pieces[p], found) if f == e]
                if own:
                    new[e] = tuple(sum(c) // len(own) for c in zip(*own))
            books[p] = new
    final = [nearest(p) for p in range(parts)]
    return [(bytes(f[i][1] for f in final), sum(f[i][0] for f in final)) for i in range(len(rows))], books


def test_codes_of_odd_vectors(spark):
    rng = np.random.default_rng(5)
    vectors = [(i, rng.normal(0, 0.3, 8).round(2).tolist(), i % 3 or None) for i in range(60)]
    vectors += [(100 + i, [0.5] * 8, 1) for i in range(40)] + [(200, [2.0**16, -2.0**16] * 4, 2)]
    bad = [(300, None, 1), (301, [None] + [0.0] * 7, 1), (302, [float("nan")] * 8, 1), (303, [float("inf")] + [0.0] * 7, None)]
    df = spark.createDataFrame(vectors + bad, "vec_id long, embedding array<double>, label int").repartition(5)
    got, book = vector_codes.compress(df, entries=16)
    rows = [(i, np.floor(np.array(v) * 1024).astype(int).tolist()) for i, v, _ in vectors]
    expected, books = coded(rows, entries=16)
    assert vector_codes.listed(book) == ",".join(str(x) for b in books for c in b for x in c)
    assert {r.vec_id: (bytes(r.code), r.error) for r in got.collect()} == {i: e for (i, _), e in zip(rows, expected)}
    totals = {}
    for (_, _, label), (_, error) in zip(vectors, expected):
        totals[label] = totals.get(label, 0) + error
    found = vector_codes.with_label_error(got).collect()
    assert len(found) == len(vectors) and all(r.label_error == totals[r.label] for r in found)


def test_lengths_repeats_and_empty_tables(spark):
    schema = "vec_id long, embedding array<float>, label string, id int, error long, vector int"
    rows = [(1, [1.0, 2.0], "a"), (1, [1.0, 2.0], "a"), (2, [], None), (None, [0.5] * 7, "b"), (3, [3e38] * 3, "b"),
            (4, [-3e38] * 3, "b")]
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], schema)
    got, book = vector_codes.compress(df, rounds=2)
    assert book.shape == (6, 8) and np.abs(book).max() == vector_codes.BOUND
    every = vector_codes.with_label_error(got).collect()
    assert len(every) == 6 and all(len(r.code) == 4 and r.error == 0 for r in every)
    assert [r.vec_id for r in sorted(every, key=lambda r: repr(r.vec_id))] == [1, 1, 2, 3, 4, None]
    for none in (df.limit(0), df.where("vec_id = 2")):
        got, book = vector_codes.compress(none)
        assert vector_codes.with_label_error(got).count() == none.count() and book.shape[1] == 0
    with pytest.raises(ValueError):
        vector_codes.compress(df, entries=257)


def test_distances_by_tables():
    rng = np.random.default_rng(6)
    for high in (50, 1 << 26):
        vectors, book = rng.integers(-high, high, (5000, 6)), rng.integers(-high, high, (9, 6))
        index, least = vector_codes.Chunk.of(vectors).nearest(book, 2, 6)
        every = ((vectors[:, None, 2:] - book[None, :, 2:]) ** 2).sum(axis=2)
        assert (index == every.argmin(axis=1)).all() and (least == every.min(axis=1)).all()


def test_every_given_vector_is_coded(spark, sf):
    given = spark.read.parquet(f"{sf}/embeddings.parquet")
    assert queries.op13_vector_codes(spark, sf).count() == given.count()
