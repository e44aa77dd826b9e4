"""Line dedup (2), SimHash near-dedup (7), embedding near-dedup (8)."""

import numpy as np
import plain
import pytest

from topicflow.llm import embedding_dedup, line_dedup, simhash
from topicflow.llm.components import connected_components


def test_lines_of_awkward_rows(tables):
    got = line_dedup.dedup_lines(tables[0], counts=("lines_", "removed_"))
    want = plain.line_dedup(plain.awkward())
    rows = [(r[0], *want.get((r[0], r[1]), (None, 0, 0))) for r in plain.awkward()]
    assert plain.rows_of(got.select("doc_id", "text", "lines_", "removed_")) == sorted(rows, key=repr)
    assert line_dedup.dedup_lines(tables[0]).columns == tables[0].columns
    assert line_dedup.dedup_lines(tables[1]).count() == 0


def test_counts_take_the_place_of_columns_of_their_names(tables):
    got = line_dedup.dedup_lines(tables[0], counts=("FOUND", "kept"))
    assert got.columns == [*(c for c in tables[0].columns if c not in ("found", "kept")), "FOUND", "kept"]
    want = line_dedup.dedup_lines(tables[0], counts=("lines_", "removed_"))
    assert plain.rows_of(got.select("doc_id", "text", "FOUND", "kept")) == \
        plain.rows_of(want.select("doc_id", "text", "lines_", "removed_"))
    with pytest.raises(ValueError):
        line_dedup.dedup_lines(tables[0], counts=("text", "kept"))


def test_lines_cover_overlapping_windows(spark):
    docs = spark.createDataFrame([(1, "a\nb\nc\nd\ne"), (2, "x\na\nb\nc\nd\n\ny"), (3, "b\nc\nd")], "doc_id long, text string")
    assert [r.text for r in line_dedup.dedup_lines(docs).orderBy("doc_id").collect()] == ["a\nb\nc\nd\ne", "x\ny", ""]


def test_simhash_of_awkward_rows(tables):
    rows = plain.awkward()
    prints = [plain.fingerprint(r[1]) for r in rows]
    ids = plain.smallest_ids([r[0] for r in rows], plain.simhash_components(prints))
    got = simhash.near_duplicates(tables[0])
    assert sorted(((r[0], r[1] % 2**64, r[2]) for r in got.collect()), key=repr) == sorted(
        ((r[0], p, i) for r, p, i in zip(rows, prints, ids)), key=repr)
    assert simhash.near_duplicates(tables[1]).count() == 0


def test_simhash_keeps_one_of_each_group(tables):
    rows = plain.awkward()
    named = [r for r in rows if r[0] is not None]
    groups = plain.simhash_components([plain.fingerprint(r[1]) for r in named])
    ids = set(plain.smallest_ids([r[0] for r in named], groups))
    kept = simhash.one_of_each_group(tables[0])
    assert kept.columns == tables[0].columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([*ids, None, None], key=repr)
    assert simhash.one_of_each_group(tables[1]).count() == 0


def test_simhash_keeps_one_row_of_each_group_under_repeated_ids(spark):
    other = [" ".join(f"w{i}x{j}" for j in range(40)) for i in range(4)]
    rows = [(1, plain.SENTENCE, "a"), (1, other[0], "a"), (1, other[0], "b"), (2, plain.SENTENCE, "a"), (2, other[1], "a"),
            (3, other[1], "a"), (1, other[2], "a"), (None, other[3], "a"), (None, other[3], "b"), (None, other[0], "a")]
    kept = simhash.one_of_each_group(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    want = [(1, plain.SENTENCE), (1, other[0]), (2, other[1]), (1, other[2]), (None, other[3]), (None, other[0])]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("most", [200, 4096])
def test_simhash_links_at_any_run_length(spark, most):
    rng = np.random.default_rng(3)
    values = set()
    for c in rng.integers(0, 2**63, 6, dtype=np.uint64):
        for _ in range(60):  # walks of single bits, so that components are chains
            c ^= np.uint64(1) << np.uint64(rng.integers(0, 64))
            values.add(int(c))
    for bit in range(0, 30):  # hundreds within a few bits of each other: long runs under many keys
        values |= {(1 << 62) | 1 << bit | 1 << other for other in range(30)}
    values |= {0, 2**64 - 1, *map(int, rng.integers(0, 2**63, 100, dtype=np.uint64))}
    values = sorted(values)
    signed = [(v - 2**64 if v >> 63 else v,) for v in values]
    rows = spark.createDataFrame([(i, s[0]) for i, s in enumerate(signed)], "id long, fp long")
    got = {r.fp % 2**64: r.component_id for r in simhash.components(rows, "id", 3, most).collect()}
    groups = plain.simhash_components(values)
    assert got == {v: g for v, g in zip(values, groups)}


def test_components_of_a_long_chain(spark):
    order = np.random.default_rng(1).permutation(300).tolist()
    links = [(order[i], order[i + 1]) for i in range(299)] + [(1000, 1001), (1001, 1001), (1001, 1000)]
    got = connected_components(spark.createDataFrame(links, "a long, b long"))
    assert plain.rows_of(got) == sorted([(i, 0) for i in range(1, 300)] + [(1001, 1000)], key=repr)


def embeddings():
    rng = np.random.default_rng(5)
    base = rng.standard_normal((40, 16))
    rows = []
    for i in range(400):
        v = base[rng.integers(40)] + rng.standard_normal(16) * rng.choice([0.02, 0.1, 0.2])
        rows.append((i, [float(x) for x in v], int(rng.integers(3))))
    rows += [(400 + i, rows[0][1], rows[0][2]) for i in range(5)]                       # equal vectors
    rows += [(500, None, 1), (501, [], 1), (502, [0.0] * 16, 1), (503, [1.0, None] * 8, 1), (504, [float("nan")] * 16, 1),
             (505, [float("inf")] * 16, 1), (506, rows[0][1], None), (507, [1.0, 2.0], 1), (508, [2.0, 4.0], 1),
             (None, rows[0][1], rows[0][2])]
    return rows


@pytest.mark.parametrize("tile", [8, 1024])
def test_embeddings_against_all_pairs(spark, tile):
    rows = embeddings()
    valid = [r for r in rows if r[0] is not None and (r[0] < 500 or r[0] > 506)]
    g, n, missed, total = plain.Groups(600), dict.fromkeys((r[0] for r in rows), 0), 0, 0
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(
        spark.createDataFrame([(*r, 1, 2) for r in rows],
                              "vec_id long, embedding array<double>, label int, rep int, sig int"), tile=tile).collect()}
    for i, (a, x, la) in enumerate(valid):
        for b, y, lb in valid[:i]:
            if la == lb and len(x) == len(y):
                x_, y_ = np.array(x), np.array(y)
                if x_ @ y_ / np.sqrt((x_ @ x_) * (y_ @ y_)) >= 0.93:
                    n[a] += 1
                    n[b] += 1
                    g.unite(a, b)
    total, links = sum(n.values()), sum(r.n_links for r in got.values())
    assert len(got) == len(rows) and 0.95 * total <= links <= total
    for r in got.values():
        assert r.n_links <= n[r.vec_id]
        assert r.vec_id is None or g.root(r.component_id) == g.root(r.vec_id)
        assert r.kept == (None if r.vec_id is None else r.vec_id == r.component_id)
    assert got[507].n_links == 1 and got[506].n_links == 0 and got[403].n_links >= 5


def test_embeddings_of_an_empty_table(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label string")
    assert embedding_dedup.near_duplicates(none).count() == 0


def test_vectors_of_extreme_norms(spark):
    rows = [(1, [1e200, 2e200]), (2, [1e200, 2.002e200]), (3, [1e-200, 2e-200]), (4, [2e-200, 1e-200]), (5, [5e-324, 0.0]),
            (6, [1e308, 0.0]), (7, [1e-310, 2e-310])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(df).collect()}
    assert got == {1: (3, 1), 2: (3, 1), 3: (3, 1), 7: (3, 1), 4: (0, 4), 5: (1, 5), 6: (1, 5)}
