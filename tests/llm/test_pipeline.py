"""The pipeline's stages against plain Python, and the registered queries against SQL."""

import os
import sys

import numpy as np
import plain
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from topicflow.llm import quality_rules

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))

from oracle_check import compare, duck  # noqa: E402


def test_stages_against_plain_python(spark, sf, scratch):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    folder, seen = scratch("stages"), [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, seen[-1], sf).write.parquet(f"{folder}/{name}")
        seen.append(spark.read.parquet(f"{folder}/{name}"))
    assert all(s.columns == docs.columns for s in seen[:-1])
    rows = [[(r.doc_id, r.text) for r in s.select("doc_id", "text").collect()] for s in seen[:-1]]

    # each stage on its own input
    model = quality_rules.train(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    texts = [t.encode() for _, t in rows[0]]
    x = quality_rules.statistics(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]))
    total = model.intercept + sum(w * quality_rules._holds(r, x) for r, w in model.rules)
    assert sorted(rows[1]) == sorted(r for r, t in zip(rows[0], total) if 1 / (1 + np.exp(-t)) >= 0.7)
    new = {k[0]: v for k, v in plain.line_dedup(rows[1]).items()}
    assert sorted(rows[2]) == sorted((d, v[0]) for d, v in new.items() if not v[2] or v[2] < v[1])
    assert all(r.n_chars == len(r.text) for r in seen[2].collect())
    prints = [plain.fingerprint(t) for _, t in rows[2]]
    ids = plain.smallest_ids([d for d, _ in rows[2]], plain.simhash_components(prints))
    assert sorted(rows[3]) == sorted(r for r, i in zip(rows[2], ids) if r[0] == i)
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    dirty = {r[0] for r in plain.decontaminated(rows[3], items) if r[5]}
    assert sorted(rows[4]) == sorted(r for r in rows[3] if r[0] not in dirty)
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    sizes = {d: len(t.encode(x, add_special_tokens=False).ids) + 1 for d, x in rows[4]}
    last = seen[-1].collect()
    got = dict.fromkeys(sizes, 0)
    for r in last:
        got[r.doc_id] += r.length
    assert got == sizes
    assert len({r.sequence_id for r in last}) == plain.best_fit_decreasing([r.length for r in last], 2048)
    run = corpus_pipeline.run(spark, sf)
    assert run.columns == seen[-1].columns
    kept = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert plain.rows_of(run.select(kept)) == plain.rows_of(seen[-1].select(kept))


@pytest.mark.parametrize("which, rows", [(1, [0, 0, 0, 0, 0]), (0, [25, 25, 18, 18, 122])])
def test_stages_on_empty_and_awkward_rows(spark, sf, scratch, tables, which, rows):
    docs, folder, counts = tables[which], scratch("stages"), []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf).write.parquet(f"{folder}/{name}")
        new = spark.read.parquet(f"{folder}/{name}")
        counts.append(new.count())
        if name != "best_fit_packing":
            assert new.columns == docs.columns
            docs = new
    assert counts == rows
    pieces = new.groupBy("doc_id").sum("length").collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in docs.select("doc_id").collect()}
    if rows[0]:  # one of each group of equal texts; rows without id are groups of their own
        texts = [r.text for r in docs.where("doc_id is not null").select("text").collect()]
        assert len(texts) == len(set(texts)) == 16 and plain.SENTENCE in texts


@pytest.mark.parametrize("name", sorted(k for k in entry.oracle_sql() if k.startswith("op")))
def test_query_matches_sql(spark, sf, name):
    line, ok = compare(spark, name, entry.queries()[name], entry.oracle_sql()[name], sf, duck(sf))
    assert ok, line


def test_all_operators_are_registered():
    names = entry.queries()
    assert "pipeline" in names and all(any(k.startswith(f"op{n}_") for k in names) for n in range(1, 14))
