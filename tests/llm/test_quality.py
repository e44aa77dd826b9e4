"""Quality classifier (4)."""

import zlib

import numpy as np
import plain

from topicflow.llm import quality_rules, queries


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op4_quality_classifier(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = got.join(labels, "doc_id").where("held_out").select("quality", "predicted").collect()
    assert sum(r.quality == r.predicted for r in rows) >= 0.95 * len(rows)
    assert got.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert got.where("score < 0 or score > 1 or score is null").isEmpty()


def test_statistics_of_whole_texts():
    raw = b"The the THE | a!! b.\n\xc3\xa9 12"
    x = dict(zip(quality_rules.STATISTICS, quality_rules.statistics(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0]))
    assert np.isclose(x["log_words"], np.log(8)) and x["bars"] == 1 / 7 and x["bangs"] == 2 / 7 and x["lines"] == 1 / 7
    assert x["repeats"] == 2 / 7 and x["top"] == 3 / 7 and x["upper"] == 4 / 11 and x["digits"] == 2 / 7


def test_awkward_rows(spark, tables):
    labels = spark.createDataFrame(
        [(r[0], int(i % 3 > 0)) for i, r in enumerate(plain.awkward())] + [(1, None), (1, 0), (1, 1), (999, 1)],
        "doc_id long, quality int")
    for some in (labels, labels.limit(0), labels.where("quality = 1"), labels.where("quality = 0")):
        model = quality_rules.train(tables[0], some)
        got = quality_rules.score(tables[0], model, into="value")
        assert got.columns == [*tables[0].columns, "value"]
        assert got.where("value is null or value < 0 or value > 1").isEmpty() and got.count() == len(plain.awkward())
        assert quality_rules.score(tables[1], model, into="value").count() == 0
    none = quality_rules.train(tables[1], labels.limit(0))
    assert quality_rules.score(tables[0], none, into="value").select("value").distinct().collect() == [(1.0,)]


def test_a_repeated_id_does_not_crowd_out_the_others(spark, monkeypatch):
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 4 != 2][:20]
    docs = [(ids[0], "one text")] * 100 + [(ids[1], "many texts " * n) for n in range(1, 101)]
    docs += [(i, f"text {'!' * i}") for i in ids[2:]]
    labels = [(ids[0], 0)] * 50 + [(i, i % 2) for i in ids]
    seen = []
    monkeypatch.setattr(quality_rules, "fit", lambda x, y: seen.append((x, y)))
    quality_rules.train(spark.createDataFrame(docs, "doc_id long, text string"),
                        spark.createDataFrame(labels, "doc_id long, quality int"), max_rows=20)
    (x, y), = seen
    bangs = x[:, quality_rules.STATISTICS.index("bangs")]
    assert len(y) == 40 and len(set(bangs[bangs > 0])) == sum(i > 0 for i in ids[2:])
    assert sum(b > 0 for b in bangs) == sum(i > 0 for i in ids[2:]) and set(y) == {0, 1}


def test_compiled_expression_equals_the_model(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = quality_rules.train(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    assert model.rules
    rows = quality_rules.with_statistics(docs, "text", "s").select("s.*", model.score("s").alias("value")).collect()
    x = np.array([[r[k] for k in quality_rules.STATISTICS] for r in rows])
    total = model.intercept + sum(w * quality_rules._holds(rule, x) for rule, w in model.rules)
    assert np.allclose([r.value for r in rows], 1 / (1 + np.exp(-total)))


def test_held_out_rows(tables):
    rows = tables[0].select("doc_id", quality_rules.held_out("doc_id").alias("out")).collect()
    assert all(r.out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
