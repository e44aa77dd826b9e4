"""Unseen ranges and span trees."""

import random

from pyspark.sql import functions as F

from topicflow.operators import groups as G
from topicflow.operators.ranges import safe_positions, unseen_ranges
from topicflow.operators.tracing import span_trees


def test_unseen_ranges_of_commits_in_any_order(spark):
    rng, rows, bounds, want = random.Random(2), [], [], set()
    for group, begin, end, share in (("a", 0, 70_000, 0.999), ("b", 5, 40_000, 0.5), ("c", 32_760, 32_780, 0.6),
                                     ("d", 0, 200_000, 0.0), ("e", 0, 1, 1.0), (None, 10, 100, 0.9), ("f", 7, 7, 1.0)):
        seen = {o for o in range(begin, end) if rng.random() < share and not (group == "a" and 30_000 <= o < 66_000)}
        seen |= {3, end + 5} if group == "b" else set()  # outside its bounds
        rows += [(group, "t", 0, o) for o in seen] + [(group, "t", 0, o) for o in list(seen)[:50]]
        bounds.append((group, "t", 0, begin, end))
        missing = [o for o in range(begin, end) if o not in seen]
        start = None
        for i, o in enumerate(missing):
            start = o if start is None else start
            if i + 1 == len(missing) or missing[i + 1] != o + 1:
                want.add((group, "t", 0, start, o + 1, o + 1 - start))
                start = None
    rng.shuffle(rows)
    schema = "group string, topic string, partition int"
    committed = spark.createDataFrame(rows, f"{schema}, offset bigint")
    limits = spark.createDataFrame(bounds, f"{schema}, begin_offset bigint, end_offset bigint")
    gaps = unseen_ranges(committed, limits)
    got = [tuple(r) for r in gaps.collect()]
    assert len(got) == len(set(got)) and set(got) == want
    safe = {r.group: r.committed for r in safe_positions(gaps, limits).collect()}
    first = {g: min((a for x, _, _, a, _, _ in want if x == g), default=e) for g, _, _, _, e in bounds}
    assert safe == first
    assert unseen_ranges(committed.limit(0), limits.limit(0)).count() == 0


def _trees(spark, rows):
    df = spark.createDataFrame(rows, "trace_id string, span_id string, parent_span_id string, note int")
    return {(r.trace_id, r.span_id, r.note): (r.root_span_id, r.depth, r.path, r.kind) for r in span_trees(df).collect()}


def test_span_trees_roots_orphans_cycles(spark):
    rows = [("t", "r", None, 1), ("t", "a", "r", 1), ("t", "b", "a", 1), ("t", "c", "r", 1), ("u", "a", "gone", 1),
            ("u", "b", "a", 1), ("u", "x", "y", 1), ("u", "y", "z", 1), ("u", "z", "x", 1), ("u", "w", "x", 1), ("v", "s", "s", 1),
            ("t", "b", "a", 2), (None, "n", None, 1), ("t", None, "r", 1)]
    rows += [("deep", f"s{i}", f"s{i - 1}" if i else None, 1) for i in range(77)]
    got = _trees(spark, rows)
    assert got["t", "r", 1] == ("r", 0, ["r"], "root") and got["t", "b", 1] == ("r", 2, ["r", "a", "b"], "child")
    assert got["t", "b", 2] == got["t", "b", 1] and got["t", "c", 1] == ("r", 1, ["r", "c"], "child")
    assert got["u", "a", 1] == ("a", 0, ["a"], "orphan") and got["u", "b", 1] == ("a", 1, ["a", "b"], "child")
    for span in (("u", "x"), ("u", "y"), ("u", "z"), ("u", "w"), ("v", "s")):
        assert got[*span, 1] == (None, None, None, "cycle")
    assert got[None, "n", 1] == (None,) * 4 == got["t", None, 1]
    for i in range(77):
        assert got["deep", f"s{i}", 1] == ("s0", i, [f"s{k}" for k in range(i + 1)], "child" if i else "root")
    assert _trees(spark, []) == {}


def test_groups_with_many_time_points(spark):
    """Four hundred groups read the log once, and each has the positions it has alone."""
    log = spark.range(3000).select(
        F.lit("t").alias("topic"), (F.col("id") % 3).cast("int").alias("partition"), F.col("id").alias("offset"),
        F.when(F.col("id") % 50 != 0, F.timestamp_add("SECOND", (F.col("id") * 7919 % 86_400).cast("int"), F.lit("2024-01-01")
                                                      .cast("timestamp"))).alias("timestamp"))
    def at(k):
        return f"2024-01-01 {k // 60 % 24:02d}:{k % 60:02d}:00"
    groups = [G.Group(f"g{i}", ("t",), "latest" if i % 3 else "earliest", joined_at=at(i * 3), consumed_until=at(i * 3 + 200))
              for i in range(400)]
    groups.append(G.Group("never", ("t",), "latest"))
    got = {(r.group, r.partition): tuple(r) for r in G.group_positions(log, groups).collect()}
    for g in (*groups[:400:57], groups[-1]):
        alone = G.group_positions(log, [g]).collect()
        assert alone and all(got[g.name, r.partition] == tuple(r) for r in alone)
    some = G.fan_out(log, groups[5:6]).where("consumed").agg(F.max("offset")).first()[0]
    assert some + 1 == max(v[5] for k, v in got.items() if k[0] == "g5")


def test_children_of_roots_take_no_step(spark):
    """A root, its child and that one's child: one join of the open spans, whose result alone is checkpointed."""
    import unittest.mock

    from pyspark.sql.classic.dataframe import DataFrame

    kept = []
    real = DataFrame.checkpoint
    rows = [("t", "a", None), ("t", "b", "a"), ("t", "c", "b"), ("t", "d", "x"), ("t", "e", "d"), ("t", "y", "z"), ("t", "z", "y")]
    with unittest.mock.patch.object(DataFrame, "checkpoint", lambda df, *a, **k: (kept.append(out := real(df, *a, **k)), out)[1]):
        got = {r.span_id: r for r in span_trees(spark.createDataFrame(rows[:3], "trace_id string, span_id string, parent_span_id string")).collect()}
        assert [x.count() for x in kept] == [3, 3, 1]  # the links, where their first step led, the second
        both = {r.span_id: r for r in span_trees(spark.createDataFrame(rows, "trace_id string, span_id string, parent_span_id string")).collect()}
    assert [(got[x].root_span_id, got[x].depth, got[x].kind) for x in "abc"] == [("a", 0, "root"), ("a", 1, "child"), ("a", 2, "child")]
    assert [(both[x].root_span_id, both[x].depth, both[x].kind) for x in "cdeyz"] == [
        ("a", 2, "child"), ("d", 0, "orphan"), ("d", 1, "child"), (None, None, "cycle"), (None, None, "cycle")]


def test_spans_are_placed_by_trace_as_by_steps(spark, monkeypatch):
    """One shuffle for all traces that fit a task: no checkpoint of the spans, the same places as the steps give."""
    import unittest.mock

    from pyspark.sql import Row

    from topicflow.operators import tracing
    rng, rows = random.Random(5), []
    for t in range(300):
        ids = [f"{rng.choice(['a', 'Z', 'é', '0'])}{i}" for i in range(rng.choice([1, 2, 3, 5, 40]))]
        rows += [(f"t{t % 290}", s, rng.choice([None, "gone", *ids[:i], *ids]), i) for i, s in enumerate(ids)]
    rows += [(None, f"n{i}", "x", i) for i in range(50)] + [("t1", None, "a0", i) for i in range(50)]
    rows += [("hot", f"h{i}", f"h{i - 1}" if i else None, i) for i in range(500)]
    rows += rng.sample(rows, 200) + [(t, s, "other", -1) for t, s, _, _ in rng.sample(rows, 100)]
    spans = spark.createDataFrame(rows, "trace_id string, span_id string, parent_span_id string, note int").repartition(3)
    want = sorted(map(str, span_trees(spans).collect()))
    kept, frame = [], type(spans)
    real = frame.checkpoint
    monkeypatch.setattr(tracing, "FEW_SPANS", 0)
    with unittest.mock.patch.object(frame, "checkpoint", lambda df, *a, **k: (kept.append(out := real(df, *a, **k)), out)[1]):
        assert sorted(map(str, span_trees(spans).collect())) == want and not kept
        monkeypatch.setattr(tracing, "TRACE_SPANS", 300)
        assert sorted(map(str, span_trees(spans).collect())) == want and max(x.count() for x in kept) == 500  # the hot trace alone
    assert span_trees(spans.limit(0)).collect() == [] and tracing._placed_by_trace(spans.limit(0)).collect() == []
    assert tracing._placed_by_trace(spans).schema.names == span_trees(spans.limit(0)).schema.names
    only = tracing._placed_by_trace(spans.where("trace_id is null")).first()
    assert isinstance(only, Row) and only.kind is None and only.path is None
