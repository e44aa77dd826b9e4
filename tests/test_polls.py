"""Bounded polls, start by time, publish history, key sketches."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from topicflow.operators import groups as G
from topicflow.operators.publish import assign_partition, publish, publish_history, stored_key_spread
from topicflow.sources.topics import read_since, read_topic
from topicflow.streaming import streams as ST
from topicflow.streaming.polls import Reader


def _records(spark, lo, hi, topic="t", n=3):
    return assign_partition(
        spark.range(lo, hi).select(
            F.col("id").alias("seq"), F.lit(topic).alias("topic"), F.col("id").cast("string").cast("binary").alias("key"),
            F.repeat(F.lit("x"), (F.col("id") % 7).cast("int")).cast("binary").alias("value"),
            F.timestamp_add("MINUTE", F.col("id").cast("int"), F.lit("2024-01-01").cast("timestamp")).alias("timestamp")),
        F.col("seq").cast("string"), n)


def _pruned_to(df, *versions):
    """Whether the scan is pruned to the folders of these publishes."""
    plan = io.StringIO()
    with contextlib.redirect_stdout(plan):
        df.explain("formatted")
    filters = re.search(r"PartitionFilters: \[(.*)\]", plan.getvalue()).group(1)
    wanted = f" = {versions[0]})" if len(versions) == 1 else f" IN ({','.join(map(str, versions))})"
    return re.search(r"batch#\d+L?" + re.escape(wanted), filters) is not None


def _positions(log):
    return sorted((r.topic, r.partition, r.offset) for r in log.select("topic", "partition", "offset").collect())


def test_polls_are_bounded_and_resume(spark, scratch):
    root, ck, seen = scratch("log"), scratch("ck"), []
    for lo in (0, 100, 230):
        publish(_records(spark, lo, {0: 100, 100: 230, 230: 250}[lo]), root, "seq")

    def handle(batch, number):
        seen.append((number, _positions(batch)))
    assert Reader(spark, root, "t", ck, max_records=40).drain(handle, max_polls=3) == 3
    reader = Reader(spark, root, "t", ck, max_records=40)  # a restart
    reader.drain(handle)
    publish(_records(spark, 250, 260), root, "seq")
    reader.drain(handle)
    assert [n for n, _ in seen] == list(range(len(seen))) and max(len(x) for _, x in seen) == 40
    assert sorted(p for _, x in seen for p in x) == _positions(read_topic(spark, root, "t"))
    committed = {r.partition: r.committed for r in ST.positions_from_checkpoint(spark, ck).collect()}
    ends = {r.partition: r.end_offset for r in G.topic_profile(read_topic(spark, root, "t")).collect()}
    assert committed == ends and reader.next_poll() is None
    assert reader.last.versions == [3] and _pruned_to(reader.records(reader.last), 3)


def test_a_poll_that_failed_comes_again(spark, scratch):
    root, ck, seen = scratch("log"), scratch("ck"), []
    publish(_records(spark, 0, 50), root, "seq")

    def handle(batch, number):
        seen.append((number, _positions(batch)))
        if len(seen) == 2:
            raise RuntimeError("handler failed")
    with pytest.raises(RuntimeError):
        Reader(spark, root, "t", ck, max_records=20).drain(handle)
    publish(_records(spark, 50, 60), root, "seq")
    Reader(spark, root, "t", ck, max_records=1000).drain(handle)
    assert seen[1] == seen[2]
    got = [p for _, x in [seen[0], *seen[2:]] for p in x]
    assert sorted(got) == _positions(read_topic(spark, root, "t"))
    a, b = (Reader(spark, root, "t", ck) for _ in range(2))
    publish(_records(spark, 60, 70), root, "seq")
    a.next_poll()
    b.store.read = lambda name: None  # looked before the other had planned
    with pytest.raises(RuntimeError, match="another reader"):
        b.next_poll()


def test_bytes_bound_a_poll_and_a_huge_record_passes(spark, scratch):
    root, sizes = scratch("log"), []
    publish(_records(spark, 0, 300).withColumn("value", F.repeat(F.lit("y"), 1000).cast("binary")), root, "seq")
    publish(_records(spark, 300, 303).withColumn("value", F.repeat(F.lit("z"), 100_000).cast("binary")), root, "seq")

    def handle(batch, number):
        sizes.append(batch.agg(F.count("*"), F.sum(F.octet_length("value"))).first())
    Reader(spark, root, "t", scratch("ck"), max_records=10_000, max_bytes=50_000).drain(handle)
    assert sum(n for n, _ in sizes) == 303
    assert all(size <= 50_000 or n == 1 for n, size in sizes) and len(sizes) == 7 + 3


def test_latest_start_topics_and_publishes_in_flight(spark, scratch, monkeypatch):
    from topicflow.operators import publish as PUB
    root, ck, seen = scratch("log"), scratch("ck"), []
    publish(_records(spark, 0, 30), root, "seq")
    reader = Reader(spark, root, "t", ck, start="latest")
    assert reader.drain(lambda b, n: seen.append(b.count())) == 0
    publish(_records(spark, 0, 30, "other"), root, "seq")
    with monkeypatch.context() as m:
        m.setattr(PUB, "to_envelope", lambda df: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            publish(_records(spark, 30, 40), root, "seq", publish_id="a")
    publish(_records(spark, 40, 45), root, "seq")
    reader = Reader(spark, root, "t", ck, start="latest")
    assert reader.drain(lambda b, n: seen.append(b.count())) == 0  # what was reserved first isn't there yet
    publish(_records(spark, 30, 40), root, "seq", publish_id="a")
    reader.drain(lambda b, n: seen.append(b.count()))
    assert sum(seen) == 15


def test_start_by_time_reads_only_publishes_that_can_hold_it(spark, scratch):
    root = scratch("log")
    for lo in (0, 60, 120):
        publish(_records(spark, lo, lo + 60), root, "seq")
    publish(_records(spark, 180, 190).withColumn("timestamp", F.lit(None).cast("timestamp")), root, "seq")
    got = read_since(spark, root, "t", "2024-01-01 02:30:00")
    assert got.count() == 30
    assert _pruned_to(got, 2, 3)
    history = publish_history(spark, root)
    assert history.agg(F.sum("records")).first()[0] == 190 and history.count() == 12
    assert history.where("version = 3 and (first_ts is not null or last_ts is not null)").isEmpty()
    sizes = read_topic(spark, root, "t").agg(F.sum(F.octet_length("key") + F.octet_length("value"))).first()[0]
    assert history.agg(F.sum("bytes")).first()[0] == sizes


def test_key_sketches_are_merged_over_publishes(spark, scratch):
    root = scratch("log")
    for lo in (0, 3000, 1500):
        publish(_records(spark, lo, lo + 3000), root, "seq", publish_id=f"p{lo}", key_sketches=True)
    publish(_records(spark, 0, 3000), root, "seq", publish_id="p0", key_sketches=True)  # a replay counts once
    exact = {r.partition: r for r in G.key_spread(read_topic(spark, root, "t")).collect()}
    for r in stored_key_spread(spark, root).collect():
        assert r.records == exact[r.partition].records
        assert abs(r.distinct_keys - exact[r.partition].distinct_keys) <= 0.05 * exact[r.partition].distinct_keys


@pytest.mark.parametrize("most", [256, 1])  # bounds in the filter, or broadcast
def test_a_poll_shuffles_no_record(spark, scratch, monkeypatch, most):
    from topicflow.streaming import polls
    monkeypatch.setattr(polls, "MOST_LITERAL", most)
    root, seen = scratch("log"), []
    for lo in (0, 300):
        publish(_records(spark, lo, lo + 300), root, "seq")

    def handle(batch, number):
        plan = io.StringIO()
        with contextlib.redirect_stdout(plan):
            batch.explain()
        assert "hashpartitioning" not in plan.getvalue() and "offset" in re.search(r"PushedFilters: (.*)", plan.getvalue()).group(1)
        seen.append(_positions(batch))
    Reader(spark, root, "t", scratch("ck"), max_records=70).drain(handle)
    assert max(map(len, seen)) <= 70 and sorted(p for x in seen for p in x) == _positions(read_topic(spark, root, "t"))


def test_ranges_are_merged_to_few_that_cover_all():
    from topicflow.streaming.polls import _merged
    assert _merged([(5, 9), (0, 3), (3, 4), (8, 12)]) == [(0, 4), (5, 12)]
    assert _merged([(0, 1), (10, 11), (12, 13), (40, 41)], most=2) == [(0, 13), (40, 41)]


def test_polls_fetched_ahead_are_the_same_polls(spark, scratch, monkeypatch):
    """One read of the log for several polls; what each hands over, its plan and its commit are as without."""
    from topicflow.session import checkpoint_base
    from topicflow.streaming import polls
    root, seen, reads, real = scratch("log"), {}, [], polls.read_publishes
    for lo in (0, 300, 307):
        publish(_records(spark, lo, {0: 300, 300: 307, 307: 600}[lo]), root, "seq")
    monkeypatch.setattr(polls, "read_publishes", lambda *a: reads.append(a) or real(*a))

    def run(ck, ahead, fail=None, max_polls=None):
        def handle(batch, number):
            if number == fail:
                raise RuntimeError("handler failed")
            assert batch.columns == read_topic(spark, root, "t").columns
            seen.setdefault((ck, number), sorted(map(str, batch.collect())))
        return Reader(spark, root, "t", ck, max_records=40, ahead=ahead).drain(handle, max_polls)
    one, many = scratch("ck"), scratch("ck")
    run(one, 1)
    single, reads[:] = len(reads), []
    with pytest.raises(RuntimeError):
        run(many, 6, fail=4)
    run(many, 6, max_polls=3)
    publish(_records(spark, 600, 630), root, "seq")
    run(one, 1), reads.clear()
    run(many, 6)
    got = [[(n, v) for (ck, n), v in sorted(seen.items()) if ck == x] for x in (one, many)]
    assert [v for _, v in got[0]] and sorted(r for _, v in got[0] for r in v) == sorted(r for _, v in got[1] for r in v)
    assert [x for x in got[0][:15]] == [x for x in got[1][:15]] and max(len(v) for _, v in got[1]) == 40
    assert len(reads) <= 3 < single and sorted(r for _, v in got[1] for r in v) == sorted(map(str, read_topic(spark, root, "t").collect()))
    import os
    assert not [x for x in os.listdir(checkpoint_base(spark).removeprefix("file:")) if x.startswith("fetched-")]
