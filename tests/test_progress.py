"""Offsets, numbering, positions, rates and sampling."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from topicflow.operators import groups as G
from topicflow.operators import progress as P
from topicflow.operators.publish import assign_offsets, assign_partition
from topicflow.operators.ranking import range_row_number


def test_numbering_of_sparse_and_repeated_keys(spark):
    """Hashed keys, and one key on half of the rows: numbers are dense in key order and the rows are spread."""
    rnd = random.Random(7)
    rows = [("hot" if i % 3 else f"g{i % 11}", 5 if i % 2 else rnd.randrange(-2**62, 2**62), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, k bigint, i int").repartition(8)
    got = range_row_number(df, ["g"], ["k"], out="n").collect()
    assert sorted((r.g, r.k, r.i) for r in got) == sorted(rows)
    for g in {r.g for r in got}:
        own = sorted((r.n, r.k) for r in got if r.g == g)
        assert [n for n, _ in own] == list(range(1, len(own) + 1)) and [k for _, k in own] == sorted(k for _, k in own)
    from topicflow.operators.ranking import place_rows
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # which would join so few rows again
    try:
        same = place_rows(df, ["g"], ["k"]).where("g = 'hot' and k = 5")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert same.select("_tf_pid").distinct().count() > 1


def test_offsets_dense_and_continue_existing_log(spark):
    df = spark.range(0, 500).select(F.col("id").alias("seq"), F.lit("t").alias("topic"),
                                    (F.col("id") % 7).cast("string").alias("k"))
    df = assign_partition(df, "k", 3)
    both = assign_offsets(df, "seq")
    chk = P.order_check(both).collect()
    assert all(r.dense and r.begin_offset == 0 for r in chk)
    # the same key always lands in the same partition
    assert both.groupBy("k").agg(F.count_distinct("partition").alias("n")).where("n > 1").count() == 0


def test_positions_after_two_records(spark):
    df = spark.createDataFrame([("g", "t", 0, 0), ("g", "t", 0, 1)],
                               "group string, topic string, partition int, offset bigint")
    r = G.positions(df).first()
    assert r.committed == 2


def test_next_fetch_runs_ahead_of_the_commit(spark):
    df = spark.createDataFrame([("t", 0, i, f"2024-01-0{i + 1} 12:00:00") for i in range(6)] + [("t", 0, 6, None)],
                               "topic string, partition int, offset bigint, at string") \
        .withColumn("timestamp", F.col("at").cast("timestamp"))
    groups = [G.Group("g", ("t",), "latest", joined_at="2024-01-02 00:00:00", consumed_until="2024-01-03 00:00:00",
                      fetched_until="2024-01-05 00:00:00"),
              G.Group("e", ("t",), "earliest"), G.Group("n", ("t",), "latest")]
    got = {r.group: (r.start_offset, r.committed, r.next_fetch, r.has_committed)
           for r in G.group_positions(df, groups).collect()}
    assert got == {"g": (1, 2, 4, True), "e": (0, 0, 0, False), "n": (7, 7, 7, False)}


def test_summaries_equal_the_fan_out(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice("abc"), rnd.randrange(3), i, f"2024-01-{rnd.randrange(1, 29):02d} 0{rnd.randrange(10)}:00:00")
            for i in range(500)]
    df = spark.createDataFrame(rows, "topic string, partition int, offset bigint, at string") \
        .withColumn("timestamp", F.col("at").cast("timestamp")).drop("at")
    groups = [G.Group("x", ("a", "b"), "earliest", consumed_until="2024-01-20 00:00:00"),
              G.Group("y", ("b", "c"), "latest", joined_at="2024-01-05 00:00:00", consumed_until="2024-01-15 00:00:00")]
    for flag in ("started", "consumed"):
        whole = G.fan_out(df, groups).where(flag).groupBy("group", "topic", "partition").agg(
            F.count("*"), F.min("offset"), F.max("offset"), F.min("timestamp"), F.max("timestamp"))
        small = G.fan_out_summary(G.interval_summary(df, groups), groups).where(flag).groupBy(
            "group", "topic", "partition").agg(F.sum("records"), F.min("first_offset"), F.max("last_offset"),
                                               F.min("first_ts"), F.max("last_ts"))
        assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, small.collect()))


def test_rate_zero_span_is_count(spark):
    at = F.lit("2024-01-01 00:00:00").cast("timestamp")
    df = spark.createDataFrame([("g", 4)], "group string, records bigint").withColumns({"first_ts": at, "last_ts": at})
    r = P.throughput(df).first()
    assert r.seconds == 0 and r.rate == 4.0


def test_every_nth_offset(spark):
    df = spark.createDataFrame([(0,), (2999,), (3000,)], "offset bigint")
    assert [r[0] for r in P.every_nth_offset(df, 3000).collect()] == [0, 3000]


def test_lag_from_positions(spark):
    log = spark.createDataFrame([("t", 0, 0, 5), ("t", 1, 1, 5)],
                                "topic string, partition int, log_begin_offset bigint, log_end_offset bigint")
    pos = spark.createDataFrame([("g", "t", 0, 3)], "group string, topic string, partition int, committed bigint")
    got = {(r.partition): (r.current_offset, r.lag) for r in G.lag_from_positions(log, pos).collect()}
    assert got == {0: (3, 2), 1: (1, 4)}


def test_range_row_number_with_hot_group_and_burst(spark):
    """A third of the rows in one reader, most of them at the same instant: numbering is
    exact and the burst is spread over several tasks."""
    rows = []
    for i in range(3000):
        g = "hot" if i % 3 == 0 else f"g{i % 7}"
        ts = "2024-01-01 00:00:00" if i % 3 == 0 and i % 2 == 0 else f"2024-01-01 00:{i % 60:02d}:00"
        rows.append((g, ts, "t", i % 4, i))
    df = spark.createDataFrame(rows, "group string, ts string, topic string, partition int, offset bigint") \
        .withColumn("timestamp", F.col("ts").cast("timestamp")).drop("ts")
    order = ["timestamp", "topic", "partition", "offset"]
    got = range_row_number(df, ["group"], order, out="n")
    want = df.withColumn("n", F.row_number().over(Window.partitionBy("group").orderBy(*order)).cast("bigint"))
    assert got.exceptAll(want.select(*got.columns)).count() == 0
    assert want.select(*got.columns).exceptAll(got).count() == 0
    spread = (df.repartitionByRange(8, "group", *order)
              .where((F.col("group") == "hot") & (F.col("timestamp") == F.lit("2024-01-01").cast("timestamp")))
              .select(F.spark_partition_id().alias("p")).distinct().count())
    assert spread > 1


def test_lag_from_ends(spark):
    ends = spark.createDataFrame([("t", 0, 0, 10), ("t", 1, 0, 4)],
                                 "topic string, partition int, log_begin_offset bigint, log_end_offset bigint")
    pos = spark.createDataFrame([("t", 0, 7)], "topic string, partition int, committed bigint")
    got = {r.partition: (r.current_offset, r.lag) for r in G.lag_from_ends(ends, pos, "w").collect()}
    assert got == {0: (7, 3), 1: (0, 4)}


def test_fan_out_only_subscribed_topics(spark):
    recs = spark.createDataFrame([("a", 0, 0), ("b", 0, 0), ("zzz", 0, 0)],
                                 "topic string, partition int, offset bigint") \
        .withColumn("timestamp", F.lit("2024-01-02").cast("timestamp"))
    groups = [G.Group("g1", ("a", "b"), "earliest"),
              G.Group("g2", ("b",), "latest", joined_at="2024-01-01 00:00:00",
                      consumed_until="2024-01-03 00:00:00")]
    got = sorted((r.topic, r.group, r.started, r.consumed) for r in G.fan_out(recs, groups).collect())
    assert got == [("a", "g1", True, False), ("b", "g1", True, False), ("b", "g2", True, True)]
