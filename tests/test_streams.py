"""Streaming: resume from the checkpoint, exactly-once batch output, dedup, JSON lines."""

import os

import pytest
from pyspark.sql import functions as F

from topicflow.operators.progress import order_check, rate_window
from topicflow.operators.publish import assign_partition, delivery_report, forget_old_ends, publish, read_log_ends
from topicflow.schema import ENVELOPE
from topicflow.sources.files import read_jsonl, read_numbered_jsonl
from topicflow.sources.topics import read_topic
from topicflow.streaming import stateful as SF
from topicflow.streaming import streams as ST


def _records(spark, lo, hi):
    return assign_partition(
        spark.range(lo, hi).select(
            F.col("id").alias("seq"), F.lit("t").alias("topic"),
            F.col("id").cast("string").cast("binary").alias("key"),
            F.to_json(F.struct(F.col("id").alias("n"))).cast("binary").alias("value"),
            F.lit("2024-01-01").cast("timestamp").alias("timestamp")),
        F.col("seq").cast("string"), 2)


def test_resume_reads_nothing_twice(spark, scratch):
    root, out, ck = scratch("log"), scratch("out"), scratch("ck")
    publish(_records(spark, 0, 50), root, "seq")

    def run():
        s = read_topic(spark, root, "t", streaming=True).select(
            "topic", "partition", "offset", F.lit(None).cast("string").alias("reason"))
        ST.await_all([ST.run_worker(s, lambda b: b, out, ck)])

    run()
    run()  # nothing new: no batch, no duplicate
    publish(_records(spark, 50, 80), root, "seq")
    run()
    got = ST.read_outcome(spark, out)
    assert got.count() == 80
    assert got.select("topic", "partition", "offset").distinct().count() == 80


def test_replayed_batch_overwrites_its_output(spark, scratch):
    out = scratch("out")
    df = spark.range(10).withColumn("outcome", F.lit("ok"))
    ST.write_batch(df, out, 3)
    ST.write_batch(df, out, 3)  # the same batch again after a failure
    assert spark.read.parquet(out).count() == 10


def test_worker_keeps_rejects(spark, scratch):
    root, out, ck = scratch("log"), scratch("out"), scratch("ck")
    recs = _records(spark, 0, 20).withColumn(
        "value", F.when(F.col("seq") % 5 == 0, F.lit("oops").cast("binary")).otherwise(F.col("value")))
    publish(recs, root, "seq")
    s = read_topic(spark, root, "t", streaming=True)

    def transform(b):
        d = b.select("topic", "partition", "offset",
                     F.from_json(F.col("value").cast("string"), "n bigint")["n"].alias("n"))
        return d.withColumn("reason", F.when(F.col("n").isNull(), F.lit("decode")))

    ST.await_all([ST.run_worker(s, transform, out, ck)])
    assert ST.read_outcome(spark, out, ST.OK).count() == 16
    assert ST.read_outcome(spark, out, ST.REJECTED).count() == 4


def test_jsonl_blank_and_padded_lines(spark, scratch):
    d = scratch("jsonl")
    with open(f"{d}/a.jsonl", "w") as f:
        f.write('{"order_id": 1}\n\n   \n \t\n\t {"order_id": 2} \t\n')
    got = [bytes(r.value).decode() for r in read_jsonl(spark, d).collect()]
    assert got == ['{"order_id": 1}', '{"order_id": 2}']


def test_line_numbers_of_split_files(spark, scratch):
    d = scratch("jsonl")
    want = {}
    for name, n in (("a", 4000), ("b", 7)):
        lines = [f'{{"n": {i}}}' if i % 5 else "  " for i in range(n)]
        with open(f"{d}/{name}.jsonl", "w") as f:
            f.write("\n".join(lines) + "\n")
        want |= {(name, i + 1): line for i, line in enumerate(lines) if line.strip()}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")  # many splits per file
    try:
        got = read_numbered_jsonl(spark, d).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {(r.file.rsplit("/", 1)[1][0], r.line_no): bytes(r.value).decode() for r in got} == want


def test_bounded_fetch_progress_and_stop(spark, scratch):
    """maxFilesPerTrigger bounds each micro-batch; observe() metrics reach the listener;
    a processing-time query stopped and restarted on its checkpoint loses nothing."""
    import time

    root, out, ck = scratch("log"), scratch("out"), scratch("ck")
    for lo in range(0, 40, 10):  # four appends → several files
        publish(_records(spark, lo, lo + 10), root, "seq")
    listener = ST.ProgressLog()
    spark.streams.addListener(listener)
    try:
        s = read_topic(spark, root, "t", streaming=True, options={"maxFilesPerTrigger": "1"})
        s = ST.observed(s, "seen", F.count(F.lit(1)).alias("records"))
        ST.await_all([ST.copy_stream(s.select("topic", "partition", "offset"), out, ck)])
        deadline = time.time() + 10
        while time.time() < deadline and sum(p["rows"] for p in listener.progress) < 40:
            time.sleep(0.2)
        batches = [p for p in listener.progress if p["rows"] > 0]
        assert len(batches) > 1
        assert sum(p["metrics"]["seen"]["records"] for p in batches) == 40
    finally:
        spark.streams.removeListener(listener)
    assert spark.read.parquet(out).count() == 40

    # processing-time trigger: idle notice, clean stop, append, restart on the same checkpoint
    out2, ck2 = scratch("out2"), scratch("ck2")
    idle = ST.ProgressLog()
    spark.streams.addListener(idle)
    try:
        q = ST.copy_stream(read_topic(spark, root, "t", streaming=True)
                           .select("topic", "partition", "offset"), out2, ck2, trigger="1 second")
        q.processAllAvailable()
        deadline = time.time() + 20
        while time.time() < deadline and str(q.id) not in idle.idle:
            time.sleep(0.5)
        assert str(q.id) in idle.idle  # no new data → the listener hears the query is idle
        q.stop()
    finally:
        spark.streams.removeListener(idle)
    publish(_records(spark, 40, 50), root, "seq")
    ST.await_all([ST.copy_stream(read_topic(spark, root, "t", streaming=True)
                                 .select("topic", "partition", "offset"), out2, ck2)])
    got = spark.read.parquet(out2)
    assert got.count() == 50 and got.distinct().count() == 50


def test_republishing_an_id_does_not_duplicate(spark, scratch):
    """A publish re-run under its id (after a failure) replaces its files; one without an id appends."""
    root = scratch("log")
    publish(_records(spark, 0, 20), root, "seq", publish_id="a")
    publish(_records(spark, 0, 20), root, "seq", publish_id="a")
    report = publish(_records(spark, 20, 30), root, "seq")
    log = read_topic(spark, root, "t")
    assert log.count() == 30 and report.where("status = 'delivered'").count() == 10
    assert all(r.dense and r.begin_offset == 0 for r in order_check(log).collect())
    assert sum(r.log_end_offset for r in read_log_ends(spark, root).collect()) == 30
    publish(_records(spark, 0, 20), root, "seq")
    publish(_records(spark, 0, 20), root, "seq")
    assert read_topic(spark, root, "t").count() == 70
    assert all(r.dense for r in order_check(read_topic(spark, root, "t")).collect())
    forget_old_ends(spark, root, keep=2)
    publish(_records(spark, 0, 5), root, "seq")
    assert sum(r.log_end_offset for r in read_log_ends(spark, root).collect()) == 75


def test_publish_numbers_null_and_repeated_keys_and_reports_failures(spark, scratch):
    root = scratch("log")
    recs = _records(spark, 0, 40).withColumns({
        "seq": F.when(F.col("seq") % 2 == 0, F.lit(7)).otherwise(F.when(F.col("seq") > 20, F.xxhash64("seq"))),
        "topic": F.when(F.col("key").cast("string") == "3", F.lit(None)).otherwise(F.col("topic")),
        "partition": F.when(F.col("key").cast("string") == "4", F.lit(None)).otherwise(F.col("partition"))})
    rows = delivery_report(publish(recs, root, "seq"), "key").collect()
    failed = {bytes(r.key).decode(): r.error for r in rows if r.status == "failed"}
    assert len(rows) == 40 and failed == {"3": "missing:topic", "4": "missing:partition"}
    log = read_topic(spark, root, "t")
    assert log.count() == 38 and all(r.dense for r in order_check(log).collect())
    kept = spark.read.parquet(f"{root}/_rejects").collect()
    assert sorted((bytes(r.key).decode(), r.error) for r in kept) == sorted(failed.items())


def test_publish_stream_appends_and_passes_blank_files(spark, scratch):
    """A new stream on a filled log keeps what is there; a blank file is an empty micro-batch."""
    d, root = scratch("in"), scratch("log")
    publish(_records(spark, 0, 20), root, "seq")
    for i, text in enumerate(('{"n": 1}\n{"n": 2}\n', " \n\t\n", '{"n": 3}\n')):
        with open(f"{d}/f{i}.jsonl", "w") as f:
            f.write(text)
    src = read_jsonl(spark, d, streaming=True, options={"maxFilesPerTrigger": "1"})
    ck = scratch("ck")
    for _ in range(2):
        ST.await_all([ST.publish_stream(src.withColumn("topic", F.lit("t")).drop("file"), root, ck, partitions=2)])
    log = read_topic(spark, root, "t")
    assert log.count() == 23 and all(r.dense for r in order_check(log).collect())
    empty = scratch("none")
    publish(_records(spark, 0, 0), empty, "seq")
    assert read_log_ends(spark, empty).count() == 0


def _two_months(spark, scratch):
    """A log of four publishes, newest first, over more than 60 days."""
    root = scratch("log")
    for lo in (30, 20, 10, 0):
        recs = _records(spark, lo, lo + 10).withColumn(
            "timestamp", F.timestamp_add("DAY", (F.col("seq") * 2).cast("int"), F.lit("2024-01-01").cast("timestamp")))
        publish(recs, root, "seq")
    return root


def test_streams_do_not_depend_on_micro_batches(spark, scratch):
    root = _two_months(spark, scratch)
    replay, out = scratch("replay"), scratch("out")
    src = spark.read.schema(ENVELOPE).parquet(root)
    for _ in range(2):
        src.write.mode("append").partitionBy("topic", "partition").parquet(replay)
    one = {"maxFilesPerTrigger": "1"}
    s = read_topic(spark, replay, "t", streaming=True, options=one).select("topic", "partition", "offset", "timestamp")
    ST.await_all([SF.dedup_stream(s, f"{out}/dedup", scratch("ck"))])
    got = spark.read.parquet(f"{out}/dedup")
    assert got.count() == 40 and got.select("topic", "partition", "offset").distinct().count() == 40
    s = read_topic(spark, root, "t", streaming=True, options=one)
    ST.await_all([ST.window_counts(s, f"{out}/windows", scratch("ck"), "3 days")])
    want = rate_window(src, "3 days").select("topic", "window_start", "window_end", "records")
    got = ST.read_window_counts(spark, f"{out}/windows").select(*want.columns)
    assert sorted(got.collect()) == sorted(want.collect())


def test_late_rows_and_timeouts_are_errors(spark, scratch):
    root = _two_months(spark, scratch)
    s = read_topic(spark, root, "t", streaming=True, options={"maxFilesPerTrigger": "1"})
    counts = s.withWatermark("timestamp", "1 day").groupBy(F.window("timestamp", "1 day")).count().select("count")
    with pytest.raises(RuntimeError, match="behind its watermark"):
        ST.await_all([ST.copy_stream(counts, scratch("out"), scratch("ck"))])
    q = ST.copy_stream(s.select("offset"), scratch("out"), scratch("ck"), trigger="1 hour")
    try:
        with pytest.raises(TimeoutError):
            ST.await_all([q], timeout_s=0.5)
    finally:
        q.stop()


def test_outcome_of_a_worker_that_met_no_record(spark, scratch):
    assert ST.read_outcome(spark, f"{scratch('out')}/none", schema="offset bigint").count() == 0
    with pytest.raises(ValueError):
        ST.read_outcome(spark, f"{scratch('out')}/none")


def test_checkpoint_folder_must_be_shared_off_local_masters(spark, monkeypatch):
    from topicflow import session
    monkeypatch.setattr(session, "_LOCAL_BASE", {})
    monkeypatch.setattr(session, "_is_local", lambda spark: False)

    class Bare:
        sparkContext = None
        conf = type("C", (), {"get": staticmethod(lambda k, d=None: d)})
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_dir(Bare())


def test_publish_stream_continues_offsets(spark, scratch):
    """Stream → log: several micro-batches, offsets dense across them."""
    d, root = scratch("in"), scratch("log")
    for i in range(3):
        with open(f"{d}/f{i}.jsonl", "w") as f:
            f.write("\n".join(f'{{"n": {i * 100 + j}}}' for j in range(25)) + "\n")
    src = read_jsonl(spark, d, streaming=True, options={"maxFilesPerTrigger": "1"})
    src = src.withColumn("topic", F.lit("t")).drop("file")
    q = ST.publish_stream(src, root, scratch("ck"), partitions=2)
    ST.await_all([q])
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 3
    log = read_topic(spark, root, "t")
    assert log.count() == 75
    assert all(r.dense and r.begin_offset == 0 for r in order_check(log).collect())


def _crash_once_after(real, is_batch):
    """Wrap a batch writer: the first time it has written the batch in question, fail right after the
    write, as a driver crash between writing and committing would."""
    state = {"crashed": False}

    def wrapper(*args, **kwargs):
        real(*args, **kwargs)
        if is_batch(args, kwargs) and not state["crashed"]:
            state["crashed"] = True
            raise RuntimeError("simulated crash after write, before commit")
    return wrapper


def test_worker_crash_between_write_and_commit(spark, scratch, monkeypatch):
    root, out, ck = scratch("log"), scratch("out"), scratch("ck")
    for lo in range(0, 40, 10):
        publish(_records(spark, lo, lo + 10), root, "seq")
    monkeypatch.setattr(ST, "write_batch", _crash_once_after(ST.write_batch, lambda a, k: a[2] == 1))

    def start():
        s = read_topic(spark, root, "t", streaming=True, options={"maxFilesPerTrigger": "2"})
        s = s.select("topic", "partition", "offset", F.lit(None).cast("string").alias("reason"))
        return ST.run_worker(s, lambda b: b, out, ck)

    with pytest.raises(Exception):
        ST.await_all([start()])
    ST.await_all([start()])  # restart: batch 1 is replayed and overwrites its own output
    got = ST.read_outcome(spark, out)
    assert got.count() == 40
    assert got.select("topic", "partition", "offset").distinct().count() == 40


def test_publish_stream_crash_between_write_and_commit(spark, scratch, monkeypatch):
    from topicflow.operators import publish as PUB

    d, root, ck = scratch("in"), scratch("log"), scratch("ck")
    for i in range(3):
        with open(f"{d}/f{i}.jsonl", "w") as f:
            f.write("\n".join(f'{{"n": {i * 100 + j}}}' for j in range(20)) + "\n")
    monkeypatch.setattr(PUB, "publish", _crash_once_after(PUB.publish, lambda a, k: k["publish_id"].endswith("-1")))

    def start():
        src = read_jsonl(spark, d, streaming=True, options={"maxFilesPerTrigger": "1"})
        return ST.publish_stream(src.withColumn("topic", F.lit("t")).drop("file"), root, ck,
                                 partitions=2)

    with pytest.raises(Exception):
        ST.await_all([start()])
    ST.await_all([start()])
    log = read_topic(spark, root, "t")
    assert log.count() == 60
    assert all(r.dense and r.begin_offset == 0 for r in order_check(log).collect())


def test_latest_start_on_the_file_log(spark, scratch):
    """'latest' skips what the log held at the first start, reads what comes after, and after
    a restart still reads records that arrived while the stream was down."""
    root, out, ck = scratch("log"), scratch("out"), scratch("ck")
    publish(_records(spark, 0, 20), root, "seq")

    def run():
        s = read_topic(spark, root, "t", streaming=True, start="latest", checkpoint=ck)
        ST.await_all([ST.copy_stream(s.select("topic", "partition", "offset",
                                              F.col("key").cast("string").alias("k")), out, ck)])

    run()
    assert spark.read.parquet(out).count() == 0
    publish(_records(spark, 20, 30), root, "seq")
    run()
    publish(_records(spark, 30, 45), root, "seq")
    run()
    got = sorted(int(r.k) for r in spark.read.parquet(out).collect())
    assert got == list(range(20, 45))


def test_topic_pattern_prunes_folders(spark, scratch):
    root = scratch("log")
    recs = _records(spark, 0, 30).withColumn(
        "topic", F.when(F.col("seq") < 10, "demo.a").when(F.col("seq") < 20, "demo.b").otherwise("other"))
    publish(recs, root, "seq")
    df = read_topic(spark, root, pattern=r"^demo\.")
    assert df.count() == 20
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    assert "PartitionFilters: [isnotnull(topic" in buf.getvalue() and "RLIKE" in buf.getvalue()


def test_positions_from_checkpoint(spark, scratch):
    """Kafka-source offsets as Spark writes them (offsets/<n>, commits/<n>): the latest
    committed batch gives the group's positions; a file-source checkpoint gives none."""
    import os
    ck = scratch("kafka-ck")
    os.makedirs(f"{ck}/offsets"); os.makedirs(f"{ck}/commits")
    meta = '{"batchWatermarkMs":0,"batchTimestampMs":1,"conf":{}}'
    for n, offs in enumerate(['{"demo.orders":{"0":5,"1":3}}', '{"demo.orders":{"0":9,"1":4}}',
                              '{"demo.orders":{"0":12,"1":8}}']):
        with open(f"{ck}/offsets/{n}", "w") as f:
            f.write(f"v1\n{meta}\n{offs}")
    for n in (0, 1):  # batch 2 was planned but not committed
        with open(f"{ck}/commits/{n}", "w") as f:
            f.write('v1\n{"nextBatchWatermarkMs":0}')
    got = {r.partition: r.committed for r in ST.positions_from_checkpoint(spark, ck).collect()}
    assert got == {0: 9, 1: 4}
    with open(f"{ck}/offsets/1", "w") as f:
        f.write(f"v7\n{meta}\n" + '{"demo.orders":{"0":9,"1":4}}')
    with pytest.raises(ValueError, match="v7"):
        ST.positions_from_checkpoint(spark, ck)

    root, out, ck2 = scratch("log"), scratch("out"), scratch("ck")
    publish(_records(spark, 0, 5), root, "seq")
    ST.await_all([ST.copy_stream(read_topic(spark, root, "t", streaming=True)
                                 .select("topic", "partition", "offset"), out, ck2)])
    assert ST.positions_from_checkpoint(spark, ck2).count() == 0


def test_publish_stream_stores_a_batch_once_compressed_and_in_order(spark, scratch, monkeypatch):
    from topicflow.session import checkpoint_base
    frame = type(spark.range(0))
    src, root, kept, real = scratch("in"), scratch("log"), [], frame.checkpoint
    spark.range(0, 4000, numPartitions=3).select(F.concat(F.lit("line "), F.col("id"), F.lit(" "), F.repeat(F.lit("x"), 500))) \
        .write.mode("overwrite").option("compression", "gzip").text(src)
    before = set(os.listdir(checkpoint_base(spark).removeprefix("file:")))
    monkeypatch.setattr(frame, "checkpoint", lambda df, *a, **k: kept.append(df.columns) or real(df, *a, **k))
    monkeypatch.setattr(frame, "repartitionByRange", lambda *a: 1 / 0)
    lines = read_jsonl(spark, src, streaming=True).withColumn("topic", F.lit("t"))
    ST.await_all([ST.publish_stream(lines, root, scratch("ck"), partitions=2)])
    assert kept and not any("value" in columns for columns in kept)  # a row for each task at most
    assert not [x for x in set(os.listdir(checkpoint_base(spark).removeprefix("file:"))) - before if x.startswith("publish-")]
    rows = read_topic(spark, root, "t").select("partition", "offset", "value").collect()
    assert sorted(int(bytes(r.value).split()[1]) for r in rows) == list(range(4000))
    for p in (0, 1):  # dense offsets, in the lines' order within a file
        own = [int(bytes(r.value).split()[1]) for r in sorted(rows, key=lambda r: r.offset) if r.partition == p]
        assert [r.offset for r in sorted(rows, key=lambda r: r.offset) if r.partition == p] == list(range(len(own)))
        assert sum(a > b for a, b in zip(own, own[1:])) < 3
