"""Several writers on one log: no record lost, offsets dense, replays idempotent."""

import threading

import pytest
from pyspark.sql import functions as F

from topicflow.operators import publish as PUB
from topicflow.operators.progress import order_check
from topicflow.operators.publish import assign_partition, forget_old_ends, publish, read_log_ends, unfinished_publishes
from topicflow.sources.store import Store
from topicflow.sources.topics import read_topic


def _records(spark, lo, hi, topic="t"):
    return assign_partition(
        spark.range(lo, hi).select(
            F.col("id").alias("seq"), F.lit(topic).alias("topic"), F.col("id").cast("string").cast("binary").alias("key")),
        F.col("seq").cast("string"), 2)


def _dense(spark, root, n, topic="t"):
    log = read_topic(spark, root, topic)
    assert log.count() == n and log.select("key").distinct().count() == n
    assert all(r.dense and r.begin_offset == 0 for r in order_check(log).collect())


def _together(*jobs):
    failed = []

    def run(job):
        try:
            job()
        except Exception as e:  # noqa: BLE001
            failed.append(e)
    threads = [threading.Thread(target=run, args=(j,)) for j in jobs]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed, failed


def test_two_publishes_at_the_same_time_lose_nothing(spark, scratch):
    root = scratch("log")
    publish(_records(spark, 0, 100), root, "seq")
    _together(*(lambda lo=lo: publish(_records(spark, lo, lo + 1000), root, "seq") for lo in (100, 1100)))
    _dense(spark, root, 2100)
    assert sum(r.log_end_offset for r in read_log_ends(spark, root).collect()) == 2100
    assert PUB.Versions(spark, root).numbers() == [0, 1, 2] and unfinished_publishes(spark, root) == []


def test_five_writers_on_a_new_log(spark, scratch):
    root = scratch("log")
    _together(*(lambda i=i: publish(_records(spark, i * 40, i * 40 + 40, "t" if i % 2 else "u"), root, "seq") for i in range(5)))
    _dense(spark, root, 80)
    _dense(spark, root, 120, "u")


def test_only_the_bases_change_when_another_writer_was_first(spark, scratch, monkeypatch):
    root = scratch("log")
    real, state = Store.create, {"second": None}

    def create(store, name, text):  # another publish claims the version between the look and the claim
        if state["second"] is None:
            state["second"] = True
            publish(_records(spark, 50, 80), root, "seq")
        return real(store, name, text)
    monkeypatch.setattr(Store, "create", create)
    report = publish(_records(spark, 0, 50), root, "seq", publish_id="late")
    _dense(spark, root, 80)
    least = {r.partition: r.least for r in report.groupBy("partition").agg(F.min("offset").alias("least")).collect()}
    first = PUB.Versions(spark, root).read(0)
    assert least == {p: a.records for (_, p), a in first.added.items()}


def test_a_writer_that_died_after_its_claim_is_replayed(spark, scratch, monkeypatch):
    root = scratch("log")
    publish(_records(spark, 0, 10), root, "seq")

    def die(*args):
        raise RuntimeError("gone")
    with monkeypatch.context() as m:
        m.setattr(PUB, "to_envelope", die)
        with pytest.raises(RuntimeError):
            publish(_records(spark, 10, 30), root, "seq", publish_id="a")
    publish(_records(spark, 30, 40), root, "seq")
    assert unfinished_publishes(spark, root) == ["a"]
    assert not all(r.dense for r in order_check(read_topic(spark, root, "t")).collect())
    publish(_records(spark, 10, 30), root, "seq", publish_id="a")
    _dense(spark, root, 40)
    assert unfinished_publishes(spark, root) == []
    with pytest.raises(ValueError, match="other numbers"):
        publish(_records(spark, 10, 31), root, "seq", publish_id="a")


def test_ids_that_left_the_recent_list_are_known(spark, scratch, monkeypatch):
    monkeypatch.setattr(PUB, "RECENT", 2)
    root = scratch("log")
    for i in range(5):
        publish(_records(spark, i * 10, i * 10 + 10), root, "seq", publish_id=f"p{i}")
    for i in (0, 2, 4):
        publish(_records(spark, i * 10, i * 10 + 10), root, "seq", publish_id=f"p{i}")
    _dense(spark, root, 50)
    versions = PUB.Versions(spark, root)
    assert len(versions.last().recent) == 2 and versions.numbers() == [0, 1, 2, 3, 4]
    forget_old_ends(spark, root, keep=2)
    assert versions.numbers() == [3, 4]
    with pytest.raises(ValueError, match="removed"):
        publish(_records(spark, 0, 10), root, "seq", publish_id="p0")
    versions.store.delete("_log_ends/_last")  # the hint is only a hint
    publish(_records(spark, 50, 60), root, "seq")
    _dense(spark, root, 60)


def test_a_log_without_side_table_is_continued(spark, scratch):
    root = scratch("log")
    publish(_records(spark, 0, 20), root, "seq")
    Store(spark, root).delete("_log_ends")
    publish(_records(spark, 20, 50).where("partition = 0"), root, "seq", existing=read_topic(spark, root, "t"))
    log = read_topic(spark, root, "t")
    assert log.count() > 20 and all(r.dense for r in order_check(log).collect())
    assert sum(r.log_end_offset for r in read_log_ends(spark, root).collect()) == log.count()


@pytest.mark.parametrize("scheme", ["file", "viewfs"])
def test_the_store_creates_a_file_once(spark, scratch, scheme):
    root = scratch("store")
    if scheme == "viewfs":
        spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.writers.link./in", f"file://{root}")
        root = "viewfs://writers/in"
    store, won = Store(spark, root), []
    assert store.read("a/b") is None and store.names("a") == []
    _together(*(lambda i=i: won.append(i) if store.create("a/b", f"text {i} é") else None for i in range(4)))
    assert len(won) == 1 and store.read("a/b") == f"text {won[0]} é"
    assert not store.create("a/b", "later") and [n for n in store.names("a") if n[0] != "."] == ["b"]
    store.replace("a/b", "new")
    assert store.read("a/b") == "new"
    store.delete("a")
    assert store.read("a/b") is None


def test_encode_makes_the_records_once_and_stores_no_more(spark, scratch):
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def text(i):
        made.add(1)
        return f"{i:06d}" * 500
    root = scratch("log")
    source = spark.range(4000).select(F.col("id").alias("seq"), F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.lit("w").alias("wide"))
    report = publish(source, root, "seq", encode=lambda d: d.select("topic", "partition", text("seq").cast("binary").alias("value")))
    assert made.value == 4000 and "wide" not in report.columns and "_tf_key" not in report.columns
    got = read_topic(spark, root, "t").select("offset", F.col("value").cast("string").substr(1, 6).cast("int").alias("n")).collect()
    assert len(got) == 4000 and all(r.offset == r.n for r in got)
    assert PUB.Versions(spark, root).last().added["t", 0].bytes == 4000 * 3000


def test_a_file_of_the_log_has_parts_for_several_tasks(spark, scratch):
    import glob

    import pyarrow.parquet as pq

    root = scratch("log")
    value = F.concat(*[F.sha2(F.concat(F.col("id").cast("string"), F.lit(f"/{k}")), 512) for k in range(40)])
    publish(spark.range(4000).select(F.col("id").alias("seq"), F.lit("t").alias("topic"), F.lit(0).alias("partition"), value.cast("binary").alias("value")),
            root, "seq")
    for f in glob.glob(f"{root}/topic=t/partition=0/*/*.parquet"):  # 20 MB in all
        found = pq.ParquetFile(f).metadata
        assert max(found.row_group(i).column(c).total_compressed_size
                   for i in range(found.num_row_groups) for c in range(found.num_columns)) < 10 << 20
    assert read_topic(spark, root, "t").count() == 4000
