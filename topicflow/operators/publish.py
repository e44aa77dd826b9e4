"""Publishing tables to topics: partition choice, offsets, the append itself, delivery report.

The file log at ``<root>/topic=…/partition=…/batch=<version>/`` has a side table
``<root>/_log_ends/version=<n>/ends.json``: per topic partition its begin and end offset after each publish, how many
records and bytes that publish adds, their first and last time, and the publish's id (:func:`publish_history`). Any number of writers may publish at the same time. A writer counts
its records per topic partition, then claims the next version: a file that only one writer can create, with the ends
of the version before plus its own counts. The writer that comes second takes the new ends and claims the version
after; nothing but the bases of its offsets changes, and they are added when the records are written. So a claim
reserves a dense range of offsets per partition, and no two publishes share a folder.

A publish with an id that holds a claim (a replay after a failure) writes its own reserved range again. Each version
names the last ``RECENT`` publishes; an id that leaves that list gets a file of its own first, so that
finding an id or the latest ends costs a few small reads, however long the log is.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topicflow.functions.partitioning import choose_partition
from topicflow.operators.ranking import COUNT, number_rows, place_rows, range_row_number, task_starts
from topicflow.schema import ENVELOPE_COLUMNS
from topicflow.session import scratch_dir
from topicflow.sources.store import Store

# Producer settings of the demo producers, as sink options. The file log ignores the
# broker-only ones; the Kafka sink passes ``kafka.*`` through to its producer.
DURABLE_SINK_OPTIONS = {
    "kafka.acks": "all",
    "kafka.enable.idempotence": "true",
    "kafka.retries": "5",
    "kafka.linger.ms": "20",
    "kafka.batch.size": "65536",
    "kafka.compression.type": "lz4",
}

DELIVERED = "delivered"
FAILED = "failed"


def kafka_sink_options(servers: str, extra: dict | None = None) -> dict:
    """Options for Spark's Kafka sink: brokers plus the durable producer settings; ``extra``
    overrides. The sink takes ``topic`` and ``partition`` from the columns of each row."""
    return {"kafka.bootstrap.servers": servers, **DURABLE_SINK_OPTIONS, **(extra or {})}


def assign_partition(df: DataFrame, key_text: str | Column, n: int,
                     out: str = "partition", seq=None) -> DataFrame:
    """Same key → same partition (md5 rule); records without a key are spread evenly
    (round-robin by ``seq`` when given)."""
    return df.withColumn(out, choose_partition(key_text, n, seq))


def assign_offsets(df: DataFrame, order_key: str | Column, *, by: Sequence[str] = ("topic", "partition"),
                   tie_breakers: Sequence[str] = (), out: str = "offset") -> DataFrame:
    """Dense offsets from 0 per (topic, partition), in the order of ``order_key`` and the tie breakers.

    Any key will do: sparse, repeated or null (nulls come first).
    """
    keyed = df.withColumn("_tf_key", F.col(order_key) if isinstance(order_key, str) else order_key)
    numbered = range_row_number(keyed, by, ["_tf_key", *tie_breakers], out="_tf_rn")
    return numbered.withColumn(out, F.col("_tf_rn") - 1).drop("_tf_rn", "_tf_key")


def to_envelope(df: DataFrame) -> DataFrame:
    """Keep only envelope columns, in envelope order, filling optional ones with null."""
    cols = []
    for name in ENVELOPE_COLUMNS:
        if name in df.columns:
            cols.append(F.col(name))
        elif name == "headers":
            cols.append(F.lit(None).cast("array<struct<key:string,value:binary>>").alias(name))
        elif name == "timestamp":
            cols.append(F.current_timestamp().alias(name))
        else:
            cols.append(F.lit(None).cast("binary").alias(name))
    return df.select(*cols)


def log_ends(log: DataFrame) -> DataFrame:
    """(topic, partition, log_begin_offset, log_end_offset) by a scan of a log without side table."""
    return log.groupBy("topic", "partition").agg(
        F.min("offset").alias("log_begin_offset"), (F.max("offset") + 1).alias("log_end_offset"))


LOG_ENDS_DIR = "_log_ends"
REJECTS_DIR = "_rejects"
SKETCHES_DIR = "_key_sketches"
ENDS_SCHEMA = "topic string, partition int, log_begin_offset bigint, log_end_offset bigint"
RECENT = 1000
ROW_GROUP = 8 << 20  # bytes of a row group: a few files are read by many tasks, and offsets are found without the rest
LOG_FILES = {"parquet.block.size": ROW_GROUP, "compression": "zstd"}
Place = tuple[str, int]


class Added(NamedTuple):
    """What a publish adds to a partition; times in microseconds, None where no record has one."""

    records: int
    bytes: int | None = None
    first_us: int | None = None
    last_us: int | None = None


@dataclass
class Version:
    """One claim: begin and end offset of each topic partition after it, its own numbers of records, recent ids."""

    number: int
    publish_id: str | None
    ends: dict[Place, tuple[int, int]]
    added: dict[Place, Added]
    recent: list[tuple[str, int]]

    def base(self, place: Place) -> int:
        """The first offset of this publish in a partition."""
        return self.ends[place][1] - (self.added[place].records if place in self.added else 0)

    def text(self) -> str:
        rows = [{"topic": t, "partition": p, "log_begin_offset": b, "log_end_offset": e,
                 **self.added.get((t, p), Added(0))._asdict()} for (t, p), (b, e) in sorted(self.ends.items())]
        return "\n".join(json.dumps(r) for r in [{"publish_id": self.publish_id, "recent": self.recent}, *rows]) + "\n"

    @classmethod
    def parsed(cls, number: int, text: str) -> Version:
        head, *rows = map(json.loads, text.splitlines())
        places = [((r["topic"], r["partition"]), r) for r in rows]
        return cls(number, head["publish_id"], {k: (r["log_begin_offset"], r["log_end_offset"]) for k, r in places},
                   {k: Added(*(r[f] for f in Added._fields)) for k, r in places if r["records"]}, [(i, n) for i, n in head["recent"]])


class Versions:
    """The claims of a log."""

    def __init__(self, spark: SparkSession, root: str):
        self.store = Store(spark, root)

    def read(self, number: int) -> Version | None:
        text = self.store.read(f"{LOG_ENDS_DIR}/version={number}/ends.json")
        return None if text is None else Version.parsed(number, text)

    def numbers(self) -> list[int]:
        return sorted(int(n[len("version="):]) for n in self.store.names(LOG_ENDS_DIR) if n.startswith("version="))

    def last(self, since: int = -1) -> Version | None:
        """The latest claim: from a hint onwards, which may be old but never too new."""
        hint = self.store.read(f"{LOG_ENDS_DIR}/_last")
        found = self.read(max(int(hint) if hint else 0, since, 0))
        if found is None and since < 0:  # no hint yet: a new log, or one whose first writer died
            found = next((v for n in reversed(self.numbers()) if (v := self.read(n)) is not None), None)
        while found is not None and (after := self.read(found.number + 1)) is not None:
            found = after
        return found

    def of(self, publish_id: str, last: Version | None) -> Version | None:
        """The claim of an id."""
        if last is None:
            return None
        number = dict(last.recent).get(publish_id)
        if number is None:
            text = self.store.read(self._named(publish_id))
            number = None if text is None else int(text)
        if number is None:
            return None
        found = self.read(number)
        if found is None:
            raise ValueError(f"version {number}, of the publish {publish_id}, was removed: it can't be replayed")
        return found

    def claim(self, publish_id: str, added: dict[Place, Added], begin: Version) -> Version:
        """Reserve offsets behind the latest ends; ``begin`` stands for the last claim of a log that has none."""
        last = self.last()
        while True:
            old = last or begin
            ends = {place: old.ends.get(place, (0, 0)) for place in {*old.ends, *added}}
            ends = {place: (b, e + (added[place].records if place in added else 0)) for place, (b, e) in ends.items()}
            recent = [*old.recent, (publish_id, old.number + 1)]
            for evicted, number in recent[:-RECENT]:
                self.store.replace(self._named(evicted), str(number))
            own = Version(old.number + 1, publish_id, ends, added, recent[-RECENT:])
            if self.store.create(f"{LOG_ENDS_DIR}/version={own.number}/ends.json", own.text()):
                self.store.replace(f"{LOG_ENDS_DIR}/_last", str(own.number))
                return own
            last = self.last(old.number + 1)

    def written(self, number: int) -> bool:
        return self.store.read(f"{LOG_ENDS_DIR}/version={number}/_written") is not None

    def done(self, number: int) -> None:
        self.store.replace(f"{LOG_ENDS_DIR}/version={number}/_written", "")

    @staticmethod
    def _named(publish_id: str) -> str:
        return f"{LOG_ENDS_DIR}/_ids/{hashlib.sha256(publish_id.encode()).hexdigest()}"


def read_log_ends(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """(topic, partition, log_begin_offset, log_end_offset) as of a version, by default the latest; empty for a new
    log. Offsets of a publish that is still being written count."""
    versions = Versions(spark, root)
    found = versions.last() if version is None else versions.read(version)
    rows = [(t, p, b, e) for (t, p), (b, e) in sorted(found.ends.items())] if found else []
    return spark.createDataFrame(rows, ENDS_SCHEMA)


def unfinished_publishes(spark: SparkSession, root: str) -> list[str]:
    """Ids of publishes that reserved offsets and have not finished writing: running, or failed and to be replayed
    under their id."""
    versions = Versions(spark, root)
    found = (versions.read(n) for n in versions.numbers() if not versions.written(n))
    return [v.publish_id for v in found if v is not None]


def publish_history(spark: SparkSession, root: str) -> DataFrame:
    """A row for each publish and topic partition it added to: version, topic, partition, first_offset, end_offset,
    records, bytes (of keys and values), first_ts, last_ts (null where the records' times aren't known). No scan of the
    log."""
    schema = f"{ENDS_SCHEMA}, records bigint, bytes bigint, first_us bigint, last_us bigint, version bigint"
    rows = spark.read.schema(schema).json(f"{root.rstrip('/')}/{LOG_ENDS_DIR}")
    return rows.where("topic is not null and records > 0").select(
        "version", "topic", "partition", (F.col("log_end_offset") - F.col("records")).alias("first_offset"),
        F.col("log_end_offset").alias("end_offset"), "records", "bytes", F.timestamp_micros("first_us").alias("first_ts"),
        F.timestamp_micros("last_us").alias("last_ts"))


def stored_key_spread(spark: SparkSession, root: str) -> DataFrame:
    """Records and about how many distinct keys per topic partition, from the sketches saved by publishes
    (``key_sketches``): they are merged, the log isn't read. The estimate's standard error is 1.6 %."""
    saved = spark.read.parquet(f"{root.rstrip('/')}/{SKETCHES_DIR}")
    return saved.groupBy("topic", "partition").agg(
        F.sum("records").alias("records"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_keys"))


def _last_folder(spark: SparkSession, root: str) -> int:
    """The highest number of a publish's folder in a log without side table, -1 if it has none."""
    stored = spark.read.parquet(root)
    found = stored.agg(F.max("batch")).first()[0] if "batch" in stored.columns else None
    return -1 if found is None else int(found)


def _problem() -> Column:
    return F.when(F.col("topic").isNull(), F.lit("missing:topic")) \
        .when(F.col("partition").isNull(), F.lit("missing:partition"))


def _measures(records: DataFrame) -> list[Column]:
    """Bytes of keys and values, and the extreme times in microseconds."""
    size = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in ("key", "value") if c in records.columns), F.lit(0))
    time = F.unix_micros(F.col("timestamp").cast("timestamp")) if "timestamp" in records.columns else \
        F.lit(None).cast("bigint")
    return [F.sum(size.cast("bigint")).alias("_tf_bytes"), F.min(time).alias("_tf_first_us"), F.max(time).alias("_tf_last_us")]


def _storable(df: DataFrame) -> bool:
    """Whether Parquet can take the rows: no column without type or of calendar intervals, no two of one name."""
    names = {c.lower() for c in df.columns}
    return len(names) == len(df.columns) and not any("void" in kind or "interval" in kind for _, kind in df.dtypes)


def publish(records: DataFrame, root: str, order_key: str | Column | None, *, publish_id: str | None = None,
            existing: DataFrame | None = None, tie_breakers: Sequence[str] = (), fmt: str = "parquet",
            options: dict | None = None, key_sketches: bool = False,
            encode: Callable[[DataFrame], DataFrame] | None = None, report: bool = True) -> DataFrame | None:
    """Append records to a topic log and return the delivery report.

    ``records`` carries key/value/headers/topic/partition (see :func:`assign_partition`); other columns
    only appear in the report, which has every record with its ``offset``, ``status`` and ``error``.
    Records without topic or partition fail and are kept under ``<root>/_rejects``. Offsets continue the log
    (``existing``, the log as read now, is scanned only when the log has no side table yet), densely whatever
    other writers publish meanwhile. With a ``publish_id`` that was published before, the same records take their
    offsets again instead of new ones; other numbers of records raise ValueError. A writer that dies after
    its claim leaves a gap until it is replayed (:func:`unfinished_publishes`). A checkpoint holds the records while
    numbers, files, ends and report are made (before it, range partitioning samples the input once). With
    ``key_sketches``, a distinct-count sketch of the keys is saved for each partition (:func:`stored_key_spread`).
    ``encode``, a projection that keeps topic and partition, makes key, value and headers of the sorted records: sampling
    and sort then see the narrow columns they are made from, and only what it returns is stored and reported. Without
    ``order_key``, records keep the order of the input, and none is sampled or shuffled. Without ``report``, the records
    are compressed while they are held, and what held them is removed when they are published. For ``fmt="kafka"``, ``root`` is the bootstrap servers, the broker assigns offsets itself and there is no report.
    """
    if fmt == "kafka":
        from topicflow.sources.topics import kafka_connector_hint
        records = records if encode is None else encode(records)
        with kafka_connector_hint():
            (records.select("topic", "key", "value", "headers", "partition")
             .write.format("kafka").options(**kafka_sink_options(root, options)).save())
        return None
    spark, by, root = records.sparkSession, ["topic", "partition"], root.rstrip("/")
    versions = Versions(spark, root)
    last = versions.last()
    keyed, order = records, None
    if order_key is not None:
        keyed = records.withColumn("_tf_key", F.col(order_key) if isinstance(order_key, str) else order_key)
        order = ["_tf_key", *tie_breakers]
    keyed = keyed.drop("offset")  # records of another log get offsets of this one
    stage = None if report or not _storable(keyed) else scratch_dir(spark, "publish")
    placed = place_rows(keyed, by, order, encode, stage)
    starts = task_starts(placed, by, *_measures(placed)).checkpoint(eager=True)  # a row for each task and partition
    totals = starts.groupBy(*by).agg(F.sum(COUNT), F.sum("_tf_bytes"), F.min("_tf_first_us"), F.max("_tf_last_us"),
                                     F.count(F.lit(1)))
    counts = [tuple(r) for r in totals.collect()]  # a row for each topic partition
    added = {(t, p): Added(*rest) for t, p, *rest, _ in counts if t is not None and p is not None}
    own = None if publish_id is None else versions.of(publish_id, last)
    if own is not None and {k: a.records for k, a in own.added.items()} != {k: a.records for k, a in added.items()}:
        raise ValueError(f"the publish {publish_id} had other numbers of records: {own.added}, now {added}")
    if own is None:
        begin = Version(-1, None, {}, {}, [])
        if last is None and existing is not None:
            begin.ends = {(r.topic, r.partition): (r.log_begin_offset, r.log_end_offset)
                          for r in log_ends(existing).collect()}
            begin.number = _last_folder(spark, root)
        own = versions.claim(publish_id or uuid.uuid4().hex, added, begin)

    bases = spark.createDataFrame([(*place, own.base(place)) for place in added], "_t string, _p int, _tf_own bigint")
    starts = starts.join(bases, (F.col("topic") == F.col("_t")) & (F.col("partition") == F.col("_p")), "left") \
        .drop("_t", "_p")
    numbered = number_rows(placed, starts, by, "offset", F.coalesce("_tf_own", F.lit(0)),
                           size=sum(c[-1] for c in counts)).drop("_tf_key")
    numbered = numbered.withColumn("error", _problem()).withColumns({
        "offset": F.when(F.col("error").isNull(), F.col("offset")),
        "status": F.when(F.col("error").isNull(), F.lit(DELIVERED)).otherwise(F.lit(FAILED))})
    stored = to_envelope(numbered.where("error is null")).withColumn("batch", F.lit(own.number))
    if stage is not None:  # a task reads parts of several tasks' rows
        stored = stored.sortWithinPartitions(*by, "batch", "offset")
    (stored.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**(LOG_FILES if fmt == "parquet" else {}))
     .options(**{k: v for k, v in (options or {}).items() if not k.startswith("kafka.")})
     .partitionBy("topic", "partition", "batch").format(fmt).save(root))
    if len(added) < len(counts):
        failed = numbered.where("error is not null")
        (failed.select(*[c for c in ("key", "value", "headers", "topic", "partition", "error") if c in failed.columns])
         .write.mode("overwrite").parquet(f"{root}/{REJECTS_DIR}/batch={own.number}"))
    if key_sketches:
        sketches = numbered.where("error is null").groupBy(*by).agg(
            F.count(F.lit(1)).alias("records"), F.hll_sketch_agg(F.coalesce("key", F.lit(b""))).alias("sketch"))
        sketches.write.mode("overwrite").parquet(f"{root}/{SKETCHES_DIR}/batch={own.number}")
    versions.done(own.number)
    if stage is not None:
        folder, _, name = stage.rpartition("/")
        Store(spark, folder).delete(name)
    return numbered if report else None


def delivery_report(published: DataFrame, *identity: str) -> DataFrame:
    """What became of each record of a publish: the given columns, topic, partition, offset, status, error."""
    return published.select(*identity, "topic", "partition", "offset", "status", "error")


def forget_old_ends(spark: SparkSession, root: str, keep: int = 100) -> None:
    """Remove all but the last ``keep`` versions of the side table. A publish whose version is gone can't be replayed."""
    versions = Versions(spark, root)
    last = versions.last()
    for number in versions.numbers():
        if last is not None and number <= last.number - keep:
            versions.store.delete(f"{LOG_ENDS_DIR}/version={number}")
