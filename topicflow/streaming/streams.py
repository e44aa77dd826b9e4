"""Streaming readers and workers over topics.

A worker is one streaming query with one checkpoint: Spark's checkpoint is the group's
committed position, so a restart resumes where the last committed micro-batch ended and a
second ``availableNow`` run reads nothing twice. Each micro-batch is written once, tagged
with an outcome (``ok`` / ``rejected``), under ``batch_id=<n>``; a replayed batch overwrites
its own folder, so readers of the output see every record exactly once even though the
source is read at least once.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


OK = "ok"
REJECTED = "rejected"

# A transform returns the batch with a ``reason`` column: null keeps the row, text rejects it.
Transform = Callable[[DataFrame], DataFrame]


def _trigger(writer, trigger: str | None):
    if trigger is None or trigger == "availableNow":
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def write_batch(df: DataFrame, root: str, batch_id: int, fmt: str = "parquet",
                partition_by: Sequence[str] = ("outcome",)) -> None:
    """Idempotent micro-batch output: overwrite ``root/batch_id=<n>`` in one pass."""
    (df.write.mode("overwrite").partitionBy(*partition_by).format(fmt)
     .save(f"{root.rstrip('/')}/batch_id={batch_id}"))


def run_worker(stream: DataFrame, transform: Transform, output: str, checkpoint: str, *,
               trigger: str | None = "availableNow", name: str | None = None) -> StreamingQuery:
    """Process records, keep failures as rejects with their reason, commit after writing.

    ``transform`` maps a micro-batch to rows with a ``reason`` column; rows with a reason go
    to the ``rejected`` outcome with their log position, the rest to ``ok``. A bad record
    never stops the worker and is never lost.
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        out = transform(batch)
        tagged = out.withColumn("outcome", F.when(F.col("reason").isNull(), F.lit(OK))
                                .otherwise(F.lit(REJECTED)))
        write_batch(tagged, output, batch_id)

    w = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    return _trigger(w, trigger).start()


def read_outcome(spark: SparkSession, output: str, outcome: str = OK, schema=None) -> DataFrame:
    """Rows a worker wrote with one outcome, across all its batches. A worker that has met no record yet reads as
    an empty frame of ``schema``."""
    rows = _written(spark, output)
    if rows is None:
        if schema is None:
            raise ValueError(f"nothing was written to {output}: give the schema of an empty result")
        return spark.createDataFrame([], schema)
    return rows.where(F.col("outcome") == outcome).drop("outcome")


def copy_stream(stream: DataFrame, output: str, checkpoint: str, *, fmt: str = "parquet",
                trigger: str | None = "availableNow", partition_by: Sequence[str] = (),
                options: dict | None = None) -> StreamingQuery:
    """Plain sink: append micro-batches to files (exactly once per committed batch)."""
    w = (stream.writeStream.format(fmt).option("path", output)
         .option("checkpointLocation", checkpoint).options(**(options or {})))
    if partition_by:
        w = w.partitionBy(*partition_by)
    return _trigger(w, trigger).start()


def publish_stream(stream: DataFrame, root: str, checkpoint: str, *, partitions: int,
                   key_text: str | Column | None = None,
                   trigger: str | None = "availableNow") -> StreamingQuery:
    """Continuously append a stream of records (key/value/headers/topic) to a file log.

    Each micro-batch gets partitions (by key, or spread) and dense offsets behind the log's current ends. It
    is published under an id made of the checkpoint folder and the batch number, so that a micro-batch
    replayed after a failure replaces its own files, and a stream on a log that others filled only appends.
    The batch is stored once, compressed and in its own order, before anything is derived from it.
    """
    from topicflow.functions.partitioning import choose_partition
    from topicflow.operators.publish import publish

    writer = hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()

    def each(batch: DataFrame, batch_id: int) -> None:
        k = F.lit(None).cast("string") if key_text is None else (
            F.col(key_text) if isinstance(key_text, str) else key_text)
        publish(batch.withColumn("partition", choose_partition(k, partitions)), root, None,
                publish_id=f"{writer}-{batch_id}", report=False)

    w = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()


# Results that must not depend on how the input falls into micro-batches are written as one partial result per
# batch and completed when they are read: no watermark, so nothing is ever late, and no state that grows.

def partial_results(stream: DataFrame, partial: Transform, output: str, checkpoint: str,
                    trigger: str | None = "availableNow") -> StreamingQuery:
    """``partial`` of every micro-batch under ``output/batch_id=<n>``; a replayed batch overwrites its own."""
    def each(batch: DataFrame, batch_id: int) -> None:
        partial(batch).write.mode("overwrite").parquet(f"{output.rstrip('/')}/batch_id={batch_id}")

    w = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()


def _written(spark: SparkSession, output: str) -> DataFrame | None:
    from pyspark.errors import AnalysisException
    try:
        return spark.read.parquet(output)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def window_counts(stream: DataFrame, output: str, checkpoint: str, size: str, by: Sequence[str] = ("topic",),
                  ts: str = "timestamp", trigger: str | None = "availableNow") -> StreamingQuery:
    """Records per tumbling event-time window, as partial counts per micro-batch (:func:`read_window_counts`)."""
    from topicflow.operators.progress import rate_window
    return partial_results(stream, lambda b: rate_window(b, size, by, ts), output, checkpoint, trigger)


def read_window_counts(spark: SparkSession, output: str, by: Sequence[str] = ("topic",)) -> DataFrame:
    """The windows' counts so far."""
    return spark.read.parquet(output).groupBy(*by, "window_start", "window_end").agg(
        F.sum("records").alias("records"))


def run_group_streams(streams: dict[str, DataFrame], output: str, checkpoint_root: str, *,
                      trigger: str | None = "availableNow") -> list[StreamingQuery]:
    """Fan-out: one query and one checkpoint per group, each writing its own folder (read
    them back with :func:`read_group_outputs`)."""
    qs = []
    for group, df in streams.items():
        qs.append(copy_stream(df, f"{output.rstrip('/')}/group={group}",
                              f"{checkpoint_root.rstrip('/')}/{group}", trigger=trigger))
    return qs


def positions_from_checkpoint(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Committed positions (topic, partition, committed) of a Kafka-reading stream, from its
    checkpoint: the offsets of the latest batch that has a commit marker.

    ``offsets/<n>`` holds a version line, a metadata line, then one JSON line per source; a
    Kafka source's line maps topic → partition → next offset to read. Lines of other sources
    do not have that shape and drop out. Read with Spark; nothing is listed by hand. These files are Spark's own, not
    a public format: any version but ``v1`` raises ValueError. :class:`topicflow.streaming.polls.Reader` writes the same.
    """
    root = checkpoint.rstrip("/")
    commits = spark.read.text(f"{root}/commits").select(
        F.col("_metadata.file_name").try_cast("bigint").alias("batch"))
    last = commits.agg(F.max("batch").alias("batch"))
    lines = (spark.read.text(f"{root}/offsets")
             .select(F.col("_metadata.file_name").try_cast("bigint").alias("batch"), "value")
             .join(last, "batch"))
    odd = lines.where(F.col("value").rlike(r"^v\d+$") & (F.col("value") != "v1")).first()
    if odd is not None:
        raise ValueError(f"{checkpoint} is a checkpoint of format {odd.value}; v1 is known")
    parsed = lines.select(F.from_json("value", "map<string,map<string,bigint>>").alias("m"))
    return (parsed.where(F.col("m").isNotNull())
            .select(F.explode("m").alias("topic", "parts"))
            .select("topic", F.explode("parts").alias("partition", "committed"))
            .select("topic", F.col("partition").try_cast("int").alias("partition"),
                    "committed")
            .where(F.col("partition").isNotNull() & F.col("committed").isNotNull()))


def read_group_outputs(spark: SparkSession, output: str, groups, schema=None) -> DataFrame:
    """What each group's sink committed, as one frame with a ``group`` column.

    Each sink folder is read by its own path: only then does Spark use the sink's commit log
    and skip files of a batch that failed before committing. ``schema`` (the streams' schema)
    lets a group that committed no rows read as empty.
    """
    def one(g):
        r = spark.read.schema(schema) if schema is not None else spark.read
        return r.parquet(f"{output.rstrip('/')}/group={g}").withColumn("group", F.lit(g))
    frames = [one(g) for g in groups]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def await_all(queries: Sequence[StreamingQuery], timeout_s: float | None = None, late_rows_ok: bool = False) -> None:
    """Wait for all queries to end. Raises when one fails, is still running after ``timeout_s``, or dropped rows
    behind its watermark that the caller did not declare."""
    for q in queries:
        ended = q.awaitTermination(timeout_s) if timeout_s is not None else q.awaitTermination()
        if timeout_s is not None and not ended:
            raise TimeoutError(f"the query {q.name or q.id} is still running after {timeout_s} s")
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
        late = sum(o.numRowsDroppedByWatermark for p in q.recentProgress for o in p.stateOperators)
        if late and not late_rows_ok:
            raise RuntimeError(f"the query {q.name or q.id} dropped {late} rows behind its watermark")


def observed(stream: DataFrame, name: str, *metrics: Column) -> DataFrame:
    """Attach named metrics (e.g. ``count(lit(1)).alias('records')``) reported with every
    micro-batch's progress event."""
    return stream.observe(name, *(metrics or (F.count(F.lit(1)).alias("records"),)))


class ProgressLog(StreamingQueryListener):
    """Listener keeping the latest progress and idle notices: records per batch, input rate, metrics."""

    def __init__(self, keep: int = 1000):
        self.progress: deque[dict] = deque(maxlen=keep)
        self.idle: deque[str] = deque(maxlen=keep)

    def onQueryStarted(self, event):  # noqa: N802
        pass

    def onQueryProgress(self, event):  # noqa: N802
        p = event.progress
        self.progress.append({"id": str(p.id), "batch": p.batchId,
                              "rows": p.numInputRows, "rate": p.processedRowsPerSecond,
                              "metrics": {k: v.asDict() for k, v in p.observedMetrics.items()}})

    def onQueryIdle(self, event):  # noqa: N802
        self.idle.append(str(event.id))

    def onQueryTerminated(self, event):  # noqa: N802
        pass
