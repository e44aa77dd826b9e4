"""Reading topics as record-envelope frames, in batch or as a stream.

Two physical forms share one schema: a broker through Spark's Kafka source, and a Parquet
file log laid out as ``<root>/topic=<name>/partition=<n>/``. In the file log ``topic`` and
``partition`` are directory columns, so a ``where`` on them prunes whole directories.
"""

from __future__ import annotations

import contextlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicflow.schema import ENVELOPE, ENVELOPE_COLUMNS

EARLIEST = "earliest"
LATEST = "latest"


def _topics(topics: str | Sequence[str]) -> list[str]:
    if isinstance(topics, str):
        return [t for t in (x.strip() for x in topics.split(",")) if t]
    return list(topics)


def read_topic(spark: SparkSession, source: str, topics: str | Sequence[str] | None = None, *,
               fmt: str = "parquet", streaming: bool = False, start: str = EARLIEST,
               options: dict | None = None, checkpoint: str | None = None,
               pattern: str | None = None) -> DataFrame:
    """Records of one or more topics (``"a,b"`` or a list, or every topic whose name matches
    the regular expression ``pattern``) in the envelope schema.

    ``source`` is the log root for the file log, or the bootstrap servers for ``fmt="kafka"``.
    ``start`` applies when no position is known yet: ``earliest`` reads the whole log,
    ``latest`` only records that arrive after the first run (streams) — in batch it yields
    the records past the current end, i.e. none. A stream's checkpoint overrides it on resume;
    a file-log stream starting at ``latest`` needs its ``checkpoint`` folder, where the log
    ends seen at its first start are kept.
    Extra ``options`` pass through (bounded fetch: ``maxOffsetsPerTrigger``,
    ``maxFilesPerTrigger``, ``maxBytesPerTrigger``).
    """
    if (topics is None) == (pattern is None):
        raise ValueError("give either topics or a pattern")
    names = _topics(topics) if topics is not None else []
    opts = dict(options or {})
    if fmt == "kafka":
        reader = spark.readStream if streaming else spark.read
        r = reader.format("kafka").options(**kafka_source_options(source, names, start,
                                                                  streaming, opts, pattern))
        with kafka_connector_hint():
            return r.load().select(*ENVELOPE_COLUMNS)

    reader = spark.readStream if streaming else spark.read
    df = reader.schema(ENVELOPE).options(**opts).parquet(source).select(*ENVELOPE_COLUMNS)
    # a filter on the topic directory column: whole folders are pruned
    df = df.where(F.col("topic").isin(names) if pattern is None else F.col("topic").rlike(pattern))
    if start == LATEST and not streaming:
        df = df.where(F.lit(False))
    if start == LATEST and streaming:
        if checkpoint is None:
            raise ValueError("a file-log stream starting at 'latest' needs its checkpoint folder")
        df = from_positions(df, first_start_positions(spark, source, checkpoint),
                            column="log_end_offset")
    return df


START_POSITIONS_DIR = "_tf_start_positions"


def first_start_positions(spark: SparkSession, root: str, checkpoint: str) -> DataFrame:
    """Log ends (topic, partition, log_end_offset) as of a stream's first start.

    Saved beside the stream's checkpoint on the first start and read back on every restart,
    so ``latest`` means "after the first start", as with a broker: records that arrive while
    the stream is down are still read. Taken from the log-ends side table (no log scan).
    """
    from pyspark.errors import AnalysisException

    from topicflow.operators.publish import read_log_ends

    path = f"{checkpoint.rstrip('/')}/{START_POSITIONS_DIR}"
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        pass
    ends = read_log_ends(spark, root).where("topic is not null")
    ends.select("topic", "partition", "log_end_offset").write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@contextlib.contextmanager
def kafka_connector_hint():
    """Turn Spark's "data source not found" for ``kafka`` into a message naming the package."""
    from pyspark.errors import AnalysisException
    try:
        yield
    except AnalysisException as e:
        if "kafka" in str(e).lower() and "find" in str(e).lower():
            raise RuntimeError(
                "Spark's Kafka connector is not on the classpath: start Spark with "
                "--packages org.apache.spark:spark-sql-kafka-0-10_<scala>:<spark version>"
            ) from e
        raise


def kafka_source_options(servers: str, topics: Sequence[str], start: str = EARLIEST,
                         streaming: bool = False, extra: dict | None = None,
                         pattern: str | None = None) -> dict:
    """Options for Spark's Kafka source: subscription, headers on, start rule.

    A stream uses ``startingOffsets`` only on its first run (the checkpoint wins after);
    a batch read spans ``startingOffsets``..``endingOffsets`` (latest), so ``latest`` as the
    start reads nothing. Bounded fetch: ``maxOffsetsPerTrigger``, ``kafka.fetch.max.bytes``,
    ``kafka.max.poll.records`` pass through in ``extra``.
    """
    opts = {"kafka.bootstrap.servers": servers, "includeHeaders": "true",
            "startingOffsets": start}
    if pattern is not None:
        opts["subscribePattern"] = pattern
    else:
        opts["subscribe"] = ",".join(topics)
    if not streaming:
        opts["endingOffsets"] = LATEST
    opts.update(extra or {})
    return opts


def from_positions(records: DataFrame, positions: DataFrame,
                   column: str = "committed") -> DataFrame:
    """Records at or past a group's committed position (resume in batch).

    ``positions`` holds one row per (topic, partition); partitions without a row are read
    from the beginning. Adaptive execution broadcasts it when it is measured small.
    """
    pos = positions.select("topic", "partition", F.col(column).alias("_tf_from"))
    return (records.join(pos, ["topic", "partition"], "left")
            .where(F.col("_tf_from").isNull() | (F.col("offset") >= F.col("_tf_from")))
            .drop("_tf_from"))


def read_publishes(spark: SparkSession, root: str, topics: str | Sequence[str], versions: Sequence[int]) -> DataFrame:
    """Records of some publishes of a file log: only their folders are read."""
    rows = spark.read.schema(T.StructType([*ENVELOPE.fields, T.StructField("batch", T.LongType())])).parquet(root)
    return rows.where(F.col("topic").isin(_topics(topics)) & F.col("batch").isin(list(versions))).select(*ENVELOPE_COLUMNS)


def read_since(spark: SparkSession, root: str, topics: str | Sequence[str], since: str) -> DataFrame:
    """Records of a file log at or after a time (ISO text, UTC): a group that starts at ``latest`` as of then.

    The side table has the first and last time of each publish per partition; publishes that end earlier aren't
    read. Where a record's time isn't known to the side table, its publish is read."""
    from topicflow.operators.publish import publish_history

    at = F.lit(since).cast("timestamp")
    known = publish_history(spark, root).where(F.col("topic").isin(_topics(topics)))
    wanted = known.where(F.col("last_ts").isNull() | (F.col("last_ts") >= at)).select("version").distinct().collect()
    return read_publishes(spark, root, topics, [r.version for r in wanted]).where(F.col("timestamp") >= at)


def union_topics(*frames: DataFrame) -> DataFrame:
    """Records of topics whose frames differ in columns as one frame; what a frame lacks is null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
