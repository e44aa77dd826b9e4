"""Consumer groups over a topic log: fan-out, positions, lag, profiles.

A group is an independent reading position on its topics. In batch a group is described by
its subscription, its start rule (earliest, or latest as of the time it joined) and the time up
to which it has processed and committed records. Every report here is one scan and one
aggregation of the log: records are tagged per subscribed group inside the scan stage
(a generator over the small group list, no join), and partial aggregation runs before the
shuffle, so a hot topic partition never lands whole in one task. Reports that only need extremes and counts
aggregate first: time is cut at all groups' start and until points, the log is summed up once per topic
partition and interval, and groups are fanned out over that small table.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicflow.sources.topics import EARLIEST, LATEST

FEW_POINTS, MOST_CELLS = 8, 1 << 16  # points compared one by one; entries of a constant array

@dataclass(frozen=True)
class Group:
    name: str
    topics: tuple[str, ...]
    start: str = LATEST                 # 'earliest' | 'latest'
    joined_at: str | None = None        # when the group first connected (for 'latest')
    consumed_until: str | None = None   # records before this time are processed + committed
    fetched_until: str | None = None    # records before this time are planned, by default the same

    def __post_init__(self):
        if self.start not in (EARLIEST, LATEST):
            raise ValueError(f"start must be earliest or latest, not {self.start!r}")


def _ts(text: str | None) -> Column:
    return F.lit(None).cast("timestamp_ntz") if text is None else F.lit(text).cast("timestamp_ntz")


def _subscriptions(groups: Sequence[Group]) -> Column:
    """The group list as one literal map: topic → array of its subscribers' settings."""
    entry = lambda g: F.struct(F.lit(g.name).alias("group"), F.lit(g.start).alias("start"),
                               _ts(g.joined_at).alias("joined_at"),
                               _ts(g.consumed_until).alias("until"))
    topics = sorted({t for g in groups for t in g.topics})
    pairs = []
    for t in topics:
        pairs += [F.lit(t), F.array(*[entry(g) for g in groups if t in g.topics])]
    return F.create_map(*pairs)


def fan_out(records: DataFrame, groups: Sequence[Group], ts: str = "timestamp") -> DataFrame:
    """Every record once per group subscribed to its topic, with ``group``, ``started``
    (at or past the group's start) and ``consumed`` (started and committed) flags. The
    subscribers of a record's topic come from one map lookup, whatever the number of groups."""
    mine = F.element_at(_subscriptions(groups), F.col("topic"))
    t = F.col(ts).cast("timestamp_ntz")
    return (records.withColumn("_tf_g", F.explode(mine))
            .withColumn("group", F.col("_tf_g.group"))
            .withColumn("started", (F.col("_tf_g.start") == F.lit(EARLIEST))
                        | (t >= F.col("_tf_g.joined_at")))
            .withColumn("consumed", F.col("started")
                        & F.coalesce(t < F.col("_tf_g.until"), F.lit(False)))
            .drop("_tf_g"))


def consumed(records: DataFrame, groups: Sequence[Group], ts: str = "timestamp") -> DataFrame:
    """Records each group has processed and committed (group column added)."""
    return fan_out(records, groups, ts).where("consumed").drop("started", "consumed")


def interval_summary(records: DataFrame, groups: Sequence[Group], ts: str = "timestamp") -> DataFrame:
    """The log per topic partition and interval between the groups' time points: ``interval`` (how many points
    lie at or before the record; null without time), records, first and last offset and time."""
    at = F.col(ts).cast("timestamp_ntz")
    interval = points_before(F.unix_micros(at.cast("timestamp")), [_micros(p) for p in _points(groups)])
    return records.where(F.col("topic").isin(sorted({t for g in groups for t in g.topics}))).groupBy(
        "topic", "partition", F.when(at.isNotNull(), interval).alias("interval")).agg(
            F.count(F.lit(1)).alias("records"), F.min("offset").alias("first_offset"),
            F.max("offset").alias("last_offset"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))


def _micros(text: str) -> int:
    """ISO text without zone as microseconds of UTC, the zone that sessions are held in."""
    return (datetime.fromisoformat(text) - datetime(1970, 1, 1)) // timedelta(microseconds=1)


def points_before(value: Column, points: Sequence[int]) -> Column:
    """How many of the ascending ``points`` are at most ``value``, in a time that doesn't grow with their number.

    An even grid over the points' range tells, by one look into a constant array, how many lie before the value's cell;
    those of its own cell are compared. The grid is made finer until a cell holds few; where it can't be (points of
    a crowded moment beside far ones), the cell's are filtered.
    """
    if len(points) <= FEW_POINTS:
        return sum((F.when(value >= F.lit(p), 1).otherwise(0) for p in points), F.lit(0))
    low, cells = points[0], len(points)
    while True:
        width = max(1, -(-(points[-1] - low + 1) // cells))
        own = Counter((p - low) // width for p in points)
        if max(own.values()) <= FEW_POINTS or cells >= MOST_CELLS:
            break
        cells *= 2
    before = list(accumulate((own.get(c, 0) for c in range(-1, cells)), initial=0))  # of cell -1 (below all) and up
    def constant(xs):
        return F.split(F.lit(",".join(map(str, xs))), ",").cast("array<bigint>")  # folded to one literal
    cell = F.greatest(F.lit(-1), F.least(F.floor((value - F.lit(low)) / F.lit(width)), F.lit(cells)))
    at = (cell + 2).cast("int")
    first, end = F.element_at(constant(before), at), F.element_at(constant([*before[1:], len(points)]), at)
    if max(own.values()) <= FEW_POINTS:
        listed = constant([*points, *[points[-1]] * FEW_POINTS])
        inside = sum((F.when((first + k < end) & (value >= F.element_at(listed, (first + k + 1).cast("int"))), 1).otherwise(0)
                      for k in range(max(own.values()))), F.lit(0))
    else:
        inside = F.size(F.filter(F.slice(constant(points), (first + 1).cast("int"), (end - first).cast("int")), lambda p: p <= value))
    return (first + inside).cast("int")


def _points(groups: Sequence[Group]) -> list[str]:
    return sorted({p for g in groups for p in (g.joined_at, g.consumed_until, g.fetched_until) if p is not None},
                  key=_micros)


def fan_out_summary(summary: DataFrame, groups: Sequence[Group]) -> DataFrame:
    """The rows of :func:`interval_summary` once per subscribed group, flagged ``started``, ``consumed``, ``fetched``: a
    join of two small tables on the topic."""
    place = {p: i for i, p in enumerate(_points(groups))}
    rows = []
    for g in groups:
        planned = g.fetched_until or g.consumed_until
        start = -1 if g.start == EARLIEST else place[g.joined_at] + 1 if g.joined_at else 1 << 30
        rows += [(t, g.name, start, place[g.consumed_until] if g.consumed_until else -1, place[planned] if planned else -1)
                 for t in dict.fromkeys(g.topics)]
    subscribed = summary.sparkSession.createDataFrame(
        rows, "topic string, group string, _from int, _until int, _planned int")
    f = summary.join(subscribed, "topic")
    started = (F.col("_from") < 0) | F.coalesce(F.col("interval") >= F.col("_from"), F.lit(False))
    return f.withColumn("started", started).withColumns({
        "consumed": F.col("started") & F.coalesce(F.col("interval") <= F.col("_until"), F.lit(False)),
        "fetched": F.col("started") & F.coalesce(F.col("interval") <= F.col("_planned"), F.lit(False))}) \
        .drop("_from", "_until", "_planned")


def group_positions(records: DataFrame, groups: Sequence[Group],
                    ts: str = "timestamp") -> DataFrame:
    """(group, topic, partition, log_begin_offset, start_offset, committed, next_fetch, log_end_offset).

    ``start_offset`` is where the group began (log begin for earliest; the first record at
    or after its join time for latest); ``committed`` is one past its last processed record,
    or its start when it processed none; ``next_fetch`` one past the last record that was planned.
    """
    f = fan_out_summary(interval_summary(records, groups, ts), groups)
    agg = f.groupBy("group", "topic", "partition").agg(
        F.min("first_offset").alias("log_begin_offset"),
        (F.max("last_offset") + 1).alias("log_end_offset"),
        F.min(F.when(F.col("started"), F.col("first_offset"))).alias("_first_started"),
        (F.max(F.when(F.col("consumed"), F.col("last_offset"))) + 1).alias("_after_consumed"),
        (F.max(F.when(F.col("fetched"), F.col("last_offset"))) + 1).alias("_after_fetched"),
    )
    start = F.coalesce(F.col("_first_started"), F.col("log_end_offset"))
    return agg.select(
        "group", "topic", "partition", "log_begin_offset",
        start.alias("start_offset"),
        F.coalesce(F.col("_after_consumed"), start).alias("committed"),
        F.coalesce(F.col("_after_fetched"), start).alias("next_fetch"),
        "log_end_offset", F.col("_after_consumed").isNotNull().alias("has_committed"),
    )


def consumer_lag(records: DataFrame, groups: Sequence[Group], ts: str = "timestamp") -> DataFrame:
    """Per group and partition: current (committed) offset, log end offset and lag."""
    p = group_positions(records, groups, ts)
    return p.select("group", "topic", "partition",
                    F.col("committed").alias("current_offset"),
                    F.col("log_end_offset"),
                    (F.col("log_end_offset") - F.col("committed")).alias("lag"))


def lag_from_positions(ends: DataFrame, positions: DataFrame) -> DataFrame:
    """Lag of every group with a stored position (group, topic, partition, committed), from the log-ends side table
    (topic, partition, log_begin_offset, log_end_offset): no scan of the log. Partitions a group has no position
    for count from the log's begin. Both tables have one row per topic partition (and group)."""
    pos = positions.select("group", "topic", "partition", "committed")
    groups = pos.select("group", "topic").distinct()
    j = ends.join(groups, "topic").join(pos, ["group", "topic", "partition"], "left")
    cur = F.coalesce(F.col("committed"), F.col("log_begin_offset"))
    return j.select("group", "topic", "partition", cur.alias("current_offset"),
                    "log_end_offset", (F.col("log_end_offset") - cur).alias("lag"))


def lag_from_ends(ends: DataFrame, positions: DataFrame, group: str) -> DataFrame:
    """Lag of one reader from the log-ends side table and its positions (topic, partition, committed); partitions
    it has not read yet count from the log's begin."""
    pos = positions.select("topic", "partition", "committed")
    j = ends.join(pos, ["topic", "partition"], "left")
    cur = F.coalesce(F.col("committed"), F.col("log_begin_offset"))
    return j.select(F.lit(group).alias("group"), "topic", "partition",
                    cur.alias("current_offset"), "log_end_offset",
                    (F.col("log_end_offset") - cur).alias("lag"))


def positions(consumed_records: DataFrame, by: Sequence[str] = ("group",)) -> DataFrame:
    """Committed position per reader and partition: last offset read + 1."""
    return consumed_records.groupBy(*by, "topic", "partition").agg((F.max("offset") + 1).alias("committed"))


def list_groups(positions: DataFrame) -> DataFrame:
    """Names of groups that hold a committed position, from their positions."""
    return positions.select("group").distinct()


def topic_profile(records: DataFrame) -> DataFrame:
    """Per topic partition: begin offset, end offset and record count."""
    return records.groupBy("topic", "partition").agg(
        F.min("offset").alias("begin_offset"),
        (F.max("offset") + 1).alias("end_offset"),
        F.count(F.lit(1)).alias("records"))


def profile_from_ends(ends: DataFrame) -> DataFrame:
    """:func:`topic_profile` from the log-ends side table alone (one row per partition, no
    scan of the log): offsets run densely from the log's begin to its end."""
    return ends.select("topic", "partition", F.col("log_begin_offset").alias("begin_offset"),
                       F.col("log_end_offset").alias("end_offset"),
                       (F.col("log_end_offset") - F.col("log_begin_offset")).alias("records"))


def key_spread(records: DataFrame) -> DataFrame:
    """Records and distinct keys per topic partition."""
    return records.groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("records"),
        F.count_distinct("key").alias("distinct_keys"))


def key_stability(records: DataFrame) -> DataFrame:
    """Per topic and key: how many partitions hold it (1 when keyed routing holds)."""
    return (records.where(F.col("key").isNotNull())
            .groupBy("topic", F.col("key").cast("string").alias("key_text"))
            .agg(F.count_distinct("partition").alias("partitions"),
                 F.min("partition").alias("partition"),
                 F.count(F.lit(1)).alias("records")))


def unconsumed(sent: DataFrame, done: DataFrame,
               on: Sequence[str] = ("topic", "partition", "offset")) -> DataFrame:
    """Records sent but not (yet) consumed: anti-join on log position (unique keys).

    Replayed duplicates in ``done`` need no de-duplication first: an anti-join only asks
    whether a match exists."""
    return sent.join(done.select(*on), list(on), "left_anti")


def not_yet_consumed(records: DataFrame, groups: Sequence[Group], ts: str = "timestamp") -> DataFrame:
    """Records past a group's start that it has not processed (group column added): one scan, no join."""
    return fan_out(records, groups, ts).where("started and not consumed").drop("started", "consumed")


def start_filter(records: DataFrame, group: Group, ts: str = "timestamp") -> DataFrame:
    """The records a group reads given its start rule alone (earliest/latest at join)."""
    if group.start == EARLIEST:
        return records.where(F.col("topic").isin(list(group.topics)))
    return records.where(F.col("topic").isin(list(group.topics))
                         & (F.col(ts).cast("timestamp_ntz") >= _ts(group.joined_at)))
