"""The registered reports: name → (Spark plan builder, SQL twin or None).

Every plan reads the driver tables (``sf_dir``) or data Spark derives from them, and covers
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicflow.functions import records as R
from topicflow.functions import tracing as TR
from topicflow.operators import groups as G
from topicflow.operators import orders as O
from topicflow.operators import progress as P
from topicflow.operators import tracing as TS
from topicflow.operators.groups import Group
from topicflow.plans import sql as S
from topicflow.schema import POSITION
from topicflow.session import app_id, scratch_dir, state_session
from topicflow.sources import files as FI
from topicflow.sources import testtopic as TT
from topicflow.sources.testtopic import events_topic
from topicflow.sources.topics import EARLIEST, LATEST, read_topic
from topicflow.streaming import stateful as SF
from topicflow.streaming import streams as ST

ALL_TOPICS = ("demo.click", "demo.view", "demo.error", "demo.purchase", "demo.signup")

# Consumer groups of the demo services, placed on the events time line (January 2024).
DEMO_GROUPS = (
    Group("kitchen", ("demo.purchase",), LATEST, joined_at="2024-01-05 00:00:00",
          consumed_until="2024-01-25 00:00:00"),
    Group("payments", ("demo.purchase",), EARLIEST, consumed_until="2024-01-20 00:00:00"),
    Group("delivery", ("demo.purchase", "demo.signup"), LATEST,
          joined_at="2024-01-10 00:00:00", consumed_until="2024-01-28 12:00:00"),
    Group("analytics", ALL_TOPICS, EARLIEST, consumed_until="2024-01-26 00:00:00",
          fetched_until="2024-01-27 00:00:00"),
    Group("audit", ("demo.error",), LATEST, joined_at="2024-02-01 00:00:00"),
)

Plan = Callable[[SparkSession, str], DataFrame]


def log(spark: SparkSession, sf_dir: str, topics=ALL_TOPICS) -> DataFrame:
    """The events topics as stored in the file log (written once per application)."""
    return read_topic(spark, TT.events_log(spark, sf_dir), topics)


def ntz(c: str):
    return F.col(c).cast("timestamp_ntz").alias(c)


def done(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records each demo group has processed and committed."""
    return G.consumed(log(spark, sf_dir), DEMO_GROUPS)


def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What :func:`done` holds, summed up per group, topic partition and interval before the fan-out."""
    return G.fan_out_summary(G.interval_summary(log(spark, sf_dir), DEMO_GROUPS), DEMO_GROUPS).where("consumed")


REGISTRY: dict[str, tuple[Plan, str | None]] = {}
# Main input table of each report (for records-per-second figures); events unless listed.
INPUT_TABLE = {
    **{q: "lineitem" for q in (
        "normalize_orders", "route_cost", "require_fields", "dead_letter", "worker", "worker_rejects", "jsonl_lines",
        "file_to_topic", "publish_readback", "validate_quantity", "shape_order", "order_file", "trace_failures")},
}


# Reports that read a side table, or one topic of several.
PART_READERS = {"topic_ends", "list_groups", "stored_lag", "start_earliest", "start_latest", "multi_topic",
                "read_from_positions", "publish_history", "start_by_time", "rate_live", "trace_link_live", "progress_live"}


def input_table(name: str) -> str | None:
    """The table a report reads whole, for records per second; None for other queries."""
    if name in PART_READERS or name not in REGISTRY:
        return None
    return INPUT_TABLE.get(name, "events")


def register(name: str, oracle: str | None):
    def deco(fn: Plan) -> Plan:
        REGISTRY[name] = (fn, oracle)
        return fn
    return deco


# ---------------------------------------------------------------- groups, positions, lag

@register("consumer_lag", S.with_topic("""
SELECT grp AS "group", topic, partition,
       coalesce(max(CASE WHEN consumed THEN "offset" END) + 1,
                coalesce(min(CASE WHEN started THEN "offset" END), max("offset") + 1))
         AS current_offset,
       max("offset") + 1 AS log_end_offset,
       max("offset") + 1 - coalesce(max(CASE WHEN consumed THEN "offset" END) + 1,
                coalesce(min(CASE WHEN started THEN "offset" END), max("offset") + 1)) AS lag
FROM fan GROUP BY grp, topic, partition""", DEMO_GROUPS))
def consumer_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.consumer_lag(log(spark, sf_dir), DEMO_GROUPS)


@register("positions", S.with_topic("""
SELECT grp AS "group", topic, partition, max(CASE WHEN consumed THEN "offset" END) + 1 AS committed,
       max("offset") + 1 AS next_fetch
FROM fan WHERE consumed OR (grp = 'analytics' AND ts < TIMESTAMP '2024-01-27 00:00:00')
GROUP BY grp, topic, partition HAVING max(CASE WHEN consumed THEN "offset" END) IS NOT NULL""", DEMO_GROUPS))
def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last commit of each group, and what it fetches next: analytics has planned a day more."""
    return G.group_positions(log(spark, sf_dir), DEMO_GROUPS).where("has_committed").select(
        "group", "topic", "partition", "committed", "next_fetch")


@register("list_groups", S.with_topic("""
SELECT DISTINCT grp AS "group" FROM fan WHERE consumed""", DEMO_GROUPS))
def list_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.list_groups(stored_positions(spark, sf_dir))


@register("topic_profile", S.with_topic("""
SELECT topic, partition, min("offset") AS begin_offset, max("offset") + 1 AS end_offset,
       count(*) AS records
FROM rec GROUP BY topic, partition"""))
def topic_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.topic_profile(log(spark, sf_dir))


@register("topic_ends", S.with_topic("""
SELECT topic, partition, min("offset") AS begin_offset, max("offset") + 1 AS end_offset,
       count(*) AS records
FROM rec GROUP BY topic, partition"""))
def topic_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The topic profile from the log-ends side table written at publish time."""
    from topicflow.operators.publish import read_log_ends
    return G.profile_from_ends(read_log_ends(spark, TT.events_log(spark, sf_dir)))


# ---------------------------------------------------------------- scans and start positions

TRACEPARENT_SQL = ("'00-' || md5(CAST(event_id AS VARCHAR)) || '-' || "
                   "substr(sha256('produce:' || CAST(event_id AS VARCHAR)), 1, 16) || '-' || "
                   "CASE WHEN event_type <> 'error' THEN '01' ELSE '00' END")


@register("topic_scan", S.with_topic("""
SELECT topic, partition, "offset", CAST(user_id AS VARCHAR) AS key, props AS value,
       ts AS timestamp, event_type
FROM rec"""))
def topic_scan(spark, sf_dir):
    r = log(spark, sf_dir)
    return r.select("topic", "partition", "offset", R.decode_key().alias("key"),
                    R.value_text().alias("value"), ntz("timestamp"),
                    R.header_value("event-type").alias("event_type"))


@register("multi_topic", S.with_topic("""
SELECT topic, partition, "offset", CAST(user_id AS VARCHAR) AS key FROM rec
WHERE topic IN ('demo.purchase', 'demo.signup')"""))
def multi_topic(spark, sf_dir):
    r = log(spark, sf_dir, "demo.purchase,demo.signup")
    return r.select("topic", "partition", "offset", R.decode_key().alias("key"))


@register("start_earliest", S.with_topic("""
SELECT 'payments' AS "group", topic, partition, "offset" FROM rec
WHERE topic = 'demo.purchase'"""))
def start_earliest(spark, sf_dir):
    g = next(x for x in DEMO_GROUPS if x.name == "payments")
    return (G.start_filter(log(spark, sf_dir), g)
            .select(F.lit(g.name).alias("group"), "topic", "partition", "offset"))


@register("start_latest", S.with_topic("""
SELECT 'kitchen' AS "group", topic, partition, "offset" FROM rec
WHERE topic = 'demo.purchase' AND ts >= TIMESTAMP '2024-01-05 00:00:00'"""))
def start_latest(spark, sf_dir):
    g = next(x for x in DEMO_GROUPS if x.name == "kitchen")
    return (G.start_filter(log(spark, sf_dir), g)
            .select(F.lit(g.name).alias("group"), "topic", "partition", "offset"))


# ---------------------------------------------------------------- decoding

@register("decode_key", S.with_topic("""
SELECT topic, partition, "offset", CAST(user_id AS VARCHAR) AS key_text FROM rec"""))
def decode_key(spark, sf_dir):
    return log(spark, sf_dir).select("topic", "partition", "offset",
                                     R.decode_key_strict().alias("key_text"))


@register("json_strict", S.with_topic("""
SELECT topic, partition, "offset", CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM rec"""))
def json_strict(spark, sf_dir):
    r = log(spark, sf_dir)
    return r.select("topic", "partition", "offset",
                    R.decode_json_strict("value", "k bigint")["k"].alias("k"))


@register("json_or_text", S.with_topic("""
SELECT topic, partition, "offset", json_valid(props) AS is_json,
       CAST(json_extract(props, '$.k') AS BIGINT) AS k, props AS raw FROM rec"""))
def json_or_text(spark, sf_dir):
    d = R.decode_json_or_text()
    r = log(spark, sf_dir).select("topic", "partition", "offset", d.alias("d"))
    return r.select("topic", "partition", "offset", F.col("d.is_json").alias("is_json"),
                    F.try_variant_get("d.json", "$.k", "bigint").alias("k"),
                    F.col("d.raw").alias("raw"))


@register("header_map", S.with_topic(f"""
SELECT topic, partition, "offset", event_type, {TRACEPARENT_SQL} AS traceparent,
       2 AS n_headers FROM rec"""))
def header_map(spark, sf_dir):
    r = log(spark, sf_dir).select("topic", "partition", "offset", R.header_map().alias("h"))
    return r.select("topic", "partition", "offset",
                    F.col("h")["event-type"].alias("event_type"),
                    F.col("h")["traceparent"].alias("traceparent"),
                    F.size("h").alias("n_headers"))


@register("by_event_type", S.with_topic("""
SELECT event_type, count(*) AS records,
       CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS k_sum
FROM rec GROUP BY event_type"""))
def by_event_type(spark, sf_dir):
    r = log(spark, sf_dir).select(R.header_map()["event-type"].alias("event_type"),
                                  F.try_variant_get(R.decode_json_or_text()["json"], "$.k",
                                                    "bigint").alias("k"))
    return r.groupBy("event_type").agg(F.count(F.lit(1)).alias("records"),
                                       F.sum("k").alias("k_sum"))


@register("encode_roundtrip", """
SELECT event_id, ts, user_id, event_type, value, props FROM events""")
def encode_roundtrip(spark, sf_dir):
    ev = TT.table(spark, sf_dir, "events")
    enc = ev.select(R.encode_value("event_id", "ts", "user_id", "event_type", "value", "props")
                    .alias("v"))
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, " \
             "value double, props string"
    return enc.select(R.decode_json_strict("v", schema).alias("o")).select("o.*")


@register("record_lines", S.with_topic("""
SELECT topic, partition, "offset",
       printf('partition=%d offset=%d key=%s value=%s', partition, "offset",
              CAST(user_id AS VARCHAR), props) AS line
FROM rec"""))
def record_lines(spark, sf_dir):
    return log(spark, sf_dir).select("topic", "partition", "offset", R.record_line().alias("line"))


# ---------------------------------------------------------------- publishing

@register("offset_assign", S.with_topic("""
SELECT event_id, topic, partition, "offset" FROM rec"""))
def offset_assign(spark, sf_dir):
    return events_topic(spark, sf_dir, keep_event_id=True).select(
        "event_id", "topic", "partition", "offset")


@register("key_partition", S.with_topic("""
SELECT topic, CAST(user_id AS VARCHAR) AS key_text, count(DISTINCT partition) AS partitions,
       min(partition) AS partition, count(*) AS records
FROM rec GROUP BY topic, CAST(user_id AS VARCHAR)"""))
def key_partition(spark, sf_dir):
    return G.key_stability(log(spark, sf_dir))


@register("key_spread", S.with_topic("""
SELECT topic, partition, count(*) AS records, count(DISTINCT user_id) AS distinct_keys
FROM rec GROUP BY topic, partition"""))
def key_spread(spark, sf_dir):
    return G.key_spread(log(spark, sf_dir))


@register("delivery_report", S.with_topic("""
SELECT event_id, topic, partition, "offset", 'delivered' AS status, CAST(NULL AS VARCHAR) AS error FROM rec"""))
def delivery_report(spark, sf_dir):
    """The events published to a log of their own, and what became of each."""
    from topicflow.operators.publish import delivery_report as report, publish
    return report(publish(TT.events_records(spark, sf_dir), scratch_dir(spark, "report-log"), "event_id"), "event_id")


@register("publish_append", S.with_topic("""
SELECT event_id, topic, partition,
       row_number() OVER (PARTITION BY topic, partition ORDER BY event_id % 3, event_id) - 1 AS "offset"
FROM rec"""))
def publish_append(spark, sf_dir):
    """The events published in three calls with default arguments: each appends behind the one before."""
    from topicflow.operators.publish import publish
    root = scratch_dir(spark, "append-log")
    recs = TT.events_records(spark, sf_dir)
    for turn in range(3):
        publish(recs.where(F.col("event_id") % 3 == turn), root, "event_id")
    sent = TT.table(spark, sf_dir, "events").select("event_id", F.md5(F.col("event_id").cast("string")).alias("trace"))
    trace = TR.parse_traceparent(R.header_value(TR.TRACEPARENT_HEADER))["trace_id"]
    stored = read_topic(spark, root, ALL_TOPICS).select("topic", "partition", "offset", trace.alias("trace"))
    return sent.join(stored, "trace").drop("trace")


@register("publish_stream_append", S.with_topic("""
SELECT topic, partition, count(*) AS records, count(*) AS distinct_offsets, CAST(0 AS BIGINT) AS begin_offset,
       count(*) AS end_offset, true AS dense, count(DISTINCT event_id) AS events
FROM rec GROUP BY topic, partition"""))
def publish_stream_append(spark, sf_dir):
    """A stream published, a few files per micro-batch, onto a log that holds the earlier events: dense offsets and
    every event once."""
    from topicflow.operators.publish import publish
    cut = F.col("timestamp") < F.lit(RESUME_CUT).cast("timestamp")
    root, rest = scratch_dir(spark, "filled-log"), scratch_dir(spark, "rest-log")
    recs = TT.events_records(spark, sf_dir)
    publish(recs.where(cut), root, "event_id")
    publish(recs.where(~cut), rest, "event_id")
    s = read_topic(spark, rest, ALL_TOPICS, streaming=True, options={"maxFilesPerTrigger": "8"})
    ST.await_all([ST.publish_stream(s.drop("partition", "offset"), root, _ck(spark, "append"),
                                    partitions=TT.PARTITIONS, key_text=R.decode_key())])
    full = read_topic(spark, root, ALL_TOPICS)
    trace = TR.parse_traceparent(R.header_value(TR.TRACEPARENT_HEADER))["trace_id"]
    events = full.groupBy("topic", "partition").agg(F.count_distinct(trace).alias("events"))
    return P.order_check(full).join(events, ["topic", "partition"])


# ---------------------------------------------------------------- groups

@register("group_fan_out", S.with_topic("""
SELECT grp AS "group", topic, partition, count(*) AS records, min("offset") AS first_offset,
       max("offset") AS last_offset
FROM fan WHERE started GROUP BY grp, topic, partition""", DEMO_GROUPS))
def group_fan_out(spark, sf_dir):
    f = G.fan_out_summary(G.interval_summary(log(spark, sf_dir), DEMO_GROUPS), DEMO_GROUPS).where("started")
    return f.groupBy("group", "topic", "partition").agg(
        F.sum("records").alias("records"), F.min("first_offset").alias("first_offset"),
        F.max("last_offset").alias("last_offset"))


@register("unconsumed", S.with_topic("""
SELECT grp AS "group", topic, partition, "offset" FROM fan WHERE started AND NOT consumed""",
                                     DEMO_GROUPS))
def unconsumed(spark, sf_dir):
    return G.not_yet_consumed(log(spark, sf_dir), DEMO_GROUPS).select("group", "topic", "partition", "offset")


# ---------------------------------------------------------------- progress

@register("consumed_total", S.with_topic("""
SELECT grp AS "group", count(*) AS records FROM fan WHERE consumed GROUP BY grp""", DEMO_GROUPS))
def consumed_total(spark, sf_dir):
    return P.consumed_total(summary(spark, sf_dir))


THROUGHPUT_SQL = """
SELECT "group", records, first_ts, last_ts, seconds,
       CASE WHEN seconds = 0 THEN CAST(records AS DOUBLE) ELSE records / seconds END AS rate
FROM (SELECT grp AS "group", count(*) AS records, min(ts) AS first_ts, max(ts) AS last_ts,
             date_diff('microsecond', min(ts), max(ts)) / 1000000.0 AS seconds
      FROM fan WHERE consumed GROUP BY grp)"""


@register("throughput", S.with_topic(THROUGHPUT_SQL, DEMO_GROUPS))
def throughput(spark, sf_dir):
    t = P.throughput(summary(spark, sf_dir))
    return t.select("group", "records", ntz("first_ts"), ntz("last_ts"), "seconds", "rate")


@register("progress_points", S.with_topic("""
SELECT "group", n, topic, partition, "offset",
       CASE WHEN secs = 0 THEN CAST(n AS DOUBLE) ELSE n / secs END AS rate
FROM (SELECT grp AS "group", topic, partition, "offset",
             row_number() OVER (PARTITION BY grp ORDER BY ts, topic, partition, "offset") AS n,
             date_diff('microsecond', min(ts) OVER (PARTITION BY grp), ts) / 1000000.0 AS secs
      FROM fan WHERE consumed)
WHERE n % 5000 = 0""", DEMO_GROUPS))
def progress_points(spark, sf_dir):
    return P.progress_points(done(spark, sf_dir), P.PROGRESS_EVERY)


@register("first_five", S.with_topic("""
SELECT "group", n, topic, partition, "offset"
FROM (SELECT grp AS "group", topic, partition, "offset",
             row_number() OVER (PARTITION BY grp ORDER BY ts, topic, partition, "offset") AS n
      FROM fan WHERE consumed)
WHERE n <= 5""", DEMO_GROUPS))
def first_five(spark, sf_dir):
    return P.first_n(done(spark, sf_dir), P.FIRST_N).select(
        "group", "n", "topic", "partition", "offset")


@register("limit_n", S.with_topic("""
SELECT topic, partition, "offset", ts AS timestamp FROM rec
ORDER BY ts, topic, partition, "offset" LIMIT 30"""))
def limit_n(spark, sf_dir):
    return P.limit_n(log(spark, sf_dir), 30).select("topic", "partition", "offset",
                                                     ntz("timestamp"))


@register("every_nth_offset", S.with_topic("""
SELECT topic, partition, "offset", CAST(user_id AS VARCHAR) AS key FROM rec
WHERE "offset" % 3000 = 0"""))
def every_nth_offset(spark, sf_dir):
    return P.every_nth_offset(log(spark, sf_dir), P.SAMPLE_EVERY_OFFSETS).select(
        "topic", "partition", "offset", R.decode_key().alias("key"))


@register("order_check", S.with_topic("""
SELECT topic, partition, count(*) AS records, count(DISTINCT "offset") AS distinct_offsets,
       min("offset") AS begin_offset, max("offset") + 1 AS end_offset,
       (count(*) = count(DISTINCT "offset")
        AND count(*) = max("offset") + 1 - min("offset")) AS dense
FROM rec GROUP BY topic, partition"""))
def order_check(spark, sf_dir):
    return P.order_check(log(spark, sf_dir))


@register("rate_window", S.with_topic("""
SELECT topic, time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
       time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, count(*) AS records
FROM rec GROUP BY topic, time_bucket(INTERVAL 1 HOUR, ts)"""))
def rate_window(spark, sf_dir):
    w = P.rate_window(log(spark, sf_dir), "1 hour")
    return w.select("topic", ntz("window_start"), ntz("window_end"), "records")


# ---------------------------------------------------------------- trace links

@register("trace_format", f"""
SELECT event_id, {TRACEPARENT_SQL} AS traceparent FROM events""")
def trace_format(spark, sf_dir):
    ev = TT.table(spark, sf_dir, "events")
    return ev.select("event_id", TR.format_traceparent(
        F.md5(F.col("event_id").cast("string")), TT.produce_span_id(F.col("event_id")),
        F.col("event_type") != "error").alias("traceparent"))


@register("trace_parse", S.with_topic("""
SELECT topic, partition, "offset", md5(CAST(event_id AS VARCHAR)) AS trace_id,
       substr(sha256('produce:' || CAST(event_id AS VARCHAR)), 1, 16) AS span_id,
       event_type <> 'error' AS sampled
FROM rec"""))
def trace_parse(spark, sf_dir):
    r = log(spark, sf_dir).select(
        "topic", "partition", "offset",
        TR.parse_traceparent(R.header_value(TR.TRACEPARENT_HEADER)).alias("c"))
    return r.select("topic", "partition", "offset", "c.trace_id", "c.span_id", "c.sampled")


@register("trace_header", f"""
SELECT event_id, 1 AS n_headers, {TRACEPARENT_SQL} AS traceparent FROM events""")
def trace_header(spark, sf_dir):
    ev = TT.table(spark, sf_dir, "events")
    h = TR.trace_header(F.md5(F.col("event_id").cast("string")),
                        TT.produce_span_id(F.col("event_id")), F.col("event_type") != "error")
    return ev.select("event_id", F.coalesce(F.size(h), F.lit(0)).alias("n_headers"),
                     F.element_at(h, 1)["value"].cast("string").alias("traceparent"))


@register("trace_link", S.with_topic("""
SELECT grp AS reader, md5(CAST(event_id AS VARCHAR)) AS trace_id,
       substr(sha256('consume:' || grp || ':' || md5(CAST(event_id AS VARCHAR)) || ':'
                     || CAST("offset" AS VARCHAR)), 1, 16) AS span_id,
       substr(sha256('produce:' || CAST(event_id AS VARCHAR)), 1, 16) AS parent_span_id,
       'kafka.consume' AS name, 'kafka' AS system, topic AS destination, partition, "offset",
       event_id AS parent_event_id
FROM fan WHERE consumed""", DEMO_GROUPS))
def trace_link(spark, sf_dir):
    spans = TS.consume_spans(done(spark, sf_dir))
    ev = TT.table(spark, sf_dir, "events")
    produced = ev.select(F.md5(F.col("event_id").cast("string")).alias("trace_id"),
                         TT.produce_span_id(F.col("event_id")).alias("span_id"), "event_id")
    return TS.link_spans(spans, produced)


# ---------------------------------------------------------------- order payloads

def order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order topic as stored in its file log (published once per application)."""
    return read_topic(spark, TT.orders_log(spark, sf_dir), TT.ORDERS_TOPIC)


CANON_COLS = ("topic", "partition", "offset", "order_id", "user", "total", "status",
              "restaurant", "seq", "ts")


@register("normalize_orders", S.with_orders("""
SELECT topic, partition, "offset", order_id, "user", total, status, restaurant, seq, ts, sku, qty
FROM canon_items"""))
def normalize_orders(spark, sf_dir):
    return O.explode_items(O.normalize_orders(order_log(spark, sf_dir))).select(
        *CANON_COLS, "sku", "qty")


@register("route_cost", S.with_orders("""
SELECT topic, partition, "offset", order_id, restaurant,
       CASE WHEN restaurant IN ('Tandoori Tales', 'Masala Magic') THEN 2 ELSE 1 END AS prep_cost
FROM canon WHERE restaurant IS NOT NULL"""))
def route_cost(spark, sf_dir):
    o = O.normalize_orders(order_log(spark, sf_dir)).where(F.col("restaurant").isNotNull())
    return o.select("topic", "partition", "offset", "order_id", "restaurant",
                    O.prep_cost().alias("prep_cost"))


@register("require_fields", S.with_orders("""
SELECT topic, partition, "offset",
       CASE shape WHEN 0 THEN 'missing:order_id' ELSE 'missing:restaurant' END AS reason
FROM canon WHERE shape <> 4"""))
def require_fields(spark, sf_dir):
    o = O.normalize_orders(order_log(spark, sf_dir))
    _, rejects = O.require_fields(o, ["order_id", "restaurant", "seq"])
    return rejects.select("topic", "partition", "offset", "reason")


# The orders worker's verdict on every order record (reason null when it can be processed).
ORDER_REASONS_SQL = """
SELECT topic, partition, "offset",
  CASE shape WHEN 0 THEN 'decode:not JSON'
             WHEN 1 THEN 'missing:order_id'
             WHEN 2 THEN CASE WHEN first_sku IS NULL THEN 'missing:item' END
             WHEN 5 THEN CASE WHEN c_name IS NULL THEN 'missing:user' ELSE 'missing:item' END
             ELSE 'missing:user' END AS reason
FROM canon"""
DEAD_LETTER_SQL = f"""
SELECT r.topic, r.partition, r."offset", r.reason, c.key_text AS key,
       CASE c.shape WHEN 0 THEN 'unreadable order ' || CAST(c.o_orderkey AS VARCHAR) ELSE c.order_id END AS payload
FROM ({ORDER_REASONS_SQL}) r JOIN canon c ON c.partition = r.partition AND c."offset" = r."offset"
WHERE r.reason IS NOT NULL"""


def _letters(rejects: DataFrame) -> DataFrame:
    """Dead letters with their key as text and what identifies their payload."""
    text = R.value_text()
    return rejects.select(
        *POSITION, "reason", R.decode_key().alias("key"),
        F.coalesce(F.get_json_object(text, "$.order_id"), F.get_json_object(text, "$.id"), text).alias("payload"))


@register("dead_letter", S.with_orders(DEAD_LETTER_SQL))
def dead_letter(spark, sf_dir):
    return _letters(O.order_rejects(order_log(spark, sf_dir)))


def order_requests(spark: SparkSession, sf_dir: str, keep_identity: bool = False) -> DataFrame:
    """API order requests from line items: user = customer name, item = part, quantity."""
    li = TT.table(spark, sf_dir, "lineitem")
    o = TT.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = TT.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    j = (li.join(o, li["l_orderkey"] == o["o_orderkey"], "left")
         .join(c, F.col("o_custkey") == c["c_custkey"], "left"))
    extra = ["l_partkey", "l_suppkey"] if keep_identity else []
    return j.select("l_orderkey", "l_linenumber", *extra, F.col("c_name").alias("user"),
                    F.concat(F.lit("part-"), F.col("l_partkey").cast("string")).alias("item"),
                    F.col("l_quantity").cast("bigint").alias("quantity"))


@register("validate_quantity", """
SELECT l_orderkey, l_linenumber, "user", item, quantity,
  CASE WHEN "user" IS NULL THEN 'missing:user' WHEN item IS NULL THEN 'missing:item'
       WHEN quantity IS NULL THEN 'missing:quantity'
       WHEN quantity NOT BETWEEN 1 AND 20 THEN 'range:quantity not in 1..20' END AS reason
FROM (SELECT l.l_orderkey, l.l_linenumber, c.c_name AS "user",
             'part-' || CAST(l.l_partkey AS VARCHAR) AS item,
             CAST(l.l_quantity AS BIGINT) AS quantity
      FROM lineitem l LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey
      LEFT JOIN customer c ON c.c_custkey = o.o_custkey)""")
def validate_quantity(spark, sf_dir):
    return order_requests(spark, sf_dir).withColumn("reason", O.validation_reason())


@register("shape_order", """
SELECT sha256(concat_ws('|', CAST(l.l_orderkey AS VARCHAR), CAST(l.l_linenumber AS VARCHAR),
                        CAST(l.l_partkey AS VARCHAR), CAST(l.l_suppkey AS VARCHAR))) AS order_id,
       c.c_name AS "user", 'part-' || CAST(l.l_partkey AS VARCHAR) AS item,
       CAST(l.l_quantity AS BIGINT) AS quantity, c.c_name AS key_text
FROM lineitem l LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey
LEFT JOIN customer c ON c.c_custkey = o.o_custkey
WHERE c.c_name IS NOT NULL AND CAST(l.l_quantity AS BIGINT) BETWEEN 1 AND 20""")
def shape_order(spark, sf_dir):
    """Valid requests shaped as API orders, with replay-stable ids (a hash of the request's
    identity) instead of random UUIDs, so a recomputed task produces the same ids."""
    ok, _ = O.validate_orders(order_requests(spark, sf_dir, keep_identity=True))
    return O.shape_orders(ok, stable_id=["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])


# ---------------------------------------------------------------- streams and files
#
# Streaming reports run their query to the end of the input (availableNow) into files in
# the shared checkpoint folder and return what the sink committed.

def _ck(spark, name):
    return scratch_dir(spark, f"ck-{name}")


def stream_log(spark: SparkSession, sf_dir: str, topics=ALL_TOPICS, **opts) -> DataFrame:
    return read_topic(spark, TT.events_log(spark, sf_dir), topics, streaming=True,
                      options=opts or None)


@register("stream_scan", S.with_topic("""
SELECT topic, partition, "offset", CAST(user_id AS VARCHAR) AS key, props AS value,
       ts AS timestamp
FROM rec"""))
def stream_scan(spark, sf_dir):
    s = stream_log(spark, sf_dir, maxFilesPerTrigger="8").select(
        "topic", "partition", "offset", R.decode_key().alias("key"),
        R.value_text().alias("value"), ntz("timestamp"))
    out = scratch_dir(spark, "stream-scan")
    ST.await_all([ST.copy_stream(s, out, _ck(spark, "stream-scan"))])
    return spark.read.parquet(out)


@register("drain", S.with_topic("""
SELECT topic, partition, count(*) AS records, max("offset") + 1 AS end_offset
FROM rec GROUP BY topic, partition"""))
def drain(spark, sf_dir):
    s = stream_log(spark, sf_dir).groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("records"), (F.max("offset") + 1).alias("end_offset"))
    out = scratch_dir(spark, "drain")

    def each(batch, batch_id):
        batch.write.mode("overwrite").parquet(out)

    q = (s.writeStream.outputMode("complete").foreachBatch(each)
         .option("checkpointLocation", _ck(spark, "drain")).trigger(availableNow=True).start())
    ST.await_all([q])
    return spark.read.parquet(out)


WORKER_SQL = """
SELECT topic, partition, "offset", order_id, c_name AS "user", first_sku AS item,
       total_qty AS quantity
FROM canon WHERE shape = 2 AND first_sku IS NOT NULL"""


def _run_worker(spark, sf_dir, name):
    s = read_topic(spark, TT.orders_log(spark, sf_dir), TT.ORDERS_TOPIC, streaming=True,
                   options={"maxFilesPerTrigger": "4"})
    out = scratch_dir(spark, name)
    ST.await_all([ST.run_worker(s, O.worker_orders, out, _ck(spark, name))])
    return out


@register("worker", S.with_orders(WORKER_SQL))
def worker(spark, sf_dir):
    return ST.read_outcome(spark, _run_worker(spark, sf_dir, "worker"), ST.OK).select(
        *POSITION, "order_id", "user", "item", "quantity")


@register("worker_rejects", S.with_orders(DEAD_LETTER_SQL))
def worker_rejects(spark, sf_dir):
    """What the streaming worker set aside, with its reasons."""
    return _letters(ST.read_outcome(spark, _run_worker(spark, sf_dir, "worker-rejects"), ST.REJECTED))


RESUME_CUT = "2024-01-15 00:00:00"


@register("resume", S.with_topic(f"""
SELECT topic, partition, "offset",
       CASE WHEN ts < TIMESTAMP '{RESUME_CUT}' THEN 1 ELSE 2 END AS run
FROM rec"""))
def resume(spark, sf_dir):
    """A worker run, then more records published, then a second run on the same checkpoint:
    the second run reads exactly the new records."""
    from topicflow.operators.publish import publish
    recs = TT.events_records(spark, sf_dir)
    cut = F.col("timestamp") < F.lit(RESUME_CUT).cast("timestamp")
    root, out, ck = scratch_dir(spark, "resume-log"), scratch_dir(spark, "resume-out"), \
        _ck(spark, "resume")

    def run():
        s = read_topic(spark, root, ALL_TOPICS, streaming=True).select(
            "topic", "partition", "offset", F.lit(None).cast("string").alias("reason"))
        q = ST.run_worker(s, lambda b: b, out, ck)
        ST.await_all([q])
        return q.lastProgress["batchId"] if q.lastProgress else -1

    publish(recs.where(cut), root, "event_id")
    first_last = run()
    publish(recs.where(~cut), root, "event_id")
    run()
    got = ST.read_outcome(spark, out, ST.OK)
    return got.select("topic", "partition", "offset",
                      F.when(F.col("batch_id") <= first_last, 1).otherwise(2).alias("run"))


@register("dedup", S.with_topic("""
SELECT topic, partition, "offset", ts AS timestamp FROM rec"""))
def dedup(spark, sf_dir):
    """The log delivered twice (an at-least-once replay) and read as a stream: every record
    comes out once."""
    src = log(spark, sf_dir)
    replay = scratch_dir(spark, "replay-log")
    for _ in range(2):
        src.write.mode("append").partitionBy("topic", "partition").parquet(replay)
    s = read_topic(spark, replay, ALL_TOPICS, streaming=True,
                   options={"maxFilesPerTrigger": "8"})
    out = scratch_dir(spark, "dedup")
    ST.await_all([SF.dedup_stream(s.select(*POSITION, ntz("timestamp")), out, _ck(spark, "dedup"))])
    return spark.read.parquet(out)


@register("fan_out_stream", S.with_topic("""
SELECT grp AS "group", topic, partition, "offset" FROM fan WHERE consumed""", DEMO_GROUPS))
def fan_out_stream(spark, sf_dir):
    streams = {}
    for g in DEMO_GROUPS:
        s = stream_log(spark, sf_dir, g.topics)
        s = G.start_filter(s, g)
        if g.consumed_until is not None:
            s = s.where(F.col("timestamp").cast("timestamp_ntz")
                        < F.lit(g.consumed_until).cast("timestamp_ntz"))
        else:
            s = s.where(F.lit(False))
        streams[g.name] = s.select("topic", "partition", "offset")
    out = scratch_dir(spark, "fan-out")
    ST.await_all(ST.run_group_streams(streams, out, _ck(spark, "fan-out")))
    schema = next(iter(streams.values())).schema
    return ST.read_group_outputs(spark, out, list(streams), schema).select(
        "group", "topic", "partition", "offset")


@register("topic_to_file", "SELECT props AS value FROM events")
def topic_to_file(spark, sf_dir):
    s = stream_log(spark, sf_dir).select(R.value_text().alias("value"))
    out = scratch_dir(spark, "topic-to-file")
    ST.await_all([ST.copy_stream(s, out, _ck(spark, "topic-to-file"), fmt="text")])
    return spark.read.text(out)


ORDER_FILE_SQL = S.with_orders("""
SELECT o_orderkey AS order_id, c_name AS "user", price AS total FROM ord""")


@register("jsonl_lines", ORDER_FILE_SQL)
def jsonl_lines(spark, sf_dir):
    lines = FI.read_jsonl(spark, TT.order_file_dir(spark, sf_dir))
    v = R.value_text()
    return lines.select(F.get_json_object(v, "$.order_id").try_cast("bigint").alias("order_id"),
                        F.get_json_object(v, "$.user").alias("user"),
                        F.get_json_object(v, "$.total").try_cast("double").alias("total"))


@register("order_file", S.with_orders("""
SELECT o_orderkey AS order_id, c_name AS "user", first_sku AS sku, total_qty AS qty, price AS total,
       'PLACED' AS status, o_orderdate AS ts FROM ord
UNION ALL
SELECT o_orderkey, c_name, second_sku, 1, price, 'PLACED', o_orderdate FROM ord WHERE NOT no_items"""))
def order_file(spark, sf_dir):
    o = FI.read_order_file(spark, TT.order_file_dir(spark, sf_dir))
    x = o.select("order_id", "user", F.explode_outer("items").alias("it"), "total", "status",
                 ntz("ts"))
    return x.select("order_id", "user", F.col("it.sku").alias("sku"),
                    F.col("it.qty").alias("qty"), "total", "status", "ts")


@register("file_to_topic", ORDER_FILE_SQL)
def file_to_topic(spark, sf_dir):
    # what a micro-batch holds on disk meanwhile is bounded by its files
    src = FI.read_jsonl(spark, TT.order_file_dir(spark, sf_dir), streaming=True, options={"maxFilesPerTrigger": "64"})
    root = scratch_dir(spark, "file-topic-log")
    q = ST.publish_stream(src.withColumn("topic", F.lit(TT.ORDERS_TOPIC)), root,
                          _ck(spark, "f2t"), partitions=TT.PARTITIONS)
    ST.await_all([q])
    back = read_topic(spark, root, TT.ORDERS_TOPIC)
    v = R.value_text()
    return back.select(F.get_json_object(v, "$.order_id").try_cast("bigint").alias("order_id"),
                       F.get_json_object(v, "$.user").alias("user"),
                       F.get_json_object(v, "$.total").try_cast("double").alias("total"))


@register("publish_readback", S.with_orders("""
SELECT topic, partition, "offset", key_text AS key,
       CASE WHEN shape = 1 THEN NULL ELSE order_id END AS order_id
FROM canon"""))
def publish_readback(spark, sf_dir):
    r = read_topic(spark, TT.orders_log(spark, sf_dir), TT.ORDERS_TOPIC)
    return r.select("topic", "partition", "offset", R.decode_key().alias("key"),
                    F.get_json_object(R.value_text(), "$.order_id").alias("order_id"))


@register("rate_window_stream", S.with_topic("""
SELECT topic, time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
       time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, count(*) AS records
FROM rec GROUP BY topic, time_bucket(INTERVAL 1 HOUR, ts)"""))
def rate_window_stream(spark, sf_dir):
    """Hourly records per topic from a stream, whatever the micro-batches: partial counts per batch, summed up when
    they are read."""
    out = scratch_dir(spark, "rate-window")
    ST.await_all([ST.window_counts(stream_log(spark, sf_dir, maxFilesPerTrigger="8"), out, _ck(spark, "rate-window"),
                                   "1 hour")])
    return ST.read_window_counts(spark, out).select("topic", ntz("window_start"), ntz("window_end"), "records")


@register("trace_link_stream", S.with_topic("""
SELECT grp AS reader, md5(CAST(event_id AS VARCHAR)) AS trace_id,
       substr(sha256('consume:' || grp || ':' || md5(CAST(event_id AS VARCHAR)) || ':'
                     || CAST("offset" AS VARCHAR)), 1, 16) AS span_id,
       substr(sha256('produce:' || CAST(event_id AS VARCHAR)), 1, 16) AS parent_span_id,
       'kafka.consume' AS name, 'kafka' AS system, topic AS destination, partition, "offset",
       topic AS parent_topic, partition AS parent_partition, "offset" AS parent_offset
FROM fan WHERE consumed""", DEMO_GROUPS))
def trace_link_stream(spark, sf_dir):
    """Span links from a stream, whatever the micro-batches: each batch stores the consume spans of all groups and
    the producer's spans (header context and delivery position); the links are made when they are read."""
    out = scratch_dir(spark, "trace-link-stream")
    s = stream_log(spark, sf_dir, maxFilesPerTrigger="8")
    ST.await_all([
        ST.partial_results(s, lambda b: TS.consume_spans(G.consumed(b, DEMO_GROUPS)), f"{out}/consumed",
                           _ck(spark, "spans-consumed")),
        ST.partial_results(s, _produced, f"{out}/produced", _ck(spark, "spans-produced"))])
    consumed, produced = (spark.read.parquet(f"{out}/{x}").drop("batch_id") for x in ("consumed", "produced"))
    return TS.link_spans(consumed, produced)


def _produced(records: DataFrame, ts: str | None = None) -> DataFrame:
    c = TR.parse_traceparent(R.header_value(TR.TRACEPARENT_HEADER))
    return records.select(c["trace_id"].alias("trace_id"), c["span_id"].alias("span_id"), *POSITION,
                          *([F.col(ts).alias("produced_ts")] if ts else []))


# Live streams: the events published in time order, a third of the month at a time, and every stream run again after
# each publish. So state is carried over restarts, and windows and spans close while the log grows.
SLICES = ("2024-01-11 00:00:00", "2024-01-21 00:00:00")
LIVE_DELAY, LIVE_STEP = "1 hour", 1000
_LIVE: dict[tuple[str, str], dict[str, str]] = {}


def live_outputs(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Folders that the live streams have written, once per application."""
    from topicflow.operators.publish import publish
    memo = (app_id(spark), sf_dir.rstrip("/"))
    if memo in _LIVE:
        return _LIVE[memo]
    root = scratch_dir(spark, "live-log")
    out = {k: scratch_dir(spark, f"live-{k}") for k in ("rates", "links", "progress")}
    ck = {k: _ck(spark, f"live-{k}") for k in out}
    out["log"] = root
    live = state_session(spark)
    recs, at = TT.event_sources(spark, sf_dir), F.col("ts").cast("timestamp_ntz")
    bounds = [None, *SLICES, None]
    for low, high in zip(bounds, bounds[1:]):
        part = recs if low is None else recs.where(at >= F.lit(low).cast("timestamp_ntz"))
        part = part if high is None else part.where(at < F.lit(high).cast("timestamp_ntz"))
        publish(part, root, "event_id", key_sketches=True, encode=lambda placed: TT.encode_events(placed).drop("event_id"),
                report=False)
        s = read_topic(live, root, ALL_TOPICS, streaming=True)
        consumed = TS.consume_spans(G.consumed(s, DEMO_GROUPS), ts="timestamp")
        produced = _produced(s, "timestamp")
        links = TS.link_spans_stream(consumed, produced, within="1 hour", delay=LIVE_DELAY)
        ST.await_all([
            ST.copy_stream(SF.live_rates(s, "1 hour", LIVE_DELAY), out["rates"], ck["rates"]),
            ST.copy_stream(links, out["links"], ck["links"]),
            SF.progress_stream(G.consumed(s, DEMO_GROUPS).select("group", "timestamp", *POSITION), out["progress"],
                               ck["progress"], every=LIVE_STEP)])
    _LIVE[memo] = out
    return out


@register("rate_live", S.with_topic("""
SELECT topic, time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
       time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, count(*) AS records,
       count(*) / CAST(3600 AS DOUBLE) AS per_second
FROM rec GROUP BY topic, time_bucket(INTERVAL 1 HOUR, ts)
HAVING time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM rec) - INTERVAL 1 HOUR"""))
def rate_live(spark, sf_dir):
    """The rates that a stream has emitted: all windows closed so far, each once."""
    return spark.read.parquet(live_outputs(spark, sf_dir)["rates"]).select(
        "topic", ntz("window_start"), ntz("window_end"), "records", "per_second")


@register("trace_link_live", REGISTRY["trace_link_stream"][1])
def trace_link_live(spark, sf_dir):
    """Span links that a stream-stream join has emitted, from its state."""
    return spark.read.parquet(live_outputs(spark, sf_dir)["links"]).drop("ts", "parent_produced_ts")


@register("progress_live", REGISTRY["progress_points"][1].replace("% 5000", f"% {LIVE_STEP}"))
def progress_live(spark, sf_dir):
    """Progress points written while the log was read."""
    return spark.read.parquet(live_outputs(spark, sf_dir)["progress"] + "/points").drop("batch_id")


@register("publish_history", S.with_topic(f"""
SELECT CAST(CASE WHEN ts < TIMESTAMP '{SLICES[0]}' THEN 0 WHEN ts < TIMESTAMP '{SLICES[1]}' THEN 1 ELSE 2 END AS BIGINT) AS version,
       topic, partition, min("offset") AS first_offset, max("offset") + 1 AS end_offset, count(*) AS records,
       CAST(sum(strlen(CAST(user_id AS VARCHAR)) + strlen(props)) AS BIGINT) AS bytes, min(ts) AS first_ts, max(ts) AS last_ts
FROM rec GROUP BY ALL"""))
def publish_history(spark, sf_dir):
    """What each publish of the live log added, from the side table."""
    from topicflow.operators.publish import publish_history
    return publish_history(spark, live_outputs(spark, sf_dir)["log"]).withColumns({
        c: F.col(c).cast("timestamp_ntz") for c in ("first_ts", "last_ts")})


@register("start_by_time", S.with_topic(f"""
SELECT topic, partition, "offset" FROM rec WHERE topic = 'demo.purchase' AND ts >= TIMESTAMP '{RESUME_CUT}'"""))
def start_by_time(spark, sf_dir):
    """The purchases from a time on: publishes that end earlier aren't read."""
    from topicflow.sources.topics import read_since
    return read_since(spark, live_outputs(spark, sf_dir)["log"], "demo.purchase", RESUME_CUT).select(*POSITION)


@register("key_spread_sketch", S.with_topic("""
SELECT topic, partition, count(*) AS records, true AS within_bound FROM rec GROUP BY topic, partition"""))
def key_spread_sketch(spark, sf_dir):
    """Key spread from the sketches of all publishes, held against the exact count: within five standard errors."""
    from topicflow.operators.publish import stored_key_spread
    root = live_outputs(spark, sf_dir)["log"]
    exact = G.key_spread(read_topic(spark, root, ALL_TOPICS)).select("topic", "partition", F.col("distinct_keys").alias("exact"))
    off = F.abs(F.col("distinct_keys") - F.col("exact"))
    return stored_key_spread(spark, root).join(exact, ["topic", "partition"]).select(
        "topic", "partition", "records", (off <= 1 + 0.08 * F.col("exact")).alias("within_bound"))


POLL_RECORDS = 8192
POLLS_AHEAD = 64  # fetched by one read of the log


@register("bounded_polls", S.with_topic(f"""
SELECT topic, partition, "offset", ts AS timestamp, true AS in_bound FROM rec"""))
def bounded_polls(spark, sf_dir):
    """The whole log, at most 8,192 records at a time, from positions committed after each poll."""
    from topicflow.streaming.polls import Reader
    out = scratch_dir(spark, "polls")
    reader = Reader(spark, live_outputs(spark, sf_dir)["log"], ALL_TOPICS, _ck(spark, "polls"), max_records=POLL_RECORDS,
                    ahead=POLLS_AHEAD)
    reader.drain(lambda batch, number: batch.select(*POSITION, ntz("timestamp")).write.mode("overwrite")
                 .parquet(f"{out}/poll={number}"))
    rows = spark.read.parquet(out)
    sizes = rows.groupBy("poll").agg((F.count(F.lit(1)) <= POLL_RECORDS).alias("in_bound"))
    return rows.join(sizes, "poll").drop("poll")


@register("file_follow", ORDER_FILE_SQL)
def file_follow(spark, sf_dir):
    """Order files followed by byte positions, some of their lines at a time."""
    from topicflow.streaming.follow import Follower
    path, out = TT.order_file_dir(spark, sf_dir, plain=True), scratch_dir(spark, "follow")
    size = spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0]
    follower = Follower(spark, path, _ck(spark, "follow"), max_bytes=size // 3 + 1)
    follower.drain(lambda batch, number: batch.write.mode("overwrite").parquet(f"{out}/step={number}"))
    v = R.value_text()
    return spark.read.parquet(out).select(
        F.get_json_object(v, "$.order_id").try_cast("bigint").alias("order_id"), F.get_json_object(v, "$.user").alias("user"),
        F.get_json_object(v, "$.total").try_cast("double").alias("total"))


@register("trace_tree", S.with_topic("""
, consumed AS (
  SELECT md5(CAST(event_id AS VARCHAR)) AS trace_id, substr(sha256('produce:' || CAST(event_id AS VARCHAR)), 1, 16) AS produced,
         event_type <> 'click' AS kept,
         substr(sha256('consume:' || grp || ':' || md5(CAST(event_id AS VARCHAR)) || ':' || CAST("offset" AS VARCHAR)), 1, 16) AS c
  FROM fan WHERE consumed),
spans AS (
  SELECT DISTINCT md5(CAST(event_id AS VARCHAR)) AS trace_id, CAST(NULL AS VARCHAR) AS parent,
         substr(sha256('produce:' || CAST(event_id AS VARCHAR)), 1, 16) AS span_id
  FROM rec WHERE event_type <> 'click'
  UNION ALL SELECT trace_id, produced, c FROM consumed
  UNION ALL SELECT trace_id, c, substr(sha256('process:' || c), 1, 16) FROM consumed),
tree AS (
  SELECT trace_id, span_id, span_id AS root_span_id, CAST(0 AS INTEGER) AS depth, span_id AS path,
         CASE WHEN parent IS NULL THEN 'root' ELSE 'orphan' END AS kind
  FROM spans s WHERE parent IS NULL
     OR NOT EXISTS (SELECT 1 FROM spans p WHERE p.trace_id = s.trace_id AND p.span_id = s.parent)
  UNION ALL
  SELECT s.trace_id, s.span_id, t.root_span_id, t.depth + 1, t.path || '/' || s.span_id, 'child'
  FROM tree t JOIN spans s ON s.trace_id = t.trace_id AND s.parent = t.span_id)
SELECT trace_id, span_id, root_span_id, depth, path, kind FROM tree""", DEMO_GROUPS)
          .replace("WITH ", "WITH RECURSIVE ", 1))
def trace_tree(spark, sf_dir):
    """Produce, consume and process spans of the demo groups as trees. The producers of clicks sent no span of their own,
    so the spans that read clicks are orphans."""
    r = log(spark, sf_dir)
    made = _produced(r.where("topic <> 'demo.click'")).select("trace_id", "span_id", F.lit(None).cast("string").alias("parent_span_id"))
    read = TS.consume_spans(done(spark, sf_dir)).select("trace_id", "span_id", "parent_span_id")
    spans = made.unionByName(read).unionByName(TS.process_spans(read).drop("name"))
    return TS.span_trees(spans).select("trace_id", "span_id", "root_span_id", "depth", F.array_join("path", "/").alias("path"), "kind")


RANGES_CTE = """
own AS (
  SELECT grp, topic, partition, "offset" FROM fan WHERE consumed AND user_id % 5 <> 0),
bounds AS (
  SELECT grp, topic, partition, min("offset") AS b, max("offset") + 1 AS e FROM fan GROUP BY grp, topic, partition),
missing AS (
  SELECT f.grp, f.topic, f.partition, f."offset",
         f."offset" - row_number() OVER (PARTITION BY f.grp, f.topic, f.partition ORDER BY f."offset") AS island
  FROM fan f WHERE NOT (f.consumed AND f.user_id % 5 <> 0)),
gaps AS (
  SELECT grp AS "group", topic, partition, min("offset") AS from_offset, max("offset") + 1 AS to_offset, count(*) AS records
  FROM missing GROUP BY grp, topic, partition, island)"""


def _unseen(spark, sf_dir):
    """What the demo groups have not committed when every fifth user's records failed in all of them, and the bounds."""
    from topicflow.operators.ranges import unseen_ranges
    r = log(spark, sf_dir)
    bounds = G.group_positions(r, DEMO_GROUPS).select(
        "group", "topic", "partition", F.col("log_begin_offset").alias("begin_offset"), F.col("log_end_offset").alias("end_offset"))
    committed = done(spark, sf_dir).where(R.decode_key().try_cast("bigint") % 5 != 0).select("group", *POSITION)
    return unseen_ranges(committed, bounds), bounds


@register("unseen_ranges", S.with_topic("SELECT * FROM gaps", DEMO_GROUPS, RANGES_CTE))
def unseen_ranges(spark, sf_dir):
    return _unseen(spark, sf_dir)[0]


@register("safe_positions", S.with_topic("""
SELECT b.grp AS "group", b.topic, b.partition, coalesce(min(g.from_offset), max(b.e)) AS committed
FROM bounds b LEFT JOIN gaps g ON g."group" = b.grp AND g.topic = b.topic AND g.partition = b.partition
GROUP BY b.grp, b.topic, b.partition""", DEMO_GROUPS, RANGES_CTE))
def safe_positions(spark, sf_dir):
    """Up to where each group can commit without losing a record that failed."""
    from topicflow.operators.ranges import safe_positions
    return safe_positions(*_unseen(spark, sf_dir))


@register("publish_two_writers", """
SELECT 'all.events' AS topic,
       CAST(CAST(('0x' || substr(md5(CAST(user_id AS VARCHAR)), 1, 8)) AS BIGINT) % 3 AS INTEGER) AS partition,
       count(*) AS records, count(*) AS distinct_offsets, CAST(0 AS BIGINT) AS begin_offset, count(*) AS end_offset,
       true AS dense
FROM events GROUP BY ALL""")
def publish_two_writers(spark, sf_dir):
    """Two streams that append to one log at the same time: no record is lost, offsets are dense."""
    root, halves = scratch_dir(spark, "two-writers"), (ALL_TOPICS[:2], ALL_TOPICS[2:])
    ST.await_all([
        ST.publish_stream(stream_log(spark, sf_dir, topics).withColumn("topic", F.lit("all.events")), root,
                          _ck(spark, f"writer-{i}"), partitions=TT.PARTITIONS, key_text=R.decode_key())
        for i, topics in enumerate(halves)])
    return P.order_check(read_topic(spark, root, "all.events"))


# ---------------------------------------------------------------- stored positions

_POSITIONS: dict[tuple[str, str], str] = {}


def stored_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The demo groups' committed positions, written once as a table (as a commit log would
    hold them) and read back."""
    memo = (app_id(spark), sf_dir.rstrip("/"))
    path = _POSITIONS.get(memo)
    if path is None:
        path = scratch_dir(spark, "positions")
        positions(spark, sf_dir).write.mode("overwrite").parquet(path)
        _POSITIONS[memo] = path
    return spark.read.parquet(path)


POS_CTE = """
pos AS (SELECT grp, topic, partition, max("offset") + 1 AS committed
        FROM fan WHERE consumed GROUP BY grp, topic, partition),
bounds AS (SELECT topic, partition, min("offset") AS b, max("offset") + 1 AS e
           FROM rec GROUP BY topic, partition)"""


@register("stored_lag", S.with_topic("""
SELECT g.grp AS "group", b.topic, b.partition, coalesce(p.committed, b.b) AS current_offset,
       b.e AS log_end_offset, b.e - coalesce(p.committed, b.b) AS lag
FROM bounds b JOIN (SELECT DISTINCT grp, topic FROM pos) g ON g.topic = b.topic
LEFT JOIN pos p ON p.grp = g.grp AND p.topic = b.topic AND p.partition = b.partition""",
                                     DEMO_GROUPS, POS_CTE))
def stored_lag(spark, sf_dir):
    """Lag of every group holding positions, from the stored positions table; partitions a
    group has no position for count from the log's begin."""
    from topicflow.operators.publish import read_log_ends
    return G.lag_from_positions(read_log_ends(spark, TT.events_log(spark, sf_dir)), stored_positions(spark, sf_dir))


@register("read_from_positions", S.with_topic("""
SELECT r.topic, r.partition, r."offset" FROM rec r
LEFT JOIN pos p ON p.grp = 'payments' AND p.topic = r.topic AND p.partition = r.partition
WHERE r.topic = 'demo.purchase' AND (p.committed IS NULL OR r."offset" >= p.committed)""",
                                              DEMO_GROUPS, POS_CTE))
def read_from_positions(spark, sf_dir):
    """Batch resume: what the payments group reads next, from its committed positions."""
    from topicflow.sources.topics import from_positions
    pos = stored_positions(spark, sf_dir).where(F.col("group") == "payments")
    return from_positions(log(spark, sf_dir, "demo.purchase"), pos).select(
        "topic", "partition", "offset")



@register("worker_lag", S.with_topic(f"""
SELECT 'worker' AS "group", topic, partition,
       count(*) FILTER (WHERE ts < TIMESTAMP '{RESUME_CUT}') AS current_offset,
       count(*) AS log_end_offset,
       count(*) FILTER (WHERE ts >= TIMESTAMP '{RESUME_CUT}') AS lag
FROM rec GROUP BY topic, partition"""))
def worker_lag(spark, sf_dir):
    """Lag of a streaming worker from what it committed (its output) and the log-ends side
    table: the worker drains the log, more records are published, and the lag is exactly
    the new records — without scanning the log."""
    from topicflow.operators.publish import publish, read_log_ends
    recs = TT.events_records(spark, sf_dir)
    cut = F.col("timestamp") < F.lit(RESUME_CUT).cast("timestamp")
    root, out = scratch_dir(spark, "lag-log"), scratch_dir(spark, "lag-out")
    publish(recs.where(cut), root, "event_id")
    s = read_topic(spark, root, ALL_TOPICS, streaming=True).select(
        "topic", "partition", "offset", F.lit(None).cast("string").alias("reason"))
    ST.await_all([ST.run_worker(s, lambda b: b, out, _ck(spark, "lag"))])
    publish(recs.where(~cut), root, "event_id")
    done_pos = G.positions(spark.read.parquet(out), by=())
    return G.lag_from_ends(read_log_ends(spark, root), done_pos, "worker")



@register("stream_latest", S.with_topic(f"""
SELECT topic, partition, "offset" FROM rec WHERE ts >= TIMESTAMP '{RESUME_CUT}'"""))
def stream_latest(spark, sf_dir):
    """A stream that starts at 'latest' on a log holding the first half of the events, then
    runs again after the second half is published: it reads exactly the second half."""
    from topicflow.operators.publish import publish
    recs = TT.events_records(spark, sf_dir)
    cut = F.col("timestamp") < F.lit(RESUME_CUT).cast("timestamp")
    root, out, ck = scratch_dir(spark, "latest-log"), scratch_dir(spark, "latest-out"), \
        _ck(spark, "latest")

    def run():
        s = read_topic(spark, root, ALL_TOPICS, streaming=True, start=LATEST, checkpoint=ck)
        ST.await_all([ST.copy_stream(s.select("topic", "partition", "offset"), out, ck)])

    publish(recs.where(cut), root, "event_id")
    run()
    publish(recs.where(~cut), root, "event_id")
    run()
    return spark.read.parquet(out)



@register("trace_failures", S.with_orders("""
SELECT 'orders-worker' AS reader, tid AS trace_id,
       substr(sha256('consume:orders-worker:' || tid || ':' || CAST("offset" AS VARCHAR)), 1, 16)
         AS span_id,
       CAST(NULL AS VARCHAR) AS parent_span_id, 'kafka.consume' AS name, 'kafka' AS system,
       topic AS destination, partition, "offset", reason AS exception
FROM (SELECT *, md5(topic || ':' || CAST(partition AS VARCHAR) || ':' || CAST("offset" AS VARCHAR))
             AS tid
      FROM (""" + ORDER_REASONS_SQL + """))"""))
def trace_failures(spark, sf_dir):
    """The orders worker's consume spans with the failure of each rejected record recorded
    on its span (the topic carries no trace headers, so every span is a root)."""
    r = order_log(spark, sf_dir)
    spans = TS.consume_spans(r.withColumn("group", F.lit("orders-worker")))
    return TS.spans_with_failures(spans, O.order_rejects(r))


def queries() -> dict[str, Plan]:
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}
