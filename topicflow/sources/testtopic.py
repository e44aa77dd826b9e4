"""The driver tables as topics.

``events`` becomes the record log every registered query reads:

* topic      ``'demo.' || event_type``
* key        ``user_id`` as text; partition = md5 rule over 3 partitions
* offset     dense per (topic, partition) in ``event_id`` order
* timestamp  ``ts``; value = ``props`` (JSON text)
* headers    ``event-type`` and a ``traceparent`` whose trace id is ``md5(event_id)``
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicflow.functions.partitioning import key_partition
from topicflow.functions.records import make_headers
from topicflow.functions.tracing import format_traceparent
from topicflow.operators.publish import assign_offsets
from topicflow.session import app_id

# Fixed values of the test topic.
TOPIC_PREFIX = "demo."
PARTITIONS = 3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def produce_span_id(event_id) -> F.Column:
    """Span id of the producer span of an event: 16 hex digits from sha2."""
    return F.substring(F.sha2(F.concat(F.lit("produce:"), event_id.cast("string")), 256), 1, 16)


def event_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the events' records are made from, with what orders and places them."""
    return table(spark, sf_dir, "events").select(
        "event_id", "user_id", "props", "event_type", "ts",
        F.concat(F.lit(TOPIC_PREFIX), F.col("event_type")).alias("topic"),
        key_partition(F.col("user_id").cast("string"), PARTITIONS).alias("partition"))


def events_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelope columns plus ``event_id`` (the sequence key), before offsets are assigned."""
    return encode_events(event_sources(spark, sf_dir))


def encode_events(sources: DataFrame) -> DataFrame:
    """:func:`events_records` of :func:`event_sources`."""
    return sources.select(
        F.col("event_id"),
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.col("props").cast("binary").alias("value"),
        "topic", "partition",
        F.col("ts").cast("timestamp").alias("timestamp"),
        make_headers(**{
            "event-type": F.col("event_type"),
            "traceparent": format_traceparent(
                F.md5(F.col("event_id").cast("string")), produce_span_id(F.col("event_id")),
                F.col("event_type") != F.lit("error")),
        }).alias("headers"),
    )


def events_topic(spark: SparkSession, sf_dir: str, keep_event_id: bool = False) -> DataFrame:
    """The events log with offsets: envelope columns (+ ``event_id`` when asked)."""
    recs = assign_offsets(events_records(spark, sf_dir), "event_id")
    cols = ["key", "value", "topic", "partition", "offset", "timestamp", "headers"]
    return recs.select(*(["event_id"] if keep_event_id else []), *cols)


# ------------------------------------------------------------------ stored copy of the log

_LOGS: dict[tuple[str, str], str] = {}


def events_log(spark: SparkSession, sf_dir: str) -> str:
    """Root of a Parquet file log holding the events topic, written once per application.

    Written with :func:`topicflow.operators.publish.publish` into the shared checkpoint
    folder, so reports read the log the way consumers would: by topic directory, with
    offsets stored.
    """
    from topicflow.operators.publish import publish
    from topicflow.session import scratch_dir

    memo = (app_id(spark), sf_dir.rstrip("/"))
    root = _LOGS.get(memo)
    if root is not None:
        return root
    root = scratch_dir(spark, "events-log")
    publish(event_sources(spark, sf_dir), root, "event_id", encode=lambda placed: encode_events(placed).drop("event_id"),
            report=False)
    _LOGS[memo] = root
    return root


# --------------------------------------------------------- mixed-shape order topic

ORDERS_TOPIC = "food.orders"
KITCHENS = 4
# Fixed value of the test topic: every so many orders the value is not JSON (shape 0).
UNREADABLE_EVERY = 50
FILE_LINES = 1_000_000  # lines of a compressed file, which one task reads
# An order's lines in the log; lines that agree in all of these are equal records.
LINE_ORDER = ("line", "l_partkey", "l_suppkey", "qty", "price")


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders ⟕ lineitem ⟕ customer: a row per line item (one for an order without any), with ``line``, ``sku``,
    ``qty``, ``price`` and an ``items`` array made of the row's own columns. A record never gathers rows, so an
    order of any size is dealt with alike."""
    o = table(spark, sf_dir, "orders")
    li = table(spark, sf_dir, "lineitem")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    # customers before lines: the rows of the lines are shuffled once. Sorted joins at any size: no table passes the driver
    j = (o.join(c.hint("merge"), o["o_custkey"] == c["c_custkey"], "left")
         .join(li.hint("merge"), o["o_orderkey"] == li["l_orderkey"], "left"))
    rows = j.select(
        "o_orderkey", "o_custkey", "c_name", "o_orderdate", "o_orderstatus", "o_orderpriority",
        F.coalesce("l_linenumber", F.lit(0)).cast("bigint").alias("line"), F.col("l_quantity").cast("bigint").alias("qty"),
        F.coalesce("l_extendedprice", "o_totalprice").cast("double").alias("price"), "l_orderkey", "l_partkey", "l_suppkey")
    return rows.withColumns({"sku": _sku(), "items": _items(F.col("l_orderkey").isNotNull())})


def _sku() -> F.Column:
    return F.concat(F.lit("part-"), F.col("l_partkey").cast("string"))


def _items(has_line: F.Column) -> F.Column:
    extra = F.concat(F.lit("supp-"), F.col("l_suppkey").cast("string"))
    return F.when(has_line, F.array(
        F.struct(_sku().alias("sku"), F.col("qty").alias("qty")),
        F.struct(extra.alias("sku"), F.lit(1).cast("bigint").alias("qty"))))


def order_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the order records are made from, a row for each, with what orders and places them."""
    j = order_lines(spark, sf_dir)
    okey = F.col("o_orderkey")
    shape = F.when(okey % UNREADABLE_EVERY == 0, F.lit(0)).otherwise(
        F.substring("o_orderpriority", 1, 1).try_cast("int"))
    return j.select(
        "o_orderkey", "o_custkey", "o_orderdate", "c_name", "line", shape.alias("shape"), F.lit(ORDERS_TOPIC).alias("topic"),
        (okey + F.col("line")).alias("seq_no"), F.when(shape.isin(2, 5), F.col("c_name")).alias("key_text"),
        F.col("l_orderkey").isNotNull().alias("has_line"), "l_partkey", "l_suppkey", "qty", "price")


def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order records before they are published (:func:`encode_orders`)."""
    return encode_orders(order_sources(spark, sf_dir))


def encode_orders(sources: DataFrame) -> DataFrame:
    """One record per order line as JSON values in five producer shapes (by priority):

    1 widget {id, item, ts}; 2 simple {order_id, user, item, quantity};
    3 cart {order_id, user_id, items[{sku,qty}], amount, status}; 4 food {order_id, seq,
    restaurant, items[sku], total, ts (no zone)}; 5 file {order_id (int), user, items, total,
    status, ts (Z)}; 0 a value that is not JSON. Columns: o_orderkey, line, shape, key, value (+ envelope
    columns).
    """
    from topicflow.functions.records import encode_value
    from topicflow.operators.orders import SLOW_RESTAURANTS

    j = sources.withColumns({"sku": _sku(), "items": _items(F.col("has_line"))})
    okey, shape = F.col("o_orderkey"), F.col("shape")
    ts_z = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    ts_local = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    kitchen = F.pmod(F.col("o_custkey"), F.lit(KITCHENS))
    rest = F.when(kitchen < len(SLOW_RESTAURANTS), F.element_at(
        F.array(*[F.lit(r) for r in SLOW_RESTAURANTS]), F.least(kitchen + 1, F.lit(len(SLOW_RESTAURANTS))).cast("int"))) \
        .otherwise(F.concat(F.lit("kitchen-"), kitchen.cast("string")))
    value = (
        F.when(shape == 0, F.concat(F.lit("unreadable order "), okey.cast("string")).cast("binary"))
        .when(shape == 1, encode_value(okey.alias("id"), F.col("sku").alias("item"), ts_z.alias("ts")))
        .when(shape == 2, encode_value(F.concat(F.lit("o"), okey.cast("string")).alias("order_id"),
                                       F.col("c_name").alias("user"), F.col("sku").alias("item"),
                                       F.col("qty").alias("quantity")))
        .when(shape == 3, encode_value(F.substring(F.md5(okey.cast("string")), 1, 8).alias("order_id"),
                                       F.col("o_custkey").alias("user_id"), F.col("items"),
                                       F.round("price", 2).alias("amount"),
                                       F.lit("CREATED").alias("status")))
        .when(shape == 4, encode_value(F.md5(okey.cast("string")).alias("order_id"),
                                       okey.alias("seq"), rest.alias("restaurant"),
                                       F.transform("items", lambda x: x["sku"]).alias("items"),
                                       F.col("price").alias("total"), ts_local.alias("ts")))
        .otherwise(encode_value(okey.alias("order_id"), F.col("c_name").alias("user"),
                                F.col("items"), F.col("price").alias("total"),
                                F.lit("PLACED").alias("status"), ts_z.alias("ts")))
    )
    return j.select(
        *[c for c in sources.columns if c not in ("o_custkey", "o_orderdate", "c_name", "has_line")],
        F.col("key_text").cast("binary").alias("key"), value.alias("value"), F.col("o_orderdate").cast("timestamp").alias("timestamp"))


def orders_log(spark: SparkSession, sf_dir: str) -> str:
    """Root of a Parquet file log holding the order topic, written once per application."""
    from topicflow.operators.publish import assign_partition, publish
    from topicflow.session import scratch_dir

    memo = (app_id(spark), sf_dir.rstrip("/") + "#orders")
    root = _LOGS.get(memo)
    if root is not None:
        return root
    root = scratch_dir(spark, "orders-log")
    recs = assign_partition(order_sources(spark, sf_dir), "key_text", PARTITIONS, seq="seq_no")
    publish(recs, root, "o_orderkey", tie_breakers=LINE_ORDER,
            encode=lambda placed: encode_orders(placed).select("topic", "partition", "key", "value", "timestamp"), report=False)
    _LOGS[memo] = root
    return root


def order_file_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order line in the order-file shape as JSON lines, as a producer's file would hold
    them: lines of pending orders padded with spaces and tabs, and a blank line after each line of an
    urgent open order."""
    from topicflow.functions.records import encode_value

    j = order_lines(spark, sf_dir)
    line = encode_value(F.col("o_orderkey").alias("order_id"), F.col("c_name").alias("user"),
                        "items", F.col("price").alias("total"),
                        F.lit("PLACED").alias("status"),
                        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("ts"),
                        ).cast("string")
    padded = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit(" \t"), line, F.lit("\t ")))\
        .otherwise(line)
    blank = (F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "1-URGENT")
    return j.select(F.explode(F.when(blank, F.array(padded, F.lit(" \t "))).otherwise(F.array(padded))).alias("value"))


def order_file_dir(spark: SparkSession, sf_dir: str, plain: bool = False) -> str:
    """Folder of JSON-lines order files derived from the driver tables (written once): gzip files of some tens of MB, or
    ``plain`` ones for who reads them by byte places."""
    from topicflow.session import scratch_dir

    memo = (app_id(spark), sf_dir.rstrip("/") + ("#jsonl-plain" if plain else "#jsonl"))
    root = _LOGS.get(memo)
    if root is not None:
        return root
    root = scratch_dir(spark, "order-files")
    files = {} if plain else {"compression": "gzip", "maxRecordsPerFile": FILE_LINES}
    order_file_lines(spark, sf_dir).write.mode("overwrite").options(**files).text(root + "/in")
    _LOGS[memo] = root + "/in"
    return root + "/in"
