"""Order payloads: one canonical table from mixed shapes, validation, routing, dead letters.

Several producers share topics without a schema registry, so a topic can hold five value
shapes. Values are parsed once to VARIANT and every canonical field is read with
``try_variant_get`` (no inference, no exceptions on odd input). Records that a reader cannot
use are split off with a reason instead of stopping the job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicflow.functions.records import decode_json_or_text, parse_once
from topicflow.schema import POSITION

# The two kitchens that take longer.
SLOW_RESTAURANTS = ("Tandoori Tales", "Masala Magic")
SLOW_COST = 2
FAST_COST = 1
# Range rule of the order API.
MIN_QUANTITY = 1
MAX_QUANTITY = 20


def _get(j: Column, path: str, typ: str) -> Column:
    return F.try_variant_get(j, path, typ)


def _ts(text: Column) -> Column:
    """ISO text (with ``Z``/offset, or zone-less meaning UTC) → TIMESTAMP_NTZ in UTC."""
    return F.try_to_timestamp(text).cast("timestamp_ntz")


def canonical_items(j: Column) -> Column:
    """ARRAY<STRUCT<sku,qty>> from ``items`` (objects, or bare names counting 1 each) or
    from a single ``item``/``quantity`` pair."""
    arr = _get(j, "$.items", "array<variant>")
    from_array = F.transform(
        arr,
        lambda x: F.when(
            F.schema_of_variant(x).startswith("OBJECT"),
            F.struct(_get(x, "$.sku", "string").alias("sku"),
                     _get(x, "$.qty", "bigint").alias("qty")),
        ).otherwise(F.struct(_get(x, "$", "string").alias("sku"),
                             F.lit(1).cast("bigint").alias("qty"))),
    )
    item = _get(j, "$.item", "string")
    single = F.when(item.isNotNull(), F.array(F.struct(
        item.alias("sku"),
        F.coalesce(_get(j, "$.quantity", "bigint"), F.lit(1).cast("bigint")).alias("qty"))))
    return F.coalesce(from_array, single)


def normalize_orders(records: DataFrame, value: str = "value",
                     keep: Sequence[str] = POSITION) -> DataFrame:
    """Records of any order shape → canonical columns (order_id, user, items, total, status,
    restaurant, seq, ts) plus ``keep`` columns; values that are not JSON objects give nulls."""
    parsed = parse_once(records, keep, _j=decode_json_or_text(value)["json"])
    j = F.col("_j")
    return parsed.select(
        *keep,
        F.coalesce(_get(j, "$.order_id", "string"), _get(j, "$.id", "string")).alias("order_id"),
        F.coalesce(_get(j, "$.user", "string"), _get(j, "$.user_id", "string")).alias("user"),
        canonical_items(j).alias("items"),
        F.coalesce(_get(j, "$.total", "double"), _get(j, "$.amount", "double")).alias("total"),
        _get(j, "$.status", "string").alias("status"),
        _get(j, "$.restaurant", "string").alias("restaurant"),
        _get(j, "$.seq", "bigint").alias("seq"),
        _ts(_get(j, "$.ts", "string")).alias("ts"),
    )


def explode_items(orders: DataFrame) -> DataFrame:
    """One row per (order, item); orders without items keep one row with null sku/qty."""
    return (orders.select("*", F.explode_outer("items").alias("_it"))
            .select(*[c for c in orders.columns if c != "items"],
                    F.col("_it.sku").alias("sku"), F.col("_it.qty").alias("qty")))


def split_rejects(df: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """(ok, rejects): rows whose ``reason`` is null, and the others with a ``reason`` column."""
    tagged = df.withColumn("reason", reason)
    return tagged.where(F.col("reason").isNull()).drop("reason"), tagged.where(
        F.col("reason").isNotNull())


def missing_reason(names: Sequence[str]) -> Column:
    """``'missing:<first absent field>'`` or null when all ``names`` are present."""
    return F.coalesce(*[F.when(F.col(n).isNull(), F.lit(f"missing:{n}")) for n in names])


def require_fields(df: DataFrame, names: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Split rows lacking any of ``names`` (null after decode) into rejects."""
    return split_rejects(df, missing_reason(names))


def worker_orders(records: DataFrame) -> DataFrame:
    """What the orders worker makes of its records: the envelope's key, value, headers and position, the fields of
    the simple order shape, and ``reason``: null, ``decode:not JSON``, or the first missing field."""
    from topicflow.functions.records import value_text
    from topicflow.schema import SIMPLE_ORDER

    text = value_text()
    parsed = parse_once(records, ["key", "value", "headers", *POSITION],
                        o=F.from_json(text, SIMPLE_ORDER), json=F.try_parse_json(text).isNotNull())
    fields = parsed.select("key", "value", "headers", *POSITION, "json", "o.*")
    reason = F.when(~F.col("json"), F.lit("decode:not JSON")).otherwise(
        missing_reason(["order_id", "user", "item", "quantity"]))
    return fields.withColumn("reason", reason).drop("json")


def order_rejects(records: DataFrame) -> DataFrame:
    """Dead letters: records the orders worker cannot process, whole, with position and reason."""
    return worker_orders(records).where(F.col("reason").isNotNull()).select(
        "key", "value", "headers", *POSITION, "reason")


def validation_reason(user="user", item="item", quantity="quantity") -> Column:
    """Order API rules: user and item required; quantity an integer within 1..20."""
    q = F.col(quantity) if isinstance(quantity, str) else quantity
    return F.coalesce(
        F.when(F.col(user).isNull(), F.lit("missing:user")),
        F.when(F.col(item).isNull(), F.lit("missing:item")),
        F.when(q.isNull(), F.lit("missing:quantity")),
        F.when(~q.between(MIN_QUANTITY, MAX_QUANTITY),
               F.lit(f"range:quantity not in {MIN_QUANTITY}..{MAX_QUANTITY}")),
    )


def validate_orders(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ok, rejects) by :func:`validation_reason`."""
    return split_rejects(df, validation_reason())


def prep_cost(restaurant="restaurant") -> Column:
    """Kitchen routing cost: the slow kitchens cost 2, the others 1."""
    r = F.col(restaurant) if isinstance(restaurant, str) else restaurant
    return F.when(r.isin(*SLOW_RESTAURANTS), F.lit(SLOW_COST)).otherwise(F.lit(FAST_COST))


def shape_orders(requests: DataFrame, stable_id: Sequence[str] | None = None) -> DataFrame:
    """API shaping: new order id, user, item, quantity, and the user as the record key.

    With ``stable_id`` columns the id is a hash of them (the same on replay); otherwise a
    random UUID per row, as the API does.
    """
    oid = (F.sha2(F.concat_ws("|", *[F.col(c).cast("string") for c in stable_id]), 256)
           if stable_id else F.uuid())
    return requests.select(oid.alias("order_id"), "user", "item", "quantity",
                           F.col("user").alias("key_text"))
