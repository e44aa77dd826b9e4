"""SQL text shared by the oracle statements (plain ANSI SQL as DuckDB runs it).

These restate each report's definition in SQL over the source tables, independently of the
DataFrame code, so comparing both checks the Spark plans (encode/decode included).
"""

from __future__ import annotations

from collections.abc import Sequence

from topicflow.operators.groups import Group

# The test topic: events as records (same rules as topicflow.sources.testtopic).
TOPIC_CTE = """
ev AS (
  SELECT event_id, ts, user_id, event_type, value AS ev_value, props,
         'demo.' || event_type AS topic,
         CAST(CAST(('0x' || substr(md5(CAST(user_id AS VARCHAR)), 1, 8)) AS BIGINT) % 3 AS INTEGER)
           AS partition
  FROM events),
rec AS (
  SELECT *, row_number() OVER (PARTITION BY topic, partition ORDER BY event_id) - 1 AS "offset"
  FROM ev)"""


def _lit_ts(text: str | None) -> str:
    return "CAST(NULL AS TIMESTAMP)" if text is None else f"TIMESTAMP '{text}'"


def groups_cte(groups: Sequence[Group]) -> str:
    rows = ",\n    ".join(
        f"('{g.name}', '{t}', '{g.start}', {_lit_ts(g.joined_at)}, {_lit_ts(g.consumed_until)})"
        for g in groups for t in g.topics)
    return f"""
grp(grp, g_topic, start, joined_at, until) AS (
  VALUES
    {rows}),
fan AS (
  SELECT r.*, g.grp,
         (g.start = 'earliest' OR r.ts >= g.joined_at) AS started,
         ((g.start = 'earliest' OR r.ts >= g.joined_at) AND coalesce(r.ts < g.until, false))
           AS consumed
  FROM rec r JOIN grp g ON g.g_topic = r.topic)"""


def with_topic(body: str, groups: Sequence[Group] | None = None, extra: str = "") -> str:
    ctes = [TOPIC_CTE]
    if groups is not None:
        ctes.append(groups_cte(groups))
    if extra:
        ctes.append(extra)
    return "WITH " + ",".join(ctes) + "\n" + body


# The mixed-shape order topic (same rules as topicflow.sources.testtopic.order_records).
ORDERS_CTE = """
ord AS (
  SELECT o.o_orderkey, CAST(coalesce(l.l_linenumber, 0) AS BIGINT) AS line,
         CASE WHEN o.o_orderkey % 50 = 0 THEN 0
              ELSE CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) END AS shape,
         o.o_custkey, CAST(coalesce(l.l_extendedprice, o.o_totalprice) AS DOUBLE) AS price, o.o_orderdate,
         c.c_name, 'part-' || CAST(l.l_partkey AS VARCHAR) AS first_sku,
         'supp-' || CAST(l.l_suppkey AS VARCHAR) AS second_sku,
         l.l_partkey, l.l_suppkey, CAST(l.l_quantity AS BIGINT) AS total_qty, l.l_orderkey IS NULL AS no_items
  FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
  LEFT JOIN customer c ON c.c_custkey = o.o_custkey),
ordkey AS (
  SELECT *, CASE WHEN shape IN (2, 5) THEN c_name END AS key_text, o_orderkey + line AS seq_no
  FROM ord),
ordpart AS (
  SELECT *, CASE WHEN key_text IS NULL THEN CAST(seq_no % 3 AS INTEGER)
            ELSE CAST(CAST(('0x' || substr(md5(key_text), 1, 8)) AS BIGINT) % 3 AS INTEGER)
            END AS partition
  FROM ordkey),
olog AS (
  SELECT *, 'food.orders' AS topic,
         row_number() OVER (PARTITION BY partition ORDER BY o_orderkey, line, l_partkey, l_suppkey, total_qty, price) - 1 AS "offset"
  FROM ordpart),
canon AS (
  SELECT topic, partition, "offset", o_orderkey, line, shape, first_sku, second_sku, total_qty, no_items,
    c_name, key_text,
    CASE shape WHEN 0 THEN NULL WHEN 1 THEN CAST(o_orderkey AS VARCHAR)
               WHEN 2 THEN 'o' || CAST(o_orderkey AS VARCHAR)
               WHEN 3 THEN substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8)
               WHEN 4 THEN md5(CAST(o_orderkey AS VARCHAR))
               ELSE CAST(o_orderkey AS VARCHAR) END AS order_id,
    CASE shape WHEN 2 THEN c_name WHEN 3 THEN CAST(o_custkey AS VARCHAR)
               WHEN 5 THEN c_name END AS "user",
    CASE shape WHEN 3 THEN round(price, 2) WHEN 4 THEN price WHEN 5 THEN price END AS total,
    CASE shape WHEN 3 THEN 'CREATED' WHEN 5 THEN 'PLACED' END AS status,
    CASE WHEN shape = 4 THEN CASE o_custkey % 4 WHEN 0 THEN 'Tandoori Tales' WHEN 1 THEN 'Masala Magic'
         ELSE 'kitchen-' || CAST(o_custkey % 4 AS VARCHAR) END END AS restaurant,
    CASE WHEN shape = 4 THEN o_orderkey END AS seq,
    CASE WHEN shape IN (1, 4, 5) THEN o_orderdate END AS ts
  FROM olog),
canon_items AS (
  SELECT c.*, c.first_sku AS sku,
         CASE WHEN c.no_items THEN NULL WHEN c.shape = 4 THEN 1 ELSE c.total_qty END AS qty
  FROM canon c WHERE c.shape IN (3, 4, 5)
  UNION ALL
  SELECT c.*, c.second_sku AS sku, 1 AS qty FROM canon c WHERE c.shape IN (3, 4, 5) AND NOT c.no_items
  UNION ALL
  SELECT c.*, c.first_sku AS sku,
         CASE WHEN c.first_sku IS NULL THEN NULL WHEN c.shape = 1 THEN 1 ELSE c.total_qty END AS qty
  FROM canon c WHERE c.shape IN (1, 2)
  UNION ALL
  SELECT c.*, NULL AS sku, NULL AS qty FROM canon c WHERE c.shape = 0)"""


def with_orders(body: str) -> str:
    return "WITH " + ORDERS_CTE + "\n" + body
