"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from topicflow.llm import sharding

LINE_DEDUP = r"""
WITH lines AS (
  SELECT doc_id, u.ln, u.line, regexp_replace(u.line, '^[ \t\r\x0B\x0C]+|[ \t\r\x0B\x0C]+$', '', 'g') AS bare
  FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents),
       LATERAL (SELECT unnest(parts) AS line, generate_subscripts(parts, 1) AS ln) u),
numbered AS (
  SELECT *, count(*) FILTER (bare <> '') OVER (PARTITION BY doc_id ORDER BY ln) AS i FROM lines),
windows AS (
  SELECT doc_id, i, bare || chr(10) || lead(bare, 1) OVER w || chr(10) || lead(bare, 2) OVER w AS body
  FROM numbered WHERE bare <> '' WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
ranked AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY body ORDER BY doc_id, i) AS occurrence
  FROM windows WHERE body IS NOT NULL),
covered AS (
  SELECT DISTINCT doc_id, i + k AS i FROM ranked, (SELECT unnest([0, 1, 2]) AS k) WHERE occurrence > 1)
SELECT n.doc_id,
       coalesce(string_agg(n.line, chr(10) ORDER BY n.ln) FILTER (c.i IS NULL), '') AS text,
       CAST(count(*) FILTER (n.bare <> '') AS BIGINT) AS n_lines,
       CAST(count(*) FILTER (n.bare <> '' AND c.i IS NOT NULL) AS BIGINT) AS n_removed
FROM numbered n LEFT JOIN covered c ON n.doc_id = c.doc_id AND n.i = c.i
GROUP BY n.doc_id"""

SHARDING = """
WITH rows_ AS (
  SELECT doc_id, CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT) AS h,
         CAST(strlen(text) AS BIGINT) AS n_bytes FROM documents),
levels AS (
  SELECT doc_id, n_bytes, d, h >> (60 - d) AS p FROM rows_, (SELECT unnest(range(0, 25)) AS d)),
buckets AS (SELECT d, p, sum(n_bytes) AS b, count(*) AS c FROM levels GROUP BY d, p),
leaves AS (
  SELECT l.doc_id, l.n_bytes, l.d, l.p, b.b,
         row_number() OVER (PARTITION BY l.doc_id ORDER BY l.d) AS turn
  FROM levels l JOIN buckets b USING (d, p) WHERE b.b <= {limit} OR b.c = 1)
SELECT doc_id, CASE WHEN d = 0 THEN '' ELSE right(lpad(bin(p), 60, '0'), d) END AS shard, n_bytes,
       CAST(b AS BIGINT) AS shard_bytes
FROM leaves WHERE turn = 1"""

DECONTAMINATION = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS body
  FROM b, LATERAL (SELECT unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM item_windows),
doc_windows AS (
  SELECT doc_id, size, u.i, array_to_string(w[u.i : u.i + size - 1], ' ') AS body
  FROM d, sizes, LATERAL (SELECT unnest(range(1, len(w) - size + 2)) AS i) u),
found AS (
  SELECT doc_id, i, x.size, item_id FROM doc_windows x JOIN item_windows y ON x.size = y.size AND x.body = y.body),
hits AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM found, LATERAL (SELECT unnest(range(0, size)) AS k) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(list, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits ON d.doc_id = hits.doc_id LEFT JOIN items ON d.doc_id = items.doc_id"""


_NAME = "|".join(
    "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in name)
    for name in ("password", "passwd", "secret", "token", "api_?key"))
_ASSIGN = f"""({_NAME})["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
_SECRET_KINDS = [(0, _ASSIGN), (1, "AKIA[A-Z0-9]{12,}"), (2, "[0-9a-f]{32,}"), (3, "[A-Za-z0-9+/_-]{20,}")]

SECRET_SCAN = f"""
WITH found AS (
  {" UNION ALL ".join(
      f"SELECT doc_id, source, {kind} AS kind, regexp_extract_all(text, '{pattern}') AS m, "
      f"string_split_regex(text, '{pattern}') AS gaps FROM documents" for kind, pattern in _SECRET_KINDS)}),
places AS (
  SELECT doc_id, source, kind, u.i, m[u.i] AS body,
         list_sum(list_transform(gaps[1:u.i], lambda x: length(x)))
           + coalesce(list_sum(list_transform(m[1:u.i - 1], lambda x: length(x))), 0) AS start
  FROM found, LATERAL (SELECT unnest(range(1, len(m) + 1)) AS i) u),
valued AS (
  SELECT *, CASE kind WHEN 0 THEN regexp_extract(body, '{_ASSIGN}', 2) ELSE body END AS secret FROM places),
candidates AS (
  SELECT *, coalesce(source, '') AS owner, coalesce(CAST(doc_id AS VARCHAR), '') AS repo FROM valued
  WHERE CASE kind WHEN 0 THEN length(secret) >= 8
                  WHEN 3 THEN length(regexp_replace(body, '[^0-9]', '', 'g')) >= 3
                              AND length(regexp_replace(body, '[^A-Za-z]', '', 'g')) >= 3
                              AND len(list_distinct(string_split(body, ''))) >= 10
                  ELSE true END),
frequency AS (
  SELECT secret, count(DISTINCT owner) AS owners, count(DISTINCT repo) AS repos FROM candidates GROUP BY secret),
verdicts AS (
  SELECT c.*, CASE WHEN owners > 2 THEN 'example' WHEN repos > 10 THEN 'spread' ELSE 'owned' END AS verdict
  FROM candidates c JOIN frequency f ON c.secret = f.secret),
judged AS (
  SELECT doc_id, start, verdict, kind < 3 OR verdict <> 'example' AS kept,
         CASE WHEN kind = 3 AND verdict = 'spread' THEN 4 ELSE kind END AS kind,
         CASE kind WHEN 0 THEN 'assign' WHEN 1 THEN 'access' WHEN 2 THEN 'hex' ELSE verdict END || ':'
           || CAST(CAST(start AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(start AS BIGINT) + length(body) AS VARCHAR) AS name
  FROM verdicts)
SELECT d.doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
       count(*) FILTER (kind = 2) AS n_hex,
       sha256(coalesce(string_agg(name, ',' ORDER BY start, kind) FILTER (kind < 3), '')) AS base_sha256,
       coalesce(string_agg(name, ',' ORDER BY start, kind) FILTER (kept), '') AS spans,
       count(*) FILTER (kind = 3 AND kept) AS n_owned, count(*) FILTER (kind = 4) AS n_spread,
       count(*) FILTER (NOT kept) AS n_examples,
       count(*) FILTER (kind < 3 AND verdict = 'owned') AS base_owned,
       count(*) FILTER (kind < 3 AND verdict = 'spread') AS base_spread,
       count(*) FILTER (kind < 3 AND verdict = 'example') AS base_example
FROM documents d LEFT JOIN judged j ON d.doc_id = j.doc_id GROUP BY d.doc_id"""


def _vector_codes() -> str:
    """Four rounds over (vector, part, position) rows, each joined with the codebooks of the round before."""
    steps = ["""
WITH kept AS (
  SELECT vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cells AS (
  SELECT vec_id, (i - 1) // (n // 4) AS part, (i - 1) % (n // 4) AS pos, CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) AS x
  FROM (SELECT vec_id, len(embedding) AS n, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM kept)),
book0 AS (
  SELECT part, e, pos, x AS c
  FROM cells JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT 256) USING (vec_id))"""]
    for r in range(5):
        steps.append(f"""
dist{r} AS (
  SELECT vec_id, part, e, sum((x - c) * (x - c)) AS d FROM cells JOIN book{r} USING (part, pos) GROUP BY vec_id, part, e),
near{r} AS (SELECT vec_id, part, min(d) AS d, arg_min(e, (d, e)) AS e FROM dist{r} GROUP BY vec_id, part)""")
        if r < 4:
            steps.append(f"""
book{r + 1} AS (
  SELECT b.part, b.e, b.pos, CASE WHEN n IS NULL THEN c ELSE CAST((s - ((s % n) + n) % n) // n AS BIGINT) END AS c
  FROM book{r} b LEFT JOIN (
    SELECT part, e, pos, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
    FROM cells JOIN near{r} USING (vec_id, part) GROUP BY part, e, pos) m ON b.part = m.part AND b.e = m.e AND b.pos = m.pos)""")
    return ",".join(steps) + """,
coded AS (
  SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM near4 GROUP BY vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, e, pos)) FROM book4) AS codebooks_sha256
FROM coded JOIN kept USING (vec_id)"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_secret_scan": SECRET_SCAN,
        "op2_line_dedup": LINE_DEDUP,
        "op6_sharding": SHARDING.format(limit=sharding.LIMIT),
        "op10_benchmark_decontamination": DECONTAMINATION,
        "op13_vector_codes": _vector_codes(),
    }
