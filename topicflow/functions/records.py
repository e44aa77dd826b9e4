"""Key, value and header codecs for envelope columns.

Everything here returns a Column built from Spark's native expressions, so decoding stays in
whole-stage codegen and runs the same on batch and streaming frames.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decode_key(key="key") -> Column:
    """UTF-8 text of a key; null and empty bytes give null, and so do bytes that are not UTF-8."""
    return F.nullif(F.try_validate_utf8(_c(key).cast("string")), F.lit(""))


def decode_key_strict(key="key") -> Column:
    """As :func:`decode_key`, but bytes that are not UTF-8 fail the query."""
    return F.nullif(F.validate_utf8(_c(key).cast("string")), F.lit(""))


def value_text(value="value") -> Column:
    """Value bytes as text (bad UTF-8 gives null)."""
    return F.try_validate_utf8(_c(value).cast("string"))


def strip(text) -> Column:
    """Text without white space (Unicode) at its ends. Text between two visible ASCII characters is taken as it is; only
    other text is searched."""
    t = _c(text)
    bare = F.ascii(F.left(t, F.lit(1))).between(33, 126) & F.ascii(F.right(t, F.lit(1))).between(33, 126)
    return F.when(bare, t).otherwise(F.regexp_replace(t, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", ""))


def record_line() -> Column:
    """One printed line per record: partition, offset, key and value."""
    return F.format_string("partition=%d offset=%d key=%s value=%s", F.col("partition"), F.col("offset"),
                           decode_key(), value_text())


def decode_json_strict(value, schema: StructType | DataType | str) -> Column:
    """Parse a JSON value with a fixed schema; any bad value (blank text included) stops the job.

    ``from_json`` in FAILFAST mode raises on malformed text but returns null for an empty
    string, so blank and null values are rejected explicitly first.
    """
    text = F.validate_utf8(_c(value).cast("string"))
    checked = F.when(text.isNull() | (strip(text) == ""),
                     F.raise_error(F.lit("strict JSON decode: empty or null value"))).otherwise(text)
    return F.from_json(checked, schema, {"mode": "FAILFAST"})


def decode_json_or_text(value="value") -> Column:
    """Tolerant decode: struct(json VARIANT, raw STRING, is_json BOOLEAN, raw_bytes BINARY).

    Any JSON document counts, bare scalars such as ``5`` and ``"x"`` included, and so does an object that
    names a field twice (the last counts; ``session.REQUIRED_CONF``); anything else keeps its raw text with
    ``is_json = false``, and bytes that are not UTF-8 are kept in ``raw_bytes``.
    """
    raw = F.try_validate_utf8(_c(value).cast("string"))
    parsed = F.try_parse_json(raw)
    return F.struct(parsed.alias("json"), raw.alias("raw"), parsed.isNotNull().alias("is_json"),
                    F.when(raw.isNull(), _c(value)).alias("raw_bytes"))


def parse_once(df, keep, **parsed):
    """Select ``keep`` columns plus each ``name=expression`` evaluated exactly once per row.

    A filter on a field derived from a parsed value would otherwise be pushed below the
    projection and inline the parse once per reference. Producing the parsed values from a
    one-row generator keeps them above any pushed filter, so each value is parsed once.
    """
    packed = F.array(F.struct(*[e.alias(n) for n, e in parsed.items()]))
    return df.select(*keep, F.inline(packed))


def header_map(headers="headers") -> Column:
    """Header list → MAP<STRING,STRING>: last duplicate wins, empty value → null, null list → {}.

    Earlier duplicates are dropped inside the expression (keep an entry only when no later
    entry has the same name), so no session-wide map-key policy is needed.
    """
    h = _c(headers)
    last_only = F.filter(
        h,
        lambda x, i: ~F.exists(
            F.slice(h, i + 2, F.greatest(F.size(h) - i - 1, F.lit(0))),
            lambda y: y["key"] == x["key"]),
    )
    entries = F.transform(
        last_only,
        lambda x: F.struct(x["key"].alias("key"),
                           F.nullif(F.try_validate_utf8(x["value"].cast("string")), F.lit(""))
                           .alias("value")),
    )
    return F.coalesce(F.map_from_entries(entries),
                      F.create_map().cast("map<string,string>"))


def header_value(name: str, headers="headers") -> Column:
    """Text of the last header called ``name`` (null when absent or empty)."""
    h = _c(headers)
    matching = F.filter(h, lambda x: x["key"] == F.lit(name))
    last = F.try_element_at(matching, F.lit(-1))
    return F.nullif(F.try_validate_utf8(last["value"].cast("string")), F.lit(""))


def encode_key(col) -> Column:
    """Key column → UTF-8 bytes (null stays null)."""
    return _c(col).cast("string").cast("binary")


# Timestamps are written with all six fraction digits (Spark's default keeps milliseconds).
JSON_WRITE_OPTIONS = {
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}


def encode_value(*cols, keep_nulls: bool = True) -> Column:
    """Columns → JSON object bytes. Null fields are written as ``null`` like Python's encoder
    (Spark's default would drop them); timestamps keep microseconds."""
    opts = dict(JSON_WRITE_OPTIONS)
    if keep_nulls:
        opts["ignoreNullFields"] = "false"
    return F.to_json(F.struct(*[_c(c) for c in cols]), opts).cast("binary")


def make_headers(**named) -> Column:
    """``make_headers(**{"event-type": col})`` → ARRAY<STRUCT<key STRING, value BINARY>>.

    A header whose value is null is left out, so optional headers disappear row by row.
    """
    entries = [F.struct(F.lit(k).alias("key"), _c(v).cast("string").cast("binary").alias("value"))
               for k, v in named.items()]
    return F.filter(F.array(*entries), lambda x: x["value"].isNotNull())
