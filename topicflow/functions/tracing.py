"""W3C ``traceparent`` text: ``<version>-<trace id>-<span id>-<flags>``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the header format.
TRACEPARENT_HEADER = "traceparent"
TRACEPARENT_VERSION = "00"
SAMPLED_FLAG = "01"
UNSAMPLED_FLAG = "00"
# Exactly four dash-separated parts; ids are hex digits of at most 32 and 16 characters.
TRACEPARENT_PATTERN = r"^([^-]*)-([0-9a-fA-F]{1,32})-([0-9a-fA-F]{1,16})-([^-]*)$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def format_traceparent(trace_id, span_id, sampled) -> Column:
    """Header text from hex ids and a sampled flag; ids are lower-cased and zero-padded."""
    return F.concat_ws(
        "-",
        F.lit(TRACEPARENT_VERSION),
        F.lpad(F.lower(_c(trace_id)), 32, "0"),
        F.lpad(F.lower(_c(span_id)), 16, "0"),
        F.when(_c(sampled), F.lit(SAMPLED_FLAG)).otherwise(F.lit(UNSAMPLED_FLAG)),
    )


def parse_traceparent(text) -> Column:
    """Header text → struct(trace_id, span_id, sampled), or null when it is not a valid header.

    The version part is ignored; the flag is sampled only when it is exactly ``01``.
    """
    t = _c(text)
    ok = t.rlike(TRACEPARENT_PATTERN)
    # text that matches has three dashes: its parts are cut there, no further search
    return F.when(
        ok,
        F.struct(
            F.lpad(F.lower(F.substring_index(F.substring_index(t, "-", 2), "-", -1)), 32, "0").alias("trace_id"),
            F.lpad(F.lower(F.substring_index(F.substring_index(t, "-", -2), "-", 1)), 16, "0").alias("span_id"),
            (F.substring_index(t, "-", -1) == F.lit(SAMPLED_FLAG)).alias("sampled"),
        ),
    )


def span_is_valid(trace_id, span_id) -> Column:
    """A span context is valid when both ids are present and not all zeros."""
    return (_c(trace_id).isNotNull() & _c(span_id).isNotNull()
            & (F.ltrim(_c(trace_id), F.lit("0")) != "") & (F.ltrim(_c(span_id), F.lit("0")) != ""))


def trace_header(trace_id, span_id, sampled) -> Column:
    """Headers list carrying the trace context, or null when the span is not valid."""
    return F.when(
        span_is_valid(trace_id, span_id),
        F.array(F.struct(
            F.lit(TRACEPARENT_HEADER).alias("key"),
            format_traceparent(trace_id, span_id, sampled).cast("binary").alias("value"))),
    )
