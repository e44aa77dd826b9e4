"""Column-level functions (pure Spark expressions, no Python UDFs)."""

from topicflow.functions.records import (
    decode_key, decode_key_strict, decode_json_strict, decode_json_or_text, header_map,
    header_value, encode_value, encode_key, make_headers, parse_once, value_text,
)
from topicflow.functions.tracing import format_traceparent, parse_traceparent, trace_header
from topicflow.functions.partitioning import key_partition, spread_partition
from topicflow.functions.rates import seconds_between, rate

__all__ = [
    "decode_key", "decode_key_strict", "decode_json_strict", "decode_json_or_text", "header_map",
    "header_value", "encode_value", "encode_key", "make_headers", "parse_once", "value_text",
    "format_traceparent", "parse_traceparent", "trace_header",
    "key_partition", "spread_partition", "seconds_between", "rate",
]
