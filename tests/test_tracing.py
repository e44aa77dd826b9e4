"""traceparent text, parsing rules and span links."""

from pyspark.sql import functions as F

from topicflow.functions import tracing as TR
from topicflow.operators import tracing as TS

TID = "4bf92f3577b34da6a3ce929d0e0e4736"
SID = "00f067aa0ba902b7"


def test_format_pads_and_lowercases(spark):
    df = spark.createDataFrame([("ABC", "1F", True), (TID, SID, False)], "t string, s string, f boolean")
    got = [r[0] for r in df.select(TR.format_traceparent("t", "s", "f")).collect()]
    assert got == ["00-" + "0" * 29 + "abc-" + "0" * 14 + "1f-01", f"00-{TID}-{SID}-00"]


def test_parse_rules(spark):
    rows = [f"00-{TID}-{SID}-01", f"ff-{TID}-{SID}-00", f"00-{TID}-{SID}", f"00-{TID}-{SID}-01-x",
            f"00-{TID[:-1]}g-{SID}-01", None, f"00-{TID}-{SID}-1"]
    df = spark.createDataFrame([(r,) for r in rows], "h string")
    got = [r[0] for r in df.select(TR.parse_traceparent("h")).collect()]
    assert tuple(got[0]) == (TID, SID, True)
    assert tuple(got[1]) == (TID, SID, False)      # version ignored, flag 00
    assert got[2] is None and got[3] is None and got[4] is None and got[5] is None
    assert tuple(got[6]) == (TID, SID, False)      # only exactly "01" is sampled


def test_header_only_for_valid_span(spark):
    df = spark.createDataFrame([(TID, SID), ("0" * 32, SID), (TID, None)], "t string, s string")
    got = [r[0] for r in df.select(TR.trace_header("t", "s", F.lit(True))).collect()]
    assert got[0] is not None and got[1] is None and got[2] is None
    assert bytes(got[0][0]["value"]).decode() == f"00-{TID}-{SID}-01"


def test_link_spans_parent_and_root(spark):
    hdr = "array<struct<key:string,value:binary>>"
    recs = spark.createDataFrame(
        [("g", "t", 0, 0, [("traceparent", bytearray(f"00-{TID}-{SID}-01".encode()))]),
         ("g", "t", 0, 1, None)],
        f"group string, topic string, partition int, offset bigint, headers {hdr}")
    produced = spark.createDataFrame([(TID, SID, "api")], "trace_id string, span_id string, who string")
    got = {r.offset: r for r in TS.link_spans(TS.consume_spans(recs), produced).collect()}
    assert got[0].parent_span_id == SID and got[0].parent_who == "api" and got[0].trace_id == TID
    assert got[1].parent_span_id is None and got[1].parent_who is None


def test_all_zero_context_is_no_parent(spark):
    hdr = "array<struct<key:string,value:binary>>"
    zeros = [f"00-{'0' * 32}-{SID}-01", f"00-{TID}-{'0' * 16}-01", f"00-{'0' * 32}-{'0' * 16}-01"]
    recs = spark.createDataFrame(
        [("g", "t", 0, i, [("traceparent", bytearray(z.encode()))]) for i, z in enumerate(zeros)],
        f"group string, topic string, partition int, offset bigint, headers {hdr}")
    spans = TS.consume_spans(recs).collect()
    assert all(r.parent_span_id is None and r.trace_id.strip("0") for r in spans)
    assert len({r.trace_id for r in spans}) == 3


def test_a_header_is_searched_once(spark):
    """What matches is cut at its dashes: one search a header, the parts that the pattern's groups have."""
    import contextlib
    import io
    odd = [f"00-{TID}-{SID}-01", "-a-B-", "x-1f-2-00", f"00-{TID}-{SID}-01\n", f"00-{TID}\n-{SID}-01", "00-0-0-0-0", "a-g-1-1", "--1-1", "",
           f"00-{TID}0-{SID}-01", "é-AB-cd-é", None]
    df = spark.createDataFrame([(h,) for h in odd], "h string")
    part = lambda i: F.regexp_extract("h", TR.TRACEPARENT_PATTERN, i)
    want = F.when(F.col("h").rlike(TR.TRACEPARENT_PATTERN), F.struct(F.lpad(F.lower(part(2)), 32, "0"), F.lpad(F.lower(part(3)), 16, "0"), part(4) == "01"))
    parsed = df.select(TR.parse_traceparent("h").alias("got"), want.alias("want"))
    assert all(r.got == r.want for r in parsed.collect()) and parsed.where("got is not null").count() == 5
    plan = io.StringIO()
    with contextlib.redirect_stdout(plan):
        df.select(TR.parse_traceparent("h")).explain()
    assert "regexp_extract" not in plan.getvalue()
