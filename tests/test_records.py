"""Edge rows for key, value and header decoding (FIXTURES.md §3)."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicflow.functions import records as R

HDR = T.ArrayType(T.StructType([T.StructField("key", T.StringType()),
                                T.StructField("value", T.BinaryType())]))


def test_decode_key_null_empty_and_bad_utf8(spark):
    df = spark.createDataFrame([(None,), (bytearray(b""),), (bytearray(b"john"),),
                                (bytearray(b"\xff\xfe"),)], "key binary")
    got = [r[0] for r in df.select(R.decode_key()).collect()]
    assert got == [None, None, "john", None]
    with pytest.raises(Exception):
        df.select(R.decode_key_strict()).collect()


def test_json_or_text(spark):
    rows = ['{"a":1}', "5", '"x"', "plain", "", '{"a":']
    df = spark.createDataFrame([(bytearray(r.encode()),) for r in rows], "value binary")
    got = df.select(R.decode_json_or_text().alias("d")).select("d.is_json", "d.raw").collect()
    assert [r.is_json for r in got] == [True, True, True, False, False, False]
    assert [r.raw for r in got] == rows


@pytest.mark.parametrize("text", ["plain", "", '{"a":'])
def test_json_strict_fails_on_bad_value(spark, text):
    df = spark.createDataFrame([(bytearray(text.encode()),)], "value binary")
    with pytest.raises(Exception):
        df.select(R.decode_json_strict("value", "a bigint")).collect()


def test_json_strict_reads_good_value(spark):
    df = spark.createDataFrame([(bytearray(b'{"a": 7}'),)], "value binary")
    assert df.select(R.decode_json_strict("value", "a bigint")["a"]).first()[0] == 7


def test_header_map_last_wins_and_empty_values(spark):
    rows = [([("a", b"1"), ("a", b"2"), ("b", b""), ("c", None)],), (None,), ([],)]
    df = spark.createDataFrame(rows, T.StructType([T.StructField("headers", HDR)]))
    got = [r[0] for r in df.select(R.header_map()).collect()]
    assert got[0] == {"a": "2", "b": None, "c": None}
    assert got[1] == {} and got[2] == {}


def test_header_value_and_make_headers(spark):
    df = spark.range(2).select(
        R.make_headers(**{"event-type": F.when(F.col("id") == 0, F.lit("click")),
                          "x": F.lit("y")}).alias("headers"))
    got = df.select(R.header_value("event-type"), R.header_value("x"), F.size("headers")).collect()
    assert [tuple(r) for r in got] == [("click", "y", 2), (None, "y", 1)]


def test_encode_keeps_nulls_and_microseconds(spark):
    df = spark.sql("select cast(null as string) a, timestamp_ntz'2024-01-01 00:00:07.179575' ts")
    text = df.select(R.encode_value("a", "ts").cast("string")).first()[0]
    assert text == '{"a":null,"ts":"2024-01-01T00:00:07.179575"}'


def test_tolerant_decode_of_odd_values(spark):
    values = [b'{"a":1,"a":2}', b"\xff\xfe", b"plain", None, b"5"]
    df = spark.createDataFrame([(i, v and bytearray(v)) for i, v in enumerate(values)], "i int, value binary")
    got = {r.i: r for r in df.select("i", R.decode_json_or_text().alias("d")).select(
        "i", F.try_variant_get("d.json", "$.a", "int").alias("a"), "d.raw", "d.is_json", "d.raw_bytes").collect()}
    assert got[0].is_json and got[0].a == 2                        # the last of a repeated name counts
    assert not got[1].is_json and got[1].raw is None and bytes(got[1].raw_bytes) == values[1]
    assert (got[2].is_json, got[2].raw, got[2].raw_bytes) == (False, "plain", None)
    assert (got[3].is_json, got[3].raw, got[3].raw_bytes) == (False, None, None) and got[4].is_json


def test_strip_and_blank_values(spark):
    texts = ["\t a \r\n", " b　", "\x1cc\x1f", " \t", ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i")
    assert [r[0] for r in df.select(R.strip("t")).collect()] == [t.strip() for t in texts]
    import pytest
    blank = spark.createDataFrame([(bytearray(b"\t"),)], "value binary")
    with pytest.raises(Exception, match="empty or null"):
        blank.select(R.decode_json_strict("value", "a int")).collect()


def test_record_line_and_union_of_topics(spark):
    from topicflow.sources.topics import union_topics
    a = spark.createDataFrame([(1, 2, bytearray(b"k"), bytearray(b"v"))], "partition int, offset bigint, key binary, value binary")
    assert a.select(R.record_line()).first()[0] == "partition=1 offset=2 key=k value=v"
    b = spark.createDataFrame([(3, "x")], "partition int, extra string")
    both = {r.partition: r for r in union_topics(a, b).collect()}
    assert both[1].extra is None and both[3].offset is None and both[3].extra == "x"


def test_strip_searches_only_text_with_odd_ends(spark):
    from pyspark.sql import functions as F
    texts = ["a b", "x　", " y", "z\n", "q \r\n", "!", "~", "é", " é ", "a\x1f", "\x00a", "a\x7f", "a\nb", "a \n b", None, ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i")
    searched = F.regexp_replace("t", r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")
    assert all(a == b for a, b in df.select(R.strip("t"), searched).collect())
    # a bare line is taken as it is: the pattern stands in a branch only
    assert "CASE WHEN" in df.select(R.strip("t").alias("s"))._jdf.queryExecution().optimizedPlan().toString()
