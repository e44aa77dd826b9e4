"""Five value shapes → canonical rows; validation, required fields, routing (FIXTURES.md)."""

import datetime as dt

from pyspark.sql import functions as F

from topicflow.operators import orders as O

SHAPES = [
    '{"id":1,"item":"widget-1","ts":"2025-11-07T12:05:00Z"}',
    '{"order_id":"u1","user":"john","item":"burger","quantity":5}',
    '{"order_id":"c1","user_id":1500,"items":[{"sku":"PIZZA-PEP","qty":1}],"amount":9.5,"status":"CREATED"}',
    '{"order_id":"d1","seq":3,"restaurant":"Bao Bae","items":["bao","dosa"],"total":12.25,"ts":"2025-11-07T12:05:00.123456"}',
    '{"order_id":7321,"user":"mira","items":[{"sku":"lentils","qty":2}],"total":18.75,"status":"PLACED","ts":"2024-03-02T08:30:00Z"}',
    'not json',
]


def _records(spark, values):
    return spark.createDataFrame(
        [("t", 0, i, bytearray(v.encode())) for i, v in enumerate(values)],
        "topic string, partition int, offset bigint, value binary")


def test_normalize_five_shapes(spark):
    got = {r.offset: r for r in O.normalize_orders(_records(spark, SHAPES)).collect()}
    items = lambda r: [(x.sku, x.qty) for x in r.items] if r.items is not None else None
    assert (got[0].order_id, got[0].user, items(got[0]), got[0].total) == ("1", None, [("widget-1", 1)], None)
    assert got[0].ts == dt.datetime(2025, 11, 7, 12, 5)
    assert (got[1].order_id, got[1].user, items(got[1]), got[1].ts) == ("u1", "john", [("burger", 5)], None)
    assert (got[2].order_id, got[2].user, items(got[2]), got[2].total) == ("c1", "1500", [("PIZZA-PEP", 1)], 9.5)
    assert (got[3].order_id, items(got[3]), got[3].total, got[3].restaurant, got[3].seq) == \
        ("d1", [("bao", 1), ("dosa", 1)], 12.25, "Bao Bae", 3)
    assert got[3].ts == dt.datetime(2025, 11, 7, 12, 5, 0, 123456)
    assert (got[4].order_id, got[4].user, items(got[4]), got[4].total, got[4].status) == \
        ("7321", "mira", [("lentils", 2)], 18.75, "PLACED")
    assert got[5].order_id is None and got[5].items is None


def test_validation_quantity_rule(spark):
    df = spark.createDataFrame([("u", "i", q) for q in (0, 1, 20, 21, None)] + [(None, "i", 1), ("u", None, 1)],
                               "user string, item string, quantity bigint")
    ok, rej = O.validate_orders(df)
    assert sorted(r.quantity for r in ok.collect()) == [1, 20]
    reasons = sorted(r.reason for r in rej.collect())
    assert reasons == ["missing:item", "missing:quantity", "missing:user",
                       "range:quantity not in 1..20", "range:quantity not in 1..20"]


def test_require_fields_names_the_field(spark):
    canon = O.normalize_orders(_records(spark, SHAPES))
    _, rej = O.require_fields(canon, ["order_id", "restaurant"])
    got = {r.offset: r.reason for r in rej.collect()}
    assert got[4] == "missing:restaurant" and got[5] == "missing:order_id" and 3 not in got


def test_route_cost(spark):
    df = spark.createDataFrame([(r,) for r in ("Tandoori Tales", "Masala Magic", "Pizza Hub", None)],
                               "restaurant string")
    assert [r[0] for r in df.select(O.prep_cost()).collect()] == [2, 2, 1, 1]


def test_shape_orders_stable_ids(spark):
    df = spark.createDataFrame([("u", "i", 1, 7)], "user string, item string, quantity bigint, n bigint")
    a = O.shape_orders(df, stable_id=["n"]).first()
    b = O.shape_orders(df, stable_id=["n"]).first()
    assert a.order_id == b.order_id and a.key_text == "u"
    assert len(O.shape_orders(df).withColumn("l", F.length("order_id")).first().order_id) == 36


def test_an_order_of_any_size_makes_one_record_per_line(spark, scratch):
    """3,000 lines of one order: the same rule as for a small one, and the totals add up as in DuckDB."""
    import duckdb

    from topicflow.sources import testtopic as TT

    d = scratch("tables")
    spark.createDataFrame([(7, 1, 10.0, "O", "5-LOW"), (8, 2, 5.0, "P", "3-MEDIUM"), (9, 3, 4.0, "O", "2-HIGH")],
                          "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderstatus string, "
                          "o_orderpriority string") \
        .withColumn("o_orderdate", F.lit("1995-01-01").cast("timestamp_ntz")).coalesce(1).write.parquet(f"{d}/orders.parquet")
    spark.createDataFrame([(1, "ann"), (2, "bob")], "c_custkey bigint, c_name string").coalesce(1) \
        .write.parquet(f"{d}/customer.parquet")
    lines = [(7, i, i % 50, 3, 2.0, i / 4) for i in range(3000)] + [(8, 1, 1, 1, 1.0, 2.5)]
    spark.createDataFrame(lines, "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, "
                          "l_quantity double, l_extendedprice double").repartition(4).write.parquet(f"{d}/lineitem.parquet")
    records = TT.order_records(spark, d)
    got = {(r.o_orderkey, r.n) for r in records.groupBy("o_orderkey").agg(F.count("*").alias("n")).collect()}
    assert got == {(7, 3000), (8, 1), (9, 1)}
    canon = O.normalize_orders(records.withColumns({"partition": F.lit(0), "offset": F.lit(0).cast("bigint")}))
    total = canon.where("status = 'PLACED'").agg(F.sum("total")).first()[0]
    want = duckdb.sql(f"select sum(l_extendedprice) from '{d}/lineitem.parquet/*.parquet' where l_orderkey = 7").fetchall()[0][0]
    assert abs(total - want) < 1e-6


def test_dead_letters_keep_the_record_and_tell_decode_errors(spark):
    values = [b"not json", b'{"order_id":"x","user":"u"}', b"\xff\xfe", b'{"order_id":"a","user":"u","item":"i","quantity":2}',
              None]
    df = spark.createDataFrame([(b"k", v and bytearray(v), None, "t", 0, i) for i, v in enumerate(values)],
                               "key binary, value binary, headers array<struct<key:string,value:binary>>, topic string, "
                               "partition int, offset bigint")
    got = {r.offset: (r.reason, r.value and bytes(r.value)) for r in O.order_rejects(df).collect()}
    assert got == {0: ("decode:not JSON", b"not json"), 1: ("missing:item", values[1]),
                   2: ("decode:not JSON", values[2]), 4: ("decode:not JSON", None)}


def test_order_lines_shuffle_the_lines_once_and_broadcast_nothing(spark, tmp_path):
    from topicflow.sources import testtopic as TT
    from pyspark.sql import functions as F
    d = str(tmp_path)
    spark.range(6).selectExpr("id o_orderkey", "if(id = 5, null, id % 3) o_custkey", "'O' o_orderstatus", "1.5D o_totalprice",
                              "timestamp_ntz'2024-01-01' o_orderdate", "concat(id, '-X') o_orderpriority").write.parquet(f"{d}/orders.parquet")
    spark.createDataFrame([(0, "a"), (1, "b"), (1, "b2")], "c_custkey bigint, c_name string").write.parquet(f"{d}/customer.parquet")
    spark.range(8).selectExpr("if(id = 7, null, id % 4) l_orderkey", "id l_partkey", "id l_suppkey", "int(id) l_linenumber", "2D l_quantity",
                              "3D l_extendedprice").write.parquet(f"{d}/lineitem.parquet")
    got = TT.order_lines(spark, d)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and plan.count("SortMergeJoin") == 2
    o, li, c = (TT.table(spark, d, t) for t in ("orders", "lineitem", "customer"))
    want = o.join(li, o.o_orderkey == li.l_orderkey, "left").join(c, o.o_custkey == c.c_custkey, "left")
    key = lambda df, n: sorted(map(str, df.select("o_orderkey", "c_name", "l_partkey", n).collect()))
    assert key(got.withColumn("q", F.col("qty").cast("double")), "q") == [x.replace("l_quantity", "q") for x in key(want, "l_quantity")]
