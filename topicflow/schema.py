"""Physical schemas: the record envelope and the order value shapes."""

from pyspark.sql import types as T

HEADER = T.StructType([
    T.StructField("key", T.StringType(), True),
    T.StructField("value", T.BinaryType(), True),
])

# The record envelope: the Kafka source's own columns (with includeHeaders=true), so the
# same operators run on a broker stream and on the Parquet file log.
ENVELOPE = T.StructType([
    T.StructField("key", T.BinaryType(), True),
    T.StructField("value", T.BinaryType(), True),
    T.StructField("topic", T.StringType(), False),
    T.StructField("partition", T.IntegerType(), False),
    T.StructField("offset", T.LongType(), False),
    T.StructField("timestamp", T.TimestampType(), True),
    T.StructField("headers", T.ArrayType(HEADER, True), True),
])
ENVELOPE_COLUMNS = [f.name for f in ENVELOPE.fields]

# Log position of a record; the identity used by reports, dead letters and de-duplication.
POSITION = ["topic", "partition", "offset"]

ITEM = T.StructType([
    T.StructField("sku", T.StringType(), True),
    T.StructField("qty", T.LongType(), True),
])

# Order-file shape (one JSON object per line).
ORDER_FILE = T.StructType([
    T.StructField("order_id", T.LongType(), True),
    T.StructField("user", T.StringType(), True),
    T.StructField("items", T.ArrayType(ITEM), True),
    T.StructField("total", T.DoubleType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("ts", T.TimestampType(), True),
])

# Simple API order: the shape the tracker and the orders worker read.
SIMPLE_ORDER = T.StructType([
    T.StructField("order_id", T.StringType(), True),
    T.StructField("user", T.StringType(), True),
    T.StructField("item", T.StringType(), True),
    T.StructField("quantity", T.LongType(), True),
])
