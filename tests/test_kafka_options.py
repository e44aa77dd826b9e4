"""The Kafka form can only be checked for its option maps here (no connector installed)."""

from topicflow.operators.publish import kafka_sink_options
from topicflow.sources.topics import kafka_source_options


def test_source_options_stream_and_batch():
    s = kafka_source_options("b:9092", ["a", "b"], "earliest", streaming=True,
                             extra={"maxOffsetsPerTrigger": "500"})
    assert s == {"kafka.bootstrap.servers": "b:9092", "subscribe": "a,b", "includeHeaders": "true",
                 "startingOffsets": "earliest", "maxOffsetsPerTrigger": "500"}
    b = kafka_source_options("b:9092", ["a"], "latest")
    assert b["startingOffsets"] == "latest" and b["endingOffsets"] == "latest"


def test_sink_options_durable_by_default():
    o = kafka_sink_options("b:9092", {"kafka.linger.ms": "5"})
    assert o["kafka.acks"] == "all" and o["kafka.enable.idempotence"] == "true"
    assert o["kafka.linger.ms"] == "5" and o["kafka.bootstrap.servers"] == "b:9092"


def test_pattern_subscription_option():
    o = kafka_source_options("b:9092", [], pattern="demo\\..*", streaming=True)
    assert o["subscribePattern"] == "demo\\..*" and "subscribe" not in o


def test_cluster_profile_settings():
    from topicflow.session import CLUSTER_CONF, DEFAULT_CONF
    assert CLUSTER_CONF["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == "256m"
    assert CLUSTER_CONF["spark.sql.autoBroadcastJoinThreshold"] == "-1"
    assert DEFAULT_CONF["spark.sql.adaptive.enabled"] == "true"


def test_missing_connector_is_named(spark):
    import pytest
    from topicflow.sources.topics import read_topic
    with pytest.raises(RuntimeError, match="spark-sql-kafka"):
        read_topic(spark, "localhost:9092", "demo.orders", fmt="kafka")
