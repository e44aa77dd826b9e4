"""topicflow: Spark-native operators for order events kept in partitioned record topics.

Topics are DataFrames in the record-envelope schema (the same columns Spark's Kafka source
produces), so every operator runs on a broker stream, a batch read of a broker, or a Parquet
file log laid out as ``topic=<name>/partition=<n>/``.
"""

from topicflow.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]
