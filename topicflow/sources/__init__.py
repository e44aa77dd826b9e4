"""Readers: topics (broker or Parquet file log), JSON-lines files, and the test topic."""
