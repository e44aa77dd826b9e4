"""Structured Streaming forms: workers with exactly-once outputs, fan-out, dedup, copies."""
