"""Partition choice for publishing: same key → same partition; no key → spread."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_partition(key_text, n: int) -> Column:
    """Stable partition of a text key: first 32 bits of md5(key) modulo ``n``.

    md5 (rather than the broker's murmur2) keeps the rule reproducible in plain SQL, so any
    engine can recompute where a key lives.
    """
    k = F.col(key_text) if isinstance(key_text, str) else key_text
    h = F.conv(F.substring(F.md5(k.cast("string")), 1, 8), 16, 10).cast("bigint")
    return F.pmod(h, F.lit(n)).cast("int")


def spread_partition(n: int, seq=None) -> Column:
    """Partition for records without a key: spread evenly across ``n`` partitions.

    With a sequence column the spread is round-robin by it (the same on replay); without one
    it follows the row's position in its task.
    """
    if seq is None:
        return F.pmod(F.monotonically_increasing_id(), F.lit(n)).cast("int")
    s = F.col(seq) if isinstance(seq, str) else seq
    return F.pmod(s, F.lit(n)).cast("int")


def choose_partition(key_text, n: int, seq=None) -> Column:
    """Keyed records by :func:`key_partition`, key-less ones by :func:`spread_partition`."""
    k = F.col(key_text) if isinstance(key_text, str) else key_text
    return F.when(k.isNull(), spread_partition(n, seq)).otherwise(key_partition(k, n))
