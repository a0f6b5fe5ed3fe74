"""Deterministic, partition-independent pseudo-randomness.

Spark's ``rand``/``randomSplit`` depend on how rows are laid out in
partitions, so the same seed can give different rows on a different cluster.
Every split and sample here is a pure function of ``(seed, key)`` instead,
which also makes it reproducible by any SQL engine that has ``md5``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_u32(key, seed: int) -> Column:
    """Unsigned 32-bit integer from the first 8 hex digits of md5(seed:key)."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), _col(key).cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def hash_bucket(key, seed: int, buckets: int = 100) -> Column:
    """Bucket in ``[0, buckets)``; a 30 % split is ``hash_bucket(..) < 30``."""
    return hash_u32(key, seed) % F.lit(buckets)


def hash_rank_key(key, seed: int) -> Column:
    """Sort key for a seeded shuffle (ties broken by the key itself)."""
    return F.md5(F.concat(F.lit(f"{seed}:"), _col(key).cast("string")))


def sql_hash_u32(key_sql: str, seed: int) -> str:
    """DuckDB twin of :func:`hash_u32` (used by the oracle SQL)."""
    return f"('0x' || substr(md5(concat('{seed}:', CAST({key_sql} AS VARCHAR))), 1, 8))::BIGINT"


def sql_hash_rank_key(key_sql: str, seed: int) -> str:
    return f"md5(concat('{seed}:', CAST({key_sql} AS VARCHAR)))"
