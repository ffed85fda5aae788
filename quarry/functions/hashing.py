"""Seeded, engine-independent hashing.

Every "random" choice in the library (sampling, splits, folds, bootstrap draws,
resampling, search draws) is a function of ``md5(seed:key)``, so it is
deterministic, order-independent, survives task retries, and can be reproduced
by any SQL engine that has ``md5``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: 2^32, the range of hash_unit.
HASH_RANGE = 4294967296.0


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_unit(seed, key) -> Column:
    """Unsigned 32-bit integer in [0, 2^32) from the first 8 hex chars of md5("seed:key")."""
    token = F.concat_ws(":", F.lit(str(seed)), _as_col(key).cast("string"))
    return F.conv(F.substring(F.md5(token), 1, 8), 16, 10).cast("bigint")


def hash_wide(seed, key) -> Column:
    """Unsigned 60-bit integer from the first 15 hex chars of md5("seed:key"): for draws over more rows than
    32 bits can number, and without their modulo bias."""
    token = F.concat_ws(":", F.lit(str(seed)), _as_col(key).cast("string"))
    return F.conv(F.substring(F.md5(token), 1, 15), 16, 10).cast("bigint")


def hash_uniform(seed, key) -> Column:
    """Uniform double in [0, 1)."""
    return hash_unit(seed, key) / F.lit(HASH_RANGE)


def hash_bucket(seed, key, n: int) -> Column:
    """Bucket 0..n-1."""
    return F.pmod(hash_unit(seed, key), F.lit(n))


def sql_hash_unit(seed, key_sql: str) -> str:
    """DuckDB twin of :func:`hash_unit` (used by the oracle SQL)."""
    return f"('0x' || substr(md5(concat_ws(':', '{seed}', CAST({key_sql} AS VARCHAR))), 1, 8))::BIGINT"


def sql_hash_wide(seed, key_sql: str) -> str:
    """DuckDB twin of :func:`hash_wide`."""
    return f"('0x' || substr(md5(concat_ws(':', '{seed}', CAST({key_sql} AS VARCHAR))), 1, 15))::BIGINT"
