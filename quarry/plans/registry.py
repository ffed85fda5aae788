"""Registry of named queries: a Spark builder ``(spark, sf_dir) -> DataFrame`` and,
where the operator is SQL-expressible, its DuckDB twin."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query key {name}")

        def run(spark, sf_dir, _fn=fn):
            return finish(_fn(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def finish(df: DataFrame) -> DataFrame:
    """Output convention: doubles rounded to 6 places, integers as bigint."""
    exprs = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            exprs.append(F.round(c.cast("double"), 6).alias(f.name))
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            exprs.append(c.cast("bigint").alias(f.name))
        else:
            exprs.append(c)
    return df.select(*exprs)


def rnd(sql: str, *double_cols: str) -> str:
    """Wrap oracle SQL so the listed double columns are rounded like ``finish``."""
    if not double_cols:
        return sql
    rep = ", ".join(f"round(CAST({c} AS DOUBLE), 6) AS {c}" for c in double_cols)
    return f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) _q"
