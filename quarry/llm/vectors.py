"""Vectors inside Arrow batches: which rows take part, and their components as integers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dimension_of(df: DataFrame, vec_col: str) -> int:
    """The most frequent length of the non-null vectors, the longest of several; 0 if there are none."""
    sizes = df.where(F.col(vec_col).isNotNull()).groupBy(F.size(vec_col).alias("d")).count()
    first = sizes.orderBy(F.desc("count"), F.desc("d")).first()
    return first["d"] if first else 0


def scaled(lists: pa.Array, dims: int, factor: int, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the rows that take part, and floor(factor * component) of those (a row each, int64). Left out:
    null vectors, those of another length, with null or non-finite components, or with one of ``limit`` or more."""
    fits = pc.fill_null(pc.equal(pc.list_value_length(lists), dims), False)
    at = np.flatnonzero(fits.to_numpy(zero_copy_only=False))
    flat = lists.filter(fits).flatten().cast(pa.float64())
    x = flat.to_numpy(zero_copy_only=False).reshape(len(at), dims)  # null components become NaN
    with np.errstate(over="ignore", invalid="ignore"):
        x = np.floor(x * factor)
        good = (np.abs(x) < limit).all(axis=1) if dims else np.zeros(len(at), bool)
    return at[good], x[good].astype(np.int64)
