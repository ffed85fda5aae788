"""Scalar column expressions (the reference's value normalisers, M1-M9, A9).

All are built-in Spark expressions, so they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Accepted spellings of booleans.
TRUE_TOKENS = ["true", "1", "yes", "y", "t"]
FALSE_TOKENS = ["false", "0", "no", "n", "f"]

# Fixed value: placeholder for a missing categorical value.
MISSING_TOKEN = "__MISSING__"

# Run-status spellings and their normal form.
STATUS_GROUPS = {
    "completed": ["completed", "closed", "finished", "published", "success"],
    "failed": ["failed", "error"],
    "stopped": ["stopped", "aborted"],
    "queued": ["queued", "created", "pending"],
    "running": ["in_progress", "running"],
}


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def finite_or_null(c) -> Column:
    """A9 for one float column: NaN and +-Inf become NULL."""
    x = _c(c)
    return F.when(F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), F.lit(None).cast("double")).otherwise(x)


def canonicalize_missing(df: DataFrame) -> DataFrame:
    """Make NULL the only missing marker in every float/double column."""
    exprs = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            exprs.append(finite_or_null(f.name).cast(f.dataType).alias(f.name))
        else:
            exprs.append(F.col(f"`{f.name}`"))
    return df.select(*exprs)


def to_float_finite(c) -> Column:
    """M1: parse to double; unparsable or non-finite -> NULL."""
    return finite_or_null((F.trim(_c(c).cast("string"))).try_cast("double"))


def to_int_safe(c, default: int | None = None) -> Column:
    """M2: parse to bigint, else ``default``."""
    parsed = (F.trim(_c(c).cast("string"))).try_cast("bigint")
    return parsed if default is None else F.coalesce(parsed, F.lit(default).cast("bigint"))


def trim_or_null(c) -> Column:
    """M3: strip; empty string -> NULL."""
    return F.nullif(F.trim(_c(c).cast("string")), F.lit(""))


def parse_bool_text(c, default: bool = False) -> Column:
    """M4: text to boolean with a default for anything unrecognised."""
    t = F.lower(F.trim(_c(c).cast("string")))
    return F.when(t.isin(TRUE_TOKENS), F.lit(True)).when(t.isin(FALSE_TOKENS), F.lit(False)).otherwise(F.lit(default))


def slugify(c, max_len: int = 40, default: str = "col") -> Column:
    """M5: keep [0-9A-Za-z_-], whitespace to '_', strip '_' at both ends,
    empty -> default, then cut to max_len."""
    s = F.regexp_replace(_c(c).cast("string"), "\\s", "_")
    s = F.regexp_replace(s, "[^0-9A-Za-z_-]", "")
    s = F.regexp_replace(s, "^_+|_+$", "")
    s = F.coalesce(F.nullif(s, F.lit("")), F.lit(default))
    return F.substring(s, 1, max_len)


def stringify_missing(c) -> Column:
    """M6: categorical value as text; NULL -> __MISSING__."""
    return F.coalesce(_c(c).cast("string"), F.lit(MISSING_TOKEN))


def normalize_status(c) -> Column:
    """M9: map run-status spellings to one of five states (unknown -> lower-cased input)."""
    t = F.lower(F.trim(_c(c).cast("string")))
    out = None
    for norm, spellings in STATUS_GROUPS.items():
        out = (F.when if out is None else out.when)(t.isin(spellings), F.lit(norm))
    return out.otherwise(t)


def round6(c) -> Column:
    return F.round(_c(c), 6)
