"""Null-safe flags and clipping.

A comparison with NULL is NULL in SQL; the published pipeline treats it as
false, so every flag coalesces to 0.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ._util import as_col


def null_safe_true(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False))


def flag_gt(c, x: float) -> Column:
    return null_safe_true(as_col(c) > F.lit(float(x))).cast("int")


def flag_lt(c, x: float) -> Column:
    return null_safe_true(as_col(c) < F.lit(float(x))).cast("int")


def flag_ge(c, x) -> Column:
    x = x if isinstance(x, Column) else F.lit(x)
    return null_safe_true(as_col(c) >= x).cast("int")


def flag_in(c, values) -> Column:
    return null_safe_true(as_col(c).isin(*values)).cast("int")


def clip(c, lo=None, hi=None) -> Column:
    """Clip to [lo, hi]; NULL stays NULL (``least``/``greatest`` skip nulls)."""
    c = as_col(c)
    out = c
    if lo is not None:
        out = F.greatest(out, F.lit(float(lo)))
    if hi is not None:
        out = F.least(out, F.lit(float(hi)))
    return F.when(c.isNull(), F.lit(None).cast("double")).otherwise(out)
