from __future__ import annotations

from pyspark.sql import Column, functions as F


def as_col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def lit_map(mapping: dict) -> Column:
    """A literal MAP column from a small, fixed Python dict."""
    items = []
    for k, v in mapping.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


def np_round(c, digits: int | None):
    """Round like pandas/numpy ``.round(n)``: ``rint(x * 10^n) / 10^n``
    (half-even on the scaled binary value).  ``digits=None`` leaves ``c``."""
    if digits is None:
        return as_col(c)
    scale = F.lit(float(10 ** digits))
    return F.rint(as_col(c) * scale) / scale
