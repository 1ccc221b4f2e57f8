"""Safe parsing (P1, P2): bad values become NULL instead of failing the job.

ANSI mode is on in Spark 4, so a plain cast of ``'n/a'`` to double raises;
``try_cast`` / ``try_to_date`` return NULL.  NaN is normalised to NULL at the
scan because ``NaN > 20`` is true in Spark (and false in pandas).
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ._util import as_col

# Text a CSV reader treats as missing (the pandas read_csv default list).
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)


def normalise_missing(c) -> Column:
    """Missing-value tokens -> NULL (string columns)."""
    c = as_col(c)
    return F.when(c.isin(*MISSING_TOKENS), F.lit(None).cast("string")).otherwise(c)


def nan_to_null(c) -> Column:
    c = as_col(c)
    return F.nanvl(c, F.lit(None).cast("double"))


def parse_double(c) -> Column:
    """String -> double; unparseable, missing tokens and NaN -> NULL."""
    c = as_col(c)
    return nan_to_null(F.trim(c.cast("string")).try_cast("double"))


def parse_date(c, fmt: str | None = None) -> Column:
    """String -> date; unparseable -> NULL.  Accepts a leading date part of a
    timestamp string (``2003-01-01 00:00:00``)."""
    c = F.trim(as_col(c).cast("string"))
    if fmt:
        return F.try_to_date(c, F.lit(fmt))
    return F.coalesce(F.try_to_date(c), F.to_date(F.try_to_timestamp(c)))
