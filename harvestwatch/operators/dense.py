"""J4 on a panel: the missing months as rows, and their values filled.

An entity's months are generated from its own first to last period (or given ends) by
a sequence per entity, so nothing is crossed, and joined to the panel on its unique
key.  Filling is a window over one entity's months; forward and backward looks share
one partitioning, so one exchange serves all columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def period_of(year="year", month="month") -> Column:
    """Months since year 0."""
    return F.col(year) * 12 + F.col(month) - 1


def densify(df: DataFrame, key="district", start: Column | None = None, end: Column | None = None) -> DataFrame:
    """Every month of each entity from its first to its last one (or ``start`` to
    ``end``, month indexes); ``known`` is 1 for months that the panel has.  Rows with a
    NULL period are left out; entities are unique on (key, year, month)."""
    keys = _keys(key)
    panel = df.withColumn("__p", period_of()).where(F.col("__p").isNotNull())
    ends = panel.groupBy(*keys).agg(F.min("__p").alias("__lo"), F.max("__p").alias("__hi"))
    lo, hi = (F.col("__lo") if start is None else start), (F.col("__hi") if end is None else end)
    spine = ends.where(lo <= hi).select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
                                        F.explode(F.sequence(lo, hi)).alias("__q"))
    on = [F.col(f"p.{k}").eqNullSafe(F.col(f"s.__k{i}")) for i, k in enumerate(keys)] + [F.col("p.__p") == F.col("s.__q")]
    rest = [c for c in df.columns if c not in (*keys, "year", "month")]
    return spine.alias("s").join(panel.alias("p"), [*on], "left").select(
        *[F.col(f"s.__k{i}").alias(k) for i, k in enumerate(keys)], F.floor(F.col("s.__q") / 12).cast("int").alias("year"),
        (F.col("s.__q") % 12 + 1).cast("int").alias("month"), *[F.col(f"p.`{c}`") for c in rest],
        F.col("p.__p").isNotNull().cast("int").alias("known"))


def carry_forward(df: DataFrame, cols: dict, limit: int, key="district") -> DataFrame:
    """For each ``{column: output}`` the last known value of at most ``limit`` months
    before, on a dense panel."""
    w = Window.partitionBy(*_keys(key)).orderBy("year", "month").rowsBetween(-limit, Window.currentRow)
    return df.withColumns({out: F.last(F.col(c), ignorenulls=True).over(w) for c, out in cols.items()})


def interpolate(df: DataFrame, cols: dict, key="district", max_gap: int | None = None) -> DataFrame:
    """For each ``{column: output}`` the line between the known months around a missing
    one; nothing before the first or after the last known month, nor, with ``max_gap``,
    in a gap of more missing months."""
    forward = Window.partitionBy(*_keys(key)).orderBy("year", "month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    back = Window.partitionBy(*_keys(key)).orderBy(F.col("year").desc(), F.col("month").desc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    made = {}
    for c, out in cols.items():
        at = F.when(F.col(c).isNotNull(), F.struct(period_of().alias("p"), F.col(c).cast("double").alias("v")))
        a, b = F.last(at, ignorenulls=True).over(forward), F.last(at, ignorenulls=True).over(back)
        gap = b["p"] - a["p"]
        line = a["v"] + (b["v"] - a["v"]) * ((period_of() - a["p"]) / gap)
        if max_gap is not None:
            line = F.when(gap - 1 <= max_gap, line)
        made[out] = F.when(F.col(c).isNotNull(), F.col(c).cast("double")).otherwise(line)
    return df.withColumns(made)
