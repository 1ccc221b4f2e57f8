"""Panel window operators.

The panel is unique on (entity, year, month), so a window partition holds at
most one row per period: partitions are bounded by the length of the time
axis, never by how many raw rows an entity had.  All per-entity series
features share one ``Window.partitionBy(key).orderBy(year, month)`` -- one
exchange and one sort for all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions._util import as_col
from ..functions._util import np_round

ORDER = ("year", "month")


def panel_window(key="district", order=ORDER):
    keys = [key] if isinstance(key, str) else list(key)
    return Window.partitionBy(*keys).orderBy(*order)


def _period_window(key):
    """Entity window ordered by the month index (for calendar RANGE frames)."""
    keys = [key] if isinstance(key, str) else list(key)
    return Window.partitionBy(*keys).orderBy(F.col("year") * F.lit(12) + F.col("month"))


def calendar_lag_col(c: str, n: int, key="district") -> Column:
    """The value exactly ``n`` calendar months earlier (NULL when that month
    has no row): a one-row RANGE frame on the month index, so sparse panels
    need no densified spine."""
    return F.first(F.col(c)).over(_period_window(key).rangeBetween(-n, -n))


def add_lags(df: DataFrame, c: str, lags=(1,), key="district", fill=None,
             name: str | None = None, order=ORDER, calendar: bool = False) -> DataFrame:
    """Previous-row values.  ``fill`` replaces NULL afterwards, so a NULL
    source value is filled too (unlike ``lag``'s default argument).
    ``calendar=True`` lags by calendar months instead of rows (a month with
    no row gives NULL rather than reaching back to an older row)."""
    w = panel_window(key, order)
    name = name or (c + "_lag{n}")
    cols = {}
    for n in lags:
        v = calendar_lag_col(c, n, key) if calendar else F.lag(F.col(c), n).over(w)
        if fill is not None:
            v = F.coalesce(v, F.lit(fill))
        cols[name.format(n=n)] = v
    return df.withColumns(cols)


def add_lead(df: DataFrame, c: str, out: str, key="district", n: int = 1, order=ORDER) -> DataFrame:
    """Next-row value (forward target)."""
    return df.withColumn(out, F.lead(F.col(c), n).over(panel_window(key, order)))


def pct_change_col(c, prev) -> Column:
    """W3 core: (x - prev) / prev * 100; a zero or NULL base gives NULL."""
    c, prev = as_col(c), as_col(prev)
    return F.try_divide(c - prev, prev) * F.lit(100.0)


def pct_change(df: DataFrame, c: str, out: str, key="district", digits: int | None = 2,
               order=ORDER) -> DataFrame:
    """Percent change from the previous row of the same entity."""
    v = pct_change_col(c, F.lag(F.col(c), 1).over(panel_window(key, order)))
    return df.withColumn(out, np_round(v, digits) if digits is not None else v)


_ROLL = {"mean": F.avg, "sum": F.sum, "std": F.stddev_samp, "max": F.max, "min": F.min}


def rolling_col(c: str, n: int, fn: str = "mean", key="district", order=ORDER,
                calendar: bool = False) -> Column:
    """Aggregate over the current and ``n-1`` previous rows.  NULLs are
    skipped; an all-NULL frame gives NULL (min_periods=1 semantics).
    ``calendar=True`` uses the current and ``n-1`` previous calendar months."""
    if calendar:
        w = _period_window(key).rangeBetween(-(n - 1), 0)
        return _ROLL[fn](F.col(c)).over(w)
    w = panel_window(key, order).rowsBetween(-(n - 1), Window.currentRow)
    return _ROLL[fn](F.col(c)).over(w)


def rolling(df: DataFrame, c: str, n: int, fn: str = "mean", out: str | None = None,
            key="district", digits: int | None = None, order=ORDER) -> DataFrame:
    v = rolling_col(c, n, fn, key, order)
    return df.withColumn(out or f"{c}_rolling_{n}", np_round(v, digits) if digits is not None else v)


def streak(df: DataFrame, flag: str, out: str, key="district", order=ORDER) -> DataFrame:
    """Length of the current run of 1s (anything else, NULL included,
    resets to 0): row index minus the index of the last non-1 row so far.
    Both windows share one partitioning and ordering: one sort."""
    w = panel_window(key, order)
    tmp = "__hw_idx"
    df = df.withColumn(tmp, F.row_number().over(w))
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    is_one = F.coalesce(F.col(flag) == 1, F.lit(False))
    last_reset = F.max(F.when(~is_one, F.col(tmp))).over(run)
    v = F.when(is_one, F.col(tmp) - F.coalesce(last_reset, F.lit(0))).otherwise(F.lit(0)).cast("long")
    return df.withColumn(out, v).drop(tmp)


def with_group_mean(df: DataFrame, key, cols: dict, asof: bool = False, order=ORDER) -> DataFrame:
    """Per-key mean of each column, joined back to every row.

    Full-history form: a hash aggregate (partial before the shuffle, so a hot
    key is cheap) joined back on the key; the aggregate has one row per key
    and AQE broadcasts it when its measured size is under the broadcast
    threshold, otherwise it stays a shuffle join (skew-split by AQE).
    ``asof=True`` uses only strictly earlier periods (no look-ahead): totals per key and
    period, added up over the earlier periods of the key (one row per period, so a
    key with many rows a month is no large window) and joined back.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if asof:
        earlier = Window.partitionBy(*keys).orderBy("__p").rangeBetween(Window.unboundedPreceding, -1)
        periods = df.groupBy(*keys, *order).agg(
            *[f(c).alias(f"__{n}_{out}") for c, out in cols.items() for n, f in (("s", F.sum), ("n", F.count))])
        periods = periods.withColumn("__p", F.col("year") * 12 + F.col("month"))
        means = periods.select(*keys, *order, *[
            F.try_divide(F.sum(f"__s_{out}").over(earlier).cast("double"), F.sum(f"__n_{out}").over(earlier).cast("double")).alias(out)
            for out in cols.values()])
        return df.join(means, on=[*keys, *order], how="left")
    means = df.groupBy(*keys).agg(*[F.avg(F.col(c)).alias(out) for c, out in cols.items()])
    return df.join(means, on=keys, how="left")


def anomaly_vs_mean(df: DataFrame, c: str, out: str, key="district", digits: int | None = 3) -> DataFrame:
    """Percent deviation of ``c`` from the entity's mean over all periods.

    The input is a panel (one row per entity and period), so the window
    partition of an entity holds at most one row per period; a window avoids
    re-reading the input for a separate aggregate + join."""
    keys = [key] if isinstance(key, str) else list(key)
    mean = F.avg(F.col(c)).over(Window.partitionBy(*keys))
    v = (F.try_divide(F.col(c), mean) - F.lit(1.0)) * F.lit(100.0)
    return df.withColumn(out, np_round(v, digits) if digits is not None else v)


def latest_row(df: DataFrame, key, order=ORDER, cols=None) -> DataFrame:
    """The latest row per entity, as an aggregate (``max_by``), so it is
    computed with partial aggregation instead of a sorted window."""
    keys = [key] if isinstance(key, str) else list(key)
    cols = cols or [c for c in df.columns if c not in keys]
    latest = F.max_by(F.struct(*[F.col(c) for c in cols]), F.struct(*[F.col(o) for o in order]))
    return df.groupBy(*keys).agg(latest.alias("__hw_last")).select(*keys, "__hw_last.*")
