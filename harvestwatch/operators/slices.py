"""Slices, projections, selectors and simple column builders
(O1-O7, P8, P15-P25, F2, F14, R10, U2).

Functions marked † run one small aggregate job and decide on the driver from
its single result row (a column list); they never bring table rows back.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions._util import as_col
from ..functions.text import month_short_name
from ..functions._util import np_round

NUMERIC = (T.DoubleType, T.FloatType, T.IntegerType, T.LongType, T.ShortType)


def period_index(year="year", month="month") -> Column:
    return as_col(year) * F.lit(12) + as_col(month) - F.lit(1)


def latest_period(df: DataFrame) -> DataFrame:
    """Rows of the latest (year, month) in the table."""
    idx = df.select(F.max(period_index())).scalar()
    return df.filter((F.col("year") == F.floor(idx / 12)) & (period_index() == idx))


def trailing_months(df: DataFrame, n: int = 12) -> DataFrame:
    """Rows within the last ``n`` months up to the latest period.  The bounds on
    the year alone let a scan of a table partitioned by year skip the other years."""
    idx = df.select(F.max(period_index())).scalar()
    years = F.col("year").between(F.floor((idx - F.lit(n - 1)) / 12), F.floor(idx / 12))
    return df.filter(years & (period_index() > idx - F.lit(n)) & (period_index() <= idx))


def top_k(df: DataFrame, by, k: int, ties=()) -> DataFrame:
    """Top ``k`` rows; ``by`` is a list of Columns (use ``.desc()``),
    ``ties`` unique tie-breaker columns.  Planned as TakeOrderedAndProject:
    each partition keeps k rows, then a k-way merge."""
    return df.orderBy(*by, *[as_col(t) for t in ties]).limit(k)


def sample_rows(df: DataFrame, n: int, keys, seed: int = 42) -> DataFrame:
    """A reproducible sample of ``n`` rows (hash order, independent of the
    partitioning).  The limit is the feature here."""
    h = F.xxhash64(*[as_col(k) for k in keys], F.lit(seed))
    return df.orderBy(h, *[as_col(k) for k in keys]).limit(n)


def filter_positive(df: DataFrame, c: str) -> DataFrame:
    """NULLs and values <= 0 dropped."""
    return df.filter(F.col(c) > 0)


def filter_abs_le(df: DataFrame, c: str, x: float) -> DataFrame:
    """P18."""
    return df.filter(F.abs(F.col(c)) <= F.lit(float(x)))


def filter_panel(df: DataFrame, years=None, region=None, district=None) -> DataFrame:
    """Year range, optional region, optional district (year filters
    prune year-partitioned stage tables)."""
    if years is not None:
        df = df.filter(F.col("year").between(int(years[0]), int(years[1])))
    if region is not None:
        df = df.filter(F.col("region") == region)
    if district is not None:
        df = df.filter(F.col("district") == district)
    return df


def fill_zero(df: DataFrame, cols) -> DataFrame:
    """NULL -> 0 in the listed numeric columns."""
    cols = [c for c in cols if c in df.columns]
    return df.fillna(0, subset=cols) if cols else df


def lag_rolling_flag_columns(df: DataFrame) -> list[str]:
    """The columns the published fill rule reaches: names containing ``lag``
    or ``rolling`` -- which includes every ``*_flag`` column."""
    return [c for c in df.columns if "lag" in c or "rolling" in c]


def col_or(df: DataFrame, name: str, default=0) -> Column:
    """A column if the table has it, else a literal."""
    return F.col(name) if name in df.columns else F.lit(default)


def one_hot(df: DataFrame, c: str, values, prefix: str | None = None) -> DataFrame:
    """Boolean indicator per listed value (NULL -> all false)."""
    prefix = prefix if prefix is not None else c
    return df.withColumns({f"{prefix}_{v}": F.coalesce(F.col(c) == F.lit(v), F.lit(False))
                           for v in values})


def month_cycle(df: DataFrame, month: str = "month", digits: int = 4) -> DataFrame:
    """cyclical month encoding."""
    ang = F.lit(2 * math.pi) * F.col(month) / F.lit(12.0)
    return df.withColumns({"month_sin": np_round(F.sin(ang), digits),
                           "month_cos": np_round(F.cos(ang), digits)})


def time_trend(df: DataFrame, out: str = "time_trend") -> DataFrame:
    """Months since the first year of the table."""
    y0 = df.select(F.min("year")).scalar()
    return df.withColumn(out, ((F.col("year") - y0) * F.lit(12) + F.col("month")).cast("int"))


def select_features(df: DataFrame, exclude=()) -> list[str]:
    """P20 †: numeric columns (booleans fall out) not excluded and with more
    than one distinct value.  "More than one distinct non-NULL value" is
    ``min < max``, so one cheap min/max aggregate decides it exactly."""
    cand = [f.name for f in df.schema if isinstance(f.dataType, NUMERIC) and f.name not in set(exclude)]
    if not cand:
        return []
    row = df.agg(*[(F.min(c) < F.max(c)).alias(f"v{i}") for i, c in enumerate(cand)]).first()
    return [c for i, c in enumerate(cand) if row[f"v{i}"]]


def select_covered(df: DataFrame, cols, min_ratio: float = 0.5) -> list[str]:
    """P21 †: columns whose non-NULL share is above ``min_ratio``."""
    cols = list(cols)
    if not cols:
        return []
    row = df.agg(*[F.avg(F.col(c).isNotNull().cast("double")).alias(f"r{i}") for i, c in enumerate(cols)]).first()
    return [c for i, c in enumerate(cols) if (row[f"r{i}"] or 0.0) > min_ratio]


def select_by_keyword(cols, keywords) -> list[str]:
    """Names containing any keyword (driver-side, schema only)."""
    return [c for c in cols if any(k in c for k in keywords)]


def first_viable(df: DataFrame, cols, min_count: int) -> str | None:
    """P23 †: first candidate present with more than ``min_count`` non-NULLs."""
    present = [c for c in cols if c in df.columns]
    if not present:
        return None
    row = df.agg(*[F.count(F.col(c)).alias(f"n{i}") for i, c in enumerate(present)]).first()
    return next((c for i, c in enumerate(present) if row[f"n{i}"] > min_count), None)


def display_projection(df: DataFrame) -> DataFrame:
    """Top-risk table as shown to a reader (month name, warning glyph,
    readable headers)."""
    return df.select(
        F.col("year").alias("Year"), month_short_name("month").alias("Month"),
        F.col("pred_ipc_phase").alias("IPC Phase"), F.col("pred_ipc_label").alias("IPC Label"),
        F.col("rainfall_anomaly_pct").alias("Rain Anomaly (%)"),
        F.col("pred_price_direction").alias("Price Direction"),
        F.col("compound_risk_score").alias("Risk Score"),
        F.when(F.col("is_anomaly") == 1, F.lit("⚠️")).otherwise(F.lit("")).alias("Anomaly"))


# P25: the three alert projections
FEED_COLUMNS = ("district", "region", "year", "month", "pred_ipc_phase", "pred_ipc_label",
                "pred_ipc_confidence", "pred_ipc_action", "pred_price_change",
                "pred_price_direction", "is_anomaly", "anomaly_score",
                "rainfall_anomaly_pct", "flood_flag", "conflict_events", "compound_risk_score")
SNAPSHOT_COLUMNS = ("district", "region", "pred_ipc_phase", "pred_ipc_label",
                    "pred_ipc_confidence", "pred_ipc_action", "pred_price_change",
                    "pred_price_direction", "is_anomaly", "anomaly_score",
                    "rainfall_anomaly_pct", "flood_flag", "compound_risk_score")
DOWNLOAD_COLUMNS = ("district", "region", "pred_ipc_phase", "pred_ipc_label",
                    "pred_ipc_confidence", "pred_ipc_action", "pred_price_direction",
                    "is_anomaly", "compound_risk_score")
