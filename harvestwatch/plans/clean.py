"""Stage 1: raw tables -> monthly tables.

Each function takes a raw DataFrame (strings or typed) and returns the
monthly table lazily.  Filters sit before the aggregates so Catalyst pushes
them into the scan; the only shuffles are the monthly aggregates (partial
aggregation first) and, for the region-level tables, one window exchange on
the already-tiny monthly rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pyspark.sql import types as T

from .. import constants as K
from ..functions import (commodity_family, flag_gt, flag_lt, flag_pattern, matches_any,
                         parse_date, parse_double, std_region)
from ..operators import (add_lags, anomaly_vs_mean, filter_positive, monthly_events, monthly_mean, pct_change_col,
                         pivot_mean, quantile_flag, require, rolling_col, with_year_month,
                         panel_window)
from ..functions._util import np_round


def _num(df: DataFrame, c: str):
    """Typed numeric columns pass through; text is parsed (bad -> NULL)."""
    dt = df.schema[c].dataType
    if isinstance(dt, T.StringType):
        return parse_double(c)
    return F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))


def _date(df: DataFrame, c: str):
    dt = df.schema[c].dataType
    if isinstance(dt, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.to_date(F.col(c))
    return parse_date(c)


def clean_rainfall(raw: DataFrame, measures: dict | None = None, region_map: dict | None = None,
                   flood_gt: float = K.FLOOD_ANOMALY_GT, drought_lt: float = K.DROUGHT_ANOMALY_LT,
                   anomaly: str = "rainfall_anomaly_pct", anomaly_from: str | None = None,
                   digits: int = 3) -> DataFrame:
    """Dekadal district rainfall -> district x month means + flood/drought flags.

    ``anomaly_from`` derives the anomaly column as the percent deviation of a
    monthly column from the district's mean over all months (for sources
    that deliver no anomaly measure).
    """
    measures = K.RAIN_MEASURES if measures is None else measures
    df = raw.select(
        _date(raw, "date").alias("date"),
        std_region("adm1_name", region_map).alias("region"),
        F.trim(F.col("adm2_name")).alias("district"),
        *[_num(raw, c).alias(c) for c in measures])
    df = with_year_month(require(df, ["date"]))
    monthly = monthly_mean(df, ["region", "district", "year", "month"], measures, digits)
    if anomaly_from is not None:
        monthly = anomaly_vs_mean(monthly, anomaly_from, anomaly, key="district", digits=digits)
    return monthly.withColumns({"flood_flag": flag_gt(anomaly, flood_gt),
                                "drought_flag": flag_lt(anomaly, drought_lt)})


def clean_prices(raw: DataFrame, region_map: dict | None = None, keywords=K.COMMODITY_KEYWORDS,
                 families=K.COMMODITY_FAMILIES, price_col: str | None = "price_maize",
                 shock_gt: float = K.PRICE_SHOCK_GT, cut=None) -> DataFrame:
    """Market prices -> region x month price table (one column per family),
    month-on-month change, 3-month volatility and a shock flag.

    ``price_col`` names the family series the change is computed from; pass
    ``None`` to pick the first family with more than 50 observations (†).
    ``cut`` materialises the wide monthly table first, so that decision and
    the windows read it instead of the raw quotes.
    """
    df = raw.select(
        _date(raw, "date").alias("date"),
        std_region("admin1", region_map).alias("region"),
        _num(raw, "price").alias("price"),
        F.trim(F.col("commodity")).alias("commodity_clean"))
    df = with_year_month(require(df, ["date"]))
    df = filter_positive(df, "price").filter(matches_any("commodity_clean", keywords))
    # A2: mean per raw commodity name, then the family pivot (A3) averages
    # names of one family into one column.
    per_name = monthly_mean(df, ["region", "year", "month", "commodity_clean"], {"price": "price"}, 4)
    per_name = per_name.withColumn("family", commodity_family("commodity_clean", families))
    wide = pivot_mean(per_name, ["region", "year", "month"], "family", "price",
                      [name for _, name in families])
    if cut is not None:
        wide = cut(wide)
    if price_col is None:
        from ..operators import first_viable
        price_col = first_viable(wide, K.PRICE_COLUMN_CANDIDATES, 50)
    if price_col is None:
        return wide.withColumns({"price_lag1": F.lit(None).cast("double"),
                                 "price_change_pct": F.lit(None).cast("double"),
                                 "price_volatility_3m": F.lit(None).cast("double"),
                                 "price_shock_flag": F.lit(0)})
    w = panel_window("region")
    wide = wide.withColumn("price_lag1", F.lag(price_col, 1).over(w))
    wide = wide.withColumn("price_change_pct", np_round(pct_change_col(price_col, "price_lag1"), 2))
    wide = wide.withColumn("price_volatility_3m", np_round(rolling_col("price_change_pct", 3, "std", "region"), 3))
    return wide.withColumn("price_shock_flag", flag_gt("price_change_pct", shock_gt))


def monthly_events_stage_from_raw(raw: DataFrame, region_map: dict | None = None,
                                  pattern: str = K.FLOOD_EVENT_PATTERN) -> DataFrame:
    """Events -> region x month counts (the raw-reading part of the conflict stage)."""
    df = raw.select(
        F.col("event_id_cnty"),
        _date(raw, "event_date").alias("date"),
        std_region("admin1", region_map).alias("region"),
        F.coalesce(_num(raw, "fatalities"), F.lit(0.0)).alias("fatalities"),
        flag_pattern("event_type", pattern).alias("is_flood_event"))
    df = with_year_month(require(df, ["date"]))
    return monthly_events(df, ["region", "year", "month"])


def clean_conflict_from_monthly(monthly: DataFrame, q: float = K.HIGH_CONFLICT_QUANTILE,
                                calendar: bool = False) -> DataFrame:
    """Lags over the months that had events (``calendar=True``: over calendar
    months, a month without events counting as 0), and the high-conflict flag
    against the exact q-quantile of all region-months (a scalar subquery; its
    value->count buffer is bounded by the distinct event counts)."""
    monthly = add_lags(monthly, "conflict_events", [1], key="region", fill=0, name="conflict_events_lag1",
                       calendar=calendar)
    monthly = add_lags(monthly, "flood_displace_events", [1], key="region", fill=0, name="flood_displace_lag1",
                       calendar=calendar)
    return quantile_flag(monthly, "conflict_events", q, "high_conflict_flag")


def clean_conflict(raw: DataFrame, region_map: dict | None = None,
                   pattern: str = K.FLOOD_EVENT_PATTERN, q: float = K.HIGH_CONFLICT_QUANTILE,
                   cut=None, calendar: bool = False) -> DataFrame:
    """Events -> region x month counts, lags (over months that had events) and
    a high-conflict flag against the q-quantile of all region-months.

    ``cut`` (e.g. ``session.cut_lineage``) materialises the monthly counts
    before the quantile, so the quantile's scalar subquery reads the small
    monthly table instead of scanning the events again."""
    monthly = monthly_events_stage_from_raw(raw, region_map, pattern)
    if cut is not None:
        monthly = cut(monthly)
    return clean_conflict_from_monthly(monthly, q, calendar)
