"""Stage 3: master -> feature table.

All per-district series features use one window spec
``partitionBy(district).orderBy(year, month)``: Spark plans one exchange and
one sort for all of them.  The history profile is an aggregate joined back
(one more small shuffle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import constants as K
from ..functions import compound_risk_score, region_type
from ..operators import (add_lags, fill_zero, lag_rolling_flag_columns, month_cycle, one_hot,
                         rolling_col, streak, time_trend, with_group_mean)
from ..functions._util import np_round


def build_features(master: DataFrame, profile_key: str = "region", north=K.NORTH_REGIONS,
                   coastal=K.COASTAL_REGIONS, seasons=K.SEASON_PHASES, asof_profile: bool = False,
                   key: str = "district") -> DataFrame:
    df = master
    # rainfall lags 1..3; flag lags filled with 0
    df = add_lags(df, "rainfall_anomaly_pct", [1, 2, 3], key, name="rainfall_anomaly_lag{n}")
    df = add_lags(df, "flood_flag", [1, 2, 3], key, fill=0)
    df = add_lags(df, "drought_flag", [1, 2, 3], key, fill=0)
    df = df.withColumns({
        "rainfall_rolling_3m": np_round(rolling_col("rainfall_mm", 3, "mean", key), 3),
        "rainfall_rolling_6m": np_round(rolling_col("rainfall_mm", 6, "mean", key), 3)})
    df = streak(df, "flood_flag", "flood_streak_months", key)

    if "price_change_pct" in df.columns:
        df = add_lags(df, "price_change_pct", [1, 2], key, name="price_change_lag{n}")
        df = add_lags(df, "price_volatility_3m", [1, 2], key, name="price_volatility_lag{n}")
        pc = F.coalesce(F.col("price_change_pct"), F.lit(0.0))
        df = df.withColumns({
            "flood_price_lag1_interact": np_round(F.col("flood_flag_lag1") * pc, 3),
            "drought_price_interact": np_round(F.col("drought_flag") * pc, 3)})

    if "conflict_events" in df.columns:
        df = add_lags(df, "conflict_events", [1, 2], key, fill=0, name="conflict_lag{n}")
        df = df.withColumn("conflict_rolling_3m", rolling_col("conflict_events", 3, "sum", key))

    df = one_hot(df, "season_phase", seasons, prefix="season")
    df = month_cycle(df)
    df = time_trend(df)

    profile = {"flood_flag": "region_flood_freq_hist"}
    if "conflict_events" in df.columns:
        profile["conflict_events"] = "region_conflict_intensity_hist"
    df = with_group_mean(df, profile_key, profile, asof=asof_profile)
    df = df.withColumn("region_type", region_type("region", north, coastal))
    df = df.withColumn("compound_risk_score", compound_risk_score())
    df = df.drop("season_phase")
    return fill_zero(df, lag_rolling_flag_columns(df))
