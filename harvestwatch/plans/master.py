"""Stage 2: monthly tables -> district x month master table with rule columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import constants as K
from ..functions import (compound_risk_flag, flood_price_interaction, ipc_phase_rule, ipc_score,
                         is_lean_season, season_phase, vulnerability)
from ..operators import join_master, require

MASTER_KEYS = ("rainfall_mm", "region", "district", "year", "month")


def with_rules(df: DataFrame, north=K.NORTH_REGIONS, vulnerable=K.VULNERABLE_REGIONS,
               keep_score: bool = False) -> DataFrame:
    """R1-R6 as one projection (season, lean flag, vulnerability, rule phase,
    interaction, compound flag)."""
    # inputs a source may not deliver default as in the published rule
    defaults = {"price_change_pct": F.lit(None).cast("double"), "price_shock_flag": F.lit(0),
                "conflict_events": F.lit(0).cast("long"), "high_conflict_flag": F.lit(0)}
    missing = {c: v for c, v in defaults.items() if c not in df.columns}
    if missing:
        df = df.withColumns(missing)
    df = df.withColumn("season_phase", season_phase("region", "month", north))
    df = df.withColumns({"is_lean_season": is_lean_season("season_phase"),
                         "district_vulnerability": vulnerability("region", vulnerable)})
    score = ipc_score()
    cols = {"ipc_phase": ipc_phase_rule(score),
            "flood_price_interaction": flood_price_interaction(),
            "compound_risk_flag": compound_risk_flag()}
    if keep_score:
        cols["ipc_score"] = score
    return df.withColumns(cols)


def build_master(rain: DataFrame, prices: DataFrame | None, conflict: DataFrame | None,
                 north=K.NORTH_REGIONS, vulnerable=K.VULNERABLE_REGIONS) -> DataFrame:
    """J1 + R1-R6.  The district rainfall table is the spine; rows without a
    rainfall value or key are dropped (the filter is pushed below the joins)."""
    spine = require(rain, MASTER_KEYS)
    return with_rules(join_master(spine, prices, conflict), north, vulnerable)


def rain_only_master(rain: DataFrame, north=K.NORTH_REGIONS) -> DataFrame:
    """The rows of the master table with rainfall and season: prices and events
    join the spine on unique keys, so they neither add nor drop rows."""
    spine = require(rain, MASTER_KEYS).withColumn("season_phase", season_phase("region", "month", north))
    return spine.withColumn("is_lean_season", is_lean_season("season_phase"))
