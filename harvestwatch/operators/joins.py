"""Joins (J1, J3, J4) and the table form of the region standardiser (P5).

No join here carries a broadcast hint: the right sides are aggregates whose
size is only known at runtime, so AQE measures the shuffle output and turns
the join into a broadcast hash join when it is under
``spark.sql.adaptive.autoBroadcastJoinThreshold``; above it the join stays a
sort-merge join, and AQE's skew-join splits a hot key's partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import constants as K
from ..functions.rules import phase_action, phase_icon, phase_label

CONFLICT_FILL = ("conflict_events", "fatalities_total", "flood_displace_events",
                 "conflict_events_lag1", "flood_displace_lag1", "high_conflict_flag")


def join_master(spine: DataFrame, prices: DataFrame | None, conflict: DataFrame | None,
                keys=("region", "year", "month"), fill_zero=CONFLICT_FILL) -> DataFrame:
    """Left-join region-level tables onto the district x month spine.

    Each right side is unique on ``keys`` (it is an aggregate on them), so the
    spine's row count is preserved; region values fan out to every district.
    Conflict columns are 0 where a region-month had no events.
    """
    keys = list(keys)
    out = spine
    for right in (prices, conflict):
        if right is not None:
            out = out.join(right, on=keys, how="left")
    present = [c for c in fill_zero if c in out.columns]
    return out.fillna(0, subset=present) if present else out


def with_labels(df: DataFrame, phase: str = "pred_ipc_phase", prefix: str = "pred_ipc",
                action_style: str = "short", icon: bool = False) -> DataFrame:
    """Phase -> label, action (and icon) from the fixed lookup tables."""
    cols = {f"{prefix}_label": phase_label(phase),
            f"{prefix}_action": phase_action(phase, action_style)}
    if icon:
        cols[f"{prefix}_icon"] = phase_icon(phase)
    return df.withColumns(cols)


def panel_spine(entities: DataFrame, start, end, step: str = "1 month",
                date_col: str = "date") -> DataFrame:
    """Every entity x every period from ``start`` to ``end`` inclusive.

    Each entity row generates its own period sequence (a generator, not a
    cross join); ``start``/``end`` may be literals or Columns such as scalar
    subqueries of a table's date range.
    """
    s = start if isinstance(start, Column) else F.to_date(F.lit(start))
    e = end if isinstance(end, Column) else F.to_date(F.lit(end))
    return entities.select("*", F.explode(F.sequence(s, e, F.expr(f"INTERVAL {step}"))).alias(date_col))


def std_region_table(df: DataFrame, c: str, aliases: DataFrame, alias_col: str = "alias",
                     canonical_col: str = "canonical", out: str = "region",
                     unknown: str = K.UNKNOWN_REGION) -> DataFrame:
    """P5 with the alias map as a table (when it is too large or changes too
    often to live in code): left join on the trimmed name."""
    a = aliases.select(F.col(alias_col).alias("__hw_alias"), F.col(canonical_col).alias("__hw_canon"))
    t = df.withColumn("__hw_key", F.trim(F.col(c)))
    joined = t.join(a, t["__hw_key"] == a["__hw_alias"], "left")
    return (joined.withColumn(out, F.coalesce(F.col("__hw_canon"), F.col("__hw_key"), F.lit(unknown)))
            .drop("__hw_key", "__hw_alias", "__hw_canon"))
