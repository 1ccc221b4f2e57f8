"""Domain rules as native Column expressions.

Every rule is a ``when`` chain or arithmetic, so it stays inside whole-stage
codegen.  Region groups are parameters (defaults: the fixed values).
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import constants as K
from ._util import as_col, lit_map
from .flags import clip
from ._util import np_round

_D = lambda x: F.lit(float(x))  # noqa: E731  double literal (0.3 must not be DECIMAL)


def _calendar(month: Column, seasons) -> Column:
    out = None
    for months, name in seasons:
        cond = month.isin(*months)
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out.otherwise(F.lit(K.LEAN))


def season_phase(region="region", month="month", north=K.NORTH_REGIONS,
                 north_seasons=K.NORTH_SEASONS, south_seasons=K.SOUTH_SEASONS) -> Column:
    r, m = as_col(region), as_col(month)
    return (F.when(F.coalesce(r.isin(*north), F.lit(False)), _calendar(m, north_seasons))
            .otherwise(_calendar(m, south_seasons)))


def is_lean_season(phase="season_phase", lean_phases=K.LEAN_PHASES) -> Column:
    return F.coalesce(as_col(phase).isin(*lean_phases), F.lit(False)).cast("int")


def vulnerability(region="region", vulnerable=K.VULNERABLE_REGIONS) -> Column:
    return F.when(F.coalesce(as_col(region).isin(*vulnerable), F.lit(False)), F.lit(2)).otherwise(F.lit(1))


def ipc_score(rain="rainfall_anomaly_pct", flood="flood_flag", drought="drought_flag",
              price_change="price_change_pct", conflict="conflict_events",
              lean="is_lean_season", vuln="district_vulnerability") -> Column:
    """Additive risk score, terms added left to right as in the published rule."""
    rain = F.coalesce(as_col(rain), _D(0))
    pc = F.coalesce(as_col(price_change), _D(0))
    rain_pts = (F.when(rain < -40, F.lit(2)).when(rain < -20, F.lit(1))
                .when(rain > 60, F.lit(1)).otherwise(F.lit(0)))
    price_pts = (F.when(pc > 30, F.lit(3)).when(pc > 15, F.lit(2))
                 .when(pc > 5, F.lit(1)).otherwise(F.lit(0)))
    conflict_pts = F.least(F.coalesce(as_col(conflict), F.lit(0)).cast("double"), _D(10)) * _D(0.3)
    score = _D(0) + rain_pts
    score = score + F.coalesce(as_col(flood), F.lit(0)) * F.lit(2)
    score = score + F.coalesce(as_col(drought), F.lit(0))
    score = score + price_pts
    score = score + conflict_pts
    score = score + F.coalesce(as_col(lean), F.lit(0))
    score = score + (F.coalesce(as_col(vuln), F.lit(1)) - F.lit(1))
    return score


def ipc_phase_rule(score: Column | None = None, **kw) -> Column:
    s = ipc_score(**kw) if score is None else score
    return (F.when(s <= 1, F.lit(1)).when(s <= 3, F.lit(2))
            .when(s <= 6, F.lit(3)).otherwise(F.lit(4)))


def flood_price_interaction(flood="flood_flag", price_change="price_change_pct", digits=3) -> Column:
    return np_round(as_col(flood) * F.coalesce(as_col(price_change), _D(0)), digits)


def compound_risk_flag(flood="flood_flag", shock="price_shock_flag", high="high_conflict_flag") -> Column:
    cond = ((F.coalesce(as_col(flood), F.lit(0)) == 1)
            & (F.coalesce(as_col(shock), F.lit(0)) == 1)
            & (F.coalesce(as_col(high), F.lit(0)) == 1))
    return cond.cast("int")


def region_type(region="region", north=K.NORTH_REGIONS, coastal=K.COASTAL_REGIONS) -> Column:
    r = as_col(region)
    return (F.when(F.coalesce(r.isin(*north), F.lit(False)), F.lit(0))
            .when(F.coalesce(r.isin(*coastal), F.lit(False)), F.lit(2)).otherwise(F.lit(1)))


def compound_risk_score(rain="rainfall_anomaly_pct", flood="flood_flag",
                        price_change="price_change_pct", conflict="conflict_events",
                        lean="is_lean_season", digits=3) -> Column:
    s = F.abs(clip(rain, -100, 100)) * _D(0.01)
    s = s + as_col(flood) * _D(2.0)
    s = s + clip(F.coalesce(as_col(price_change), _D(0)), 0, 100) * _D(0.05)
    s = s + F.coalesce(as_col(conflict), F.lit(0)) * _D(0.1)
    s = s + as_col(lean) * _D(1.0)
    return np_round(s, digits)


def price_direction(c, rising_gt=K.DIRECTION_RISING_GT, falling_lt=K.DIRECTION_FALLING_LT) -> Column:
    c = as_col(c)
    return (F.when(c > _D(rising_gt), F.lit(K.RISING))
            .when(c < _D(falling_lt), F.lit(K.FALLING)).otherwise(F.lit(K.STABLE)))


def weather_message(rain="rainfall_anomaly_pct", flood="flood_flag", style: str = "bulletin") -> Column:
    msgs = K.WEATHER_MESSAGES[style]
    r = as_col(rain)
    if style == "bulletin":
        return (F.when(r < -20, F.lit(msgs["dry"])).when(r > 50, F.lit(msgs["wet"]))
                .otherwise(F.lit(msgs["other"])))
    return (F.when(F.coalesce(as_col(flood), F.lit(0)) == 1, F.lit(msgs["wet"]))
            .when(r < -30, F.lit(msgs["dry"])).otherwise(F.lit(msgs["other"])))


def price_message(direction="pred_price_direction", style: str = "bulletin") -> Column:
    msgs = K.PRICE_MESSAGES[style]
    d = F.coalesce(as_col(direction).cast("string"), F.lit(""))
    out = F.when(d.contains("Rising"), F.lit(msgs["rising"]))
    if msgs["falling"] is not None:
        out = out.when(d.contains("Falling"), F.lit(msgs["falling"]))
    return out.otherwise(F.lit(msgs["other"]))


def phase_label(phase="pred_ipc_phase") -> Column:
    return lit_map(K.PHASE_LABELS)[as_col(phase)]


def phase_action(phase="pred_ipc_phase", style: str = "short") -> Column:
    table = K.PHASE_ACTIONS_SHORT if style == "short" else K.PHASE_ACTIONS_LONG
    return lit_map(table)[as_col(phase)]


def phase_icon(phase="pred_ipc_phase") -> Column:
    return F.coalesce(lit_map(K.PHASE_ICONS)[as_col(phase)], F.lit(K.DEFAULT_ICON))


def risk_tier(phase="pred_ipc_phase", anomaly="is_anomaly") -> Column:
    """crisis (phase >= 3), unusual (< 3 and anomalous), stressed (= 2), else minimal."""
    p, a = as_col(phase), F.coalesce(as_col(anomaly), F.lit(0))
    return (F.when(p >= 3, F.lit("crisis")).when(a == 1, F.lit("unusual"))
            .when(p == 2, F.lit("stressed")).otherwise(F.lit("minimal")))


def is_unusual(phase="pred_ipc_phase", anomaly="is_anomaly") -> Column:
    """Below crisis and anomalous; may hold together with ``is_stressed``."""
    return F.coalesce((as_col(phase) < 3) & (as_col(anomaly) == 1), F.lit(False))


def is_stressed(phase="pred_ipc_phase") -> Column:
    """Phase 2, anomalous or not."""
    return F.coalesce(as_col(phase) == 2, F.lit(False))
