"""Column-level functions (no actions, all JVM-side expressions)."""

from .parse import parse_date, parse_double, normalise_missing, nan_to_null
from .text import (
    matches_any, commodity_family, flag_pattern, period_label, month_short_name,
    month_year_title, fractional_year, text_bar, fixed, signed_pct, std_region,
)
from .flags import flag_gt, flag_lt, flag_ge, flag_in, clip, null_safe_true
from .rules import (
    season_phase, is_lean_season, vulnerability, ipc_score, ipc_phase_rule,
    flood_price_interaction, compound_risk_flag, region_type, compound_risk_score,
    price_direction, weather_message, price_message, phase_label, phase_action,
    phase_icon, risk_tier, is_unusual, is_stressed,
)

__all__ = [n for n in dir() if not n.startswith("_")]
