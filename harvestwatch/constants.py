"""Fixed domain values.

FIXED VALUES — these must equal the published pipeline's values for results
to match: region aliases, region groups, season calendars, phase labels and
actions, message texts, thresholds.  They are stated here once, in natural
order, and every operator takes them as overridable parameters.
"""

from __future__ import annotations

# --- FIXED VALUES: region aliases (raw admin-1 name -> standard region) -----
REGION_ALIASES: dict[str, str] = {
    "Greater Accra": "Greater Accra",
    "Ashanti": "Ashanti",
    "Northern": "Northern",
    "Upper East": "Upper East",
    "Upper West": "Upper West",
    "Volta": "Volta",
    "Eastern": "Eastern",
    "Central": "Central",
    "Western": "Western",
    "Brong-Ahafo": "Bono",
    "Brong Ahafo": "Bono",
    "Bono": "Bono",
    "Bono East": "Bono East",
    "Ahafo": "Ahafo",
    "Savannah": "Savannah",
    "Oti": "Oti",
    "North East": "North East",
    "Western North": "Western North",
    "Accra": "Greater Accra",
    "Kumasi": "Ashanti",
    "Tamale": "Northern",
    "Bolgatanga": "Upper East",
    "Wa": "Upper West",
    "Ho": "Volta",
    "Koforidua": "Eastern",
    "Cape Coast": "Central",
    "Sekondi-Takoradi": "Western",
    "Sunyani": "Bono",
}
UNKNOWN_REGION = "Unknown"

# --- FIXED VALUES: region groups ---------------------------------------------
NORTH_REGIONS = ("Northern", "Upper East", "Upper West", "Savannah", "North East")
VULNERABLE_REGIONS = ("Northern", "Upper East", "Upper West", "Savannah", "North East", "Oti")
COASTAL_REGIONS = ("Greater Accra", "Central", "Western")

# --- FIXED VALUES: season calendars (month -> phase) -------------------------
# unimodal calendar (north); months not listed are "lean"
NORTH_SEASONS = (
    ((3, 4, 5), "pre_planting"),
    ((6, 7), "planting"),
    ((8, 9), "growing"),
    ((10, 11), "harvest"),
)
# bimodal calendar (everywhere else); months not listed are "lean"
SOUTH_SEASONS = (
    ((3, 4), "planting_s1"),
    ((5, 6), "growing_s1"),
    ((7,), "harvest_s1"),
    ((8,), "inter_season"),
    ((9, 10), "growing_s2"),
    ((11,), "harvest_s2"),
)
LEAN = "lean"
LEAN_PHASES = ("lean", "pre_planting")
# every phase value, sorted (the one-hot column order)
SEASON_PHASES = (
    "growing", "growing_s1", "growing_s2", "harvest", "harvest_s1", "harvest_s2",
    "inter_season", "lean", "planting", "planting_s1", "pre_planting",
)

# --- FIXED VALUES: commodity families (keyword -> price column), first match wins
COMMODITY_FAMILIES = (
    ("maize", "price_maize"),
    ("millet", "price_millet"),
    ("sorghum", "price_sorghum"),
    ("rice", "price_rice"),
    ("cowpea", "price_cowpeas"),
    ("groundnut", "price_groundnuts"),
)
# the commodity keep-filter keywords
COMMODITY_KEYWORDS = ("Maize", "Millet", "Sorghum", "Rice", "Cowpeas", "Groundnuts")
PRICE_COLUMN_CANDIDATES = ("price_maize", "price_millet", "price_sorghum")

# --- FIXED VALUES: raw rainfall measures -> monthly column names -------------
RAIN_MEASURES = {
    "rfh": "rainfall_mm",
    "rfh_avg": "rainfall_avg_mm",
    "rfq": "rainfall_anomaly_pct",
    "r1h": "rainfall_1m_mm",
    "r1h_avg": "rainfall_1m_avg_mm",
    "r1q": "rainfall_1m_anomaly_pct",
    "r3h": "rainfall_3m_mm",
    "r3h_avg": "rainfall_3m_avg_mm",
    "r3q": "rainfall_3m_anomaly_pct",
}

# --- FIXED VALUES: thresholds -------------------------------------------------
FLOOD_ANOMALY_GT = 50.0
DROUGHT_ANOMALY_LT = -40.0
PRICE_SHOCK_GT = 20.0
HIGH_CONFLICT_QUANTILE = 0.75
FLOOD_EVENT_PATTERN = "flood|displacement|displaced"
DIRECTION_RISING_GT = 5.0
DIRECTION_FALLING_LT = -5.0

# --- FIXED VALUES: phase labels, actions, icons --------------------------------
PHASE_LABELS = {1: "Minimal", 2: "Stressed", 3: "Crisis", 4: "Emergency"}
PHASE_ACTIONS_LONG = {
    1: "No action needed — continue monitoring",
    2: "Alert field teams — pre-position supplies",
    3: "Deploy food stocks and vouchers immediately",
    4: "EMERGENCY — deploy cash transfers NOW",
}
PHASE_ACTIONS_SHORT = {
    1: "Monitor",
    2: "Alert field teams — pre-position supplies",
    3: "Deploy food stocks and vouchers",
    4: "EMERGENCY — cash transfers NOW",
}
PHASE_ICONS = {1: "🟢", 2: "🟡", 3: "🟠", 4: "🔴"}
DEFAULT_ICON = "⚪"

# --- FIXED VALUES: price directions ------------------------------------------
RISING = "↑ Rising"
FALLING = "↓ Falling"
STABLE = "→ Stable"

# --- FIXED VALUES: farmer messages by style ----------------------------------
WEATHER_MESSAGES = {
    "bulletin": {
        "dry": "Rainfall is much lower than normal this period.",
        "wet": "Heavy rainfall and flood risk detected.",
        "other": "Weather conditions are unstable.",
    },
    "notebook": {
        "wet": "Heavy flooding detected.",
        "dry": "Severe dry spell.",
        "other": "Unstable weather conditions.",
    },
    "dashboard": {
        "wet": "Heavy flooding has been detected in your area this season.",
        "dry": "There is a severe dry spell in your area. Crops are under stress.",
        "other": "Weather conditions are unstable and unpredictable this season.",
    },
}
PRICE_MESSAGES = {
    "bulletin": {
        "rising": "Food prices are expected to rise. Consider selling now or storing until the lean season.",
        "falling": "Food prices may fall. This may be a good time to buy and stock food.",
        "other": "Food prices are relatively stable.",
    },
    "notebook": {
        "rising": "Food prices are rising — store food now or buy in advance.",
        "falling": None,
        "other": "Food prices are currently stable.",
    },
    "dashboard": {
        "rising": "Food prices are rising sharply. Buy or store food now before prices go higher.",
        "falling": "Food prices are expected to fall. This may be a good time to buy in bulk.",
        "other": "Food prices are currently stable in your local market.",
    },
}
NOTEBOOK_MESSAGE_SUFFIX = "Contact your district food officer."

# --- FIXED VALUES: bulletin texts --------------------------------------------
BULLETIN_ANOMALY_LINE = "     ⚠️  ANOMALY FLAG: Unusual compound risk pattern detected"
BULLETIN_VOICE_HEADER = "     📢 FARMER VOICE ALERT (Twi/Dagbani/Ewe/Hausa):"
BULLETIN_BROADCAST_NOTE = "     [Translate & broadcast via Africa's Talking SMS gateway]"
BULLETIN_NONE = "  ✅ No high-risk periods detected in recent 12 months."
BULLETIN_FLAGGED = "  ⚠️  {n} DISTRICT-MONTHS FLAGGED FOR ATTENTION"

# --- FIXED VALUES: scenario scorer -------------------------------------------
SCENARIO_PHASE_CENTRES = {1: 0.0, 2: 1.2, 3: 2.7, 4: 4.5}
SCENARIO_NORMAL_DRIVER = "✅ Conditions within normal range"

# --- FIXED VALUES: anomaly-detector feature keywords ---------------------------
ANOMALY_KEYWORDS = ("rainfall", "flood", "price", "conflict", "risk", "season", "drought")

# --- FIXED VALUES: model parameters --------------------------------------------
SEED = 42
TEST_FRACTION = 0.2
FOREST_TREES = 200
BOOST_LEARNING_RATE = 0.05
BOOST_ROW_SHARE = 0.8
BOOST_MIN_CHILD = 3
PRICE_TARGETS = ("price_change_pct", "price_millet", "price_sorghum", "price_cowpeas")
PRICE_TARGET_MIN_ROWS = 100
FOREST_SUBSAMPLE = 256
FOREST_MAX_FEATURES = 0.8
FOREST_CONTAMINATION = 0.03

# --- FIXED VALUES: scenario driver texts (format templates, in rule order) ---
SCENARIO_DRIVERS = {
    "flood": "🌊 Severe flood signal (+{rain}% rainfall anomaly)",
    "drought": "☀️ Drought signal ({rain}% rainfall deficit)",
    "dry": "🌤 Moderate dry spell ({rain}%)",
    "shock": "📈 Price shock (+{price}% food price increase)",
    "elevated": "📊 Elevated food prices (+{price}%)",
    "falling": "📉 Food prices falling ({price}%)",
    "active_flood": "🚨 Active flood event flagged",
    "high_conflict": "⚔️ High conflict activity ({conflict} events)",
    "moderate_conflict": "⚠️ Moderate conflict ({conflict} events)",
    "vegetation": "🌿 Vegetation stress (NDVI Δ {ndvi})",
    "carry_over": "🔁 Carry-over from previous Phase {prev}",
    "density": "👥 High population density ({density}/km²)",
}

# --- FIXED VALUES: scenario status table -------------------------------------
SCENARIO_PARAMETERS = ("Rainfall Anomaly", "Food Price Change", "Active Flood", "Conflict Events",
                       "NDVI Anomaly", "Population Density", "Prev. IPC Phase")
SCENARIO_STATUS = {
    "rain": ("⚠️ Flood", "⚠️ Drought", "✅ Normal"),
    "price": ("🔴 Shock", "🟡 Elevated", "✅ Normal"),
    "flood": ("🔴 Active", "✅ None"),
    "conflict": ("🔴 High", "🟡 Moderate", "✅ Low"),
    "ndvi": ("🔴 Stressed", "✅ Healthy"),
    "density": ("🟡 Dense", "✅ Normal"),
    "prev": ("🔴 Crisis+", "✅ Stable"),
}
FLOOD_YES = "Yes 🚨"
FLOOD_NO = "No ✅"

# --- FIXED VALUES: report line formats (printf style, for Spark's
# format_string; decimals are filled in as text) ---------------------------------------
RULE_LINE = "=" * 60
BULLETIN_TITLE = "  EARLY WARNING — FARMER ALERT BULLETIN"
BULLETIN_PERIOD = "  Period: %s"
BULLETIN_BLOCK_HEADER = "  %s %s · %s  —  %s"           # icon, REGION, district, Month Year
BULLETIN_PHASE_LINE = "     Food Security  : Phase %d — %s"
BULLETIN_ACTION_LINE = "     WFP Action     : %s"
BULLETIN_PRICE_LINE = "     Food Prices    : %s (%s%%)"  # direction, signed change
BULLETIN_RAIN_LINE = "     Rainfall       : %s%% vs historical average"
BULLETIN_MESSAGE_LINE = '     "%s"'
SUMMARY_TITLE = "  EARLY WARNING — DASHBOARD SUMMARY"
SUMMARY_DATA_LINE = "  Data: %d–%d  |  %d Regions"
SUMMARY_DIST_HEADER = "  IPC PHASE DISTRIBUTION (ALL HISTORY)"
SUMMARY_DIST_LINE = "    %s Phase %d — %-12s: %,5d months (%s%%)  %s"
SUMMARY_TOP_HEADER = "  TOP ANOMALOUS REGIONS (HISTORICAL)"
SUMMARY_TOP_LINE = "    • %s: %d anomalous months"
SUMMARY_LATEST_HEADER = "  LATEST SNAPSHOT — %s"
SUMMARY_LATEST_LINE = "    %s %-20s %-14s Phase %d — %-12s Price: %-12s %s"
SUMMARY_ANOMALY_MARK = "⚠️ ANOMALY"
FEATURE_REPORT_LINE = "%3d. %-45s [%s] missing=%d"
EVALUATION_LINE = "  %-28s %-14s: %s"
REPORT_TITLE = "  EARLY WARNING — MODEL EVALUATION REPORT"
REPORT_PHASE_HEADER = "MODEL 1: IPC Phase Classifier"
REPORT_F1_LINE = "  Weighted F1 Score : %s"
REPORT_PRICE_HEADER = "MODEL 2: Price Change Regressor (Random Forest)"
REPORT_MAE_LINE = "  MAE               : %s%%"
REPORT_R2_LINE = "  R²                : %s"
REPORT_NO_PRICE_LINE = "  Not fitted        : no price with enough values"
REPORT_ANOMALY_HEADER = "MODEL 3: Compound Risk Anomaly Detector (Isolation Forest)"
REPORT_ANOMALY_LINE = "  Anomalies found   : %d months (%s%%)"
REPORT_DATA_HEADER = "DATA SUMMARY"
REPORT_REGIONS_LINE = "  Regions           : %d"
REPORT_YEARS_LINE = "  Years             : %d–%d"
REPORT_ROWS_LINE = "  Total rows        : %,d"
REPORT_RULE = "-" * 40
SCENARIO_PCT_FORMAT = "%+d%%"
SCENARIO_DENSITY_FORMAT = "%d /km²"
SCENARIO_PREV_FORMAT = "Phase %d — %s"
