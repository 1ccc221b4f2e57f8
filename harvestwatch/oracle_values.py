"""Values of the SQL oracles, written out a second time.

FIXED VALUES — message texts, line formats, scenario constants and the stand-in
parameters as the oracles expect them.  Nothing here is imported from the code
under test, so a wrong text or format there shows as a mismatch.
"""

from __future__ import annotations

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
BULLETIN_ANOMALY_LINE = "     ⚠️  ANOMALY FLAG: Unusual compound risk pattern detected"
BULLETIN_VOICE_HEADER = "     📢 FARMER VOICE ALERT (Twi/Dagbani/Ewe/Hausa):"
BULLETIN_BROADCAST_NOTE = "     [Translate & broadcast via Africa's Talking SMS gateway]"
BULLETIN_NONE = "  ✅ No high-risk periods detected in recent 12 months."
BULLETIN_FLAGGED = "  ⚠️  {n} DISTRICT-MONTHS FLAGGED FOR ATTENTION"
SCENARIO_PHASE_CENTRES = {1: 0.0, 2: 1.2, 3: 2.7, 4: 4.5}
SCENARIO_NORMAL_DRIVER = "✅ Conditions within normal range"
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
BULLETIN_TITLE = "  EARLY WARNING — FARMER ALERT BULLETIN"
BULLETIN_PERIOD = "  Period: %s"
BULLETIN_BLOCK_HEADER = "  %s %s · %s  —  %s"
BULLETIN_PHASE_LINE = "     Food Security  : Phase %d — %s"
BULLETIN_ACTION_LINE = "     WFP Action     : %s"
BULLETIN_PRICE_LINE = "     Food Prices    : %s (%s%%)"
BULLETIN_RAIN_LINE = "     Rainfall       : %s%% vs historical average"
BULLETIN_MESSAGE_LINE = '     "%s"'
SUMMARY_TITLE = "  EARLY WARNING — DASHBOARD SUMMARY"
SUMMARY_DATA_LINE = "  Data: %d–%d  |  %d Regions"
SUMMARY_DIST_HEADER = "  IPC PHASE DISTRIBUTION (ALL HISTORY)"
SUMMARY_TOP_HEADER = "  TOP ANOMALOUS REGIONS (HISTORICAL)"
SUMMARY_TOP_LINE = "    • %s: %d anomalous months"
SUMMARY_LATEST_HEADER = "  LATEST SNAPSHOT — %s"
SUMMARY_LATEST_LINE = "    %s %-20s %-14s Phase %d — %-12s Price: %-12s %s"
SUMMARY_ANOMALY_MARK = "⚠️ ANOMALY"
FEATURE_REPORT_LINE = "%3d. %-45s [%s] missing=%d"
EVALUATION_LINE = "  %-28s %-14s: %.4f"
SCENARIO_PCT_FORMAT = "%+d%%"
SCENARIO_NDVI_FORMAT = "%+.2f"
SCENARIO_DENSITY_FORMAT = "%d /km²"
SCENARIO_PREV_FORMAT = "Phase %d — %s"
PHASE_LABELS = {1: "Minimal", 2: "Stressed", 3: "Crisis", 4: "Emergency"}

# stand-in parameters
STANDIN_NORTH = ("AFRICA", "MIDDLE EAST")
STANDIN_VULNERABLE = ("AFRICA", "MIDDLE EAST", "ASIA")
STANDIN_COASTAL = ("EUROPE",)
STANDIN_COMMODITY = {
    "ECONOMY": "Maize (white)",
    "LARGE": "Millet",
    "MEDIUM": "Sorghum",
    "PROMO": "Rice (local)",
    "SMALL": "Cowpeas",
    "STANDARD": "Groundnuts (shelled)",
}
STANDIN_EVENT_TYPE = {"R": "Flood displacement", "A": "Protests", "N": "Battles"}
