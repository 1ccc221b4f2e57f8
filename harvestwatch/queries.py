"""Registered queries: one per operator group, each paired with DuckDB SQL.

Every query reads the benchmark tables through the stand-ins in
``plans.standin`` (so its work grows with the tables) and returns a lazy
DataFrame.  Numeric outputs are rounded to 6 places in both engines so the
comparison does not depend on float summation order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from . import constants as K
from . import oracle as O
from . import oracle_values as V
from .functions import flag_pattern, matches_any, parse_date, parse_double, std_region
from .operators import (add_lead, count_where_by, distribution, entity_profile,
                        filter_abs_le, filter_panel, histogram, kpis, latest_period, mean_by,
                        monthly_mean, panel_spine, period_series, sum_by, top_k,
                        trailing_months, with_year_month, column_profile)
from .plans import reports as R
from .plans import scenario as SC
from .plans import standin as S
from .plans.predict import rule_scores
from .session import cut_lineage
from .sources.driver import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def r6(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round double columns to 6 places (the compared projection)."""
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType)
                       else F.col(f.name) for f in df.schema])


def register(name: str, sql: str | None, digits: int = 6):
    """``digits`` is more than 6 for means of values with three places over many rows, which can
    lie on a tie of the sixth, where the order of a sum decides."""
    def deco(fn):
        QUERIES[name] = lambda spark, sf_dir: r6(fn(spark, sf_dir), digits)
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ---- shared stand-in tables (lazy plans) -----------------------------------

def scored(spark, sf):
    # cut: the reports name the table several times, and each time would plan the anomaly
    # threshold (a chain of scalar subqueries) again
    return S._cut(rule_scores(S.features(spark, sf)))


# ---- 1. rainfall: A1, P12, A11 ---------------------------------------------

@register("monthly_mean", O.q("SELECT region, district, year, month, rainfall_mm FROM rain_mean",
                              ("region", "district")))
def q_monthly_mean(spark, sf):
    raw = S.rain_raw(spark, sf)
    df = with_year_month(raw.select(F.to_date("date").alias("date"),
                                    std_region("adm1_name").alias("region"),
                                    F.trim("adm2_name").alias("district"), "rfh").dropna(subset=["date"]))
    return monthly_mean(df, ["region", "district", "year", "month"], {"rfh": "rainfall_mm"}, 3)


@register("flood_flags", O.q("SELECT region, district, year, month, rainfall_mm, rainfall_anomaly_pct, "
                             "flood_flag, drought_flag FROM rainfall", ("region", "district")))
def q_flood_flags(spark, sf):
    return S.rainfall_monthly(spark, sf)


@register("flood_by_region", O.q("SELECT region, CAST(sum(flood_flag) AS BIGINT) AS flood_months "
                                 "FROM rainfall GROUP BY region", ("region",)))
def q_flood_by_region(spark, sf):
    return sum_by(S.rainfall_monthly(spark, sf), "region", "flood_flag", "flood_months")


# ---- 2. prices: A2, A3, W1, W3, W7, P12 -------------------------------------

_WIDE_COLS = ", ".join(O.FAMILIES)


@register("price_pivot", O.q(f"SELECT region, year, month, {_WIDE_COLS} FROM price_wide", ("region",)))
def q_price_pivot(spark, sf):
    return S.prices_monthly(spark, sf).select("region", "year", "month", *O.FAMILIES)


@register("price_change", O.q("SELECT region, year, month, price_maize, price_lag1, price_change_pct "
                              "FROM prices", ("region",)))
def q_price_change(spark, sf):
    return S.prices_monthly(spark, sf).select("region", "year", "month", "price_maize", "price_lag1",
                                              "price_change_pct")


@register("price_volatility", O.q("SELECT region, year, month, price_volatility_3m FROM prices", ("region",)))
def q_price_volatility(spark, sf):
    return S.prices_monthly(spark, sf).select("region", "year", "month", "price_volatility_3m")


@register("price_shock", O.q("SELECT region, year, month, price_change_pct, price_shock_flag FROM prices",
                             ("region",)))
def q_price_shock(spark, sf):
    return S.prices_monthly(spark, sf).select("region", "year", "month", "price_change_pct", "price_shock_flag")


# ---- 3. conflict: A4, W1, A5, P13 -------------------------------------------

@register("conflict_monthly", O.q("SELECT region, year, month, conflict_events, fatalities_total, "
                                  "flood_displace_events FROM ev_month", ("region",)))
def q_conflict_monthly(spark, sf):
    return S.conflict_monthly(spark, sf).select("region", "year", "month", "conflict_events",
                                                "fatalities_total", "flood_displace_events")


@register("conflict_lag", O.q("SELECT region, year, month, conflict_events, conflict_events_lag1, "
                              "flood_displace_lag1 FROM conflict", ("region",)))
def q_conflict_lag(spark, sf):
    return S.conflict_monthly(spark, sf).select("region", "year", "month", "conflict_events",
                                                "conflict_events_lag1", "flood_displace_lag1")


@register("high_conflict", O.q("SELECT region, year, month, conflict_events, high_conflict_flag FROM conflict",
                               ("region",)))
def q_high_conflict(spark, sf):
    return S.conflict_monthly(spark, sf).select("region", "year", "month", "conflict_events",
                                                "high_conflict_flag")


# ---- 4. parsing and text: P1, P2, P5, P9, P11, F17 --------------------------

@register("std_region", O.q("SELECT c_custkey, ' ' || r_name || ' ' AS raw_region, trim(r_name) AS region "
                            "FROM customer JOIN geo ON c_nationkey = n_nationkey",
                            ("raw_region", "region")))
def q_std_region(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    g = S._geo(spark, sf)
    df = c.join(g, c.c_nationkey == g.n_nationkey).select(
        "c_custkey", F.concat(F.lit(" "), F.col("r_name"), F.lit(" ")).alias("raw_region"))
    return df.withColumn("region", std_region("raw_region"))


_KEYWORDS = ("Red", "GEAR")


@register("keyword_filter", O.q("SELECT p_partkey, p_name FROM part WHERE "
                                + " OR ".join(f"contains(lower(p_name), '{k.lower()}')" for k in _KEYWORDS),
                                ("p_name",)))
def q_keyword_filter(spark, sf):
    return table(spark, sf, "part").select("p_partkey", "p_name").filter(matches_any("p_name", _KEYWORDS))


@register("pattern_flag", O.q("SELECT event_id, event_type, CAST(coalesce(regexp_matches(lower(event_type), "
                              "'error|fail'), false) AS INTEGER) AS is_error FROM events", ("event_type",)))
def q_pattern_flag(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "event_type")
    return ev.withColumn("is_error", flag_pattern("event_type", "error|fail"))


@register("safe_parse", O.q(
    "SELECT o_orderkey, try_cast(split_part(o_orderpriority, '-', 1) AS DOUBLE) AS priority_num, "
    "try_cast(o_orderstatus AS DOUBLE) AS status_num, "
    "CAST(o_orderdate AS DATE) AS order_date FROM orders", ("order_date",)))
def q_safe_parse(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus", "o_orderdate")
    return o.select("o_orderkey",
                    parse_double(F.split_part("o_orderpriority", F.lit("-"), F.lit(1))).alias("priority_num"),
                    parse_double("o_orderstatus").alias("status_num"),
                    parse_date(F.col("o_orderdate").cast("string")).alias("order_date"))


@register("json_value", O.q("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events"))
def q_json_value(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "props")
    return ev.select("event_id", F.from_json("props", "k BIGINT")["k"].alias("k"))


_RAW_REGIONS = (" Accra ", "Kumasi", "Brong-Ahafo", "Brong Ahafo", "Ho", "Wa", "Sunyani", "Cape Coast",
                "Sekondi-Takoradi", "Tamale", "Bolgatanga", "Koforidua", "Bono East", " Nowhere ", None)


@register("std_region_aliases", O.q(
    "SELECT c_custkey, ['Greater Accra', 'Ashanti', 'Bono', 'Bono', 'Volta', 'Upper West', 'Bono', 'Central', 'Western', "
    "'Northern', 'Upper East', 'Eastern', 'Bono East', 'Nowhere', 'Unknown'][c_custkey % 15 + 1] AS region FROM customer",
    ("region",)))
def q_std_region_aliases(spark, sf):
    """P5: aliases, padded, unmapped and missing names, dealt over the customers."""
    raw = F.get(F.array(*[F.lit(r).cast("string") for r in _RAW_REGIONS]), F.pmod("c_custkey", F.lit(15)).cast("int"))
    return table(spark, sf, "customer").select("c_custkey", std_region(raw).alias("region"))


@register("safe_parse_dirty", O.q(
    "SELECT o_orderkey, CASE WHEN o_orderkey % 6 IN (0, 1, 5) THEN CAST(o_orderdate AS DATE) END AS order_date, "
    "CASE o_orderkey % 6 WHEN 0 THEN o_orderkey::DOUBLE WHEN 3 THEN 1000.0::DOUBLE WHEN 5 THEN 12.5::DOUBLE END AS number "
    "FROM orders", ("order_date",)))
def q_safe_parse_dirty(spark, sf):
    """Cells as they come in raw files; what cannot be read is null."""
    o = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").cast("string").alias("d"))
    kind = F.pmod("o_orderkey", F.lit(6)).cast("int")

    def dealt(*cells):
        return F.get(F.array(*cells), kind)
    dates = dealt(F.col("d"), F.concat("d", F.lit(" 00:00:00")), F.lit("not a date"), F.lit(""), F.lit("2001-02-30"),
                  F.concat(F.lit(" "), "d", F.lit(" ")))
    numbers = dealt(F.col("o_orderkey").cast("string"), F.lit("n/a"), F.lit("nan"), F.lit("1e3"), F.lit("1,234"), F.lit(" 12.5 "))
    return o.select("o_orderkey", parse_date(dates).alias("order_date"), parse_double(numbers).alias("number"))


# ---- 5. master and rules: J1, R1-R6, R8 --------------------------------------

_MASTER_COLS = ("region, district, year, month, rainfall_mm, rainfall_anomaly_pct, flood_flag, drought_flag, "
                f"{_WIDE_COLS}, price_lag1, price_change_pct, price_volatility_3m, price_shock_flag, "
                "conflict_events, fatalities_total, flood_displace_events, conflict_events_lag1, "
                "flood_displace_lag1, high_conflict_flag")


@register("master_join", O.q(f"SELECT {_MASTER_COLS} FROM joined", ("region", "district")))
def q_master_join(spark, sf):
    from .operators import join_master, require
    t = S.monthly_tables(spark, sf)
    spine = require(t["rain"], ["rainfall_mm", "region", "district", "year", "month"])
    return join_master(spine, t["prices"], t["conflict"])


@register("season_phase", O.q("SELECT district, year, month, region, season_phase, is_lean_season FROM master",
                              ("district", "region", "season_phase")))
def q_season_phase(spark, sf):
    return S.rain_spine(spark, sf).select("district", "year", "month", "region", "season_phase", "is_lean_season")


@register("ipc_rule", O.q("SELECT district, year, month, district_vulnerability, ipc_phase FROM master",
                          ("district",)))
def q_ipc_rule(spark, sf):
    return S.master(spark, sf).select("district", "year", "month", "district_vulnerability", "ipc_phase")


@register("compound_flag", O.q("SELECT district, year, month, flood_price_interaction, compound_risk_flag "
                               "FROM master", ("district",)))
def q_compound_flag(spark, sf):
    return S.master(spark, sf).select("district", "year", "month", "flood_price_interaction",
                                      "compound_risk_flag")


@register("risk_score", O.q("SELECT district, year, month, region_type, compound_risk_score FROM features",
                            ("district",)))
def q_risk_score(spark, sf):
    return S.features(spark, sf).select("district", "year", "month", "region_type", "compound_risk_score")


# ---- 6. windows: W1, W2, W5, W6, W8, J2 ---------------------------------------

_LAG_COLS = ("rainfall_anomaly_lag1", "rainfall_anomaly_lag2", "rainfall_anomaly_lag3", "flood_flag_lag1",
             "flood_flag_lag2", "flood_flag_lag3", "drought_flag_lag1", "drought_flag_lag2",
             "drought_flag_lag3", "price_change_lag1", "price_change_lag2", "price_volatility_lag1",
             "price_volatility_lag2", "conflict_lag1", "conflict_lag2")


@register("lags", O.q(f"SELECT district, year, month, {', '.join(_LAG_COLS)} FROM features", ("district",)))
def q_lags(spark, sf):
    return S.features(spark, sf).select("district", "year", "month", *_LAG_COLS)


@register("lead_target", O.q(
    "SELECT district, year, month, price_change_pct, lead(price_change_pct) OVER "
    "(PARTITION BY district ORDER BY year, month) AS target_price_change FROM master", ("district",)))
def q_lead_target(spark, sf):
    m = S.master(spark, sf).select("district", "year", "month", "price_change_pct")
    return add_lead(m, "price_change_pct", "target_price_change")


@register("rolling_mean", O.q("SELECT district, year, month, rainfall_rolling_3m, rainfall_rolling_6m "
                              "FROM features", ("district",)))
def q_rolling_mean(spark, sf):
    return S.features(spark, sf).select("district", "year", "month", "rainfall_rolling_3m", "rainfall_rolling_6m")


@register("rolling_sum", O.q("SELECT district, year, month, conflict_rolling_3m FROM features", ("district",)))
def q_rolling_sum(spark, sf):
    return S.features(spark, sf).select("district", "year", "month", "conflict_rolling_3m")


@register("streak", O.q("SELECT district, year, month, flood_flag, flood_streak_months FROM features",
                        ("district",)))
def q_streak(spark, sf):
    return S.features(spark, sf).select("district", "year", "month", "flood_flag", "flood_streak_months")


@register("group_profile", O.q("SELECT district, year, month, region_flood_freq_hist, "
                               "region_conflict_intensity_hist FROM features", ("district",)))
def q_group_profile(spark, sf):
    return S.features(spark, sf).select("district", "year", "month", "region_flood_freq_hist",
                                        "region_conflict_intensity_hist")


# ---- 7. calendar features: F14, F2, R10, R9 -----------------------------------

_DUMMIES = tuple(f"season_{v}" for v in K.SEASON_PHASES)


@register("season_onehot", O.q(f"SELECT district, year, month, {', '.join(_DUMMIES)} FROM features",
                               ("district", *_DUMMIES)))
def q_season_onehot(spark, sf):
    return S.features(spark, sf).select("district", "year", "month", *_DUMMIES)


@register("month_cycle", O.q("SELECT district, year, month, month_sin, month_cos FROM features", ("district",)))
def q_month_cycle(spark, sf):
    return S.features(spark, sf).select("district", "year", "month", "month_sin", "month_cos")


@register("time_trend", O.q("SELECT district, year, month, time_trend FROM features", ("district",)))
def q_time_trend(spark, sf):
    return S.features(spark, sf).select("district", "year", "month", "time_trend")


@register("interactions", O.q("SELECT district, year, month, flood_price_lag1_interact, drought_price_interact "
                              "FROM features", ("district",)))
def q_interactions(spark, sf):
    return S.features(spark, sf).select("district", "year", "month", "flood_price_lag1_interact",
                                        "drought_price_interact")


@register("features", O.q("SELECT * FROM features", ("region", "district", *_DUMMIES)))
def q_features(spark, sf):
    return S.features(spark, sf)


# ---- 8. summaries: A6, A13, A10, A15, A14, A16, A17 ----------------------------

@register("distribution", O.q(
    "SELECT ipc_phase, count(*) AS count, count(*) * 100.0::DOUBLE / (SELECT count(*) FROM master) AS pct "
    "FROM master GROUP BY ipc_phase"))
def q_distribution(spark, sf):
    return distribution(S.master(spark, sf), "ipc_phase")


@register("kpis", O.q(
    "SELECT avg(CAST(coalesce(pred_ipc_phase >= 3, false) AS INTEGER)) * 100.0::DOUBLE AS crisis_pct, "
    "avg(flood_flag) * 100.0::DOUBLE AS flood_pct, CAST(coalesce(sum(is_anomaly), 0) AS BIGINT) AS anomaly_n, "
    "avg(compound_risk_score) AS avg_risk, count(*) AS rows FROM scored"))
def q_kpis(spark, sf):
    return kpis(scored(spark, sf))


@register("mean_by_year", O.q("SELECT year, avg(rainfall_anomaly_pct) AS mean_rainfall_anomaly_pct "
                              "FROM master GROUP BY year", digits=9), digits=9)
def q_mean_by_year(spark, sf):
    return mean_by(S.rain_spine(spark, sf), "year", "rainfall_anomaly_pct")


@register("flood_rate_by_month", O.q("SELECT month, avg(flood_flag) * 100.0::DOUBLE AS flood_rate "
                                     "FROM master GROUP BY month"))
def q_flood_rate_by_month(spark, sf):
    return mean_by(S.rain_spine(spark, sf), "month", "flood_flag", "flood_rate", scale=100.0)


@register("period_series", O.q(
    "SELECT year, month, avg(pred_ipc_phase) AS mean_pred_ipc_phase, "
    "year + (month - 1) / 12.0::DOUBLE AS date_n FROM scored GROUP BY year, month"))
def q_period_series(spark, sf):
    return period_series(scored(spark, sf), "pred_ipc_phase")


@register("entity_profile", O.q(
    "SELECT district, CAST(coalesce(sum(flood_flag), 0) AS BIGINT) AS flood_months, "
    "CAST(coalesce(sum(is_anomaly), 0) AS BIGINT) AS anomaly_months, avg(compound_risk_score) AS avg_risk, "
    "arg_max(year, pidx) AS latest_year, arg_max(month, pidx) AS latest_month, "
    "arg_max(pred_ipc_phase, pidx) AS latest_pred_ipc_phase, "
    "arg_max(pred_ipc_confidence, pidx) AS latest_pred_ipc_confidence FROM scored GROUP BY district",
    ("district",), digits=9), digits=9)
def q_entity_profile(spark, sf):
    return entity_profile(scored(spark, sf))


@register("histogram", O.q(
    ", v AS (SELECT price_change_pct AS v FROM prices WHERE abs(price_change_pct) <= 100.0::DOUBLE), "
    "b AS (SELECT min(v) AS lo, max(v) AS hi FROM v), "
    "h AS (SELECT CAST(CASE WHEN hi = lo THEN 1 ELSE least(CAST(floor(50.0::DOUBLE * (v - lo) / (hi - lo)) "
    "AS BIGINT) + 1, 50) END AS INTEGER) AS bin FROM v JOIN b ON true) "
    "SELECT bin, count(*) AS count, (SELECT lo FROM b) + (bin - 1) * (((SELECT hi FROM b) - (SELECT lo FROM b)) "
    "/ 50.0::DOUBLE) AS lo, (SELECT lo FROM b) + bin * (((SELECT hi FROM b) - (SELECT lo FROM b)) / 50.0::DOUBLE) "
    "AS hi FROM h GROUP BY bin"))
def q_histogram(spark, sf):
    p = filter_abs_le(S.prices_monthly(spark, sf).where(F.col("price_change_pct").isNotNull()),
                      "price_change_pct", 100)
    return histogram(p, "price_change_pct", 50)


_PROFILE_SQL = " UNION ALL ".join(
    f"SELECT {i + 1} AS seq, '{c}' AS \"column\", CAST(sum(CAST({c} IS NULL AS BIGINT)) AS BIGINT) AS missing "
    f"FROM master" for i, c in enumerate(sorted(
        ["region", "district", "year", "month", "rainfall_mm", "rainfall_anomaly_pct", "flood_flag",
         "drought_flag", *O.FAMILIES, "price_lag1", "price_change_pct", "price_volatility_3m",
         "price_shock_flag", "conflict_events", "fatalities_total", "flood_displace_events",
         "conflict_events_lag1", "flood_displace_lag1", "high_conflict_flag", "season_phase",
         "is_lean_season", "district_vulnerability", "ipc_phase", "flood_price_interaction",
         "compound_risk_flag"])))


@register("column_profile", O.q(_PROFILE_SQL, ("column",)))
def q_column_profile(spark, sf):
    return column_profile(S.master(spark, sf)).select("seq", "column", "missing")


# ---- 9. slices: O6, O7, O3, P19, A12 -----------------------------------------

@register("latest_snapshot", O.q(
    "SELECT district, region, year, month, pred_ipc_phase, compound_risk_score FROM latest",
    ("district", "region")))
def q_latest_snapshot(spark, sf):
    return latest_period(scored(spark, sf)).select("district", "region", "year", "month", "pred_ipc_phase",
                                                   "compound_risk_score")


@register("trailing_12m", O.q("SELECT district, year, month, pred_ipc_phase FROM recent", ("district",)))
def q_trailing_12m(spark, sf):
    return trailing_months(scored(spark, sf), 12).select("district", "year", "month", "pred_ipc_phase")


@register("top_k", O.q(
    "SELECT district, year, month, compound_risk_score FROM features "
    "ORDER BY compound_risk_score DESC, district, year, month LIMIT 10", ("district",)))
def q_top_k(spark, sf):
    f = S.features(spark, sf).select("district", "year", "month", "compound_risk_score")
    return top_k(f, [F.col("compound_risk_score").desc()], 10, ties=["district", "year", "month"])


_PANEL_YEARS = (1997, 2000)


@register("panel_filter", O.q(
    f"SELECT district, region, year, month, pred_ipc_phase FROM scored WHERE year BETWEEN {_PANEL_YEARS[0]} "
    f"AND {_PANEL_YEARS[1]} AND region = 'AFRICA'", ("district", "region")))
def q_panel_filter(spark, sf):
    return filter_panel(scored(spark, sf), years=_PANEL_YEARS, region="AFRICA").select(
        "district", "region", "year", "month", "pred_ipc_phase")


@register("anomaly_count_top5", O.q(
    "SELECT region, count(*) AS n FROM scored WHERE is_anomaly = 1 GROUP BY region "
    "ORDER BY n DESC, region LIMIT 5", ("region",)))
def q_anomaly_count_top5(spark, sf):
    return count_where_by(scored(spark, sf), F.col("is_anomaly") == 1, "region", "n", k=5)


# ---- 10. reports and scenarios: B1-B4, R11-R17 ---------------------------------

_FEED = ", ".join(R.FEED_COLUMNS)
_FEED_TEXT = ("district", "region", "pred_ipc_label", "pred_ipc_action", "pred_price_direction")


@register("alert_feed", O.q(f"SELECT {_FEED} FROM recent", _FEED_TEXT))
def q_alert_feed(spark, sf):
    return R.alert_feed(scored(spark, sf), 12)


@register("feed_order", O.q(
    "SELECT district, year, month, row_number() OVER (PARTITION BY year, month ORDER BY pred_ipc_phase DESC, district) "
    "AS position FROM recent", ("district",)))
def q_feed_order(spark, sf):
    """O1: the place of each row of the feed in its month."""
    rows = R.alert_feed(scored(spark, sf), 12)
    place = F.row_number().over(Window.partitionBy("year", "month").orderBy(*R.feed_order()))
    return rows.select("district", "year", "month", place.cast("long").alias("position"))


@register("snapshot_order", O.q(
    "SELECT district, row_number() OVER (ORDER BY pred_ipc_phase DESC, is_anomaly DESC, district) AS position FROM latest",
    ("district",)))
def q_snapshot_order(spark, sf):
    """O2: the place of each district in the latest snapshot (one month: a row per district)."""
    rows = latest_period(scored(spark, sf))
    place = F.row_number().over(Window.partitionBy("year", "month").orderBy(*R.snapshot_order()))
    return rows.select("district", place.cast("long").alias("position"))


@register("alert_snapshot", O.q(f"SELECT {', '.join(R.SNAPSHOT_COLUMNS)} FROM latest", _FEED_TEXT))
def q_alert_snapshot(spark, sf):
    return R.alert_snapshot(scored(spark, sf))


_BULLETIN = f"""
, flagged AS (SELECT * FROM recent WHERE pred_ipc_phase >= 2 OR is_anomaly = 1),
items AS (
  SELECT region, district, year, month, pred_ipc_phase, list_filter([
    printf({O.lit(V.BULLETIN_BLOCK_HEADER)}, {O._ICON}, upper(region), district, strftime(make_date(year, month, 1), '%B %Y')),
    printf({O.lit(V.BULLETIN_PHASE_LINE)}, pred_ipc_phase, {O._LABEL}),
    printf({O.lit(V.BULLETIN_ACTION_LINE)}, {O._ACTION_LONG}),
    printf({O.lit(V.BULLETIN_PRICE_LINE)}, pred_price_direction, {O.fmt('%+.1f', 'pred_price_change')}),
    printf({O.lit(V.BULLETIN_RAIN_LINE)}, {O.fmt('%+.1f', 'rainfall_anomaly_pct')}),
    CASE WHEN is_anomaly = 1 THEN '{V.BULLETIN_ANOMALY_LINE}' END,
    '',
    '{V.BULLETIN_VOICE_HEADER}',
    printf({O.lit(V.BULLETIN_MESSAGE_LINE)}, (CASE WHEN rainfall_anomaly_pct < -20 THEN '{V.WEATHER_MESSAGES["bulletin"]["dry"]}'
                      WHEN rainfall_anomaly_pct > 50 THEN '{V.WEATHER_MESSAGES["bulletin"]["wet"]}'
                      ELSE '{V.WEATHER_MESSAGES["bulletin"]["other"]}' END) || ' ' ||
           (CASE WHEN contains(pred_price_direction, 'Rising') THEN '{V.PRICE_MESSAGES["bulletin"]["rising"]}'
                 WHEN contains(pred_price_direction, 'Falling') THEN '{V.PRICE_MESSAGES["bulletin"]["falling"]}'
                 ELSE '{V.PRICE_MESSAGES["bulletin"]["other"]}' END)),
    '{V.BULLETIN_BROADCAST_NOTE.replace("'", "''")}',
    ''], lambda x: x IS NOT NULL) AS lines
  FROM flagged)
SELECT region, district, year, month, pred_ipc_phase, CAST(u.pos - 1 AS INTEGER) AS line_no, u.value AS value
FROM items, LATERAL (SELECT unnest(lines) AS value, generate_subscripts(lines, 1) AS pos) u
"""


@register("bulletin_lines", O.r6("WITH " + O.CTE.strip() + _BULLETIN, ("region", "district", "value")))
def q_bulletin_lines(spark, sf):
    return R.bulletin_lines(scored(spark, sf))


def _scenarios(spark, sf):
    return S.scenarios(spark, sf)


_SCEN_CTE = """
, scen AS (
  SELECT district || ' ' || printf('%d-%02d', year, month) AS scenario_id,
    CAST(round(coalesce(rainfall_anomaly_pct, 0.0::DOUBLE)) AS INTEGER) AS rainfall_anom,
    CAST(round(coalesce(price_change_pct, 0.0::DOUBLE)) AS INTEGER) AS price_change,
    flood_flag = 1 AS flood_flag,
    CAST(conflict_events AS INTEGER) AS conflict_events,
    nround(coalesce(rainfall_anomaly_lag1, 0.0::DOUBLE) / 400.0::DOUBLE, 2) AS ndvi_anom,
    CAST(conflict_rolling_3m AS INTEGER) AS population_density,
    CAST(coalesce(lag(ipc_phase) OVER (PARTITION BY district ORDER BY year, month), ipc_phase) AS INTEGER) AS prev_ipc
  FROM features)
"""


def _scenario_score_sql() -> str:
    T = V.SCENARIO_DRIVERS

    def t(key, **parts):
        s = "'" + T[key].replace("'", "''") + "'"
        for name, expr in parts.items():
            s = s.replace("{" + name + "}", "' || " + expr + " || '")
        return s
    r = "printf('%.0f', rainfall_anom::DOUBLE)"
    p = "printf('%.0f', price_change::DOUBLE)"
    d = "printf('%.0f', population_density::DOUBLE)"
    nd = O.fmt('%.2f', 'ndvi_anom')
    score = ("((((((0.0::DOUBLE + CASE WHEN rainfall_anom >= 50 THEN 2.5::DOUBLE WHEN rainfall_anom <= -40 THEN 2.0::DOUBLE "
             "WHEN rainfall_anom <= -20 THEN 0.8::DOUBLE ELSE 0.0::DOUBLE END) "
             "+ CASE WHEN price_change >= 30 THEN 2.0::DOUBLE WHEN price_change >= 15 THEN 1.0::DOUBLE "
             "WHEN price_change <= -10 THEN -0.5::DOUBLE ELSE 0.0::DOUBLE END) "
             "+ CASE WHEN flood_flag THEN 1.2::DOUBLE ELSE 0.0::DOUBLE END) "
             "+ CASE WHEN conflict_events >= 5 THEN 1.5::DOUBLE WHEN conflict_events >= 2 THEN 0.6::DOUBLE ELSE 0.0::DOUBLE END) "
             "+ CASE WHEN ndvi_anom <= -0.15 THEN 1.0::DOUBLE WHEN ndvi_anom >= 0.10 THEN -0.3::DOUBLE ELSE 0.0::DOUBLE END) "
             "+ CASE WHEN prev_ipc >= 3 THEN 0.8::DOUBLE WHEN prev_ipc = 1 THEN -0.4::DOUBLE ELSE 0.0::DOUBLE END) "
             "+ CASE WHEN population_density >= 200 THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END")
    drivers = (f"list_filter([CASE WHEN rainfall_anom >= 50 THEN {t('flood', rain=r)} "
               f"WHEN rainfall_anom <= -40 THEN {t('drought', rain=r)} WHEN rainfall_anom <= -20 THEN {t('dry', rain=r)} END, "
               f"CASE WHEN price_change >= 30 THEN {t('shock', price=p)} WHEN price_change >= 15 THEN {t('elevated', price=p)} "
               f"WHEN price_change <= -10 THEN {t('falling', price=p)} END, "
               f"CASE WHEN flood_flag THEN {t('active_flood')} END, "
               f"CASE WHEN conflict_events >= 5 THEN {t('high_conflict', conflict='CAST(conflict_events AS VARCHAR)')} "
               f"WHEN conflict_events >= 2 THEN {t('moderate_conflict', conflict='CAST(conflict_events AS VARCHAR)')} END, "
               f"CASE WHEN ndvi_anom <= -0.15 THEN {t('vegetation', ndvi=nd)} END, "
               f"CASE WHEN prev_ipc >= 3 THEN {t('carry_over', prev='CAST(prev_ipc AS VARCHAR)')} END, "
               f"CASE WHEN population_density >= 200 THEN {t('density', density=d)} END], lambda x: x IS NOT NULL)")
    c = V.SCENARIO_PHASE_CENTRES
    return (_SCEN_CTE + f", s1 AS (SELECT *, {score} AS s, {drivers} AS dl FROM scen), "
            "s2 AS (SELECT *, CASE WHEN s <= 0.5 THEN 1 WHEN s <= 1.8 THEN 2 WHEN s <= 3.5 THEN 3 ELSE 4 END AS phase FROM s1) "
            "SELECT scenario_id, phase, "
            f"nround(greatest(0.55::DOUBLE, least(0.97::DOUBLE, 0.97::DOUBLE - abs(s - CASE phase WHEN 1 THEN {c[1]}::DOUBLE "
            f"WHEN 2 THEN {c[2]}::DOUBLE WHEN 3 THEN {c[3]}::DOUBLE ELSE {c[4]}::DOUBLE END) * 0.12::DOUBLE)), 2) AS confidence, "
            f"nround(s, 2) AS score, array_to_string(CASE WHEN len(dl) = 0 THEN ['{V.SCENARIO_NORMAL_DRIVER}'] ELSE dl END, ' | ') "
            "AS drivers FROM s2")


@register("scenario_score", O.r6("WITH " + O.CTE.strip() + _scenario_score_sql(), ("scenario_id", "drivers")))
def q_scenario_score(spark, sf):
    out = SC.scenario_score(_scenarios(spark, sf))
    return out.select("scenario_id", "phase", "confidence", "score",
                      F.array_join("drivers", " | ").alias("drivers"))


def _status_sql() -> str:
    St = V.SCENARIO_STATUS
    P = V.SCENARIO_PARAMETERS
    rows = [
        (f"printf({O.lit(V.SCENARIO_PCT_FORMAT)}, rainfall_anom)",
         f"CASE WHEN rainfall_anom >= 50 THEN '{St['rain'][0]}' WHEN rainfall_anom <= -40 THEN '{St['rain'][1]}' ELSE '{St['rain'][2]}' END"),
        (f"printf({O.lit(V.SCENARIO_PCT_FORMAT)}, price_change)",
         f"CASE WHEN price_change >= 30 THEN '{St['price'][0]}' WHEN price_change >= 15 THEN '{St['price'][1]}' ELSE '{St['price'][2]}' END"),
        (f"CASE WHEN flood_flag THEN '{V.FLOOD_YES}' ELSE '{V.FLOOD_NO}' END",
         f"CASE WHEN flood_flag THEN '{St['flood'][0]}' ELSE '{St['flood'][1]}' END"),
        ("CAST(conflict_events AS VARCHAR)",
         f"CASE WHEN conflict_events >= 5 THEN '{St['conflict'][0]}' WHEN conflict_events >= 2 THEN '{St['conflict'][1]}' ELSE '{St['conflict'][2]}' END"),
        (f"printf({O.lit(V.SCENARIO_NDVI_FORMAT)}, ndvi_anom)",
         f"CASE WHEN ndvi_anom <= -0.15 THEN '{St['ndvi'][0]}' ELSE '{St['ndvi'][1]}' END"),
        (f"printf({O.lit(V.SCENARIO_DENSITY_FORMAT)}, population_density)",
         f"CASE WHEN population_density >= 200 THEN '{St['density'][0]}' ELSE '{St['density'][1]}' END"),
        (f"printf({O.lit(V.SCENARIO_PREV_FORMAT)}, prev_ipc, {O._case_map('prev_ipc', V.PHASE_LABELS)})",
         f"CASE WHEN prev_ipc >= 3 THEN '{St['prev'][0]}' ELSE '{St['prev'][1]}' END"),
    ]
    parts = [f"SELECT scenario_id, {i + 1} AS seq, '{name}' AS parameter, {v} AS value, {s} AS status FROM scen"
             for i, (name, (v, s)) in enumerate(zip(P, rows))]
    return _SCEN_CTE + " " + " UNION ALL ".join(parts)


@register("scenario_status", O.r6("WITH " + O.CTE.strip() + _status_sql(),
                                  ("scenario_id", "parameter", "value", "status")))
def q_scenario_status(spark, sf):
    return SC.scenario_status(_scenarios(spark, sf))


# ---- 11. spine: J4 ---------------------------------------------------------------

@register("panel_spine", O.q(
    "SELECT d.district, CAST(g.date AS DATE) AS date FROM (SELECT DISTINCT district FROM rain_raw) d, "
    "(SELECT unnest(generate_series(CAST(date_trunc('month', min(date)) AS DATE), "
    "CAST(date_trunc('month', max(date)) AS DATE), INTERVAL 1 MONTH)) AS date FROM rain_raw) g", round6=False))
def q_panel_spine(spark, sf):
    # one pass over the raw rows; the rest reads one row per district
    raw = S.rain_raw(spark, sf).select(F.trim("adm2_name").alias("district"), F.to_date("date").alias("date"))
    known = cut_lineage(raw.groupBy("district").agg(F.min("date").alias("lo"), F.max("date").alias("hi")))
    ends = known.select(F.struct(F.trunc(F.min("lo"), "month").alias("lo"),
                                 F.trunc(F.max("hi"), "month").alias("hi"))).scalar()
    return panel_spine(known.select("district"), ends.getField("lo"), ends.getField("hi"), "1 month")


# ---- 12. metrics on a persistence forecast: M4, M12-M14 ---------------------------

_PERSIST = """
, persist AS (
  SELECT district, year, month, ipc_phase AS y,
         lag(ipc_phase) OVER (PARTITION BY district ORDER BY year, month) AS pred
  FROM master QUALIFY pred IS NOT NULL)
"""


def _persistence(spark, sf):
    from .models.metrics import persistence_forecast
    return persistence_forecast(S.master(spark, sf), "ipc_phase")


@register("class_weights", O.r6("WITH " + O.CTE.strip() + _PERSIST +
    "SELECT y AS label, count(*) AS n, (SELECT count(*) FROM persist) / ((SELECT count(DISTINCT y) FROM persist) "
    "* count(*))::DOUBLE AS weight FROM persist GROUP BY y"))
def q_class_weights(spark, sf):
    from .models.metrics import class_weights
    return class_weights(_persistence(spark, sf), "y")


@register("confusion", O.r6("WITH " + O.CTE.strip() + _PERSIST +
    "SELECT y, pred, count(*) AS n FROM persist GROUP BY y, pred"))
def q_confusion(spark, sf):
    from .models.metrics import confusion
    return confusion(_persistence(spark, sf), "y", "pred")


@register("classification_report", O.r6("WITH " + O.CTE.strip() + _PERSIST + """
, c AS (SELECT y, pred, count(*) AS n FROM persist GROUP BY y, pred),
cls AS (SELECT y AS label FROM persist UNION SELECT pred FROM persist),
per AS (
  SELECT label,
    coalesce((SELECT sum(n) FROM c WHERE c.y = label AND c.pred = label), 0) AS tp,
    coalesce((SELECT sum(n) FROM c WHERE c.pred = label), 0) AS pp,
    coalesce((SELECT sum(n) FROM c WHERE c.y = label), 0) AS support
  FROM cls),
m AS (
  SELECT label, CAST(support AS BIGINT) AS support,
    CASE WHEN pp = 0 THEN 0.0::DOUBLE ELSE tp / pp::DOUBLE END AS precision,
    CASE WHEN support = 0 THEN 0.0::DOUBLE ELSE tp / support::DOUBLE END AS recall
  FROM per)
SELECT label, support, precision, recall,
  CASE WHEN precision + recall = 0 THEN 0.0::DOUBLE ELSE 2 * precision * recall / (precision + recall) END AS f1,
  sum(support * CASE WHEN precision + recall = 0 THEN 0.0::DOUBLE ELSE 2 * precision * recall / (precision + recall) END)
    OVER () / sum(support) OVER () AS weighted_f1
FROM m"""))
def q_classification_report(spark, sf):
    from .models.metrics import classification_report
    return classification_report(_persistence(spark, sf), "y", "pred")


@register("regression_metrics", O.r6("WITH " + O.CTE.strip() + """
, t AS (
  SELECT price_change_pct AS pred,
         lead(price_change_pct) OVER (PARTITION BY district ORDER BY year, month) AS y FROM master
  QUALIFY y IS NOT NULL AND pred IS NOT NULL AND abs(y) <= 200)
SELECT avg(abs(y - pred)) AS mae,
       1 - sum((y - pred) * (y - pred)) / sum((y - (SELECT avg(y) FROM t)) * (y - (SELECT avg(y) FROM t))) AS r2,
       avg(abs((y - pred) / y)) FILTER (WHERE abs(y) > 0.1) * 100.0::DOUBLE AS mape,
       count(*) AS n
FROM t"""))
def q_regression_metrics(spark, sf):
    from .models.metrics import regression_metrics
    m = add_lead(S.master(spark, sf), "price_change_pct", "y").withColumnRenamed("price_change_pct", "pred")
    m = m.filter(F.col("y").isNotNull() & F.col("pred").isNotNull())
    return regression_metrics(filter_abs_le(m, "y", 200), "y", "pred")


# ---- 13. more summaries and projections: S10, A7-A11, A18, W9, P24, P25, B4-B7, R12, R13, R17, M13

@register("source_overview", O.q(
    "SELECT count(*) AS rows, min(date) AS date_min, max(date) AS date_max, "
    "count(DISTINCT region) AS n_region, count(DISTINCT district) AS n_district, "
    "array_to_string(list_sort(list(DISTINCT region)), ',') AS regions FROM rain_raw",
    ("date_min", "date_max", "regions")))
def q_source_overview(spark, sf):
    from .sources import source_overview
    raw = S.rain_raw(spark, sf).select(F.to_date("date").alias("date"), F.trim("adm1_name").alias("region"),
                                       F.trim("adm2_name").alias("district"))
    ov = source_overview(raw, "date", ["region", "district"], ["region"])
    return ov.select("rows", "date_min", "date_max", "n_region", "n_district",
                     F.array_join("region_values", ",").alias("regions"))


@register("distinct_counts", O.q(
    "SELECT count(DISTINCT district) AS n_district, count(DISTINCT region) AS n_region, "
    "count(DISTINCT year) AS n_year FROM master"))
def q_distinct_counts(spark, sf):
    from .operators import distinct_count
    return distinct_count(S.rain_spine(spark, sf), ["district", "region", "year"])


@register("district_list", O.q("SELECT DISTINCT district FROM master WHERE region = 'AFRICA'", round6=False))
def q_district_list(spark, sf):
    from .operators import distinct_values
    return distinct_values(S.rain_spine(spark, sf).where(F.col("region") == "AFRICA"), "district")


@register("year_range", O.q(
    "SELECT min(year) AS year_min, max(year) AS year_max, min(price_change_pct) AS price_change_pct_min, "
    "max(price_change_pct) AS price_change_pct_max FROM master"))
def q_year_range(spark, sf):
    from .operators import min_max
    return min_max(S.master(spark, sf), ["year", "price_change_pct"])


@register("non_null_counts", O.q(
    "SELECT " + ", ".join(f"count({c}) AS nn_{c}" for c in (*O.FAMILIES, "price_change_pct", "price_volatility_3m"))
    + " FROM master"))
def q_non_null_counts(spark, sf):
    from .operators import non_null_counts
    return non_null_counts(S.master(spark, sf), [*O.FAMILIES, "price_change_pct", "price_volatility_3m"])


@register("mean_phase_by_region", O.q("SELECT region, avg(pred_ipc_phase) AS mean_pred_ipc_phase FROM scored "
                                      "GROUP BY region", ("region",)))
def q_mean_phase_by_region(spark, sf):
    return mean_by(scored(spark, sf), "region", "pred_ipc_phase")


@register("conflict_by_year", O.q("SELECT year, CAST(sum(conflict_events) AS BIGINT) AS conflict_total "
                                  "FROM master GROUP BY year"))
def q_conflict_by_year(spark, sf):
    return sum_by(S.master(spark, sf), "year", "conflict_events", "conflict_total")


@register("flood_by_region_year", O.q("SELECT region, year, CAST(sum(flood_flag) AS BIGINT) AS flood_months "
                                      "FROM master GROUP BY region, year", ("region",)))
def q_flood_by_region_year(spark, sf):
    return sum_by(S.rain_spine(spark, sf), ["region", "year"], "flood_flag", "flood_months")


@register("latest_per_district", O.q(
    "SELECT district, arg_max(year, pidx) AS year, arg_max(month, pidx) AS month, "
    "arg_max(pred_ipc_phase, pidx) AS pred_ipc_phase, arg_max(compound_risk_score, pidx) AS compound_risk_score "
    "FROM scored GROUP BY district", ("district",)))
def q_latest_per_district(spark, sf):
    from .operators import latest_row
    return latest_row(scored(spark, sf), "district", cols=["year", "month", "pred_ipc_phase", "compound_risk_score"])


_TOP_RISK = ("SELECT year AS \"Year\", strftime(make_date(year, month, 1), '%b') AS \"Month\", "
             "pred_ipc_phase AS \"IPC Phase\", pred_ipc_label AS \"IPC Label\", "
             "rainfall_anomaly_pct AS \"Rain Anomaly (%)\", pred_price_direction AS \"Price Direction\", "
             "compound_risk_score AS \"Risk Score\", CASE WHEN is_anomaly = 1 THEN '⚠️' ELSE '' END AS \"Anomaly\" "
             "FROM (SELECT * FROM scored WHERE district = 'NATION_0' "
             "ORDER BY compound_risk_score DESC, year, month LIMIT 10)")


@register("top_risk_months", O.q(_TOP_RISK, ("Month", "IPC Label", "Price Direction", "Anomaly")))
def q_top_risk_months(spark, sf):
    from .operators import display_projection
    d = filter_panel(scored(spark, sf), district="NATION_0")
    return display_projection(top_k(d, [F.col("compound_risk_score").desc()], 10, ties=["year", "month"]))


@register("alert_download", O.q("SELECT district, region, pred_ipc_phase, pred_ipc_label, pred_ipc_confidence, "
                                "pred_ipc_action, pred_price_direction, is_anomaly, compound_risk_score FROM latest",
                                ("district", "region", "pred_ipc_label", "pred_ipc_action", "pred_price_direction")))
def q_alert_download(spark, sf):
    from .operators import DOWNLOAD_COLUMNS
    return latest_period(scored(spark, sf)).select(*DOWNLOAD_COLUMNS)


def _tier_sql() -> str:
    W, P = V.WEATHER_MESSAGES, V.PRICE_MESSAGES

    def weather(style):
        m = W[style]
        if style == "bulletin":
            return (f"CASE WHEN rainfall_anomaly_pct < -20 THEN '{m['dry']}' WHEN rainfall_anomaly_pct > 50 "
                    f"THEN '{m['wet']}' ELSE '{m['other']}' END")
        return (f"CASE WHEN coalesce(flood_flag, 0) = 1 THEN '{m['wet']}' WHEN rainfall_anomaly_pct < -30 "
                f"THEN '{m['dry']}' ELSE '{m['other']}' END")

    def price(style):
        m = P[style]
        out = f"CASE WHEN contains(coalesce(pred_price_direction, ''), 'Rising') THEN '{m['rising']}' "
        if m["falling"] is not None:
            out += f"WHEN contains(coalesce(pred_price_direction, ''), 'Falling') THEN '{m['falling']}' "
        return out + f"ELSE '{m['other']}' END"
    return ("SELECT district, year, month, "
            "CASE WHEN pred_ipc_phase >= 3 THEN 'crisis' WHEN coalesce(is_anomaly, 0) = 1 THEN 'unusual' "
            "WHEN pred_ipc_phase = 2 THEN 'stressed' ELSE 'minimal' END AS tier, "
            "coalesce(pred_ipc_phase < 3 AND is_anomaly = 1, false) AS unusual, "
            "coalesce(pred_ipc_phase = 2, false) AS stressed, "
            + ", ".join(f"{weather(s)} || ' ' || {price(s)} AS message_{s}" for s in ("bulletin", "notebook", "dashboard"))
            + " FROM recent")


@register("farmer_messages", O.q(_tier_sql(), ("district", "tier", "unusual", "stressed", "message_bulletin", "message_notebook",
                                                "message_dashboard")))
def q_farmer_messages(spark, sf):
    from .functions import is_stressed, is_unusual, price_message, risk_tier, weather_message
    r = trailing_months(scored(spark, sf), 12)
    return r.select("district", "year", "month", risk_tier().alias("tier"), is_unusual().alias("unusual"),
                    is_stressed().alias("stressed"), *[
        F.concat(weather_message(style=s), F.lit(" "), price_message(style=s)).alias(f"message_{s}")
        for s in ("bulletin", "notebook", "dashboard")])


@register("split_counts", O.q(
    "SELECT label, split, CASE split WHEN 'test' THEN k ELSE n - k END AS n "
    "FROM (SELECT label, n, CAST(floor(n * 0.2::DOUBLE + 0.5::DOUBLE) AS BIGINT) AS k, unnest(['test', 'train']) AS split "
    "FROM (SELECT CASE WHEN month = 1 THEN NULL ELSE ipc_phase END AS label, count(*) AS n FROM features GROUP BY 1)) "
    "WHERE CASE split WHEN 'test' THEN k ELSE n - k END > 0", ("split", "label")))
def q_split_counts(spark, sf):
    """Rows per class and side of the stratified split; January rows have no label."""
    from .models.split import stratified_split
    f = S.features(spark, sf).select("district", "year", "month", "ipc_phase").withColumn(
        "label", F.when(F.col("month") != 1, F.col("ipc_phase")))
    out = stratified_split(f, "label", ["district", "year", "month"], 0.2, 42)
    return out.groupBy("label", "split").agg(F.count("*").alias("n"))


@register("confusion_matrix", O.r6("WITH " + O.CTE.strip() + _PERSIST +
    "SELECT y, " + ", ".join(f"count(*) FILTER (WHERE pred = {c}) AS \"{c}\"" for c in (1, 2, 3, 4)) +
    " FROM persist GROUP BY y"))
def q_confusion_matrix(spark, sf):
    from .models.metrics import confusion_matrix
    return confusion_matrix(_persistence(spark, sf), [1, 2, 3, 4], "y", "pred")


_SUMMARY = (
    ", tot AS (SELECT count(*) AS n FROM scored), "
    "d AS (SELECT pred_ipc_phase, count(*) AS n FROM scored GROUP BY pred_ipc_phase), "
    "lines AS ("
    f"SELECT 0 AS section, 0.0::DOUBLE AS k1, 'a' AS k2, '{'=' * 60}' AS value "
    f"UNION ALL SELECT 0, 1.0::DOUBLE, 'b', {O.lit(V.SUMMARY_TITLE)} "
    f"UNION ALL SELECT 0, 2.0::DOUBLE, 'c', printf({O.lit(V.SUMMARY_DATA_LINE)}, min(year), max(year), "
    "count(DISTINCT region)) FROM scored "
    f"UNION ALL SELECT 0, 3.0::DOUBLE, 'd', '{'=' * 60}' "
    "UNION ALL SELECT 0, 4.0::DOUBLE, 'e', '' "
    f"UNION ALL SELECT 1, -1e9::DOUBLE, '', {O.lit(V.SUMMARY_DIST_HEADER)} "
    "UNION ALL SELECT 1, 1e9::DOUBLE, '', '' "
    f"UNION ALL SELECT 2, -1e9::DOUBLE, '', {O.lit(V.SUMMARY_TOP_HEADER)} "
    "UNION ALL SELECT 2, 1e9::DOUBLE, '', '' "
    f"UNION ALL SELECT 3, -1e9::DOUBLE, '', printf({O.lit(V.SUMMARY_LATEST_HEADER)}, strftime(make_date(year, month, 1), '%B %Y')) "
    "FROM (SELECT year, month FROM latest LIMIT 1) "
    f"UNION ALL SELECT 1, CAST(pred_ipc_phase AS DOUBLE), '', printf('    %s Phase %d — %-12s: %5s months (%s%%)  %s', "
    f"{O._ICON}, pred_ipc_phase, {O._LABEL}, format('{{:,}}', n), "
    f"{O.fmt('%4.1f', 'n * 100.0::DOUBLE / (SELECT n FROM tot)')}, "
    "repeat('█', CAST(trunc(n * 100.0::DOUBLE / (SELECT n FROM tot) / 2.0::DOUBLE) AS INTEGER))) FROM d "
    f"UNION ALL SELECT * FROM (SELECT 2, CAST(-count(*) AS DOUBLE), region, printf({O.lit(V.SUMMARY_TOP_LINE)}, "
    "region, count(*)) FROM scored WHERE is_anomaly = 1 GROUP BY region ORDER BY count(*) DESC, region LIMIT 5) "
    "UNION ALL SELECT 3, CAST(-pred_ipc_phase AS DOUBLE), district, "
    f"printf({O.lit(V.SUMMARY_LATEST_LINE)}, {O._ICON}, district, region, pred_ipc_phase, "
    f"pred_ipc_label, pred_price_direction, CASE WHEN is_anomaly = 1 THEN {O.lit(V.SUMMARY_ANOMALY_MARK)} ELSE '' END) FROM latest) "
    "SELECT section, k1, k2, value FROM lines")


@register("summary_lines", O.r6("WITH " + O.CTE.strip() + _SUMMARY, ("k2", "value")))
def q_summary_lines(spark, sf):
    return R.summary_lines(scored(spark, sf))


_MASTER_PROFILE_COLS = sorted(
    ["region", "district", "year", "month", "rainfall_mm", "rainfall_anomaly_pct", "flood_flag",
     "drought_flag", *O.FAMILIES, "price_lag1", "price_change_pct", "price_volatility_3m",
     "price_shock_flag", "conflict_events", "fatalities_total", "flood_displace_events",
     "conflict_events_lag1", "flood_displace_lag1", "high_conflict_flag", "season_phase",
     "is_lean_season", "district_vulnerability", "ipc_phase", "flood_price_interaction",
     "compound_risk_flag"])
_DTYPE = ("CASE typeof(min({c})) WHEN 'DOUBLE' THEN 'float64' WHEN 'VARCHAR' THEN 'object' "
          "WHEN 'BOOLEAN' THEN 'bool' ELSE 'int64' END")
_REPORT_SQL = " UNION ALL ".join(
    f"SELECT {i + 1} AS seq, printf({O.lit(V.FEATURE_REPORT_LINE)}, {i + 1}, '{c}', {_DTYPE.format(c=c)}, "
    f"CAST(sum(CAST({c} IS NULL AS BIGINT)) AS BIGINT)) AS value FROM master"
    for i, c in enumerate(_MASTER_PROFILE_COLS))


@register("feature_report", O.q(_REPORT_SQL, ("value",)))
def q_feature_report(spark, sf):
    return R.feature_report(S.master(spark, sf))


@register("run_summary", O.q(
    "SELECT count(DISTINCT district) AS districts, count(DISTINCT region) AS regions, count(*) AS rows, "
    "min(year) AS year_min, max(year) AS year_max FROM master"))
def q_run_summary(spark, sf):
    return R.run_summary(S.rain_spine(spark, sf))


_EVAL = """
, t AS (
  SELECT price_change_pct AS pred,
         lead(price_change_pct) OVER (PARTITION BY district ORDER BY year, month) AS y FROM master
  QUALIFY y IS NOT NULL AND pred IS NOT NULL AND abs(y) <= 200),
rm AS (
  SELECT avg(abs(y - pred)) AS mae,
         1 - sum((y - pred) * (y - pred)) / sum((y - (SELECT avg(y) FROM t)) * (y - (SELECT avg(y) FROM t))) AS r2
  FROM t),
acc AS (SELECT avg(CAST(y = pred AS DOUBLE)) AS accuracy FROM persist),
m AS (
  SELECT 'persistence phase' AS model, 'accuracy' AS metric, accuracy AS value FROM acc
  UNION ALL SELECT 'persistence price', 'mae', mae FROM rm
  UNION ALL SELECT 'persistence price', 'r2', r2 FROM rm)
"""


_EVAL_VALUE = f"printf({O.lit(V.EVALUATION_LINE)}, model, metric, value::DOUBLE)"


@register("evaluation_lines", O.np_rounds("WITH " + O.CTE.strip() + _PERSIST + _EVAL +
                                          f"SELECT model, metric, {_EVAL_VALUE} AS value FROM m"))
def q_evaluation_lines(spark, sf):
    from .models.metrics import regression_metrics
    p = _persistence(spark, sf)
    acc = p.agg(F.avg((F.col("y") == F.col("pred")).cast("double")).alias("value")).select(
        F.lit("persistence phase").alias("model"), F.lit("accuracy").alias("metric"), "value")
    m = add_lead(S.master(spark, sf), "price_change_pct", "y").withColumnRenamed("price_change_pct", "pred")
    m = filter_abs_le(m.filter(F.col("y").isNotNull() & F.col("pred").isNotNull()), "y", 200)
    rm = regression_metrics(m, "y", "pred")
    reg = rm.select(F.inline(F.array(
        F.struct(F.lit("persistence price").alias("model"), F.lit("mae").alias("metric"), F.col("mae").alias("value")),
        F.struct(F.lit("persistence price").alias("model"), F.lit("r2").alias("metric"), F.col("r2").alias("value")))))
    return R.evaluation_lines(acc.unionByName(reg))


# ---- 14. W4, M17, S6, streaming refresh ------------------------------------------

@register("pct_change_district", O.q(
    "SELECT district, year, month, (rainfall_mm - lag(rainfall_mm) OVER w) / lag(rainfall_mm) OVER w "
    "* 100.0::DOUBLE AS rainfall_change_pct FROM master WINDOW w AS (PARTITION BY district ORDER BY year, month)",
    ("district",)))
def q_pct_change_district(spark, sf):
    from .operators import pct_change
    m = S.rain_spine(spark, sf).select("district", "year", "month", "rainfall_mm")
    return pct_change(m, "rainfall_mm", "rainfall_change_pct", key="district", digits=None).drop("rainfall_mm")


@register("top_anomalies", O.q(
    "SELECT district, region, year, month, anomaly_score, ipc_phase FROM scored WHERE is_anomaly = 1 "
    "ORDER BY anomaly_score DESC, district, year, month LIMIT 10", ("district", "region")))
def q_top_anomalies(spark, sf):
    sc = scored(spark, sf).where(F.col("is_anomaly") == 1).select(
        "district", "region", "year", "month", "anomaly_score", "ipc_phase")
    return top_k(sc, [F.col("anomaly_score").desc()], 10, ties=["district", "year", "month"])


@register("stage_table_filter", O.q(
    "SELECT district, year, month, ipc_phase FROM master WHERE year BETWEEN 1998 AND 1999", ("district",)))
def q_stage_table_filter(spark, sf):
    from .session import stage_path
    from .sources import write_stage
    import uuid
    st = write_stage(S.master(spark, sf).select("district", "year", "month", "ipc_phase"),
                     stage_path(spark, "master-" + uuid.uuid4().hex))
    return filter_panel(st, years=(1998, 1999)).select("district", "year", "month", "ipc_phase")


@register("conflict_streamed", O.q(
    "SELECT region, year, month, conflict_events, fatalities_total, flood_displace_events, "
    "conflict_events_lag1, flood_displace_lag1, high_conflict_flag FROM conflict", ("region",)))
def q_conflict_streamed(spark, sf):
    """The events stand-in landed as CSV files, ingested by the incremental
    stream (two availableNow runs over two landings), then re-aggregated."""
    import uuid
    from .session import stage_path
    from .streaming import conflict_from_partials, start_refresh
    base = stage_path(spark, "stream-" + uuid.uuid4().hex)
    ev = S.events_raw(spark, sf).select(
        "event_id_cnty", F.col("event_date").cast("string").alias("event_date"),
        F.lit(None).cast("string").alias("year"), "event_type", F.lit(None).cast("string").alias("sub_event_type"),
        "admin1", F.lit(None).cast("string").alias("admin2"), F.lit(None).cast("string").alias("location"),
        F.lit(None).cast("string").alias("latitude"), F.lit(None).cast("string").alias("longitude"),
        F.col("fatalities").cast("string").alias("fatalities"), F.lit(None).cast("string").alias("notes"))
    first = F.month(F.to_date("event_date")) <= 6
    for i, part in enumerate((ev.where(first), ev.where(~first))):
        part.write.mode("append").option("header", True).csv(f"{base}/landing")
        start_refresh(spark, f"{base}/landing", f"{base}/partials", f"{base}/ckpt").awaitTermination()
    return conflict_from_partials(spark, f"{base}/partials")


def _landing(spark) -> str:
    import uuid
    from .session import stage_path
    return stage_path(spark, "landing-" + uuid.uuid4().hex)


@register("landed_pages", O.q(
    "SELECT region, CAST(year(date) AS INTEGER) AS year, count(*) AS n_rows, "
    "count(event_id_cnty) AS n_events, sum(fatalities) AS fatalities FROM ev_raw GROUP BY 1, 2", ("region",)))
def q_landed_pages(spark, sf):
    """Events landed as JSON pages, read back and appended."""
    from .sources import EVENT_FIELDS, read_event_pages
    ev = S.events_raw(spark, sf)
    cells = [(F.col(f).cast("string") if f in ev.columns else F.lit(None).cast("string")).alias(f)
             for f in EVENT_FIELDS]
    path = _landing(spark)
    ev.select(F.array(F.struct(*cells)).alias("data")).write.json(path)  # a page per line, landed without a shuffle
    got = read_event_pages(spark, path, multiline=False)
    return got.groupBy(F.trim("admin1").alias("region"), F.year(parse_date("event_date")).alias("year")).agg(
        F.count("*").alias("n_rows"), F.count("event_id_cnty").alias("n_events"),
        F.sum(parse_double("fatalities")).alias("fatalities"))


@register("landed_csv", O.q(
    "SELECT region, district, count(*) AS n, min(date) AS date_min, max(date) AS date_max, sum(rfh) AS rfh FROM rain_raw "
    "WHERE contains(lower(region), 'ame') GROUP BY 1, 2",
    ("region", "district", "date_min", "date_max")))
def q_landed_csv(spark, sf):
    """Rainfall landed as CSV with a tag row (a second landing does nothing), read back
    as text, the tag row dropped, one country kept."""
    from .sources import RAINFALL_RAW, drop_tag_rows, read_table, save_if_absent, subset_country
    rain = S.rain_raw(spark, sf)
    rain = rain.select(*[(F.col(f.name).cast("string") if f.name in rain.columns else F.lit(None).cast("string"))
                         .alias(f.name) for f in RAINFALL_RAW])
    tag = spark.createDataFrame([("#date", "#adm1", "#adm2", "#rain", *[None] * 8)], RAINFALL_RAW)
    path = _landing(spark)
    for _ in range(2):
        rain.unionByName(tag).write.mode("ignore").option("header", True).csv(path)
    kept = _landing(spark)
    for _ in range(2):
        save_if_absent(subset_country(drop_tag_rows(read_table(spark, path, RAINFALL_RAW)), "ame", "adm1_name"), kept)
    got = read_table(spark, kept, fmt="parquet")
    return got.groupBy(F.trim("adm1_name").alias("region"), F.trim("adm2_name").alias("district")).agg(
        F.count("*").alias("n"), F.min(parse_date("date")).alias("date_min"),
        F.max(parse_date("date")).alias("date_max"), F.sum(parse_double("rfh")).alias("rfh"))


@register("label_index", O.q(
    "SELECT district, year, month, ipc_phase, CAST(dense_rank() OVER (ORDER BY ipc_phase) - 1 AS DOUBLE) AS label_idx "
    "FROM features", ("district",)))
def q_label_index(spark, sf):
    """M1: contiguous index of the phases that occur."""
    from pyspark.ml.feature import StringIndexer
    f = S.features(spark, sf).select("district", "year", "month", "ipc_phase", F.col("ipc_phase").cast("string").alias("label"))
    return StringIndexer(inputCol="label", outputCol="label_idx", stringOrderType="alphabetAsc").fit(f).transform(f).drop("label")


_SCALED = ("rainfall_anomaly_pct", "price_change_pct", "conflict_events")


@register("standardise", O.q(
    "SELECT district, year, month, " + ", ".join(
        f"(coalesce({c}, 0) - avg(coalesce({c}, 0)) OVER ()) / stddev_pop(coalesce({c}, 0)) OVER () AS z_{c}"
        for c in ("rainfall_anomaly_pct", "price_change_pct", "conflict_events")) + " FROM features", ("district",)))
def q_standardise(spark, sf):
    """M7: mean 0 and population deviation 1, missing values as 0."""
    from .models.forest import apply_scaler, fit_scaler
    f = S.features(spark, sf)
    return apply_scaler(f, fit_scaler(f, _SCALED)).select("district", "year", "month", *[f"z_{c}" for c in _SCALED])


_CHOICE = ("rainfall_mm", "price_change_pct", "price_volatility_3m", "flood_flag", "drought_flag", "month")


@register("feature_choice", O.q(
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, min({c}) < max({c}) AS varies, "
        f"count({c}) * 1.0::DOUBLE / count(*) > 0.99::DOUBLE AS covered FROM features"
        for c in ("rainfall_mm", "price_change_pct", "price_volatility_3m", "flood_flag", "drought_flag", "month")),
    round6=False))
def q_feature_choice(spark, sf):
    """Which columns vary, and which are known in over 99 % of rows."""
    from .operators import select_covered, select_features
    f = S.features(spark, sf).select(*_CHOICE)
    varies, covered = select_features(f), select_covered(f, _CHOICE, 0.99)
    return spark.createDataFrame([(c, c in varies, c in covered) for c in _CHOICE],
                                 "feature string, varies boolean, covered boolean")


# ---- raw overview tables (A10, A11, A16 on the raw rows) ---------------------------

@register("raw_rain_histogram", O.q(
    ", b AS (SELECT min(rfh) AS lo, max(rfh) AS hi FROM rain_raw), "
    "h AS (SELECT CAST(CASE WHEN hi = lo THEN 1 ELSE least(CAST(floor(60.0::DOUBLE * (rfh - lo) / (hi - lo)) "
    "AS BIGINT) + 1, 60) END AS INTEGER) AS bin FROM rain_raw JOIN b ON true WHERE rfh IS NOT NULL) "
    "SELECT bin, count(*) AS count, (SELECT lo FROM b) + (bin - 1) * (((SELECT hi FROM b) - (SELECT lo FROM b)) "
    "/ 60.0::DOUBLE) AS lo, (SELECT lo FROM b) + bin * (((SELECT hi FROM b) - (SELECT lo FROM b)) / 60.0::DOUBLE) "
    "AS hi FROM h GROUP BY bin"))
def q_raw_rain_histogram(spark, sf):
    """Readings in 60 bins; joined once, one column of it read twice."""
    return histogram(cut_lineage(S.rain_raw(spark, sf).select("rfh")), "rfh", 60)


@register("raw_price_by_commodity", O.q(
    "SELECT commodity_clean AS commodity, avg(price) AS mean_price FROM price_raw GROUP BY 1", ("commodity",)))
def q_raw_price_by_commodity(spark, sf):
    """A10: mean price of each raw commodity name."""
    return mean_by(S.prices_raw(spark, sf), "commodity", "price", "mean_price")


@register("raw_events_by_type", O.q(
    "SELECT CASE l_returnflag WHEN 'R' THEN 'Flood displacement' WHEN 'A' THEN 'Protests' WHEN 'N' THEN 'Battles' END "
    "AS event_type, count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN geo ON s_nationkey = n_nationkey "
    "GROUP BY 1", ("event_type",)))
def q_raw_events_by_type(spark, sf):
    """Events of each type."""
    return S.events_raw(spark, sf).groupBy("event_type").agg(F.count("*").alias("n"))


# ---- 15. remaining dashboard chart tables (A10, A11, A15) --------------------------

@register("mean_phase_by_month", O.q("SELECT month, avg(pred_ipc_phase) AS mean_pred_ipc_phase FROM scored "
                                     "GROUP BY month"))
def q_mean_phase_by_month(spark, sf):
    return mean_by(scored(spark, sf), "month", "pred_ipc_phase")


@register("price_series", O.q(
    "SELECT year, month, avg(price_change_pct) AS mean_price_change_pct, "
    "year + (month - 1) / 12.0::DOUBLE AS date_n FROM scored GROUP BY year, month "
    "HAVING avg(price_change_pct) IS NOT NULL", digits=9), digits=9)
def q_price_series(spark, sf):
    return period_series(scored(spark, sf), "price_change_pct")


@register("flood_by_year", O.q("SELECT year, CAST(sum(flood_flag) AS BIGINT) AS flood_months FROM scored "
                               "GROUP BY year"))
def q_flood_by_year(spark, sf):
    return sum_by(S.rain_spine(spark, sf), "year", "flood_flag", "flood_months")


_DOC = _BULLETIN.replace(
    "SELECT region, district, year, month, pred_ipc_phase, CAST(u.pos - 1 AS INTEGER) AS line_no, u.value AS value\n"
    "FROM items, LATERAL (SELECT unnest(lines) AS value, generate_subscripts(lines, 1) AS pos) u",
    ", body AS (SELECT region, district, year, month, pred_ipc_phase, CAST(u.pos - 1 AS INTEGER) AS line_no, "
    "u.value AS value FROM items, LATERAL (SELECT unnest(lines) AS value, generate_subscripts(lines, 1) AS pos) u), "
    "nb AS (SELECT count(*) AS n FROM body WHERE line_no = 0), "
    "title AS (SELECT strftime(make_date(year, month, 1), '%B %Y') AS t FROM latest LIMIT 1), "
    f"head AS (SELECT unnest(['{'=' * 60}', {O.lit(V.BULLETIN_TITLE)}, printf({O.lit(V.BULLETIN_PERIOD)}, t), "
    f"'{'=' * 60}', '', CASE WHEN n = 0 THEN '{V.BULLETIN_NONE}' ELSE replace('{V.BULLETIN_FLAGGED}', '{{n}}', "
    "CAST(n AS VARCHAR)) END, '']) AS value, generate_subscripts(['', '', '', '', '', '', ''], 1) - 1 AS line_no "
    "FROM title, nb) "
    "SELECT 0 AS part, 0 AS k_phase, '' AS region, '' AS district, 0 AS year, 0 AS month, "
    "CAST(line_no AS INTEGER) AS line_no, value FROM head UNION ALL "
    "SELECT 1, -pred_ipc_phase, region, district, year, month, line_no, value FROM body")
assert _DOC != _BULLETIN


@register("bulletin_document", O.r6("WITH " + O.CTE.strip() + _DOC, ("region", "district", "value")))
def q_bulletin_document(spark, sf):
    return R.bulletin_document(scored(spark, sf))


@register("conflict_lag_calendar", O.q(
    "SELECT a.region, a.year, a.month, a.conflict_events, coalesce(b.conflict_events, 0) AS conflict_events_lag1 "
    "FROM ev_month a LEFT JOIN ev_month b ON a.region = b.region "
    "AND b.year * 12 + b.month = a.year * 12 + a.month - 1", ("region",)))
def q_conflict_lag_calendar(spark, sf):
    """W1 with calendar=True: the previous calendar month, 0 when it had no events."""
    from .plans.clean import clean_conflict_from_monthly
    monthly = S.cut_monthly_events(spark, sf)
    return clean_conflict_from_monthly(monthly, calendar=True).select(
        "region", "year", "month", "conflict_events", "conflict_events_lag1")


# ---- 13. models (rows-only checks) -------------------------------------------------

def _register_models():
    from .models import queries as MQ
    for name, fn in MQ.MODEL_QUERIES.items():
        QUERIES[name] = fn


_register_models()

from . import queries_upkeep  # noqa: E402,F401  (registers its queries)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
