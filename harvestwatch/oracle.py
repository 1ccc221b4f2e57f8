"""DuckDB SQL for every registered query (the correctness oracle).

Plain SQL over the benchmark tables.  Calendars, families, labels, actions and
thresholds are written out here, texts, formats and stand-in parameters in
``oracle_values``, so that a wrong value in the code under test shows as a
mismatch.  Literals that mix with doubles carry ``::DOUBLE`` (a bare ``0.3`` is
DECIMAL).  ``printf`` rounds from the exact binary value, as the source's formats do.
"""

from __future__ import annotations

from . import oracle_values as V


def _in(vals) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in vals) + ")"


def _case_map(col: str, mapping: dict) -> str:
    whens = " ".join(f"WHEN {k!r} THEN '{v.replace(chr(39), chr(39) * 2)}'" if isinstance(k, str)
                     else f"WHEN {k} THEN '{v.replace(chr(39), chr(39) * 2)}'" for k, v in mapping.items())
    return f"CASE {col} {whens} END"


def lit(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


def fmt(form: str, x: str) -> str:
    """Fixed-point text of a double, rounded from its exact binary value."""
    return f"printf('{form}', CAST({x} AS DOUBLE))"


def _split_args(body: str):
    depth, start, out = 0, 0, []
    for i, ch in enumerate(body):
        if ch in "([":
            depth += 1
        elif ch in ")]":
            depth -= 1
        elif ch == "," and depth == 0:
            out.append(body[start:i])
            start = i + 1
    out.append(body[start:])
    return out


def np_rounds(sql: str) -> str:
    """Rewrite ``nround(x, n)`` into numpy-style rounding,
    ``round_even(x * 10^n, 0) / 10^n`` (what pandas ``.round(n)`` does)."""
    key = "nround("
    while True:
        i = sql.rfind(key)
        if i < 0:
            return sql
        j, depth = i + len(key), 1
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[j], 0)
            j += 1
        x, n = _split_args(sql[i + len(key):j - 1])
        scale = f"{10 ** int(n.strip())}.0::DOUBLE"
        sql = sql[:i] + f"(round_even(({x}) * {scale}, 0) / {scale})" + sql[j:]


def r6(sql: str, text_cols=(), digits: int = 6) -> str:
    """Round every numeric output column to 6 places (ints unchanged)."""
    sql = np_rounds(sql)
    if text_cols:
        keep = _in(text_cols)
        return (f"SELECT round(COLUMNS(lambda c: c NOT IN {keep}), {digits}), "
                f"COLUMNS(lambda c: c IN {keep}) FROM ({sql}) q")
    return f"SELECT round(COLUMNS(*), {digits}) FROM ({sql}) q"


NORTH = _in(V.STANDIN_NORTH)
VULN = _in(V.STANDIN_VULNERABLE)
COAST = _in(V.STANDIN_COASTAL)
FAMILIES = ["price_maize", "price_millet", "price_sorghum", "price_rice", "price_cowpeas", "price_groundnuts"]


def _season_sql() -> str:
    return (f"CASE WHEN coalesce(region IN {NORTH}, false) THEN "
            "CASE WHEN month BETWEEN 3 AND 5 THEN 'pre_planting' WHEN month IN (6, 7) THEN 'planting' "
            "WHEN month IN (8, 9) THEN 'growing' WHEN month IN (10, 11) THEN 'harvest' ELSE 'lean' END "
            "ELSE CASE WHEN month IN (3, 4) THEN 'planting_s1' WHEN month IN (5, 6) THEN 'growing_s1' "
            "WHEN month = 7 THEN 'harvest_s1' WHEN month = 8 THEN 'inter_season' "
            "WHEN month IN (9, 10) THEN 'growing_s2' WHEN month = 11 THEN 'harvest_s2' ELSE 'lean' END END")


_KW = "regexp_matches(lower(commodity_clean), 'maize|millet|sorghum|rice|cowpeas|groundnuts')"
_FAM = ("CASE WHEN commodity_clean ILIKE '%maize%' THEN 'price_maize' "
        "WHEN commodity_clean ILIKE '%millet%' THEN 'price_millet' "
        "WHEN commodity_clean ILIKE '%sorghum%' THEN 'price_sorghum' "
        "WHEN commodity_clean ILIKE '%rice%' THEN 'price_rice' "
        "WHEN commodity_clean ILIKE '%cowpea%' THEN 'price_cowpeas' "
        "WHEN commodity_clean ILIKE '%groundnut%' THEN 'price_groundnuts' END")
_WIDE = ",\n    ".join(f"avg(price) FILTER (WHERE fam = '{f}') AS {f}" for f in FAMILIES)
_PRICE_COLS = ", ".join(f"p.{f}" for f in FAMILIES)
_SEASON_DUMMIES = ",\n    ".join(f"coalesce(season_phase = '{v}', false) AS season_{v}" for v in (
    "growing", "growing_s1", "growing_s2", "harvest", "harvest_s1", "harvest_s2", "inter_season", "lean", "planting",
    "planting_s1", "pre_planting"))
_LABEL = _case_map("pred_ipc_phase", {1: "Minimal", 2: "Stressed", 3: "Crisis", 4: "Emergency"})
_ACTION_SHORT = _case_map("pred_ipc_phase", {
    1: "Monitor", 2: "Alert field teams — pre-position supplies", 3: "Deploy food stocks and vouchers",
    4: "EMERGENCY — cash transfers NOW"})
_ACTION_LONG = _case_map("pred_ipc_phase", {
    1: "No action needed — continue monitoring", 2: "Alert field teams — pre-position supplies",
    3: "Deploy food stocks and vouchers immediately", 4: "EMERGENCY — deploy cash transfers NOW"})
_ICON = "CASE pred_ipc_phase WHEN 1 THEN '🟢' WHEN 2 THEN '🟡' WHEN 3 THEN '🟠' WHEN 4 THEN '🔴' ELSE '⚪' END"

FILL_COLS = ("rainfall_anomaly_lag1", "rainfall_anomaly_lag2", "rainfall_anomaly_lag3", "price_lag1",
             "rainfall_rolling_3m", "rainfall_rolling_6m", "price_change_lag1", "price_change_lag2",
             "price_volatility_lag1", "price_volatility_lag2")

CTE = f"""
geo AS (
  SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey),
rain_raw AS (
  SELECT CAST(o_orderdate AS DATE) AS date, trim(r_name) AS region, trim(n_name) || ' ' || (c_custkey // 300) AS district,
         o_totalprice AS rfh
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN geo ON c_nationkey = n_nationkey),
rain_mean AS (
  SELECT region, district, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
         nround(avg(rfh), 3) AS rainfall_mm
  FROM rain_raw WHERE date IS NOT NULL AND region IS NOT NULL AND district IS NOT NULL
  GROUP BY 1, 2, 3, 4),
rain_anom AS (
  SELECT *, nround((rainfall_mm / avg(rainfall_mm) OVER (PARTITION BY district) - 1.0::DOUBLE) * 100.0::DOUBLE, 3)
            AS rainfall_anomaly_pct
  FROM rain_mean),
rainfall AS (
  SELECT *, CAST(coalesce(rainfall_anomaly_pct > 50.0::DOUBLE, false) AS INTEGER) AS flood_flag,
            CAST(coalesce(rainfall_anomaly_pct < -40.0::DOUBLE, false) AS INTEGER) AS drought_flag
  FROM rain_anom),
price_raw AS (
  SELECT CAST(l_shipdate AS DATE) AS date, trim(r_name) AS region,
         trim({_case_map('p_type', V.STANDIN_COMMODITY)}) AS commodity_clean,
         l_extendedprice / l_quantity AS price
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN geo ON s_nationkey = n_nationkey
       JOIN part ON l_partkey = p_partkey),
price_long AS (
  SELECT region, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
         commodity_clean, nround(avg(price), 4) AS price
  FROM price_raw
  WHERE date IS NOT NULL AND price > 0 AND ({_KW}) AND region IS NOT NULL
  GROUP BY 1, 2, 3, 4),
price_wide AS (
  SELECT region, year, month,
    {_WIDE}
  FROM (SELECT *, {_FAM} AS fam FROM price_long) GROUP BY 1, 2, 3),
price_lagged AS (
  SELECT *, lag(price_maize) OVER (PARTITION BY region ORDER BY year, month) AS price_lag1 FROM price_wide),
price_chg AS (
  SELECT *, nround((price_maize - price_lag1) / price_lag1 * 100.0::DOUBLE, 2) AS price_change_pct FROM price_lagged),
prices AS (
  SELECT *, nround(stddev_samp(price_change_pct) OVER (PARTITION BY region ORDER BY year, month
                  ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 3) AS price_volatility_3m,
         CAST(coalesce(price_change_pct > 20.0::DOUBLE, false) AS INTEGER) AS price_shock_flag
  FROM price_chg),
ev_raw AS (
  SELECT printf('%d-%d', l_orderkey, l_linenumber) AS event_id_cnty, CAST(l_shipdate AS DATE) AS date,
         trim(r_name) AS region, coalesce(CAST(l_quantity AS DOUBLE), 0.0::DOUBLE) AS fatalities,
         CAST(coalesce(regexp_matches(lower({_case_map('l_returnflag', V.STANDIN_EVENT_TYPE)}),
                                      'flood|displacement|displaced'), false) AS INTEGER) AS is_flood_event
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN geo ON s_nationkey = n_nationkey),
ev_month AS (
  SELECT region, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
         count(event_id_cnty) AS conflict_events,
         coalesce(sum(fatalities), 0.0::DOUBLE) AS fatalities_total,
         CAST(coalesce(sum(is_flood_event), 0) AS BIGINT) AS flood_displace_events
  FROM ev_raw WHERE date IS NOT NULL AND region IS NOT NULL GROUP BY 1, 2, 3),
ev_lagged AS (
  SELECT *, coalesce(lag(conflict_events) OVER w, 0) AS conflict_events_lag1,
            coalesce(lag(flood_displace_events) OVER w, 0) AS flood_displace_lag1
  FROM ev_month WINDOW w AS (PARTITION BY region ORDER BY year, month)),
conflict AS (
  SELECT *, CAST(coalesce(conflict_events >= (SELECT quantile_cont(conflict_events, 0.75) FROM ev_month), false)
                 AS INTEGER) AS high_conflict_flag
  FROM ev_lagged),
joined AS (
  SELECT r.region, r.district, r.year, r.month, r.rainfall_mm, r.rainfall_anomaly_pct, r.flood_flag,
         r.drought_flag, {_PRICE_COLS}, p.price_lag1, p.price_change_pct, p.price_volatility_3m,
         p.price_shock_flag,
         coalesce(c.conflict_events, 0) AS conflict_events,
         coalesce(c.fatalities_total, 0.0::DOUBLE) AS fatalities_total,
         coalesce(c.flood_displace_events, 0) AS flood_displace_events,
         coalesce(c.conflict_events_lag1, 0) AS conflict_events_lag1,
         coalesce(c.flood_displace_lag1, 0) AS flood_displace_lag1,
         coalesce(c.high_conflict_flag, 0) AS high_conflict_flag
  FROM rainfall r
  LEFT JOIN prices p ON r.region = p.region AND r.year = p.year AND r.month = p.month
  LEFT JOIN conflict c ON r.region = c.region AND r.year = c.year AND r.month = c.month
  WHERE r.rainfall_mm IS NOT NULL),
seasoned AS (
  SELECT *, {_season_sql()} AS season_phase FROM joined),
ruled AS (
  SELECT *, CAST(coalesce(season_phase IN ('lean', 'pre_planting'), false) AS INTEGER) AS is_lean_season,
         CASE WHEN coalesce(region IN {VULN}, false) THEN 2 ELSE 1 END AS district_vulnerability
  FROM seasoned),
scored_rule AS (
  SELECT *, ((((((0.0::DOUBLE
      + CASE WHEN coalesce(rainfall_anomaly_pct, 0.0::DOUBLE) < -40 THEN 2
             WHEN coalesce(rainfall_anomaly_pct, 0.0::DOUBLE) < -20 THEN 1
             WHEN coalesce(rainfall_anomaly_pct, 0.0::DOUBLE) > 60 THEN 1 ELSE 0 END)
      + coalesce(flood_flag, 0) * 2)
      + coalesce(drought_flag, 0))
      + CASE WHEN coalesce(price_change_pct, 0.0::DOUBLE) > 30 THEN 3
             WHEN coalesce(price_change_pct, 0.0::DOUBLE) > 15 THEN 2
             WHEN coalesce(price_change_pct, 0.0::DOUBLE) > 5 THEN 1 ELSE 0 END)
      + least(CAST(coalesce(conflict_events, 0) AS DOUBLE), 10.0::DOUBLE) * 0.3::DOUBLE)
      + coalesce(is_lean_season, 0))
      + (coalesce(district_vulnerability, 1) - 1) AS ipc_score
  FROM ruled),
master AS (
  SELECT * EXCLUDE (ipc_score),
    CASE WHEN ipc_score <= 1 THEN 1 WHEN ipc_score <= 3 THEN 2 WHEN ipc_score <= 6 THEN 3 ELSE 4 END AS ipc_phase,
    nround(flood_flag * coalesce(price_change_pct, 0.0::DOUBLE), 3) AS flood_price_interaction,
    CAST((coalesce(flood_flag, 0) = 1 AND coalesce(price_shock_flag, 0) = 1
          AND coalesce(high_conflict_flag, 0) = 1) AS INTEGER) AS compound_risk_flag
  FROM scored_rule),
feat1 AS (
  SELECT *,
    lag(rainfall_anomaly_pct, 1) OVER w AS rainfall_anomaly_lag1,
    lag(rainfall_anomaly_pct, 2) OVER w AS rainfall_anomaly_lag2,
    lag(rainfall_anomaly_pct, 3) OVER w AS rainfall_anomaly_lag3,
    coalesce(lag(flood_flag, 1) OVER w, 0) AS flood_flag_lag1,
    coalesce(lag(flood_flag, 2) OVER w, 0) AS flood_flag_lag2,
    coalesce(lag(flood_flag, 3) OVER w, 0) AS flood_flag_lag3,
    coalesce(lag(drought_flag, 1) OVER w, 0) AS drought_flag_lag1,
    coalesce(lag(drought_flag, 2) OVER w, 0) AS drought_flag_lag2,
    coalesce(lag(drought_flag, 3) OVER w, 0) AS drought_flag_lag3,
    nround(avg(rainfall_mm) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 3) AS rainfall_rolling_3m,
    nround(avg(rainfall_mm) OVER (w ROWS BETWEEN 5 PRECEDING AND CURRENT ROW), 3) AS rainfall_rolling_6m,
    sum(CASE WHEN coalesce(flood_flag = 1, false) THEN 0 ELSE 1 END)
        OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS streak_grp,
    lag(price_change_pct, 1) OVER w AS price_change_lag1,
    lag(price_change_pct, 2) OVER w AS price_change_lag2,
    lag(price_volatility_3m, 1) OVER w AS price_volatility_lag1,
    lag(price_volatility_3m, 2) OVER w AS price_volatility_lag2,
    coalesce(lag(conflict_events, 1) OVER w, 0) AS conflict_lag1,
    coalesce(lag(conflict_events, 2) OVER w, 0) AS conflict_lag2,
    CAST(sum(conflict_events) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS BIGINT) AS conflict_rolling_3m
  FROM master WINDOW w AS (PARTITION BY district ORDER BY year, month)),
feat2 AS (
  SELECT * EXCLUDE (streak_grp, season_phase),
    CAST(CASE WHEN coalesce(flood_flag = 1, false)
         THEN sum(CASE WHEN coalesce(flood_flag = 1, false) THEN 1 ELSE 0 END)
              OVER (PARTITION BY district, streak_grp ORDER BY year, month
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
         ELSE 0 END AS BIGINT) AS flood_streak_months,
    nround(flood_flag_lag1 * coalesce(price_change_pct, 0.0::DOUBLE), 3) AS flood_price_lag1_interact,
    nround(drought_flag * coalesce(price_change_pct, 0.0::DOUBLE), 3) AS drought_price_interact,
    {_SEASON_DUMMIES},
    nround(sin(2 * pi() * month / 12.0::DOUBLE), 4) AS month_sin,
    nround(cos(2 * pi() * month / 12.0::DOUBLE), 4) AS month_cos,
    CAST((year - (SELECT min(year) FROM master)) * 12 + month AS INTEGER) AS time_trend,
    avg(flood_flag) OVER (PARTITION BY region) AS region_flood_freq_hist,
    avg(conflict_events) OVER (PARTITION BY region) AS region_conflict_intensity_hist,
    CASE WHEN coalesce(region IN {NORTH}, false) THEN 0 WHEN coalesce(region IN {COAST}, false) THEN 2
         ELSE 1 END AS region_type,
    nround(((((abs(CASE WHEN rainfall_anomaly_pct IS NULL THEN NULL
                      ELSE least(greatest(rainfall_anomaly_pct, -100.0::DOUBLE), 100.0::DOUBLE) END) * 0.01::DOUBLE
           + flood_flag * 2.0::DOUBLE)
           + least(greatest(coalesce(price_change_pct, 0.0::DOUBLE), 0.0::DOUBLE), 100.0::DOUBLE) * 0.05::DOUBLE)
           + coalesce(conflict_events, 0) * 0.1::DOUBLE)
           + is_lean_season * 1.0::DOUBLE), 3) AS compound_risk_score
  FROM feat1),
features AS (
  SELECT * REPLACE ({', '.join(f'coalesce({c}, 0.0::DOUBLE) AS {c}' for c in FILL_COLS)},
                    coalesce(price_shock_flag, 0) AS price_shock_flag)
  FROM feat2),
pred0 AS (
  SELECT *, CAST(ipc_phase AS INTEGER) AS pred_ipc_phase, 1.0::DOUBLE AS pred_ipc_confidence,
         nround(coalesce(price_change_pct, 0.0::DOUBLE), 2) AS pred_price_change,
         nround(compound_risk_score, 4) AS anomaly_score
  FROM features),
pred1 AS (
  SELECT *, {_LABEL} AS pred_ipc_label, {_ACTION_SHORT} AS pred_ipc_action,
         CASE WHEN pred_price_change > 5.0::DOUBLE THEN '↑ Rising'
              WHEN pred_price_change < -5.0::DOUBLE THEN '↓ Falling' ELSE '→ Stable' END AS pred_price_direction
  FROM pred0),
scored AS (
  SELECT *, CAST(coalesce(anomaly_score > (SELECT quantile_cont(anomaly_score, 0.97) FROM pred1), false)
                 AS INTEGER) AS is_anomaly,
         year * 12 + month - 1 AS pidx
  FROM pred1),
recent AS (
  SELECT * FROM scored WHERE pidx > (SELECT max(pidx) FROM scored) - 12 AND pidx <= (SELECT max(pidx) FROM scored)),
latest AS (
  SELECT * FROM scored WHERE pidx = (SELECT max(pidx) FROM scored))
"""


def q(select: str, text_cols=(), round6: bool = True, digits: int = 6) -> str:
    sql = "WITH " + CTE.strip() + "\n" + select
    return r6(sql, text_cols, digits) if round6 else np_rounds(sql)
