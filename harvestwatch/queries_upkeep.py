"""Registered queries for the upkeep of stage tables: refreshes, re-sent events, missing
months, profiles without look-ahead, quantiles, label counts and distinct counts."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from . import oracle as O
from . import oracle_values as V
from .functions._util import lit_map
from .operators import monthly_mean, with_year_month
from .plans import standin as S
from .queries import register
from .session import cut_lineage, stage_path


def _scratch(spark, name: str) -> str:
    return stage_path(spark, f"{name}-{uuid.uuid4().hex}")


# ---- S6: years replaced after late readings -----------------------------------

_REFRESHED = """
, base AS (SELECT district, avg(rainfall_mm) AS baseline FROM rain_mean WHERE year <= 1993 GROUP BY 1),
anom AS (
  SELECT m.*, nround((rainfall_mm / baseline - 1.0::DOUBLE) * 100.0::DOUBLE, 3) AS rainfall_anomaly_pct
  FROM rain_mean m LEFT JOIN base b ON m.district = b.district),
flagged AS (
  SELECT *, CAST(coalesce(rainfall_anomaly_pct > 50.0::DOUBLE, false) AS INTEGER) AS flood_flag,
            CAST(coalesce(rainfall_anomaly_pct < -40.0::DOUBLE, false) AS INTEGER) AS drought_flag FROM anom),
grouped AS (
  SELECT *, sum(1 - flood_flag) OVER (PARTITION BY district ORDER BY year, month ROWS UNBOUNDED PRECEDING) AS g FROM flagged)
SELECT region, district, year, month, rainfall_mm, rainfall_anomaly_pct, flood_flag, drought_flag,
  lag(rainfall_anomaly_pct, 1) OVER w AS rainfall_anomaly_lag1, lag(rainfall_anomaly_pct, 2) OVER w AS rainfall_anomaly_lag2,
  lag(rainfall_anomaly_pct, 3) OVER w AS rainfall_anomaly_lag3,
  coalesce(lag(flood_flag, 1) OVER w, 0) AS flood_flag_lag1, coalesce(lag(flood_flag, 2) OVER w, 0) AS flood_flag_lag2,
  coalesce(lag(flood_flag, 3) OVER w, 0) AS flood_flag_lag3,
  coalesce(lag(drought_flag, 1) OVER w, 0) AS drought_flag_lag1, coalesce(lag(drought_flag, 2) OVER w, 0) AS drought_flag_lag2,
  coalesce(lag(drought_flag, 3) OVER w, 0) AS drought_flag_lag3,
  nround(avg(rainfall_mm) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 3) AS rainfall_rolling_3m,
  nround(avg(rainfall_mm) OVER (w ROWS BETWEEN 5 PRECEDING AND CURRENT ROW), 3) AS rainfall_rolling_6m,
  CAST(CASE WHEN flood_flag = 1 THEN sum(flood_flag) OVER (PARTITION BY district, g ORDER BY year, month ROWS UNBOUNDED PRECEDING)
       ELSE 0 END AS BIGINT) AS flood_streak_months
FROM grouped WINDOW w AS (PARTITION BY district ORDER BY year, month)"""


def _readings(spark, sf):
    raw = S.rain_raw(spark, sf)
    return raw.select(F.to_date("date").alias("date"), F.trim("adm1_name").alias("region"),
                      F.trim("adm2_name").alias("district"), "rfh").dropna(subset=["date"])


def _monthly(readings):
    return monthly_mean(with_year_month(readings), ["region", "district", "year", "month"], {"rfh": "rainfall_mm"}, 3)


@register("features_refreshed", O.q(_REFRESHED, ("region", "district")))
def q_features_refreshed(spark, sf):
    """A first landing without one month and with half of another, then a refresh of those two
    months: equal to a rebuild from all readings."""
    from .plans.incremental import build, refresh, with_anomaly
    readings = _readings(spark, sf)
    months = F.date_format("date", "yyyy-MM")
    late = (months == "1996-05") | ((months == "1994-02") & (F.dayofmonth("date") > 15))
    first = cut_lineage(_monthly(readings.where(~late)))
    baseline = cut_lineage(first.where("year <= 1993").groupBy("district").agg(F.avg("rainfall_mm").alias("baseline")))
    table = build(spark, _scratch(spark, "features-by-year"), with_anomaly(first, baseline))
    # only the months concerned are read again from the readings
    again = readings.where(F.col("date").between("1994-02-01", "1994-02-28") | F.col("date").between("1996-05-01", "1996-05-31"))
    refresh(table, with_anomaly(_monthly(again), baseline))
    return table.read()


# ---- J4: missing months filled ---------------------------------------------------

@register("panel_densified", O.q("""
, urgent AS (
  SELECT trim(r_name) AS region, trim(n_name) || ' ' || (c_custkey // 300) AS district,
         year(o_orderdate) * 12 + month(o_orderdate) - 1 AS p,
         nround(avg(o_totalprice), 3) AS rainfall_mm
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN geo ON c_nationkey = n_nationkey
  WHERE o_orderpriority = '1-URGENT' GROUP BY ALL),
spine AS (SELECT region, district, unnest(generate_series(min(p), max(p))) AS p FROM urgent GROUP BY 1, 2),
dense AS (
  SELECT s.*, u.rainfall_mm, CASE WHEN u.rainfall_mm IS NULL THEN NULL ELSE s.p END AS q
  FROM spine s LEFT JOIN urgent u ON s.region = u.region AND s.district = u.district AND s.p = u.p),
looked AS (
  SELECT *, last_value(rainfall_mm IGNORE NULLS) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS rainfall_carried,
    last_value(rainfall_mm IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS av,
    last_value(q IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ap,
    first_value(rainfall_mm IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS bv,
    first_value(q IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS bp
  FROM dense WINDOW w AS (PARTITION BY region, district ORDER BY p))
SELECT region, district, CAST(p // 12 AS INTEGER) AS year, CAST(p % 12 + 1 AS INTEGER) AS month, rainfall_mm,
  CAST(rainfall_mm IS NOT NULL AS INTEGER) AS known, rainfall_carried,
  CASE WHEN rainfall_mm IS NOT NULL THEN rainfall_mm ELSE av + (bv - av) * ((p - ap) / (bp - ap)) END AS rainfall_line,
  CASE WHEN rainfall_mm IS NOT NULL THEN rainfall_mm WHEN bp - ap - 1 <= 1 THEN av + (bv - av) * ((p - ap) / (bp - ap)) END AS rainfall_line_1
FROM looked""", ("region", "district")))
def q_panel_densified(spark, sf):
    """Monthly means of urgent orders only, which many districts lack in some months."""
    from .operators import carry_forward, densify, interpolate
    from .sources.driver import table
    key = ["region", "district"]
    urgent = table(spark, sf, "orders").where("o_orderpriority = '1-URGENT'").select("o_custkey", "o_orderdate", "o_totalprice")
    c, g = table(spark, sf, "customer").select("c_custkey", "c_nationkey"), S._geo(spark, sf)
    rows = urgent.join(c, F.col("o_custkey") == c.c_custkey).join(g, F.col("c_nationkey") == g.n_nationkey).select(
        F.to_date("o_orderdate").alias("date"), F.trim("r_name").alias("region"), S.district_name().alias("district"),
        F.col("o_totalprice").alias("rfh"))
    dense = densify(cut_lineage(_monthly(rows)), key)
    dense = carry_forward(dense, {"rainfall_mm": "rainfall_carried"}, 2, key)
    dense = interpolate(dense, {"rainfall_mm": "rainfall_line"}, key)
    return interpolate(dense, {"rainfall_mm": "rainfall_line_1"}, key, max_gap=1)


# ---- W10 / J2: profile of strictly earlier months -------------------------------

@register("group_profile_asof", O.q("""
, months AS (
  SELECT region, year * 12 + month AS p, sum(flood_flag) AS sf, count(flood_flag) AS nf, sum(conflict_events) AS sc,
         count(conflict_events) AS nc FROM master GROUP BY 1, 2),
upto AS (
  SELECT region, p, sum(sf) OVER w / sum(nf) OVER w AS f, sum(sc) OVER w / sum(nc) OVER w AS c
  FROM months WINDOW w AS (PARTITION BY region ORDER BY p RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT m.region, m.district, m.year, m.month, f::DOUBLE AS region_flood_freq_hist, c::DOUBLE AS region_conflict_intensity_hist
FROM master m JOIN upto u ON m.region = u.region AND m.year * 12 + m.month = u.p""", ("region", "district")))
def q_group_profile_asof(spark, sf):
    """The region's history before each month: no month sees itself or what follows."""
    from .operators import with_group_mean
    m = S.master(spark, sf).select("region", "district", "year", "month", "flood_flag", "conflict_events")
    return with_group_mean(m, "region", {"flood_flag": "region_flood_freq_hist",
                                         "conflict_events": "region_conflict_intensity_hist"}, asof=True).drop(
        "flood_flag", "conflict_events")


# ---- A5: exact quantiles of a raw column ------------------------------------------

@register("raw_quantiles", O.q("""
SELECT q.q::DOUBLE AS q, CASE q.q WHEN 0.5 THEN quantile_cont(l_extendedprice / l_quantity, 0.5)
    WHEN 0.75 THEN quantile_cont(l_extendedprice / l_quantity, 0.75) WHEN 0.97 THEN quantile_cont(l_extendedprice / l_quantity, 0.97) END AS price,
  CASE q.q WHEN 0.5 THEN quantile_cont(l_quantity, 0.5) WHEN 0.75 THEN quantile_cont(l_quantity, 0.75)
    WHEN 0.97 THEN quantile_cont(l_quantity, 0.97) END::DOUBLE AS fatalities
FROM lineitem, (SELECT unnest([0.5, 0.75, 0.97]) AS q) q GROUP BY q.q"""))
def q_raw_quantiles(spark, sf):
    """Quantiles over every line item, of many distinct values and of few."""
    from .operators import quantile_table
    from .sources.driver import table
    rows = cut_lineage(table(spark, sf, "lineitem").select(
        F.try_divide("l_extendedprice", "l_quantity").alias("price"), F.col("l_quantity").alias("fatalities")))
    out = None
    for q in (0.5, 0.75, 0.97):
        one = quantile_table(rows, "price", q).select(
            F.lit(q).alias("q"), F.col("quantile").alias("price"), quantile_table(rows, "fatalities", q).scalar().alias("fatalities"))
        out = one if out is None else out.unionByName(one)
    return out


# ---- S4: events that are sent again or corrected --------------------------------------

@register("conflict_corrected", O.q("""
, sent AS (
  SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, l_returnflag FROM lineitem),
months AS (
  SELECT trim(r_name) AS region, CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
         count(*) AS conflict_events, sum(l_quantity)::DOUBLE AS fatalities_total,
         CAST(sum(CAST(l_returnflag = 'R' AS INTEGER)) AS BIGINT) AS flood_displace_events
  FROM sent JOIN supplier ON l_suppkey = s_suppkey JOIN geo ON s_nationkey = n_nationkey GROUP BY 1, 2, 3)
SELECT *, coalesce(lag(conflict_events) OVER w, 0) AS conflict_events_lag1,
       coalesce(lag(flood_displace_events) OVER w, 0) AS flood_displace_lag1,
       CAST(conflict_events >= (SELECT quantile_cont(conflict_events, 0.75) FROM months) AS INTEGER) AS high_conflict_flag
FROM months WINDOW w AS (PARTITION BY region ORDER BY year, month)""", ("region",)))
def q_conflict_corrected(spark, sf):
    """Four landings into the keyed stream: half a year with wrong regions, months and fatalities
    of the protests, the same file again, the corrected protests, and the other half year.
    What is left is each event once, as it was sent last."""
    from .sources import EVENT_FIELDS
    from .streaming import conflict_from_partials, start_keyed_refresh
    base = _scratch(spark, "keyed")
    line = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_returnflag"]
    # the narrow columns are written once, the long ids only in the landings
    ev = cut_lineage(S._lineitem_geo(spark, sf, [c for c in line if c != "l_suppkey"]).select(*line, "r_name"))
    ev = ev.select(  # an id that tells all lines apart
        F.concat_ws("-", *line).alias("event_id_cnty"), F.col("l_shipdate").alias("event_date"), F.col("r_name").alias("admin1"),
        F.col("l_quantity").alias("fatalities"), lit_map(S.STANDIN_EVENT_TYPE)[F.col("l_returnflag")].alias("event_type"))
    ev = ev.select(*[(F.col(f) if f in ev.columns else F.lit(None)).cast("string").alias(f) for f in EVENT_FIELDS])
    first, protest = F.month(F.to_date("event_date")) <= 6, F.col("event_type") == "Protests"
    wrong = ev.where(first).withColumns({
        "admin1": F.when(protest, F.lit("Nowhere")).otherwise(F.col("admin1")),
        "fatalities": F.when(protest, F.lit("999")).otherwise(F.col("fatalities")),
        "event_date": F.when(protest, F.date_add(F.to_date("event_date"), 40).cast("string")).otherwise(F.col("event_date"))})
    landings = (wrong, wrong, ev.where(first & protest), ev.where(~first))
    for landing in landings:
        landing.write.mode("append").option("header", True).option("compression", "gzip").csv(f"{base}/landing")
        start_keyed_refresh(spark, f"{base}/landing", f"{base}/store", f"{base}/ckpt").awaitTermination()
    return conflict_from_partials(spark, f"{base}/store/partials")


# ---- S10 / A8: labels with counts; A7: distinct counts from kept sketches --------------

_LABELS = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {c}::VARCHAR AS value, count(*) AS n, count(*) / (SELECT count({c}) FROM quotes)::DOUBLE AS share, "
    f"row_number() OVER (ORDER BY count(*) DESC, {c}::VARCHAR) AS rank FROM quotes WHERE {c} IS NOT NULL GROUP BY {c}"
    for c in ("commodity", "event_type", "region", "clerk"))


@register("label_overview", O.q(f"""
, quotes AS (
  SELECT {O._case_map('p_type', V.STANDIN_COMMODITY)} AS commodity, {O._case_map('l_returnflag', V.STANDIN_EVENT_TYPE)} AS event_type,
         trim(r_name) AS region, l_suppkey AS clerk
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN geo ON s_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey)
SELECT "column", value, n, share, CAST(rank AS INTEGER) AS rank FROM ({_LABELS}) WHERE rank <= 12""", ("column", "value")))
def q_label_overview(spark, sf):
    """The labels of the raw quotes and events with their counts, and the busiest of many sources."""
    from .operators import label_counts
    from .sources.driver import table
    li = S._lineitem_geo(spark, sf, ["l_partkey", "l_returnflag"])
    p = table(spark, sf, "part").select("p_partkey", lit_map(S.STANDIN_COMMODITY)[F.col("p_type")].alias("commodity"))
    quotes = li.join(p, li.l_partkey == p.p_partkey).select(
        "commodity", lit_map(S.STANDIN_EVENT_TYPE)[F.col("l_returnflag")].alias("event_type"),
        F.trim("r_name").alias("region"), F.col("l_suppkey").alias("clerk"))
    return label_counts(quotes, ["commodity", "event_type", "region", "clerk"], 12)


@register("distinct_by_range", O.q("""
, seen AS (
  SELECT trim(r_name) AS region, year(o_orderdate) AS year, o_custkey AS station FROM orders
  JOIN customer ON o_custkey = c_custkey JOIN geo ON c_nationkey = n_nationkey)
SELECT region, count(DISTINCT station) AS n_station, true AS within FROM seen WHERE year BETWEEN 1993 AND 1996 GROUP BY region
UNION ALL SELECT 'all', count(DISTINCT station), true FROM seen""", ("region", "within")))
def q_distinct_by_range(spark, sf):
    """Distinct stations of a range of years from sketches kept by region and year, next to the
    exact counts: ``within`` tells that the estimate keeps to its stated error."""
    from .operators import distinct_from, distinct_sketches, sketch_error
    from .sources import write_stage
    from .sources.driver import table
    o, c = table(spark, sf, "orders").select("o_custkey", "o_orderdate"), table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    g = S._geo(spark, sf)
    seen = cut_lineage(o.join(c, F.col("o_custkey") == c.c_custkey).join(g, F.col("c_nationkey") == g.n_nationkey).select(
        F.trim("r_name").alias("region"), F.year("o_orderdate").alias("year"), F.col("o_custkey").alias("station")))
    kept = write_stage(distinct_sketches(seen, ["region", "year"], ["station"]), _scratch(spark, "sketches"), cluster_by=("region",))
    years = F.col("year").between(1993, 1996)
    estimate = distinct_from(kept.where(years), ["region"], ["station"]).unionByName(
        distinct_from(kept, [], ["station"]).withColumn("region", F.lit("all")))
    exact = seen.where(years).groupBy("region").agg(F.count_distinct("station").alias("n_station")).unionByName(
        seen.agg(F.count_distinct("station").alias("n_station")).withColumn("region", F.lit("all")))
    both = exact.join(estimate.withColumnRenamed("n_station", "e"), "region")
    return both.select("region", "n_station", (F.abs(F.col("e") - F.col("n_station")) <= 1 + sketch_error() * F.col("n_station")).alias("within"))


# ---- M16: contributions to a linear score, whose exact values are known ----------------

_WEIGHTS = {"rainfall_anomaly_pct": 0.03, "rainfall_anomaly_lag1": -0.02, "price_change_pct": 0.05, "conflict_events": 0.1,
            "flood_flag": 1.5, "is_lean_season": 1.0}
_X = ", ".join(f"coalesce({c}, 0.0::DOUBLE)::DOUBLE AS {c}" for c in _WEIGHTS)


@register("attribution_linear", O.q(f"""
, x AS (SELECT region, district, year, month, {_X} FROM features),
z AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY region ORDER BY year DESC, month DESC, district DESC) = 1),
m AS (SELECT {', '.join(f'avg({c}) AS {c}' for c in _WEIGHTS)} FROM z)
""" + " UNION ALL ".join(
    f"SELECT district, year, month, '{c}' AS feature, {w}::DOUBLE * (x.{c} - m.{c}) AS contribution FROM x, m"
    for c, w in _WEIGHTS.items()), ("district", "feature")))
def q_attribution_linear(spark, sf):
    """Sampled Shapley values of a linear score against the latest row of each region."""
    from .models.attribution import column_scorer, shapley_values
    from .operators import latest_row
    f = S.features(spark, sf).select("region", "district", "year", "month", *_WEIGHTS)
    back = latest_row(f, "region", order=("year", "month", "district"))
    score = sum((F.col(c) * w for c, w in _WEIGHTS.items()), F.lit(0.0))
    values = shapley_values(column_scorer(score), f, list(_WEIGHTS), ["district", "year", "month"], back, pairs=5)
    return values.select("district", "year", "month", "feature", "contribution")


# ---- M9, S9, B1: models applied, where the result is known ------------------------------

# Two hand-written trees: (tree, node, feature, threshold, left, right, size, depth); features by place.
_PATH_COLS = ("rainfall_anomaly_pct", "conflict_events", "is_lean_season")
_NODES = ((0, 0, 0, 50.0, 1, 2, 64, 0), (0, 1, 1, 20.0, 3, 4, 60, 1), (0, 2, -1, 0.0, -1, -1, 4, 1), (0, 3, -1, 0.0, -1, -1, 55, 2),
          (0, 4, -1, 0.0, -1, -1, 5, 2), (1, 0, 2, 0.5, 1, 2, 64, 0), (1, 1, -1, 0.0, -1, -1, 48, 1), (1, 2, 0, -40.0, 3, 4, 16, 1),
          (1, 3, -1, 0.0, -1, -1, 1, 2), (1, 4, -1, 0.0, -1, -1, 15, 2))


def _path_length(n: int) -> str:
    """Mean path of an unsuccessful search among n rows, as SQL."""
    return "0.0::DOUBLE" if n < 2 else f"(2 * (ln({n} - 1) + 0.5772156649015329::DOUBLE) - 2 * ({n} - 1) / {n}::DOUBLE)" if n > 2 else "1.0::DOUBLE"


@register("forest_path_scores", O.q(f"""
SELECT district, year, month, nround(power(2.0::DOUBLE, -(
    CASE WHEN coalesce(rainfall_anomaly_pct, 0) < 50 THEN CASE WHEN conflict_events < 20 THEN 2 + {_path_length(55)} ELSE 2 + {_path_length(5)} END
         ELSE 1 + {_path_length(4)} END
  + CASE WHEN is_lean_season < 0.5 THEN 1 + {_path_length(48)}
         ELSE CASE WHEN coalesce(rainfall_anomaly_pct, 0) < -40 THEN 2 + {_path_length(1)} ELSE 2 + {_path_length(15)} END END
  ) / 2 / {_path_length(64)}), 4) AS anomaly_score FROM features""", ("district",)))
def q_forest_path_scores(spark, sf):
    """The feature panel scored by a forest whose node table is given."""
    from .models.forest import NODE_SCHEMA, score_forest
    nodes = spark.createDataFrame(list(_NODES), NODE_SCHEMA)
    f = S.features(spark, sf).select("district", "year", "month", *_PATH_COLS)
    return score_forest(f, nodes, list(_PATH_COLS), 64).select("district", "year", "month", "anomaly_score")


@register("saved_scores_equal", O.q("SELECT count(*) AS n, 0::BIGINT AS n_different FROM features"))
def q_saved_scores_equal(spark, sf):
    """Models that were saved and loaded score every row as the fitted ones do."""
    from .plans.pipeline import score_models, score_saved
    f, base, keys = S.features(spark, sf), _scratch(spark, "models"), ["district", "year", "month"]
    out = ["pred_ipc_phase", "pred_ipc_confidence", "pred_price_change", "anomaly_score", "is_anomaly"]
    fitted = cut_lineage(score_models(f, base, phase_trees=20, price_trees=20, forest_trees=20).select(*keys, F.struct(*out).alias("a")))
    loaded = score_saved(f, f"{base}/models").select(*keys, F.struct(*out).alias("b"))
    return fitted.join(loaded, keys, "left").agg(F.count("*").alias("n"), F.count_if(~F.col("a").eqNullSafe(F.col("b"))).alias("n_different"))


@register("alert_feed_fitted", None)
def q_alert_feed_fitted(spark, sf):
    """B1 from fitted models: phase, confidence, price change and anomaly of the feed are predictions."""
    from .plans import reports as R
    from .plans.pipeline import score_models
    return R.alert_feed(cut_lineage(score_models(S.features(spark, sf), phase_trees=60, price_trees=60, forest_trees=100)))
