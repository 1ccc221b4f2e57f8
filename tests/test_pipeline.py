"""End to end on the benchmark stand-ins (sf0.001) and property checks."""

import os
import sys

from pyspark.sql import functions as F

from harvestwatch import constants as K
from harvestwatch.models.forest import isolation_forest
from harvestwatch.models.metrics import classification_report, persistence_forecast
from harvestwatch.models.split import hash_split, stratified_split
from harvestwatch.operators import period_index, trailing_months
from harvestwatch.plans import reports as R
from harvestwatch.plans import standin as S
from harvestwatch.plans.predict import rule_scores
from harvestwatch.plans.scenario import scenario_score, scenario_status


def test_master_rows_equal_spine(spark, sf0001):
    rain = S.rainfall_monthly(spark, sf0001)
    master = S.master(spark, sf0001)
    assert master.count() == rain.count() > 0
    phases = {r[0] for r in master.select("ipc_phase").distinct().collect()}
    assert phases <= {1, 2, 3, 4}


def test_features_schema_and_fill(spark, sf0001):
    f = S.features(spark, sf0001)
    cols = set(f.columns)
    for c in ("flood_streak_months", "rainfall_rolling_6m", "price_change_lag2", "conflict_rolling_3m",
              "month_sin", "time_trend", "region_flood_freq_hist", "compound_risk_score"):
        assert c in cols
    assert "season_phase" not in cols
    assert all(f"season_{v}" in cols for v in K.SEASON_PHASES)
    nulls = f.select(*[F.sum(F.col(c).isNull().cast("int")).alias(c) for c in f.columns
                       if "lag" in c or "rolling" in c]).first().asDict()
    assert all(v == 0 for v in nulls.values())


def test_trailing_mask_equals_index_form(spark, sf0001):
    sc = rule_scores(S.features(spark, sf0001))
    mx = sc.agg(F.max("year").alias("y")).first().y
    mm = sc.where(F.col("year") == mx).agg(F.max("month")).first()[0]
    mask = sc.where(((F.col("year") == mx) & (F.col("month") <= mm)) |
                    ((F.col("year") == mx - 1) & (F.col("month") > mm)))
    assert sorted(map(tuple, mask.select("district", "year", "month").collect())) == \
        sorted(map(tuple, trailing_months(sc, 12).select("district", "year", "month").collect()))


def test_reports(spark, sf0001):
    sc = rule_scores(S.features(spark, sf0001))
    feed = R.alert_feed(sc)
    assert feed.columns == list(R.FEED_COLUMNS)
    snap = R.alert_snapshot(sc).collect()
    assert len({(r.district) for r in snap}) == len(snap)
    lines = R.bulletin_lines(sc)
    per_block = lines.groupBy("district", "year", "month").agg(F.max("line_no").alias("m")).collect()
    assert all(r.m in (9, 10) for r in per_block)
    summary = R.summary_lines(sc).collect()
    assert {r.section for r in summary} >= {0, 1, 3}
    rep = R.feature_report(S.features(spark, sf0001)).collect()
    assert rep[0].value.startswith("  1. ")


def test_scenario_all_normal(spark):
    df = spark.createDataFrame([("s", 0, 0, False, 0, 0.0, 0, 2)],
                               "scenario_id string, rainfall_anom int, price_change int, flood_flag boolean, "
                               "conflict_events int, ndvi_anom double, population_density int, prev_ipc int")
    r = scenario_score(df).first()
    assert r.phase == 1 and r.drivers == [K.SCENARIO_NORMAL_DRIVER] and r.confidence == 0.97
    st = scenario_status(df).collect()
    assert [x.parameter for x in st] == list(K.SCENARIO_PARAMETERS)
    assert st[0].value == "+0%" and st[6].value == "Phase 2 — Stressed"


def test_scenario_extremes(spark):
    df = spark.createDataFrame([("s", 60, 35, True, 6, -0.2, 250, 3)],
                               "scenario_id string, rainfall_anom int, price_change int, flood_flag boolean, "
                               "conflict_events int, ndvi_anom double, population_density int, prev_ipc int")
    r = scenario_score(df).first()
    assert r.phase == 4 and len(r.drivers) == 7 and r.score == 9.5
    assert r.drivers[0] == "🌊 Severe flood signal (+60% rainfall anomaly)"


def test_stratified_split_is_exact(spark):
    df = spark.range(1000).select(F.col("id"), (F.when(F.col("id") < 700, 1).otherwise(2)).alias("label"))
    s = stratified_split(df, "label", ["id"], 0.2, 42, buckets=64)
    counts = {(r.label, r.split): r["count"] for r in s.groupBy("label", "split").count().collect()}
    assert counts[(1, "test")] == 140 and counts[(2, "test")] == 60
    assert s.count() == 1000
    again = stratified_split(df.repartition(5), "label", ["id"], 0.2, 42, buckets=64)
    assert sorted(r.id for r in s.where("split = 'test'").collect()) == \
        sorted(r.id for r in again.where("split = 'test'").collect())
    h = hash_split(df, ["id"], 0.8).groupBy("split").count().collect()
    assert 700 < {r.split: r["count"] for r in h}["train"] < 900


def test_classification_report(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 2), (3, 2)], "y int, pred int")
    rep = {r.label: r for r in classification_report(df).collect()}
    assert rep[1].precision == 1.0 and rep[1].recall == 0.5
    assert rep[3].precision == 0.0 and rep[3].f1 == 0.0
    assert abs(rep[2].precision - 1 / 3) < 1e-12


def test_isolation_forest_flags_contamination_share(spark):
    rows = [(i, float(i % 17), float((i * 7) % 13)) for i in range(600)]
    rows += [(1000 + i, 500.0 + i, -400.0) for i in range(6)]
    df = spark.createDataFrame(rows, "id long, a double, b double")
    out = isolation_forest(df, ["a", "b"], contamination=0.03, trees=50, keys=["id"])
    flagged = {r.id for r in out.where("is_anomaly = 1").collect()}
    assert 10 <= len(flagged) <= 25
    assert {1000 + i for i in range(6)} <= flagged


def test_persistence_forecast(spark, sf0001):
    p = persistence_forecast(S.master(spark, sf0001), "ipc_phase")
    assert p.count() > 0 and p.where(F.col("pred").isNull()).count() == 0


def test_entry_contract(spark):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0 and df.columns == ["region", "flood_months"]
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 50


def test_scored_table_is_planned_once(spark, monkeypatch):
    from harvestwatch import queries as Q
    rows = [("N", "N 1", 2020, m, 1, 0.5 * m, 10.0 * m) for m in range(1, 13)]
    f = spark.createDataFrame(rows, "region string, district string, year int, month int, ipc_phase int, price_change_pct double, "
                                    "compound_risk_score double")
    monkeypatch.setattr(Q.S, "features", lambda *_: f)
    plan = Q.scored(spark, "")._jdf.queryExecution().optimizedPlan().toString()
    assert "subquery" not in plan and Q.scored(spark, "").count() == 12
