"""Shapley values and calibrated confidence."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from harvestwatch.models.attribution import attribution_ranking, column_scorer, regression_scorer, shapley_values
from harvestwatch.models.calibrate import _between, _thin, calibration_error, fit_calibrated
from harvestwatch.models.supervised import fit_price, predict_phase, fit_phase

COLS = ["a", "b", "c", "d"]


def rows_of(n, seed=0):
    rng = np.random.default_rng(seed)
    return [(i, *map(float, rng.normal(size=4).round(3))) for i in range(n)]


def brute(f, x, background):
    """Exact Shapley values over all orders, mean over the background."""
    out = np.zeros(len(x))
    for z in background:
        for order in itertools.permutations(range(len(x))):
            now = list(z)
            for j in order:
                before = f(*now)
                now[j] = x[j]
                out[j] += f(*now) - before
    return out / (len(background) * math.factorial(len(x)))


def test_linear_model_has_exact_values(spark):
    df = spark.createDataFrame(rows_of(20), "i int, a double, b double, c double, d double")
    w = {"a": 2.0, "b": -1.0, "c": 0.5, "d": 0.0}
    back = df.where("i < 3")
    got = shapley_values(column_scorer(sum(F.col(c) * v for c, v in w.items()) + 7.0), df, COLS, ["i"], back, pairs=3).collect()
    assert len(got) == 80
    mean = {c: np.mean([r[k + 1] for r in rows_of(20)[:3]]) for k, c in enumerate(COLS)}
    data = {r[0]: dict(zip(COLS, r[1:], strict=True)) for r in rows_of(20)}
    for r in got:
        assert r["contribution"] == pytest.approx(w[r["feature"]] * (data[r["i"]][r["feature"]] - mean[r["feature"]]), abs=1e-9)
    top = attribution_ranking(spark.createDataFrame(got), 2).collect()
    assert [r["feature"] for r in top] == ["a", "b"]


def test_interactions_and_sums(spark):
    df = spark.createDataFrame(rows_of(6, 1), "i int, a double, b double, c double, d double")
    f = lambda a, b, c, d: a * b + max(c, 0.0)
    score = column_scorer(F.col("a") * F.col("b") + F.greatest("c", F.lit(0.0)))
    got = shapley_values(score, df, COLS, ["i"], df.where("i < 2"), pairs=40).collect()
    for i, *x in rows_of(6, 1):
        mine = {r["feature"]: r for r in got if r["i"] == i}
        base = np.mean([f(*z[1:]) for z in rows_of(6, 1)[:2]])
        assert mine["a"]["base"] == pytest.approx(base) and mine["a"]["prediction"] == pytest.approx(f(*x))
        assert sum(r["contribution"] for r in mine.values()) == pytest.approx(f(*x) - base)
        want = brute(f, x, [z[1:] for z in rows_of(6, 1)[:2]])  # a pair gives a product of two its exact halves
        assert [mine[c]["contribution"] for c in COLS] == pytest.approx(want.tolist(), abs=1e-9)


def test_fitted_forest_adds_up(spark):
    df = spark.createDataFrame(rows_of(120, 2), "i int, a double, b double, c double, d double").withColumn(
        "target_price_change", F.col("a") * 3 + F.col("b"))
    df = df.withColumn("d", F.when(F.col("i") % 5 > 0, F.col("d")))  # missing features are 0
    model = fit_price(df, COLS, trees=5, depth=4)
    got = shapley_values(regression_scorer(model), df.where("i < 10"), COLS, ["i"], df.where("i >= 100"), pairs=4)
    per = got.groupBy("i").agg(F.sum("contribution").alias("s"), F.first("prediction").alias("p"), F.first("base").alias("b")).collect()
    assert len(per) == 10 and all(r["s"] == pytest.approx(r["p"] - r["b"], abs=1e-9) for r in per)
    assert got.agg(F.count_distinct(F.round("base", 9))).first()[0] == 1
    assert attribution_ranking(got).first()["feature"] == "a"
    with pytest.raises(ValueError):
        shapley_values(regression_scorer(model), df, COLS, ["i"], df.limit(0))


def test_between_and_thin(spark):
    points = [(0.0, 0.1), (1.0, 0.1), (2.0, 0.5), (2.0, 0.7), (4.0, 0.9)]
    x = [-1.0, 0.0, 0.5, 1.5, 2.0, 3.0, 4.0, 9.0]
    df = spark.createDataFrame([(v,) for v in x], "x double")
    got = {r.x: r.y for r in df.select("x", _between(F.col("x"), points).alias("y")).collect()}
    assert [got[v] for v in x] == pytest.approx([0.1, 0.1, 0.1, 0.3, 0.7, 0.8, 0.9, 0.9])
    assert _thin([(float(i), 0.5) for i in range(9)], 5) == [(0.0, 0.5), (8.0, 0.5)]
    assert len(_thin([(float(i), float(i)) for i in range(900)], 50)) == 50


def test_confidence_is_calibrated(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(900):
        x, noise = rng.normal(size=2)
        p = 1 / (1 + np.exp(-2 * x))  # labels are drawn, so a sure answer is wrong at times
        rows.append((i, float(x), float(noise), int(rng.random() < p) + 1))
    df = spark.createDataFrame(rows, "i int, x double, u double, ipc_phase int")
    train, test = df.where("i < 600"), df.where("i >= 600")
    model = fit_calibrated(train, ["x", "u"], "ipc_phase", ["i"], folds=2, trees=10, depth=6, learning_rate=0.6, min_child=1)
    got = model.predict(test)
    after = calibration_error(got).first()
    plain = fit_phase(train, ["x", "u"], "ipc_phase", algo="boosted", trees=10, depth=6, learning_rate=0.6, min_child=1)
    before = calibration_error(predict_phase(plain, test, ["x", "u"])).first()
    assert after["n"] == 300 and after["ece"] < before["ece"], (after, before)  # it was too sure of itself
    assert after["accuracy"] == pytest.approx(before["accuracy"], abs=0.05)
    assert got.agg(F.min("pred_ipc_confidence")).first()[0] >= 0 and got.agg(F.max("pred_ipc_confidence")).first()[0] <= 1
    exact = spark.createDataFrame([(1, 1, 0.75)] * 3 + [(1, 2, 0.75)], "ipc_phase int, pred_ipc_phase int, pred_ipc_confidence double")
    assert calibration_error(exact).first()["ece"] == pytest.approx(0.0)


def test_steps_are_not_shuffled(spark):
    df = spark.createDataFrame(rows_of(20), "i int, a double, b double, c double, d double")
    got = shapley_values(column_scorer(F.col("a") + F.col("b")), df, COLS, ["i"], df.where("i < 3"), pairs=3)
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
