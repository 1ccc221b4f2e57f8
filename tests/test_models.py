"""Model operators on the stand-in feature panel (sf0.001): seeded, better than
a naive baseline, anomaly share near the contamination rate."""

import re

import pytest
from pyspark.sql import functions as F

from harvestwatch import constants as K
from harvestwatch.models import queries as MQ
from harvestwatch.models.forest import isolation_forest
from harvestwatch.models.importance import permutation_importance
from harvestwatch.models.metrics import classification_report
from harvestwatch.models.split import stratified_split
from harvestwatch.models.supervised import (feature_importance, fit_phase, fit_price, load_model,
                                            predict_phase, predict_price, save_model)
from harvestwatch.operators import select_by_keyword
from harvestwatch.plans import standin as S


@pytest.fixture(scope="module")
def feats(spark, sf0001):
    return S.features(spark, sf0001)


def test_phase_model_beats_majority(spark, feats, tmp_path):
    cols = MQ.feature_columns(feats)
    split = stratified_split(feats, "ipc_phase", MQ.KEYS, 0.2, K.SEED)
    model = fit_phase(split.where("split = 'train'"), cols, "ipc_phase", trees=30)
    pred = predict_phase(model, split.where("split = 'test'"), cols)
    acc = pred.select(F.avg((F.col("pred_ipc_phase") == F.col("ipc_phase")).cast("double"))).first()[0]
    majority = (split.where("split = 'test'").groupBy("ipc_phase").count()
                .select(F.max("count") / F.sum("count")).first()[0])
    assert acc >= majority
    conf = pred.select(F.min("pred_ipc_confidence"), F.max("pred_ipc_confidence")).first()
    assert 0 < conf[0] <= conf[1] <= 1
    rep = classification_report(pred.select(F.col("ipc_phase").alias("y"), F.col("pred_ipc_phase").alias("pred")))
    assert rep.count() >= 2
    path = str(tmp_path / "phase")
    save_model(model, path)
    again = predict_phase(load_model(path), split.where("split = 'test'"), cols)
    assert sorted(r[0] for r in again.select("pred_ipc_phase").collect()) == \
        sorted(r[0] for r in pred.select("pred_ipc_phase").collect())


def test_price_model_and_importance(spark, feats):
    cols = [c for c in MQ.feature_columns(feats) if c != "price_change_pct"]
    t = feats.withColumn("target_price_change", F.col("price_change_pct")).where(
        F.col("target_price_change").isNotNull())
    model = fit_price(t, cols, trees=10)
    pred = predict_price(model, t, cols)
    assert pred.where(F.col("pred_price_direction").isNull()).count() == 0
    imp = feature_importance(model, cols, spark, 15).collect()
    assert len(imp) == min(15, len(cols)) and imp[0].importance >= imp[-1].importance


def test_permutation_importance(spark, feats):
    cols = MQ.feature_columns(feats)
    model = fit_phase(feats, cols, "ipc_phase", trees=10)
    imp = permutation_importance(model, feats, cols, "ipc_phase", MQ.KEYS, k=15, bucket_rows=64).collect()
    assert 0 < len(imp) <= 15 and {r.feature for r in imp} <= set(cols)


def test_isolation_forest_share(spark, feats):
    cols = select_by_keyword(MQ.feature_columns(feats), K.ANOMALY_KEYWORDS)
    out = isolation_forest(feats, cols, trees=50, keys=MQ.KEYS)
    n, k = out.count(), out.where("is_anomaly = 1").count()
    assert abs(k / n - K.FOREST_CONTAMINATION) < 0.02
    s = out.select(F.min("anomaly_score"), F.max("anomaly_score")).first()
    assert 0 < s[0] <= s[1] < 1


def test_forest_model_save_load_and_apply(spark, feats, tmp_path):
    from harvestwatch.models.forest import ForestModel, fit_isolation_forest
    cols = select_by_keyword(MQ.feature_columns(feats), K.ANOMALY_KEYWORDS)
    model, scored = fit_isolation_forest(feats, cols, trees=30, keys=MQ.KEYS)
    path = str(tmp_path / "forest")
    model.save(path)
    again = ForestModel.load(spark, path)
    assert again.threshold == model.threshold and again.cols == model.cols
    re_scored = again.transform(feats)
    a = {(r.district, r.year, r.month): (r.anomaly_score, r.is_anomaly) for r in scored.collect()}
    b = {(r.district, r.year, r.month): (r.anomaly_score, r.is_anomaly) for r in re_scored.collect()}
    assert a == b


def test_boosted_one_vs_rest(spark, feats):
    cols = MQ.feature_columns(feats)[:12]
    model = fit_phase(feats, cols, "ipc_phase", trees=3, depth=3, algo="boosted")
    pred = predict_phase(model, feats, cols)
    acc = pred.select(F.avg((F.col("pred_ipc_phase") == F.col("ipc_phase")).cast("double"))).first()[0]
    assert acc > 0.5
    c = pred.select(F.min("pred_ipc_confidence"), F.max("pred_ipc_confidence")).first()
    assert 0 < c[0] <= c[1] <= 1


def test_weighted_f1_matches_spark_evaluator(spark, sf0001):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from harvestwatch.models.metrics import persistence_forecast
    p = persistence_forecast(S.master(spark, sf0001), "ipc_phase")
    ours = classification_report(p).first().weighted_f1
    ev = MulticlassClassificationEvaluator(labelCol="y", predictionCol="pred", metricName="f1")
    theirs = ev.evaluate(p.select(F.col("y").cast("double"), F.col("pred").cast("double")))
    assert abs(ours - theirs) < 1e-12


def test_stratified_split_keeps_rows_without_label(spark):
    from harvestwatch.models.split import stratified_split
    df = spark.range(1000).selectExpr("id", "if(id % 10 = 0, null, id % 3) AS label")
    got = stratified_split(df, "label", ["id"])
    assert got.count() == 1000
    assert got.where("label is null").groupBy("split").count().orderBy("split").collect()[0]["count"] == 20


def test_regression_metrics_on_model_output(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    from harvestwatch.models.metrics import regression_metrics
    df = spark.range(50).selectExpr("double(id) AS x", "double(id) * 2 + rand(3) AS y")
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    out = LinearRegression(labelCol="y", predictionCol="pred").fit(df).transform(df)
    r = regression_metrics(out).first()
    assert r["r2"] > 0.99 and r["n"] == 50


def test_tag_rows_keep_data_rows(spark):
    from harvestwatch.sources import drop_tag_rows
    df = spark.createDataFrame([("#date", "x"), ("2003-01-01", "# noted"), (None, "#y")], "date string, notes string")
    assert drop_tag_rows(df).count() == 2


def test_permutation_importance_reads_every_row(spark):
    from harvestwatch.models.supervised import fit_price
    df = spark.range(500).selectExpr("id", "double(id % 7) AS a", "double(id % 3) AS b", "double(id % 7) AS y")
    model = fit_price(df, ["a", "b"], target="y", trees=10)
    got = {r.feature: r.importance for r in permutation_importance(
        model, df, ["a", "b"], "y", ["id"], task="regression", k=None, bucket_rows=50).collect()}
    assert got["a"] > 5 * abs(got["b"]) and got["a"] > 0.5


def test_forest_draws_copies_one_by_one(spark):
    from harvestwatch.models.forest import fit_forest
    df = spark.range(20000).selectExpr("id", "if(id % 3 = 0, 0D, double(id)) AS x", "double(id % 11) AS z",
                                       "if(id % 3 = 0, 0, id) AS hot")
    for keys in (None, ["hot"], ["id"]):
        nodes = fit_forest(df, ["x", "z"], trees=8, psi=64, keys=keys)
        sizes = [r["size"] for r in nodes.where("node = 0").collect()]
        assert len(sizes) == 8 and all(30 < s <= 64 for s in sizes)


def test_small_table_is_its_own_subsample(spark):
    from harvestwatch.models.forest import fit_isolation_forest
    df = spark.range(100).selectExpr("id", "randn(1) AS a", "randn(2) AS b").cache()
    model, scored = fit_isolation_forest(df, ["a", "b"], keys=["id"], trees=50)
    assert model.psi == 100
    assert abs(scored.agg(F.avg("anomaly_score")).first()[0] - 0.5) < 0.06
    assert scored.where("is_anomaly = 1").count() == 3


def test_price_target_falls_back(spark):
    from harvestwatch.models.supervised import price_frame
    rows = spark.range(300).selectExpr("'d' AS district", "cast(1990 + id div 12 AS int) AS year",
                                       "cast(id % 12 + 1 AS int) AS month")
    none = rows.selectExpr("*", "cast(null AS double) AS price_change_pct")
    t, source = price_frame(none)
    assert source is None and t.count() == 0
    millet = none.selectExpr("*", "100D + (year - 1990) * 12 + month AS price_millet")
    t, source = price_frame(millet)
    assert source == "price_millet" and t.count() == 299
    first = t.orderBy("year", "month").first()
    assert abs(first["target_price_change"] - 100 / 101) < 1e-9


def test_training_rows_are_dealt_evenly(spark):
    from harvestwatch.models.supervised import spread
    df = spark.range(1000).coalesce(1)
    assert spread(df, 1000).rdd.getNumPartitions() == 1
    sizes = spread(df, 40).rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert len(sizes) >= 25 and max(sizes) <= 60 and sum(sizes) == 1000


def test_forests_keep_the_node_of_a_row(spark):
    df = spark.range(60).selectExpr("id", "double(id % 7) AS a", "double(id % 3) AS b", "double(id % 7) AS y", "id % 2 AS p")
    assert fit_phase(df, ["a", "b"], "p", trees=3).stages[-1].getCacheNodeIds()
    assert fit_price(df, ["a", "b"], target="y", trees=3).stages[-1].getCacheNodeIds()


def test_permutation_scores_only_changed_rows(spark):
    df = spark.range(200).selectExpr("id", "double(id % 7) AS a", "1D AS b", "double(id % 7) AS y")
    model = fit_price(df, ["a", "b"], target="y", trees=5)
    got = permutation_importance(model, df, ["a", "b"], "y", ["id"], task="regression", k=None, bucket_rows=50)
    assert {r.feature: r.importance for r in got.collect()}["b"] == 0.0
    assert "<=>" in got._jdf.queryExecution().optimizedPlan().toString()


def test_large_forests_are_grown_as_spark_ml_grows_them(spark):
    # one tree over all rows and features draws nothing at random: the same splits and leaves
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import RandomForestRegressor
    from harvestwatch.models.histforest import fit_forest
    df = spark.range(4000).selectExpr(
        "double(id % 7) AS a", "double((id * 7919) % 211) AS b", "double(pmod(xxhash64(id), 97)) / 3 AS c",
        "IF(id % 500 = 0, 1D, 0D) AS rare", "5D AS same").selectExpr(
        "*", "a * 3 + abs(b - 90) + 40 * rare + c / 7 AS y", "double(IF(b > 150, 2, IF(a + c > 20, 1, 0))) AS k").selectExpr(
        "*", "IF(k = 2, 2.5D, 1D) AS w").repartition(3).cache()
    cols = ["a", "b", "c", "rare", "same"]
    rows = VectorAssembler(inputCols=cols, outputCol="features").transform(df)
    one = {"numTrees": 1, "bootstrap": False, "featureSubsetStrategy": "all", "maxDepth": 5, "minInstancesPerNode": 3, "seed": 1}
    for est, args in ((RandomForestRegressor(labelCol="y", **one), ("y",)),
                      (RandomForestClassifier(labelCol="k", weightCol="w", **one), ("k", 3, [1.0, 1.0, 2.5]))):
        want, got = est.fit(rows), fit_forest(est, df, cols, *args)
        assert got.numFeatures == 5 and got.trees[0].numNodes == want.trees[0].numNodes > 9
        strip = lambda m: re.sub(r"\d+\.\d+", lambda x: f"{float(x[0]):.9g}", m.toDebugString.split("\n", 1)[1].strip())
        assert strip(got) == strip(want)
        assert got.featureImportances.toArray() == pytest.approx(want.featureImportances.toArray(), abs=1e-9)
        a, b = (sorted(str(r[0]) for r in m.transform(rows).select("prediction").distinct().collect()) for m in (got, want))
        assert [float(v) for v in a] == pytest.approx([float(v) for v in b])


def test_forests_over_many_rows(spark, tmp_path):
    df = spark.range(6000).selectExpr(
        "id", "double(pmod(xxhash64(id), 1000)) AS a", "double(pmod(xxhash64(id, 1), 1000)) AS b",
        "double(pmod(xxhash64(id, 2), 5)) AS c").selectExpr("*", "a / 10 + 20 * c AS y", "IF(a > 900, 3, IF(b > 500, 2, 1)) AS p").repartition(4)
    cols = ["a", "b", "c"]
    phase = fit_phase(df, cols, "p", trees=20, many=1000)
    assert phase.stages[-1].getNumTrees == 20 and phase.stages[-1].numClasses == 3
    save_model(phase, str(tmp_path / "phase"))
    got = predict_phase(load_model(str(tmp_path / "phase")), df, cols)
    assert got.where("p = pred_ipc_phase").count() > 5900
    price = fit_price(df, cols, target="y", trees=20, many=1000)
    few = fit_price(df, cols, target="y", trees=20)
    error = [m.transform(df).selectExpr("avg(abs(y - prediction))").first()[0] for m in (price, few)]
    assert error[0] < 1.2 * error[1] + 0.1
    assert price.stages[-1].featureImportances.toArray().argmin() == 1  # b says nothing


def test_permuted_rows_are_not_shuffled(spark):
    # by hand: rows of a bucket in the order of their hash, feature j taken j + 1 places further on
    for n, size in ((30, 1000), (500, 100), (2, 4)):
        df = spark.range(n).selectExpr("id", "double(id % 7) AS a", "double(id % 11) AS b", "double(id) AS c", "double(id % 7 + id) AS y")
        model = fit_price(df, ["a", "b", "c"], target="y", trees=5)
        got = permutation_importance(model, df, ["a", "b", "c"], "y", ["id"], task="regression", k=None, bucket_rows=size)
        rows = [(r.h, [r.a, r.b, r.c], r.y) for r in df.selectExpr("*", "xxhash64(id, 42) AS h").collect()]
        at, buckets = max(1, n // size), {}
        for r in sorted(rows):
            buckets.setdefault(r[0] % at, []).append(r)
        trial = [(-1, x, y) for _, x, y in rows]
        for some in buckets.values():
            for i, (_, x, y) in enumerate(some):
                trial += [(j, [*x[:j], some[(i + 1 + j) % len(some)][1][j], *x[j + 1:]], y) for j in range(3)]
        scored = model.transform(spark.createDataFrame([(j, *x, y) for j, x, y in trial], "j int, a double, b double, c double, y double"))
        m = {r.j: r.m for r in scored.groupBy("j").agg(F.avg(F.abs(F.col("prediction") - F.col("y"))).alias("m")).collect()}
        want = {c: m[j] - m[-1] for j, c in enumerate(("a", "b", "c"))}
        assert {r.feature: r.importance for r in got.collect()} == pytest.approx(want, abs=1e-9)
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Join") == 1 and "bucket" in plan  # of the features' names only
