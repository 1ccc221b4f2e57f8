"""Model queries (rows-only checks: no SQL oracle can fit a forest).

Each query cuts the feature table's lineage once (a reliable checkpoint in
the shared checkpoint folder) because training makes several passes over it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import constants as K
from ..operators import latest_row, sample_rows, select_by_keyword, select_covered, select_features
from ..plans import standin as S
from ..session import cut_lineage, stage_path
from .attribution import attribution_ranking, regression_scorer, shapley_values
from .calibrate import calibration_error, fit_calibrated
from .forest import isolation_forest
from .importance import permutation_importance
from .metrics import classification_report, regression_metrics
from .split import hash_split, stratified_split
from .supervised import feature_importance, fit_phase, fit_price, predict_phase, predict_price, price_frame

# Union of both exclusion lists (price_lag1 for the older lag name)
EXCLUDE = ("region", "district", "year", "month", "ipc_phase", "compound_risk_flag", "price_lag1")
KEYS = ("district", "year", "month")


def _features(spark, sf):
    # the stand-in feature panel is already a materialised stage table
    return S.features(spark, sf)


def feature_columns(df):
    return select_features(df, EXCLUDE)


def q_stratified_split(spark, sf):
    f = S.features(spark, sf).select(*KEYS, "ipc_phase")
    return stratified_split(f, "ipc_phase", KEYS, K.TEST_FRACTION, K.SEED)


def q_phase_model(spark, sf, trees: int = 300):
    f = _features(spark, sf)
    cols = feature_columns(f)
    # the split is read twice (training, scoring): materialise it once
    split = cut_lineage(stratified_split(f, "ipc_phase", KEYS, K.TEST_FRACTION, K.SEED))
    model = fit_phase(split.where(F.col("split") == "train"), cols, "ipc_phase", trees=trees)
    pred = predict_phase(model, split, cols)
    return pred.select(*KEYS, "split", "ipc_phase", "pred_ipc_phase", "pred_ipc_confidence", "pred_ipc_label")


def _price_frame(spark, sf):
    f = _features(spark, sf)
    t, source = price_frame(f)
    t = cut_lineage(t)  # read by the column choice, the training and the scoring
    cols = select_covered(t, [c for c in feature_columns(f) if c != source], 0.5)
    return f, t, cols


def q_price_model(spark, sf, trees: int = 200):
    f, t, cols = _price_frame(spark, sf)
    split = hash_split(t, KEYS, 0.8, K.SEED)
    model = fit_price(split.where(F.col("split") == "train"), cols, trees=trees)
    pred = predict_price(model, split, cols)
    return pred.select(*KEYS, "split", "target_price_change", "pred_price_change", "pred_price_direction")


def q_phase_evaluation(spark, sf):
    """Report of the fitted classifier on the held-out rows."""
    pred = cut_lineage(q_phase_model(spark, sf).where(F.col("split") == "test"))
    return classification_report(pred, "ipc_phase", "pred_ipc_phase")


def q_price_evaluation(spark, sf):
    """Errors of the fitted regressor on the held-out rows."""
    pred = q_price_model(spark, sf).where(F.col("split") == "test")
    return regression_metrics(pred, "target_price_change", "pred_price_change")


def q_isolation_forest(spark, sf):
    f = _features(spark, sf)
    cols = select_by_keyword(feature_columns(f), K.ANOMALY_KEYWORDS)
    scored = isolation_forest(f, cols, keys=KEYS)
    return scored.select(*KEYS, "anomaly_score", "anomaly_label", "is_anomaly")


def q_importance(spark, sf, trees: int = 200):
    f, t, cols = _price_frame(spark, sf)
    train = hash_split(t, KEYS, 0.8, K.SEED).where(F.col("split") == "train")
    model = fit_price(train, cols, trees=trees)
    return feature_importance(model, cols, spark, 15)


def q_permutation_importance(spark, sf, trees: int = 300):
    f = _features(spark, sf)
    cols = feature_columns(f)
    split = cut_lineage(stratified_split(f, "ipc_phase", KEYS, K.TEST_FRACTION, K.SEED))
    model = fit_phase(split.where(F.col("split") == "train"), cols, "ipc_phase", trees=trees)
    return permutation_importance(model, split.where(F.col("split") == "test"), cols, "ipc_phase", KEYS)


def q_saved_scores(spark, sf):
    """The feature table scored with models that were saved and loaded."""
    from ..plans.pipeline import score_models, score_saved
    f, base = _features(spark, sf), stage_path(spark, "models-" + uuid.uuid4().hex)
    score_models(f, base)
    return score_saved(f, f"{base}/models").select(
        *KEYS, "pred_ipc_phase", "pred_ipc_confidence", "pred_price_change", "pred_price_direction",
        "anomaly_score", "is_anomaly")


def q_attribution(spark, sf, trees: int = 100, sample: int = 200):
    """The 15 features that move the fitted regressor most, by sampled Shapley values of a
    seeded sample of held-out rows (the sample is the operator's)."""
    f, t, cols = _price_frame(spark, sf)
    split = hash_split(t, KEYS, 0.8, K.SEED)
    model = fit_price(split.where(F.col("split") == "train"), cols, trees=trees)
    test = split.where(F.col("split") == "test")
    values = shapley_values(regression_scorer(model), sample_rows(test, sample, KEYS), cols, KEYS, latest_row(
        split.where(F.col("split") == "train"), "region", order=(*KEYS[1:], "district")))
    return attribution_ranking(values)


# Boosting rounds and folds of the registered queries: each class of each fold is a model of its own.
BOOSTED = {"trees": 15, "depth": 4, "learning_rate": 0.3}


def _boosted(spark, sf):
    f = _features(spark, sf)
    cols = feature_columns(f)
    split = cut_lineage(stratified_split(f, "ipc_phase", KEYS, K.TEST_FRACTION, K.SEED))
    return split, cols, fit_calibrated(split.where(F.col("split") == "train"), cols, "ipc_phase", KEYS, folds=2, **BOOSTED)


def q_phase_boosted(spark, sf):
    """M5 boosted, M10 with calibrated confidence, over the whole feature table."""
    split, _, model = _boosted(spark, sf)
    return model.predict(split).select(*KEYS, "split", "ipc_phase", "pred_ipc_phase", "pred_ipc_confidence", "pred_ipc_label")


def q_phase_boosted_evaluation(spark, sf, trees: int = 100):
    """Weighted F1 of the boosted classifier and of the forest on the held-out rows, and how far
    the confidence of each is from its accuracy."""
    split, cols, model = _boosted(spark, sf)
    test = split.where(F.col("split") == "test")
    forest = fit_phase(split.where(F.col("split") == "train"), cols, "ipc_phase", trees=trees)
    out = None
    for name, pred in (("boosted", model.predict(test)), ("forest", predict_phase(forest, test, cols))):
        pred = cut_lineage(pred.select("ipc_phase", "pred_ipc_phase", "pred_ipc_confidence"))
        f1 = classification_report(pred, "ipc_phase", "pred_ipc_phase").agg(F.max("weighted_f1")).scalar()
        row = calibration_error(pred).select(F.lit(name).alias("model"), f1.alias("weighted_f1"), "*")
        out = row if out is None else out.unionByName(row)
    return out


MODEL_QUERIES = {
    "attribution": q_attribution,
    "phase_boosted": q_phase_boosted,
    "phase_boosted_evaluation": q_phase_boosted_evaluation,
    "stratified_split": q_stratified_split,
    "phase_model": q_phase_model,
    "price_model": q_price_model,
    "phase_evaluation": q_phase_evaluation,
    "price_evaluation": q_price_evaluation,
    "isolation_forest": q_isolation_forest,
    "importance": q_importance,
    "permutation_importance": q_permutation_importance,
    "saved_scores": q_saved_scores,
}
