"""Scoring: attach predicted phase, price change and anomaly columns.

``rule_scores`` is the stand-in scorer used before (or instead of) trained
models: the rule phase as the predicted phase, a persistence price forecast
(this month's change) and an anomaly flag for the top ``contamination``
share of the compound risk score.  ``models.score_all`` attaches the same
columns from fitted Spark ML models and the isolation forest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import constants as K
from ..functions import price_direction
from ..operators import global_quantile, with_labels
from ..functions._util import np_round


def with_anomaly_threshold(df: DataFrame, score: str = "anomaly_score",
                           contamination: float = K.FOREST_CONTAMINATION) -> DataFrame:
    """Flag rows whose score is above the (1 - contamination) quantile; the
    quantile is a scalar subquery over the whole table."""
    thr = global_quantile(df, score, 1.0 - contamination)
    return df.withColumn("is_anomaly", F.coalesce(F.col(score) > thr, F.lit(False)).cast("int"))


def rule_scores(features: DataFrame, contamination: float = K.FOREST_CONTAMINATION,
                action_style: str = "short") -> DataFrame:
    df = features.withColumns({
        "pred_ipc_phase": F.col("ipc_phase").cast("int"),
        "pred_ipc_confidence": F.lit(1.0),
        "pred_price_change": np_round(F.coalesce(F.col("price_change_pct"), F.lit(0.0)), 2),
        "anomaly_score": np_round(F.col("compound_risk_score"), 4)})
    df = with_labels(df, "pred_ipc_phase", "pred_ipc", action_style)
    df = df.withColumn("pred_price_direction", price_direction("pred_price_change"))
    return with_anomaly_threshold(df, "anomaly_score", contamination)
