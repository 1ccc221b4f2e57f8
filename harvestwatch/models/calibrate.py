"""Calibrated class confidence (M10) for the boosted classifier (M5).

Margins of boosted trees order rows well, but are no probabilities.  The training
rows are dealt into folds by a hash of their keys; a model fitted without a fold gives
that fold's margins, and over all folds one isotonic regression per class maps a
class's margin to the share of rows that were of it.  The final model is fitted to all
training rows; its margins go through the same maps, and the classes' values are
scaled to add up to one.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import phase_action, phase_label
from ..functions._util import np_round
from ..session import cut_lineage
from .supervised import fit_phase, prepare

MAX_POINTS = 1_000  # margins of a class that its map is fitted to are summed into so many steps


def margins(model: PipelineModel, df: DataFrame, cols) -> DataFrame:
    """Adds ``__margins``, one per label of the model, and ``__best``, the label of the largest."""
    out = PipelineModel(stages=model.stages[1:]).transform(prepare(df, cols))
    raw = vector_to_array("rawPrediction")
    labels = F.array(*[F.lit(v) for v in model.stages[0].labels])
    out = out.withColumns({"__margins": raw, "__best": F.element_at(labels, F.col("prediction").cast("int") + 1)})
    return out.drop(*[c for c in ("features", "rawPrediction", "probability", "prediction") if c in out.columns])


class Calibrated:
    """A fitted classifier with a map from margin to probability per class, as the
    points (margin, probability) between which it is linear."""

    def __init__(self, model: PipelineModel, cols, maps: dict[str, list[tuple[float, float]]]):
        self.model, self.cols, self.maps = model, list(cols), maps

    def probabilities(self) -> Column:
        """Probability per label of ``__margins``."""
        labels = self.model.stages[0].labels
        raw = F.array(*[_between(F.col("__margins")[i], self.maps[v]) if self.maps.get(v) else
                        1.0 / (1.0 + F.exp(-2.0 * F.col("__margins")[i])) for i, v in enumerate(labels)])
        total = F.aggregate(raw, F.lit(0.0), lambda a, p: a + p)
        return F.when(total > 0, F.transform(raw, lambda p: p / total)).otherwise(
            F.array_repeat(F.lit(1.0 / len(labels)), len(labels)))

    def predict(self, df: DataFrame, action_style: str = "short") -> DataFrame:
        """Phase, label, action and the calibrated probability of that phase."""
        labels = self.model.stages[0].labels
        out = margins(self.model, df, self.cols).withColumn("__p", self.probabilities())
        at = F.array_position(F.array(*[F.lit(v) for v in labels]), F.col("__best")).cast("int")
        out = out.withColumns({"pred_ipc_phase": F.col("__best").cast("int"),
                               "pred_ipc_confidence": np_round(F.element_at("__p", at), 3)})
        out = out.withColumns({"pred_ipc_label": phase_label("pred_ipc_phase"),
                               "pred_ipc_action": phase_action("pred_ipc_phase", action_style)})
        return out.drop("__margins", "__best", "__p")


def _between(x: Column, points: list[tuple[float, float]]) -> Column:
    """Linear between points of rising margin, level outside; at most ``MAX_POINTS`` points,
    found by their position in a sorted literal array."""
    xs, ys = F.array(*[F.lit(float(a)) for a, _ in points]), F.array(*[F.lit(float(b)) for _, b in points])
    k = F.size(F.filter(xs, lambda a: a <= x))  # points at or below x
    x0, x1, y0, y1 = F.get(xs, k - 1), F.get(xs, k), F.get(ys, k - 1), F.get(ys, k)
    line = y0 + (y1 - y0) * F.when(x1 > x0, (x - x0) / (x1 - x0)).otherwise(F.lit(0.0))
    return F.when(k == 0, F.lit(float(points[0][1]))).when(k == len(points), F.lit(float(points[-1][1]))).otherwise(line)


def _thin(points: list[tuple[float, float]], limit: int) -> list[tuple[float, float]]:
    """The ends of each level stretch; evenly chosen ones if these are over the limit."""
    kept = [p for i, p in enumerate(points) if i in (0, len(points) - 1) or not points[i - 1][1] == p[1] == points[i + 1][1]]
    if len(kept) > limit:
        kept = [kept[round(i * (len(kept) - 1) / (limit - 1))] for i in range(limit)]
    return kept


def fit_calibrated(df: DataFrame, cols, label: str, keys, folds: int = 3, seed: int = 42, **boost) -> Calibrated:
    """The boosted classifier with calibration on held-out folds; ``boost`` goes to ``fit_phase``."""
    fold = F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(folds)).cast("int")
    data = cut_lineage(df.withColumn("__fold", fold))
    held = None
    for k in range(folds):
        rest = data.where(F.col("__fold") != k).drop("__fold")
        part = fit_phase(rest, cols, label, algo="boosted", **boost)
        labels = part.stages[0].labels
        scored = margins(part, data.where(F.col("__fold") == k), cols).select(
            F.col(label).cast("string").alias("y"), F.map_from_arrays(F.array(*[F.lit(v) for v in labels]), "__margins").alias("m"))
        held = scored if held is None else held.unionByName(scored)
    held = cut_lineage(held)
    model = fit_phase(data.drop("__fold"), cols, label, algo="boosted", **boost)
    maps = {}
    for v in model.stages[0].labels:
        # margins in steps, so the regression gets a bounded number of weighted points
        m = F.col("m")[v]
        rows = held.where(m.isNotNull()).select(m.alias("x"), (F.col("y") == v).cast("double").alias("y"))
        ends = rows.agg(F.min("x").alias("lo"), F.max("x").alias("hi")).first()  # † two numbers
        if ends["lo"] is None:
            continue
        width = max((ends["hi"] - ends["lo"]) / (MAX_POINTS - 1), 1e-12)
        points = rows.groupBy(F.floor((F.col("x") - ends["lo"]) / width).alias("k")).agg(
            F.avg("x").alias("x"), F.avg("y").alias("y"), F.count(F.lit(1)).cast("double").alias("w"))
        fitted = IsotonicRegression(featuresCol="x", labelCol="y", weightCol="w").fit(points)
        maps[v] = _thin(list(zip(fitted.boundaries.toArray().tolist(), fitted.predictions.toArray().tolist(), strict=True)), 200)
    return Calibrated(model, cols, maps)


def calibration_error(df: DataFrame, label: str = "ipc_phase", predicted: str = "pred_ipc_phase",
                      confidence: str = "pred_ipc_confidence", bins: int = 10) -> DataFrame:
    """One row ``(n, accuracy, confidence, ece)``: the expected calibration error is the mean
    distance of confidence and accuracy over bins of confidence, weighted by rows."""
    at = F.least(F.floor(F.col(confidence) * bins), F.lit(bins - 1))
    by = df.where(F.col(confidence).isNotNull()).groupBy(at.alias("b")).agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col(label) == F.col(predicted)).cast("double")).alias("hit"),
        F.sum(confidence).alias("conf"))
    return by.agg(F.sum("n").alias("n"), F.try_divide(F.sum("hit"), F.sum("n")).alias("accuracy"),
                  F.try_divide(F.sum("conf"), F.sum("n")).alias("confidence"),
                  F.try_divide(F.sum(F.abs(F.col("hit") - F.col("conf"))), F.sum("n")).alias("ece"))
