"""Evaluation tables (M4, M12-M14) as aggregates.

All inputs are (label, prediction) tables; the per-class tables have one row
per class, so the global totals are scalar subqueries over tiny aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import panel_window


def persistence_forecast(df: DataFrame, label: str, key: str = "district") -> DataFrame:
    """Baseline forecast: next period = this period.  Rows without a previous
    period are dropped."""
    return (df.select(key, "year", "month", F.col(label).alias("y"),
                      F.lag(label).over(panel_window(key)).alias("pred"))
            .where(F.col("pred").isNotNull()))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """M4: total / (n_classes x class count) per class."""
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.select(F.sum("n")).scalar()
    n_cls = counts.select(F.count(F.lit(1))).scalar()
    return counts.withColumn("weight", total / (n_cls * F.col("n")).cast("double"))


def with_class_weight(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """M4 joined back: each row gets its class weight (the class table has
    one row per class; AQE broadcasts it)."""
    w = class_weights(df, label).select(F.col("label").alias(label), F.col("weight").alias(out))
    return df.join(w, on=label, how="left")


def confusion(df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    """M13 (long form): count per (true, predicted)."""
    return df.groupBy(F.col(y).alias("y"), F.col(pred).alias("pred")).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, classes, y: str = "y", pred: str = "pred") -> DataFrame:
    """M13 (wide form): one column per listed class, zeros filled."""
    return (df.groupBy(F.col(y).alias("y")).pivot(pred, list(classes)).agg(F.count(F.lit(1)))
            .fillna(0))


def classification_report(df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    """Per-class precision, recall, F1, support and the support-weighted
    F1 (zero division -> 0)."""
    c = confusion(df, y, pred)
    roles = c.select(F.explode(F.array(
        F.struct(F.col("y").alias("label"), F.col("n").alias("support"), F.lit(0).cast("long").alias("pp"),
                 F.when(F.col("y") == F.col("pred"), F.col("n")).otherwise(F.lit(0)).cast("long").alias("tp")),
        F.struct(F.col("pred").alias("label"), F.lit(0).cast("long").alias("support"), F.col("n").alias("pp"),
                 F.lit(0).cast("long").alias("tp")))).alias("r")).select("r.*")
    per = roles.groupBy("label").agg(F.sum("tp").alias("tp"), F.sum("pp").alias("pp"),
                                     F.sum("support").alias("support"))
    prec = F.when(F.col("pp") == 0, F.lit(0.0)).otherwise(F.col("tp") / F.col("pp"))
    rec = F.when(F.col("support") == 0, F.lit(0.0)).otherwise(F.col("tp") / F.col("support"))
    per = per.select("label", F.col("support").cast("long").alias("support"),
                     prec.alias("precision"), rec.alias("recall"))
    f1 = F.when(F.col("precision") + F.col("recall") == 0, F.lit(0.0)).otherwise(
        F.lit(2) * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")))
    per = per.withColumn("f1", f1)
    weighted = per.select(F.sum(F.col("support") * F.col("f1")) / F.sum("support")).scalar()
    return per.withColumn("weighted_f1", weighted)


def regression_metrics(df: DataFrame, y: str = "y", pred: str = "pred", mape_floor: float = 0.1) -> DataFrame:
    """MAE, R^2 and MAPE (over |y| > floor, in percent) in one aggregate."""
    e = F.col(y) - F.col(pred)
    return df.agg(
        F.avg(F.abs(e)).alias("mae"),
        # spread about the mean as a variance: no subquery, so model output works too
        (F.lit(1.0) - F.sum(e * e) / (F.var_pop(y) * F.count(y))).alias("r2"),
        (F.avg(F.when(F.abs(F.col(y)) > mape_floor, F.abs(e / F.col(y)))) * F.lit(100.0)).alias("mape"),
        F.count(F.lit(1)).alias("n"))
