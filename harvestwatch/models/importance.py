"""Permutation importance (M16): how much a metric drops when one feature's
values are shuffled over the scored rows -- one scoring job for all features.

Rows are dealt into hash buckets of about ``bucket_rows`` rows and numbered in
each; for feature j a row takes feature j from the row ``j + 1`` places further
on in its bucket (a rotation, so no row keeps its own value where a bucket has
more rows than there are features).  The values come from the rows that follow in the
bucket's window, so a row is shuffled once and its ``features`` copies are made where they
are scored; no task ever numbers more than one bucket.  Rows are scored as they are once;
a row whose donor has the same value keeps that score, so flags and values of a region
cost few rows.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Window, functions as F

from ..operators import sample_rows
from ..session import cut_lineage
from .supervised import prepare

BUCKET_ROWS = 4096


def permutation_importance(model: PipelineModel, df: DataFrame, cols, label: str, keys,
                           n: int | None = None, seed: int = 42, task: str = "classification",
                           k: int | None = 15, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Importance of ``cols`` over all rows of ``df`` (held-out rows, as a rule), or
    over a seeded sample of ``n`` (O5).  ``keys`` identify rows."""
    cols = list(cols)
    stages = model.stages[1:] if task == "classification" else model.stages
    if task == "classification":
        lab = F.element_at(F.array(*[F.lit(v) for v in model.stages[0].labels]), F.col("prediction").cast("int") + 1)
        metric = (lab == F.col("__y").cast("string")).cast("double")
    else:
        metric = -F.abs(F.col("prediction") - F.col("__y"))

    def score(df: DataFrame, keep, out: str) -> DataFrame:
        x = df.select(*keep, *[F.col("__x")[i].alias(c) for i, c in enumerate(cols)])
        return PipelineModel(stages=stages).transform(x).select(*keep, metric.alias(out))

    rows = prepare(df if n is None else sample_rows(df, n, keys, seed), cols)
    rows = rows.select(F.xxhash64(*[F.col(c) for c in keys], F.lit(seed)).alias("h"), F.col(label).alias("__y"),
                       F.array(*[F.col(c) for c in cols]).alias("__x"))
    rows = cut_lineage(score(rows, ["h", "__y", "__x"], "__base"))  # read twice: counted, then permuted
    total, known = rows.agg(F.count(F.lit(1)), F.count("__base")).first()  # † decides the number of buckets
    bucket = F.pmod("h", F.lit(max(1, total // bucket_rows)))
    whole = Window.partitionBy("bucket")
    w = whole.orderBy("h", "__x")
    s = rows.withColumn("bucket", bucket).select(
        "bucket", F.row_number().over(w).alias("idx"), F.count(F.lit(1)).over(whole).alias("size"), "__y", "__x", "__base",
        F.array(*[F.lead(F.get("__x", F.lit(j)), j + 1).over(w) for j in range(len(cols))]).alias("next"))
    # the last rows of a bucket take from its first ones
    s = s.withColumn("first", F.collect_list(F.when(F.col("idx") <= len(cols), F.struct("idx", "__x"))).over(whole))
    own, other = F.get("__x", "j"), F.get("d_x", "j")
    donors = F.array(*[F.when(F.col("idx") + j < F.col("size"), F.get("next", F.lit(j))).otherwise(
        F.get(F.get(F.sort_array("first"), F.pmod(F.col("idx") + j, F.col("size")).cast("int"))["__x"], F.lit(j))) for j in range(len(cols))])
    perm = (s.select("__y", "__x", "__base", donors.alias("d_x"))
            .withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(len(cols) - 1))))
            .where(~own.eqNullSafe(other))  # the same value, the same prediction
            .select("__y", F.transform("__x", lambda v, i: F.when(i == F.col("j"), other).otherwise(v)).alias("__x"),
                    "j", "__base"))
    lost = score(perm, ["__y", "j", "__base"], "m").groupBy("j").agg(F.sum(F.col("__base") - F.col("m")).alias("lost"))
    names = F.element_at(F.array(*[F.lit(c) for c in cols]), F.col("j") + 1)
    every = df.sparkSession.range(len(cols) if total else 0).select(F.col("id").cast("int").alias("j"))
    out = every.join(lost, "j", "left").select(names.alias("feature"), F.try_divide(
        F.coalesce("lost", F.lit(0.0)), F.lit(known)).alias("importance"))
    if k is not None:
        out = out.orderBy(F.col("importance").desc(), "feature").limit(k)
    return out
