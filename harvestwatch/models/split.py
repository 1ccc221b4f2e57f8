"""Reproducible splits (M2, M3), independent of partitioning.

Both derive a uniform number per row from ``xxhash64(keys, seed)``, so a row
lands in the same split however the data is partitioned or re-run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

_SPAN = 1 << 40  # 40-bit uniform integer per row


def _u(keys, seed: int):
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys], F.lit(seed)), F.lit(_SPAN))


def hash_split(df: DataFrame, keys, train_frac: float = 0.8, seed: int = 42, out: str = "split") -> DataFrame:
    """M3: ``train`` for a ``train_frac`` share of rows (in expectation)."""
    cut = int(train_frac * _SPAN)
    return df.withColumn(out, F.when(_u(keys, seed) < F.lit(cut), F.lit("train")).otherwise(F.lit("test")))


def stratified_split(df: DataFrame, label: str, keys, test_frac: float = 0.2, seed: int = 42,
                     buckets: int = 4096, out: str = "split") -> DataFrame:
    """M2: exact stratified split -- each class sends round(test_frac x n_c)
    rows (the lowest hash values) to ``test``.

    Skew-safe: instead of ranking a whole class in one window (a class may
    hold a third of all rows), rows are counted per (class, hash bucket);
    a cumulative count over that small table locates, per class, the one
    bucket that straddles the cut, and only rows of those boundary buckets
    are ranked -- each holds about n_c / ``buckets`` rows.
    """
    shift = (_SPAN // buckets).bit_length() - 1
    rows = df.withColumns({"__u": _u(keys, seed)}).withColumn("__b", F.shiftright("__u", shift))
    counts = rows.groupBy(label, "__b").agg(F.count(F.lit(1)).alias("__n"))
    wc = Window.partitionBy(label).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    totals = Window.partitionBy(label)
    plan = (counts.withColumn("__before", F.coalesce(F.sum("__n").over(wc), F.lit(0)))
            .withColumn("__ntest", F.floor(F.sum("__n").over(totals) * F.lit(float(test_frac)) + F.lit(0.5)))
            .withColumn("__mode", F.when(F.col("__before") + F.col("__n") <= F.col("__ntest"), F.lit("test"))
                        .when(F.col("__before") >= F.col("__ntest"), F.lit("train"))
                        .otherwise(F.lit("edge")))
            .withColumn("__take", F.col("__ntest") - F.col("__before"))
            .select(label, "__b", "__mode", "__take"))
    plan = plan.withColumnRenamed(label, "__label").withColumnRenamed("__b", "__bucket")
    # null-safe: rows without a label are a class of their own
    tagged = rows.join(plan, rows[label].eqNullSafe(plan["__label"]) & (rows["__b"] == plan["__bucket"]),
                       "left").drop("__label", "__bucket")
    edge = tagged.where(F.col("__mode") == "edge")
    wr = Window.partitionBy(label, "__b").orderBy("__u", *keys)
    edge = edge.withColumn(out, F.when(F.row_number().over(wr) <= F.col("__take"), F.lit("test"))
                           .otherwise(F.lit("train")))
    rest = tagged.where(F.col("__mode") != "edge").withColumn(out, F.col("__mode"))
    return edge.unionByName(rest).drop("__u", "__b", "__mode", "__take")
