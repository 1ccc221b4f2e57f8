"""Mergeable summaries of labels and of distinct values.

``label_counts`` counts every label of the columns and ranks the most frequent ones.
``distinct_sketches`` keeps a distinct-count sketch per group; sketches of any groups can
be united later (a range of years, say) without reading the raw rows again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..session import cut_lineage

LG_K = 14  # a sketch has 2^14 registers


def label_counts(df: DataFrame, cols, k: int = 20, tracked: int | None = None) -> DataFrame:
    """(column, value, n, share, rank): the ``k`` most frequent labels of each column
    with exact counts, ties by label, NULLs left out.

    Every label is counted, whatever their number: tasks combine counts before they are
    dealt by label, and each task sends its first ``k`` of a column to the ranking.
    ``tracked`` has no effect; it was the number of labels of a summary that left the
    rest out."""
    cols = list(cols)
    cells = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).cast("string").alias("v"))
                                          for i, c in enumerate(cols)])).alias("c")).select("c.i", "c.v")
    # read twice: for the totals and the ranks
    counts = cut_lineage(cells.where(F.col("v").isNotNull()).groupBy("i", "v").agg(F.count(F.lit(1)).alias("n")))
    totals = counts.groupBy("i").agg(F.sum("n").alias("total"))  # a row per column
    first = Window.partitionBy("i").orderBy(F.col("n").desc(), "v")  # cut to k rows before they are dealt by column
    ranked = counts.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
    return ranked.join(totals, "i").select(
        F.element_at(F.array(*[F.lit(c) for c in cols]), F.col("i") + 1).alias("column"), F.col("v").alias("value"), "n",
        (F.col("n") / F.col("total")).alias("share"), "rank")


def distinct_sketches(df: DataFrame, keys, cols, lg_k: int = LG_K) -> DataFrame:
    """Per group a sketch of the distinct values of each column (``<column>_sketch``), to
    be kept with the group's stage table."""
    return df.groupBy(*keys).agg(*[F.hll_sketch_agg(c, lg_k).alias(f"{c}_sketch") for c in cols])


def distinct_from(sketches: DataFrame, keys, cols) -> DataFrame:
    """Distinct counts (``n_<column>``) of the groups united by ``keys``; with no keys one
    row.  A value of several groups counts once."""
    aggs = [F.hll_sketch_estimate(F.hll_union_agg(f"{c}_sketch")).alias(f"n_{c}") for c in cols]
    return sketches.groupBy(*keys).agg(*aggs) if keys else sketches.agg(*aggs)


def sketch_error(lg_k: int = LG_K, deviations: float = 3.0) -> float:
    """Relative error that an estimate keeps to within so many standard deviations."""
    return deviations * 1.04 / 2 ** (lg_k / 2)
