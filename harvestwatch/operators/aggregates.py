"""Summaries.

Every summary is a hash aggregate (partial aggregation before the shuffle).
Global scalars -- totals, min/max for histogram edges -- are scalar
subqueries: computed once by their own small job and inlined, never joined
with a cross join and never collected in a loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.text import fractional_year, text_bar


def distribution(df: DataFrame, c: str, bar: bool = False) -> DataFrame:
    """Value counts sorted by value, with share of the total (percent)."""
    counts = df.groupBy(c).agg(F.count(F.lit(1)).alias("count"))
    total = df.select(F.count(F.lit(1))).scalar()
    out = counts.withColumn("pct", F.col("count") * F.lit(100.0) / total)
    if bar:
        out = out.withColumn("bar", text_bar("pct"))
    return out


def distinct_count(df: DataFrame, cols, approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """Number of distinct values per column (HyperLogLog++ when ``approx``)."""
    fn = (lambda c: F.approx_count_distinct(c, rsd)) if approx else F.count_distinct
    return df.agg(*[fn(F.col(c)).alias(f"n_{c}") for c in cols])


def distinct_values(df: DataFrame, c: str) -> DataFrame:
    """Sorted distinct values."""
    return df.select(c).where(F.col(c).isNotNull()).distinct()


def min_max(df: DataFrame, cols) -> DataFrame:
    """A9."""
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
    return df.agg(*aggs)


def mean_by(df: DataFrame, key, c: str, out: str | None = None, scale: float = 1.0) -> DataFrame:
    """A10: mean of ``c`` per key (times ``scale``, e.g. 100 for a rate)."""
    keys = [key] if isinstance(key, str) else list(key)
    m = F.avg(c) if scale == 1.0 else F.avg(c) * F.lit(float(scale))
    return df.groupBy(*keys).agg(m.alias(out or f"mean_{c}"))


def sum_by(df: DataFrame, key, c: str, out: str | None = None) -> DataFrame:
    """Sum of ``c`` per key; a group with only NULLs sums to 0."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.coalesce(F.sum(c), F.lit(0)).alias(out or f"sum_{c}"))


def count_where_by(df: DataFrame, cond: Column, key, out: str = "n", k: int | None = None) -> DataFrame:
    """Rows meeting ``cond`` per key; ``k`` keeps the top k by count
    (ties broken by key, so the result is deterministic)."""
    keys = [key] if isinstance(key, str) else list(key)
    res = df.filter(cond).groupBy(*keys).agg(F.count(F.lit(1)).alias(out))
    if k is not None:
        res = res.orderBy(F.col(out).desc(), *keys).limit(k)
    return res


def kpis(df: DataFrame, phase: str = "pred_ipc_phase", flood: str = "flood_flag",
         anomaly: str = "is_anomaly", risk: str = "compound_risk_score") -> DataFrame:
    """One-row headline numbers."""
    return df.agg(
        (F.avg(F.coalesce(F.col(phase) >= 3, F.lit(False)).cast("int")) * F.lit(100.0)).alias("crisis_pct"),
        (F.avg(flood) * F.lit(100.0)).alias("flood_pct"),
        F.coalesce(F.sum(anomaly), F.lit(0)).cast("long").alias("anomaly_n"),
        F.avg(risk).alias("avg_risk"),
        F.count(F.lit(1)).alias("rows"),
    )


def entity_profile(df: DataFrame, key: str = "district", flood: str = "flood_flag",
                   anomaly: str = "is_anomaly", risk: str = "compound_risk_score",
                   latest_cols=("pred_ipc_phase", "pred_ipc_confidence")) -> DataFrame:
    """Per-entity totals plus the latest period's values, all entities
    in one aggregate (``max_by`` keeps the latest row without a window)."""
    latest = F.max_by(F.struct(*[F.col(c) for c in ("year", "month", *latest_cols)]),
                      F.struct("year", "month"))
    return (df.groupBy(key)
            .agg(F.coalesce(F.sum(flood), F.lit(0)).cast("long").alias("flood_months"),
                 F.coalesce(F.sum(anomaly), F.lit(0)).cast("long").alias("anomaly_months"),
                 F.avg(risk).alias("avg_risk"),
                 latest.alias("latest"))
            .select(key, "flood_months", "anomaly_months", "avg_risk",
                    F.col("latest.year").alias("latest_year"), F.col("latest.month").alias("latest_month"),
                    *[F.col(f"latest.{c}").alias(f"latest_{c}") for c in latest_cols]))


def period_series(df: DataFrame, c: str, out: str | None = None) -> DataFrame:
    """Mean per (year, month) with a fractional-year axis; empty months
    dropped."""
    out = out or f"mean_{c}"
    return (df.groupBy("year", "month").agg(F.avg(c).alias(out))
            .where(F.col(out).isNotNull())
            .withColumn("date_n", fractional_year()))


def histogram(df: DataFrame, c: str, bins: int = 50) -> DataFrame:
    """Equal-width bins over [min, max]; the top edge falls in the last
    bin (numpy convention).  Returns (bin, lo, hi, count) for non-empty bins."""
    vals = df.select(F.col(c).alias("v")).where(F.col("v").isNotNull())
    # both edges from one pass: a struct-valued scalar subquery
    edges = vals.select(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi"))).scalar()
    lo, hi = edges.getField("lo"), edges.getField("hi")
    width = (hi - lo) / F.lit(float(bins))
    b = F.when(hi == lo, F.lit(1)).otherwise(
        F.least(F.width_bucket(F.col("v"), lo, hi, F.lit(bins)), F.lit(bins)))
    return (vals.withColumn("bin", b.cast("int")).groupBy("bin")
            .agg(F.count(F.lit(1)).alias("count"))
            .withColumn("lo", lo + (F.col("bin") - 1) * width)
            .withColumn("hi", lo + F.col("bin") * width))


_PANDAS_DTYPE = {T.DoubleType: "float64", T.FloatType: "float64", T.IntegerType: "int64",
                 T.LongType: "int64", T.ShortType: "int64", T.BooleanType: "bool",
                 T.StringType: "object", T.DateType: "datetime64[ns]"}


def dtype_name(dt: T.DataType) -> str:
    return _PANDAS_DTYPE.get(type(dt), dt.simpleString())


def column_profile(df: DataFrame, cols=None) -> DataFrame:
    """(seq, column, dtype, missing) for each column, name-sorted and
    numbered; one aggregate over the table, then unpivoted."""
    cols = sorted(cols or df.columns)
    types = {f.name: dtype_name(f.dataType) for f in df.schema}
    missing = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(f"m{i}") for i, c in enumerate(cols)])
    rows = F.array(*[F.struct(F.lit(i + 1).alias("seq"), F.lit(c).alias("column"),
                              F.lit(types[c]).alias("dtype"),
                              F.coalesce(F.col(f"m{i}"), F.lit(0)).alias("missing"))
                     for i, c in enumerate(cols)])
    return missing.select(F.inline(rows))


def non_null_counts(df: DataFrame, cols) -> DataFrame:
    """Non-NULL count per column."""
    return df.agg(*[F.count(F.col(c)).alias(f"nn_{c}") for c in cols])
