"""Raw -> monthly grain.

All of these are hash aggregates: Spark computes partial aggregates before the
shuffle (map-side combine), so a hot key -- one region holding a third of the
rows -- ships one partial row per map task, not its raw rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.flags import flag_ge
from ..functions._util import np_round


def require(df: DataFrame, cols) -> DataFrame:
    """Drop rows with NULL in any of ``cols``."""
    return df.dropna(subset=list(cols))


def with_year_month(df: DataFrame, date: str = "date", year: str = "year", month: str = "month") -> DataFrame:
    """Integer calendar parts."""
    return df.withColumns({year: F.year(date), month: F.month(date)})


def rename_all(df: DataFrame, mapping: dict) -> DataFrame:
    """Rename the columns present in ``mapping``."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def _keys_not_null(df: DataFrame, keys) -> DataFrame:
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.filter(cond) if cond is not None else df


def monthly_mean(df: DataFrame, keys, cols, digits: int | None = 3) -> DataFrame:
    """A1/A2: mean of each value column per key (NULL keys excluded, NULLs
    skipped by the mean); ``cols`` is a list or a ``{source: output}`` map."""
    mapping = cols if isinstance(cols, dict) else {c: c for c in cols}
    aggs = []
    for src, out in mapping.items():
        m = F.avg(F.col(src))
        aggs.append((np_round(m, digits) if digits is not None else m).alias(out))
    return _keys_not_null(df, keys).groupBy(*keys).agg(*aggs)


def pivot_mean(df: DataFrame, keys, pivot_col: str, value: str, values) -> DataFrame:
    """A3: one column per listed pivot value holding the mean of ``value``.

    The value list is explicit, so Spark needs no extra job to discover the
    columns, and the output schema is fixed.
    """
    return (_keys_not_null(df, keys).groupBy(*keys)
            .pivot(pivot_col, list(values)).agg(F.avg(value)))


def monthly_events(df: DataFrame, keys, id_col: str = "event_id_cnty",
                   fatalities: str = "fatalities", flag: str = "is_flood_event") -> DataFrame:
    """A4: event count, fatality sum, flagged-event sum per key.

    A sum over no values is 0 here (as a pandas group sum), not NULL.
    """
    return (_keys_not_null(df, keys).groupBy(*keys)
            .agg(F.count(id_col).alias("conflict_events"),
                 F.coalesce(F.sum(F.coalesce(F.col(fatalities), F.lit(0.0))), F.lit(0.0)).alias("fatalities_total"),
                 F.coalesce(F.sum(flag), F.lit(0)).cast("long").alias("flood_displace_events")))


# A summary of this many points per pass; tables of no more rows need no bracket.
SUMMARY_POINTS = 20_000
BRACKET = 5.0 / SUMMARY_POINTS  # on both sides of the rank; the summary errs by 1 / SUMMARY_POINTS
RANGES = 256


def quantile_table(df: DataFrame, c: str, q: float) -> DataFrame:
    """A5 as a one-row table ``quantile``: exact and interpolated, NULLs left
    out, NULL for no values.

    A mergeable quantile summary names two values that bracket the rank with about
    one row of 2,000 between them.  A second pass counts what lies below and each
    value inside; the bracket is cut into ranges, whose totals name the one or two
    that hold the ranks, and only values of those are put in order.  Both passes
    combine before the shuffle, and no task orders more than a range of the bracket.
    """
    v = F.col(c).cast("double")
    rows = df.where(F.col(c).isNotNull()).select(v.alias("v"))
    around = [max(0.0, q - BRACKET), min(1.0, q + BRACKET)]
    summary = rows.agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("v", around, SUMMARY_POINTS).alias("ends"),
                       F.min("v").alias("least"), F.max("v").alias("most"))
    whole = F.col("n") <= SUMMARY_POINTS
    s = summary.select(F.struct(
        "n", F.when(whole, F.col("least")).otherwise(F.col("ends")[0]).alias("lo"),
        F.when(whole, F.col("most")).otherwise(F.col("ends")[1]).alias("hi")).alias("s")).scalar()
    lo, hi = s.getField("lo"), s.getField("hi")
    counts = rows.where(F.col("v") <= hi).select(F.when(F.col("v") >= lo, F.col("v")).alias("v")).groupBy("v").agg(
        F.count(F.lit(1)).alias("n"))  # the row without a value counts what lies below
    width = hi - lo
    at = F.when((width > 0) & (width < 1.7e308), F.least(F.lit(RANGES - 1), F.floor((F.col("v") - lo) / width * RANGES))
                ).otherwise(F.lit(0)).cast("int")
    counts = counts.withColumn("b", F.when(F.col("v").isNull(), F.lit(-1)).otherwise(at))
    totals = counts.groupBy("b").agg(F.sum("n").alias("n")).agg(F.collect_list(F.struct("b", "n")).alias("r"))
    before = lambda b: F.aggregate("r", F.lit(0).cast("long"),
                                   lambda a, x: a + F.when(x["b"] < b, x["n"]).otherwise(F.lit(0)))
    ranges = totals.select(F.map_from_entries(F.transform("r", lambda x: F.struct(
        x["b"], F.struct(before(x["b"]).alias("before"), x["n"].alias("held"))))).alias("m")).scalar()  # an entry per range

    pos = (s.getField("n") - 1) * F.lit(float(q))
    ranked = (counts.where(F.col("v").isNotNull())
              .withColumn("r", F.element_at(ranges, F.col("b")))
              .withColumns({"before": F.col("r.before"), "held": F.col("r.held"), "pos": pos,
                            "r_lo": F.floor(pos), "r_hi": F.ceil(pos)})
              .where((F.col("before") <= F.col("r_hi")) & (F.col("before") + F.col("held") > F.col("r_lo")))
              .select("v", "pos", "r_lo", "r_hi",
                      (F.col("before") + F.sum("n").over(Window.partitionBy("b").orderBy("v"))).alias("upto")))
    ends = ranked.agg(F.min(F.when(F.col("upto") > F.col("r_lo"), F.col("v"))).alias("v_lo"),
                      F.min(F.when(F.col("upto") > F.col("r_hi"), F.col("v"))).alias("v_hi"),
                      F.max("pos").alias("pos"), F.max("r_lo").alias("lo"), F.max("r_hi").alias("hi"))
    between = (F.col("hi") - F.col("pos")) * F.col("v_lo") + (F.col("pos") - F.col("lo")) * F.col("v_hi")
    return ends.select(F.when((F.col("lo") == F.col("hi")) | (F.col("v_lo") == F.col("v_hi")), F.col("v_lo"))
                       .otherwise(between).alias("quantile"))


def global_quantile(df: DataFrame, c: str, q: float) -> Column:
    """A5: the exact quantile as a scalar subquery, inlined into the outer plan:
    no cross join, no collect."""
    return quantile_table(df, c, q).scalar()


def quantile_flag(df: DataFrame, c: str, q: float, out: str) -> DataFrame:
    """1 where ``c`` >= the q-quantile of ``c`` over the whole table."""
    return df.withColumn(out, flag_ge(c, global_quantile(df, c, q)))
