"""Refresh of the feature stage without a rebuild.

When readings of some months arrive late or are corrected, the rows that change
are those months, the rows whose lags and rolling frames see them, and the runs
(W8) that go through them.  ``refresh`` finds the years these rows lie in, reads
the years themselves and a halo of the last few rows of each entity before them,
computes the features over that slice, and replaces just these years of a
``YearTable``.  A run that begins before the slice goes on from the length that the
table holds for the slice's first row, so no streak needs its whole history.

The features here look back a bounded number of rows.  Columns that depend on
the whole table (a quantile flag, a region's mean over its history, the deviation from
an all-time mean) would change in every year and are not part of this stage: they
belong to a reader's query over it, or to a baseline that is fixed between rebuilds,
as ``with_anomaly`` takes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions import flag_gt, flag_lt
from ..functions._util import np_round
from ..operators import add_lags, rolling_col
from ..session import cut_lineage
from ..sources.yeartable import YearTable
from .. import constants as K

KEY = "district"
BASE = ("region", "district", "year", "month", "rainfall_mm", "rainfall_anomaly_pct", "flood_flag", "drought_flag")
LAGS, ROLLS = (1, 2, 3), (3, 6)
REACH = max(*LAGS, *(n - 1 for n in ROLLS))  # rows after a changed one whose features see it
STREAK = "flood_streak_months"


def _period():
    return F.col("year") * 12 + F.col("month") - 1


def with_anomaly(monthly: DataFrame, baseline: DataFrame, measure: str = "rainfall_mm", digits: int = 3) -> DataFrame:
    """Percent deviation from each entity's baseline (``district``, ``baseline``) with
    the flood and drought flags; an entity without a baseline has no anomaly."""
    v = np_round((F.try_divide(F.col(measure), F.col("baseline")) - 1.0) * 100.0, digits)
    df = monthly.join(baseline, KEY, "left").withColumn("rainfall_anomaly_pct", v).drop("baseline")
    return df.withColumns({"flood_flag": flag_gt("rainfall_anomaly_pct", K.FLOOD_ANOMALY_GT),
                           "drought_flag": flag_lt("rainfall_anomaly_pct", K.DROUGHT_ANOMALY_LT)})


def panel_features(panel: DataFrame, carried: str | None = None) -> DataFrame:
    """Lags, rolling means and the flood streak of a panel or a slice of one.
    ``carried`` names the streak length known for a slice's first rows."""
    df = add_lags(panel, "rainfall_anomaly_pct", LAGS, KEY, name="rainfall_anomaly_lag{n}")
    df = add_lags(df, "flood_flag", LAGS, KEY, fill=0)
    df = add_lags(df, "drought_flag", LAGS, KEY, fill=0)
    df = df.withColumns({f"rainfall_rolling_{n}m": np_round(rolling_col("rainfall_mm", n, "mean", KEY), 3) for n in ROLLS})
    w = Window.partitionBy(KEY).orderBy("year", "month")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    is_one = F.coalesce(F.col("flood_flag") == 1, F.lit(False))
    df = df.withColumn("__i", F.row_number().over(w))
    reset = F.max(F.when(~is_one, F.col("__i"))).over(upto)
    before = F.greatest(F.coalesce(F.first(carried).over(upto), F.lit(0)) - 1, F.lit(0)) if carried else F.lit(0)
    run = F.when(~is_one, F.lit(0)).when(reset.isNull(), F.col("__i") + before).otherwise(F.col("__i") - reset)
    return df.withColumn(STREAK, run.cast("long")).drop("__i", *([carried] if carried else []))


def build(spark: SparkSession, root: str, panel: DataFrame) -> YearTable:
    """The stage table from a whole panel (columns ``BASE``)."""
    table = YearTable(spark, root)
    rows = cut_lineage(panel_features(panel.select(*BASE)))
    years = {r["year"] for r in rows.select("year").distinct().collect()} | set(table.years())
    table.write_years(rows, years)
    return table


def _reached(rows: DataFrame, changed: DataFrame, year: int) -> int:
    """The last year that a change in ``year`` reaches: per entity the ``REACH``th row
    after its last changed month of that year, or the end of the run after it."""
    last = changed.where(F.col("year") == year).groupBy(KEY).agg(F.max(_period()).alias("__c"))
    after = rows.where(F.col("year") >= year).join(last, KEY).where(_period() > F.col("__c"))
    rank = F.row_number().over(Window.partitionBy(KEY).orderBy("year", "month"))
    after = after.select(KEY, "year", "flood_flag", _period().alias("p"), rank.alias("r"))
    # the first row after the change that is no part of a run; without one the run lasts to the end
    ends = after.groupBy(KEY).agg(F.min(F.when(F.coalesce(F.col("flood_flag") != 1, F.lit(True)), F.col("p"))).alias("reset"),
                                  F.max(F.when(F.col("r") <= REACH, F.col("p"))).alias("seen"), F.max("p").alias("end"))
    found = ends.agg(F.max(F.greatest("seen", F.coalesce("reset", "end")))).first()[0]
    return year if found is None else max(year, found // 12)


def spans(rows: DataFrame, changed: DataFrame) -> list[tuple[int, int]]:
    """First and last year of each run of years to rewrite."""
    out: list[tuple[int, int]] = []
    for year in sorted(r["year"] for r in changed.select("year").distinct().collect()):  # a few years
        if out and year <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], _reached(rows, changed, year))
        else:
            out.append((year, _reached(rows, changed, year)))
    return out


def halo(table: YearTable, before: int, version: int, rows: int = REACH) -> DataFrame | None:
    """The last ``rows`` rows of each entity before a year: the nearest years are read
    first, twice as many each time, until no entity has more to give."""
    earlier = sorted((y for y in table.years(version) if y < before), reverse=True)
    back = Window.partitionBy(KEY).orderBy(F.col("year").desc(), F.col("month").desc())
    n = 1
    while earlier:
        near = table.read(set(earlier[:n]), version)
        last = near.withColumn("__r", F.row_number().over(back)).where(F.col("__r") <= rows).drop("__r")
        if n >= len(earlier):
            return last
        older = table.read(set(earlier[n:]), version).select(KEY).distinct()
        short = last.groupBy(KEY).agg(F.count("*").alias("n")).where(F.col("n") >= rows).select(KEY)
        if older.join(short, KEY, "left_anti").isEmpty():
            return last
        n *= 2
    return None


def refresh(table: YearTable, changed: DataFrame) -> list[int]:
    """Put the rows of ``changed`` (columns ``BASE``; they replace rows of the same entity
    and month or are new) into the table; returns the years that were rewritten."""
    version = table.version()
    changed = cut_lineage(changed.select(*BASE))
    first = changed.agg(F.min("year")).first()[0]
    if first is None:
        return []
    held = table.read({y for y in table.years(version) if y >= first}, version).select(*BASE)
    keys = [KEY, "year", "month"]
    rows = cut_lineage(held.join(changed.select(*keys), keys, "left_anti").unionByName(changed))
    done, parts = [], []
    for lo, hi in spans(rows, changed):
        current = rows.where(F.col("year").between(lo, hi)).withColumn("__streak", F.lit(None).cast("long"))
        # a change before the halo that the halo could show would have its span reach lo
        earlier = halo(table, lo, version)
        if earlier is not None:
            current = earlier.select(*BASE, F.col(STREAK).alias("__streak")).unionByName(current)
        parts.append(panel_features(current, "__streak").where(F.col("year").between(lo, hi)))
        done += range(lo, hi + 1)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    table.write_years(out, done, version)
    return done
