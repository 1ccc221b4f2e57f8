"""Report operators (B1-B7): alert feeds, bulletins, summaries.

Text is built on the executors with ``format_string``/``concat`` after the
period filter, as a lines table ``(order keys..., line_no, value)``; a sink
sorts and writes it (``sources.write_lines``).  Nothing is assembled on the
driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import constants as K
from ..functions import (month_year_title, phase_action, phase_icon, phase_label,
                         price_message, fixed, signed_pct, text_bar, weather_message)
from ..operators import (FEED_COLUMNS, SNAPSHOT_COLUMNS, column_profile, count_where_by,
                         latest_period, trailing_months)

RULE = K.RULE_LINE


def alert_feed(scored: DataFrame, months: int = 12) -> DataFrame:
    """B1: the last ``months`` months, alert columns (with district).
    Feed order: year, month, phase descending, district."""
    return trailing_months(scored, months).select(*FEED_COLUMNS)


def feed_order():
    return [F.col("year"), F.col("month"), F.col("pred_ipc_phase").desc(), F.col("district")]


def alert_snapshot(scored: DataFrame) -> DataFrame:
    """B2: latest period, alert columns.  Order: phase desc, anomaly desc, district."""
    return latest_period(scored).select(*SNAPSHOT_COLUMNS)


def snapshot_order():
    return [F.col("pred_ipc_phase").desc(), F.col("is_anomaly").desc(), F.col("district")]


def flagged(df: DataFrame, min_phase: int = 2) -> DataFrame:
    """Rows that need a bulletin entry: phase >= min_phase or anomalous."""
    return df.filter((F.col("pred_ipc_phase") >= min_phase) | (F.col("is_anomaly") == 1))


def _lines(df: DataFrame, keys, items) -> DataFrame:
    """Explode an array of (possibly NULL) text items into numbered lines."""
    arr = F.filter(F.array(*items), lambda x: x.isNotNull())
    return df.select(*keys, F.posexplode(arr).alias("line_no", "value"))


def bulletin_lines(scored: DataFrame, months: int = 12, min_phase: int = 2,
                   style: str = "bulletin", action_style: str = "long") -> DataFrame:
    """Per flagged row of the recent window, the bulletin block.

    Output ``(region, district, year, month, pred_ipc_phase, line_no, value)``;
    bulletin order is phase descending, then region, district, year, month.
    """
    rows = flagged(trailing_months(scored, months), min_phase)
    p = F.col("pred_ipc_phase")
    message = F.concat(weather_message("rainfall_anomaly_pct", "flood_flag", style), F.lit(" "),
                       price_message("pred_price_direction", style))
    if style == "notebook":
        message = F.concat(message, F.lit(" " + K.NOTEBOOK_MESSAGE_SUFFIX))
    items = [
        F.format_string(K.BULLETIN_BLOCK_HEADER, phase_icon(p), F.upper(F.col("region")), F.col("district"),
                        month_year_title()),
        F.format_string(K.BULLETIN_PHASE_LINE, p, phase_label(p)),
        F.format_string(K.BULLETIN_ACTION_LINE, phase_action(p, action_style)),
        F.format_string(K.BULLETIN_PRICE_LINE, F.col("pred_price_direction"), signed_pct("pred_price_change")),
        F.format_string(K.BULLETIN_RAIN_LINE, signed_pct("rainfall_anomaly_pct")),
        F.when(F.col("is_anomaly") == 1, F.lit(K.BULLETIN_ANOMALY_LINE)),
        F.lit(""),
        F.lit(K.BULLETIN_VOICE_HEADER),
        F.format_string(K.BULLETIN_MESSAGE_LINE, message),
        F.lit(K.BULLETIN_BROADCAST_NOTE),
        F.lit(""),
    ]
    return _lines(rows, ["region", "district", "year", "month", "pred_ipc_phase"], items)


def bulletin_document(scored: DataFrame, months: int = 12, min_phase: int = 2,
                      style: str = "bulletin", action_style: str = "long") -> DataFrame:
    """B3 as a whole document: preamble (title, period, flagged count or the
    all-clear line) followed by the blocks.  Columns ``(part, k_phase,
    region, district, year, month, line_no, value)``; the document order is
    ``document_order()``."""
    blocks = bulletin_lines(scored, months, min_phase, style, action_style)
    n = blocks.where(F.col("line_no") == 0).select(F.count(F.lit(1))).scalar()
    latest = latest_period(scored).agg(F.max(month_year_title()).alias("t"))
    count_line = F.when(n == 0, F.lit(K.BULLETIN_NONE)).otherwise(
        F.replace(F.lit(K.BULLETIN_FLAGGED), F.lit("{n}"), n.cast("string")))
    pre = [F.lit(RULE), F.lit(K.BULLETIN_TITLE), F.format_string(K.BULLETIN_PERIOD, F.col("t")), F.lit(RULE),
           F.lit(""), count_line, F.lit("")]
    head = latest.select(F.posexplode(F.array(*pre)).alias("line_no", "value")).select(
        F.lit(0).alias("part"), F.lit(0).alias("k_phase"), F.lit("").alias("region"), F.lit("").alias("district"),
        F.lit(0).alias("year"), F.lit(0).alias("month"), "line_no", "value")
    body = blocks.select(F.lit(1).alias("part"), (-F.col("pred_ipc_phase")).alias("k_phase"), "region",
                         "district", "year", "month", "line_no", "value")
    return head.unionByName(body)


def document_order():
    return [F.col(c) for c in ("part", "k_phase", "region", "district", "year", "month", "line_no")]


def _fmt1(c) -> Column:
    return fixed(c, 1, width=4)


def summary_lines(scored: DataFrame, top: int = 5) -> DataFrame:
    """Dashboard summary as ``(section, k1, k2, value)`` lines.

    Sections: 0 header, 1 phase distribution, 2 top anomalous regions,
    3 latest-period snapshot.  k1/k2 order lines within a section.
    """
    head = scored.agg(F.min("year").alias("y0"), F.max("year").alias("y1"),
                      F.count_distinct("region").alias("nr"))
    def line(k1: float, k2: str, value) -> Column:
        v = value if isinstance(value, Column) else F.lit(value)
        return F.struct(F.lit(0).alias("section"), F.lit(k1).alias("k1"), F.lit(k2).alias("k2"),
                        v.alias("value"))
    header = head.select(F.inline(F.array(
        line(0.0, "a", RULE),
        line(1.0, "b", K.SUMMARY_TITLE),
        line(2.0, "c", F.format_string(K.SUMMARY_DATA_LINE, "y0", "y1", "nr")),
        line(3.0, "d", RULE),
        line(4.0, "e", ""))))

    total = scored.select(F.count(F.lit(1))).scalar()
    dist = scored.groupBy("pred_ipc_phase").agg(F.count(F.lit(1)).alias("n"))
    pct = F.col("n") * F.lit(100.0) / total
    dist = dist.select(
        F.lit(1).alias("section"), F.col("pred_ipc_phase").cast("double").alias("k1"), F.lit("").alias("k2"),
        F.format_string(K.SUMMARY_DIST_LINE,
                        phase_icon("pred_ipc_phase"), "pred_ipc_phase", phase_label("pred_ipc_phase"),
                        "n", _fmt1(pct), text_bar(pct)).alias("value"))

    top_regions = count_where_by(scored, F.col("is_anomaly") == 1, "region", "n", k=top)
    top_regions = top_regions.select(
        F.lit(2).alias("section"), (-F.col("n")).cast("double").alias("k1"), F.col("region").alias("k2"),
        F.format_string(K.SUMMARY_TOP_LINE, "region", "n").alias("value"))

    latest = latest_period(scored)
    title = latest.agg(F.max(month_year_title()).alias("t"))
    heads = title.select(F.inline(F.array(
        F.struct(F.lit(1).alias("section"), F.lit(-1e9).alias("k1"), F.lit("").alias("k2"),
                 F.lit(K.SUMMARY_DIST_HEADER).alias("value")),
        F.struct(F.lit(1).alias("section"), F.lit(1e9).alias("k1"), F.lit("").alias("k2"), F.lit("").alias("value")),
        F.struct(F.lit(2).alias("section"), F.lit(-1e9).alias("k1"), F.lit("").alias("k2"),
                 F.lit(K.SUMMARY_TOP_HEADER).alias("value")),
        F.struct(F.lit(2).alias("section"), F.lit(1e9).alias("k1"), F.lit("").alias("k2"), F.lit("").alias("value")),
        F.struct(F.lit(3).alias("section"), F.lit(-1e9).alias("k1"), F.lit("").alias("k2"),
                 F.format_string(K.SUMMARY_LATEST_HEADER, F.col("t")).alias("value")))))
    snap = latest.select(
        F.lit(3).alias("section"), (-F.col("pred_ipc_phase")).cast("double").alias("k1"),
        F.col("district").alias("k2"),
        F.format_string(K.SUMMARY_LATEST_LINE,
                        phase_icon("pred_ipc_phase"), "district", "region", "pred_ipc_phase",
                        "pred_ipc_label", "pred_price_direction",
                        F.when(F.col("is_anomaly") == 1, F.lit(K.SUMMARY_ANOMALY_MARK)).otherwise(F.lit(""))
                        ).alias("value"))
    return header.unionByName(heads).unionByName(dist).unionByName(top_regions).unionByName(snap)


def feature_report(df: DataFrame, cols=None) -> DataFrame:
    """``seq. name [dtype] missing=n`` per column (A17 formatted)."""
    prof = column_profile(df, cols)
    return prof.select("seq", F.format_string(K.FEATURE_REPORT_LINE, "seq", "column",
                                              "dtype", "missing").alias("value"))


def run_summary(df: DataFrame, n_features: int | None = None) -> DataFrame:
    """One-row run summary (districts, regions, rows, year range)."""
    out = df.agg(F.count_distinct("district").alias("districts"),
                 F.count_distinct("region").alias("regions"),
                 F.count(F.lit(1)).alias("rows"),
                 F.min("year").alias("year_min"), F.max("year").alias("year_max"))
    if n_features is not None:
        out = out.withColumn("features", F.lit(int(n_features)))
    return out


def evaluation_lines(metrics: DataFrame) -> DataFrame:
    """Metric report lines from a ``(model, metric, value)`` table."""
    return metrics.select("model", "metric",
                          F.format_string(K.EVALUATION_LINE, "model", "metric", fixed("value", 4)).alias("value"))


def model_report(classes: DataFrame, errors: DataFrame | None, scored: DataFrame) -> DataFrame:
    """Evaluation report as ``(seq, value)`` lines, from a classification
    report, regression metrics (None: no regressor) and the scored table."""
    one = scored.agg(F.sum("is_anomaly").alias("found"), F.count(F.lit(1)).alias("rows"),
                     F.count_distinct("region").alias("regions"), F.min("year").alias("y0"), F.max("year").alias("y1"))
    one = one.withColumn("f1", classes.agg(F.max("weighted_f1")).scalar())
    if errors is not None:
        mae, r2 = errors.select("mae", "r2").first()  # † one row
        one = one.withColumns({"mae": F.lit(mae).cast("double"), "r2": F.lit(r2).cast("double")})
    price = ([F.format_string(K.REPORT_MAE_LINE, fixed("mae", 3)), F.format_string(K.REPORT_R2_LINE, fixed("r2", 4))]
             if errors is not None else [F.lit(K.REPORT_NO_PRICE_LINE)])
    share = F.col("found") * F.lit(100.0) / F.col("rows")
    rule, blank = F.lit(K.REPORT_RULE), F.lit("")
    lines = [F.lit(RULE), F.lit(K.REPORT_TITLE), F.lit(RULE), blank,
             F.lit(K.REPORT_PHASE_HEADER), rule, F.format_string(K.REPORT_F1_LINE, fixed("f1", 4)), blank,
             F.lit(K.REPORT_PRICE_HEADER), rule, *price, blank,
             F.lit(K.REPORT_ANOMALY_HEADER), rule, F.format_string(K.REPORT_ANOMALY_LINE, "found", fixed(share, 1)), blank,
             F.lit(K.REPORT_DATA_HEADER), rule, F.format_string(K.REPORT_REGIONS_LINE, "regions"),
             F.format_string(K.REPORT_YEARS_LINE, "y0", "y1"), F.format_string(K.REPORT_ROWS_LINE, "rows")]
    return one.select(F.posexplode(F.array(*lines)).alias("seq", "value"))
