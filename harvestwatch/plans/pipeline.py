"""End-to-end batch pipeline (the script chain / notebook as one Spark job graph).

Stage tables are written once as Parquet partitioned by ``year`` (S6) and
read back, so every later stage starts from files: lineage stays short, a
lost executor only re-runs tasks of the current stage, and period filters
prune partitions.  The output folder must be shared storage on a cluster.

    run(spark, {"rainfall": ..., "prices": ..., "events": ...}, out_dir)

Inputs are CSV paths (raw text schemas) or, for events, either a CSV path or
a folder of landed JSON pages (``events_pages``).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import constants as K
from ..models import queries as MQ
from ..session import cut_lineage, delete_path, materialize_all, path_exists
from ..models.forest import fit_isolation_forest
from ..models.metrics import classification_report, regression_metrics
from ..models.split import hash_split, stratified_split
from ..models.supervised import (TARGET, fit_phase, fit_price, predict_phase, predict_price, price_frame,
                                save_model, without_price)
from ..operators import select_by_keyword, select_covered, select_features
from ..sources import (EVENTS_RAW, PRICES_RAW, RAINFALL_RAW, drop_tag_rows, read_event_pages,
                       read_table, write_feed, write_lines, write_stage)
from . import reports as R
from .clean import clean_conflict, clean_prices, clean_rainfall
from .features import build_features
from .master import build_master
from .predict import rule_scores

STAGES = ("rainfall_monthly", "prices_monthly", "conflict_monthly", "master", "features",
          "predictions")


def load_raw(spark: SparkSession, paths: dict) -> dict[str, DataFrame]:
    out = {"rainfall": drop_tag_rows(read_table(spark, paths["rainfall"], RAINFALL_RAW)),
           "prices": drop_tag_rows(read_table(spark, paths["prices"], PRICES_RAW))}
    if "events_pages" in paths:
        out["events"] = read_event_pages(spark, paths["events_pages"])
    else:
        out["events"] = read_table(spark, paths["events"], EVENTS_RAW)  # has no tag row
    return out


def score_models(features: DataFrame, out_dir: str | None = None, phase_trees: int = 300,
                 price_trees: int = K.FOREST_TREES, forest_trees: int = K.FOREST_TREES) -> DataFrame:
    """Fit the three models on the feature table and attach the prediction
    columns (notebook names: pred_price_change, anomaly_score).  Where no price
    has enough values the regressor is left out and no change is predicted.
    With ``out_dir`` the models are saved and measured on the held-out rows, and
    the evaluation report is written."""
    keys = ["district", "year", "month"]
    cols = select_features(features, MQ.EXCLUDE)
    split = cut_lineage(stratified_split(features, "ipc_phase", keys, K.TEST_FRACTION, K.SEED))
    phase = fit_phase(split.where(F.col("split") == "train"), cols, "ipc_phase", trees=phase_trees)
    t, source = price_frame(features)
    price = None
    if source:
        t = cut_lineage(t)  # read by the column choice, the training and the report
        reg_cols = select_covered(t, [c for c in cols if c != source], 0.5)
        t = hash_split(t, keys)
        price = fit_price(t.where(F.col("split") == "train"), reg_cols, trees=price_trees)
    if out_dir:
        save_model(phase, os.path.join(out_dir, "models", "phase"))
        at = os.path.join(out_dir, "models", "price")
        if price:
            save_model(price, at)
        else:
            delete_path(features.sparkSession, at)  # none of an earlier run either
    scored = predict_phase(phase, features, cols)
    scored = predict_price(price, scored, reg_cols) if price else without_price(scored)
    anomaly_cols = select_by_keyword(cols, K.ANOMALY_KEYWORDS)
    forest, out = fit_isolation_forest(scored, anomaly_cols, trees=forest_trees, keys=keys)
    if out_dir:
        forest.save(os.path.join(out_dir, "models", "forest"))
        held_out = predict_phase(phase, split.where(F.col("split") == "test"), cols)
        errors = predict_price(price, t.where(F.col("split") == "test"), reg_cols) if price else None
        report = R.model_report(classification_report(cut_lineage(held_out), "ipc_phase", "pred_ipc_phase"),
                                errors and regression_metrics(errors, TARGET, "pred_price_change"), out)
        write_lines(report, f"{out_dir}/evaluation")
    return out


def score_saved(features: DataFrame, model_dir: str) -> DataFrame:
    """Score a feature table with models saved by ``run`` (the monthly
    refresh path: new data, fitted models, fitted anomaly threshold)."""
    from ..models.forest import ForestModel
    from ..models.supervised import load_model
    phase = load_model(os.path.join(model_dir, "phase"))
    at = os.path.join(model_dir, "price")
    price = load_model(at) if path_exists(features.sparkSession, at) else None
    forest = ForestModel.load(features.sparkSession, os.path.join(model_dir, "forest"))
    phase_cols = list(phase.stages[1].getInputCols())
    scored = predict_phase(phase, features, phase_cols)
    scored = predict_price(price, scored, price.stages[0].getInputCols()) if price else without_price(scored)
    return forest.transform(scored)


def run(spark: SparkSession, paths: dict, out_dir: str, models: bool = True,
        north=K.NORTH_REGIONS, vulnerable=K.VULNERABLE_REGIONS, coastal=K.COASTAL_REGIONS,
        views: bool = True) -> dict[str, DataFrame]:
    raw = load_raw(spark, paths)
    # the three monthly stages read independent sources: written concurrently;
    # each raw source is read once (the raw-reading part of a stage is cut
    # before any decision job or scalar subquery looks at it)
    st = materialize_all({
        "rainfall_monthly": lambda: clean_rainfall(raw["rainfall"]),
        "prices_monthly": lambda: clean_prices(raw["prices"], price_col=None, cut=cut_lineage),
        "conflict_monthly": lambda: clean_conflict(raw["events"], cut=cut_lineage),
    }, write=lambda name, df: write_stage(df, f"{out_dir}/{name}"))
    st["master"] = write_stage(build_master(st["rainfall_monthly"], st["prices_monthly"],
                                            st["conflict_monthly"], north, vulnerable), f"{out_dir}/master")
    st["features"] = write_stage(build_features(st["master"], north=north, coastal=coastal),
                                 f"{out_dir}/features")
    scored = score_models(st["features"], out_dir) if models else rule_scores(st["features"])
    st["predictions"] = write_stage(scored, f"{out_dir}/predictions")
    pred = st["predictions"]
    write_feed(R.alert_feed(pred), f"{out_dir}/alerts_feed", R.feed_order())
    write_feed(R.alert_snapshot(pred), f"{out_dir}/alerts_latest", R.snapshot_order())
    write_lines(R.bulletin_document(pred), f"{out_dir}/bulletin", R.document_order())
    write_lines(R.summary_lines(pred), f"{out_dir}/summary", ["section", "k1", "k2"])
    write_lines(R.feature_report(st["features"]), f"{out_dir}/feature_report", ["seq"])
    if views:
        for name, df in st.items():
            df.createOrReplaceTempView(name)
    return st
