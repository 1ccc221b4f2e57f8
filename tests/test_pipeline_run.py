"""The production path: raw CSV / JSON pages -> stage tables -> models -> feeds and reports."""

import json
import math
import os
import tempfile

from pyspark.sql import functions as F

from harvestwatch.plans.pipeline import run
from harvestwatch.sources import EVENT_FIELDS, PRICES_RAW, RAINFALL_RAW

DISTRICTS = (("Northern", "District A"), ("Northern", "District B"), ("Volta", "District C"), ("Brong-Ahafo", "District D"))


def _csv(path, header, rows):
    with open(path, "w") as fh:
        fh.write(",".join(header) + "\n")
        fh.write("#tag," + ",".join("#x" for _ in header[1:]) + "\n")  # HXL tag row
        for r in rows:
            fh.write(",".join(r) + "\n")


def _fixtures(base):
    rain, prices, pages = [], [], []
    for y in (2022, 2023):
        for m in range(1, 13):
            for di, (adm1, adm2) in enumerate(DISTRICTS):
                for dek in (1, 11, 21):
                    a = 70 * math.sin((m + di * 3 + dek / 10) / 2.0) + (y - 2022) * 5
                    rain.append([f"{y}-{m:02d}-{dek:02d}", adm1, adm2, f"{50 + a / 2:.2f}", "50", f"{a:.3f}",
                                 "1", "1", "1", "1", "1", "1"])
            for ri, adm1 in enumerate(("Northern", " Brong-Ahafo ", "Volta")):
                for ci, com in enumerate(("Maize (white)", "Rice (local)", "Rice (imported)", "Yam")):
                    p = 3 + ri + ci + 0.4 * math.sin(m + y) + (m % 4) * 0.3
                    prices.append([f"{y}-{m:02d}-15", adm1, "", "Mkt", "Cereals", com, "KG", "Retail", "GHS",
                                   f"{p:.2f}", ""])
    prices.append(["2023-01-15", "Volta", "", "Mkt", "Cereals", "Maize (white)", "KG", "Retail", "GHS", "NaN", ""])
    k = 0
    for y in (2022, 2023):
        for m in range(1, 13):
            batch = []
            for adm1 in ("Northern", "Volta"):
                for j in range((m * 7 + len(adm1)) % 5):
                    k += 1
                    ev = {f: "" for f in EVENT_FIELDS}
                    ev.update(event_id_cnty=f"EV{k}", event_date=f"{y}-{m:02d}-{j + 1:02d}", admin1=adm1,
                              event_type="Flood" if j % 3 == 0 else "Riots", fatalities=str(j))
                    batch.append(ev)
            pages.append({"data": batch})
    os.makedirs(f"{base}/pages")
    for i, p in enumerate(pages):
        with open(f"{base}/pages/page_{i:03d}.json", "w") as fh:
            json.dump(p, fh)
    _csv(f"{base}/rain.csv", [f.name for f in RAINFALL_RAW], rain)
    _csv(f"{base}/prices.csv", [f.name for f in PRICES_RAW], prices)
    return {"rainfall": f"{base}/rain.csv", "prices": f"{base}/prices.csv", "events_pages": f"{base}/pages"}


def test_pipeline_run_rule_scores(spark):
    base = tempfile.mkdtemp(prefix="hw-run-")
    paths = _fixtures(base)
    st = run(spark, paths, f"{base}/out", models=False)
    master, feats, pred = st["master"], st["features"], st["predictions"]
    assert master.count() == len(DISTRICTS) * 24 == feats.count() == pred.count()
    regions = {r[0] for r in master.select("region").distinct().collect()}
    assert regions == {"Northern", "Volta", "Bono"}
    # price-less region-months keep their spine rows
    assert master.where(F.col("price_maize").isNull()).count() == 0
    lines = spark.read.text(f"{base}/out/bulletin").count()
    assert lines > 0
    feed = spark.read.option("header", True).csv(f"{base}/out/alerts_latest")
    assert feed.count() == len(DISTRICTS)
    assert spark.sql("SELECT count(*) FROM features").first()[0] == feats.count()


def test_pipeline_run_with_models(spark, monkeypatch):
    from harvestwatch import constants as K
    monkeypatch.setattr(K, "PRICE_TARGET_MIN_ROWS", 50)  # the fixture has 96 district-months
    base = tempfile.mkdtemp(prefix="hw-run-m-")
    paths = _fixtures(base)
    from harvestwatch.plans import pipeline as P
    orig = P.score_models
    P.score_models = lambda f, out_dir=None: orig(f, out_dir, phase_trees=10, price_trees=10, forest_trees=20)
    try:
        st = run(spark, paths, f"{base}/out", models=True)
    finally:
        P.score_models = orig
    pred = st["predictions"]
    cols = set(pred.columns)
    assert {"pred_ipc_phase", "pred_ipc_confidence", "pred_price_change", "anomaly_score", "is_anomaly"} <= cols
    assert pred.where(F.col("pred_ipc_phase").isNull()).count() == 0
    assert os.path.isdir(f"{base}/out/models/phase")

    report = [r.value for r in spark.read.text(f"{base}/out/evaluation").collect()]
    assert len(report) == 22 and any("Weighted F1" in x for x in report) and any("R²" in x for x in report)

    rescored = P.score_saved(st["features"], f"{base}/out/models")
    a = {(r.district, r.year, r.month): (r.pred_ipc_phase, r.is_anomaly) for r in pred.collect()}
    b = {(r.district, r.year, r.month): (r.pred_ipc_phase, r.is_anomaly) for r in rescored.collect()}
    assert a == b


def test_cli_run_and_score(spark):
    from harvestwatch.__main__ import main
    base = tempfile.mkdtemp(prefix="hw-cli-")
    paths = _fixtures(base)
    assert main(["run", "--rainfall", paths["rainfall"], "--prices", paths["prices"],
                 "--events-pages", paths["events_pages"], "--out", f"{base}/out", "--no-models"]) == 0
    assert spark.read.parquet(f"{base}/out/features").count() == len(DISTRICTS) * 24


def test_models_without_a_price_series(spark):
    from harvestwatch.plans import pipeline as P
    base = tempfile.mkdtemp(prefix="hw-noprice-")
    st = run(spark, _fixtures(base), f"{base}/out", models=False)
    prices = [c for c in st["features"].columns if "price" in c]
    bare = st["features"].withColumns({c: F.lit(None).cast(st["features"].schema[c].dataType) for c in prices})
    out = P.score_models(bare, f"{base}/bare", phase_trees=5, price_trees=5, forest_trees=5)
    assert out.count() == bare.count() and out.where("pred_price_change IS NOT NULL").count() == 0
    again = P.score_saved(bare, f"{base}/bare/models")
    assert again.where("pred_price_change IS NULL").count() == bare.count()
    report = [r.value for r in spark.read.text(f"{base}/bare/evaluation").collect()]
    assert any("no price" in x for x in report)
