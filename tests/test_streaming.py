"""Incremental refresh: new landed files add to the monthly partials once."""

import os
import tempfile

from pyspark.sql import functions as F

from harvestwatch.plans.clean import clean_conflict
from harvestwatch.sources import EVENTS_RAW
from harvestwatch.streaming import conflict_from_partials, start_refresh

HEADER = ",".join(f.name for f in EVENTS_RAW)


def _write(d, name, rows):
    with open(os.path.join(d, name), "w") as fh:
        fh.write(HEADER + "\n")
        for r in rows:
            fh.write(",".join(r) + "\n")


def _ev(i, date, region, fat, etype):
    return [f"E{i}", date, "2020", etype, "", region, "", "", "", "", fat, ""]


def test_refresh_matches_batch(spark):
    base = tempfile.mkdtemp(prefix="hw-stream-")
    land, parts, ckpt = (os.path.join(base, x) for x in ("landing", "partials", "ckpt"))
    os.makedirs(land)
    _write(land, "a.csv", [_ev(1, "2020-01-05", "Northern", "1", "Battles"),
                           _ev(2, "2020-01-09", "Northern", "2", "Flood")])
    q = start_refresh(spark, land, parts, ckpt)
    q.awaitTermination()
    _write(land, "b.csv", [_ev(3, "2020-03-01", "Northern", "0", "Displaced"),
                           _ev(4, "2020-01-20", "Volta", "5", "Riots"),
                           _ev(5, "oops", "Volta", "5", "Riots")])
    q = start_refresh(spark, land, parts, ckpt)
    q.awaitTermination()
    got = conflict_from_partials(spark, parts)
    raw = spark.read.schema(EVENTS_RAW).option("header", True).csv(land)
    want = clean_conflict(raw)
    cols = ["region", "year", "month", "conflict_events", "fatalities_total", "flood_displace_events",
            "conflict_events_lag1", "high_conflict_flag"]
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))
    # the first file was processed once only
    assert got.where(F.col("region") == "Northern").where("month = 1").first().conflict_events == 2


def test_rainfall_refresh_matches_batch(spark):
    from harvestwatch.plans.clean import clean_rainfall
    from harvestwatch.sources import RAINFALL_RAW
    from harvestwatch.streaming import rainfall_from_partials
    base = tempfile.mkdtemp(prefix="hw-stream-r-")
    land, parts, ckpt = (os.path.join(base, x) for x in ("landing", "partials", "ckpt"))
    os.makedirs(land)
    header = ",".join(f.name for f in RAINFALL_RAW)

    def write(name, rows):
        with open(os.path.join(land, name), "w") as fh:
            fh.write(header + "\n" + "\n".join(",".join(r) for r in rows) + "\n")
    rest = ["1"] * 6
    write("a.csv", [["2020-01-01", "Northern", "D1", "10", "8", "60", *rest],
                    ["2020-01-11", "Northern", "D1", "n/a", "8", "40.5", *rest]])
    start_refresh(spark, land, parts, ckpt, kind="rainfall").awaitTermination()
    write("b.csv", [["2020-01-21", "Northern", "D1", "20", "8", "-70", *rest],
                    ["2020-02-01", "Volta", "D2", "5", "8", "-45", *rest]])
    start_refresh(spark, land, parts, ckpt, kind="rainfall").awaitTermination()
    got = rainfall_from_partials(spark, parts)
    want = clean_rainfall(spark.read.schema(RAINFALL_RAW).option("header", True).csv(land))
    cols = ["region", "district", "year", "month", "rainfall_mm", "rainfall_anomaly_pct", "flood_flag",
            "drought_flag"]
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))
