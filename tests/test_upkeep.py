"""Refreshes by year, keyed events, dense panels, profiles without look-ahead, quantiles."""

import os
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from harvestwatch.operators import carry_forward, densify, interpolate, quantile_table, with_group_mean
from harvestwatch.operators import monthly
from harvestwatch.plans import incremental
from harvestwatch.session import stage_path
from harvestwatch.sources import EVENT_FIELDS, read_event_pages
from harvestwatch.sources.yeartable import StaleRefresh, YearTable
from harvestwatch.streaming import conflict_from_partials, start_keyed_refresh

PANEL = "region string, district string, year int, month int, rainfall_mm double"


def root(spark, name):
    return stage_path(spark, f"{name}-{random.randrange(1 << 60)}")


def panel(spark, rows):
    base = spark.createDataFrame([(d, 100.0) for d in {r[1] for r in rows}], "district string, baseline double")
    return incremental.with_anomaly(spark.createDataFrame(rows, PANEL), base)


def files(table):
    return {y: int(v.split("-")[0]) for y, v in table.years().items()}


def as_set(df):
    return {tuple(r) for r in df.select(sorted(df.columns)).collect()}


# -- S6 ---------------------------------------------------------------------------

def months(lo, hi):
    return [(y, m) for y in range(lo, hi + 1) for m in range(1, 13)]


@pytest.mark.parametrize("seed", range(2))
def test_refresh_equals_a_rebuild(spark, seed):
    pick = random.Random(seed)
    rows = [("R", f"d{k}", y, m, pick.choice([20.0, 90.0, 170.0, 180.0, 190.0])) for k in range(4) for y, m in months(2000, 2007)
            if pick.random() < (0.95 if k else 0.2)]  # d0 has few rows, far apart
    rows += [("R", "wet", y, m, 200.0) for y, m in months(2000, 2007)]  # one run over all years
    late = {(r[1], r[2], r[3]) for r in pick.sample(rows, 3)}
    other = pick.sample(range(len(rows)), 2)
    first = [(*r[:4], 300.0 - r[4] if i in other else r[4]) for i, r in enumerate(rows) if r[1:4] not in late]
    changed = [r for i, r in enumerate(rows) if r[1:4] in late or i in other]
    table = incremental.build(spark, root(spark, "years"), panel(spark, first))
    before = files(table)
    done = incremental.refresh(table, panel(spark, changed))
    whole = incremental.build(spark, root(spark, "whole"), panel(spark, rows))
    assert as_set(table.read()) == as_set(whole.read())
    assert {y for y, v in files(table).items() if before.get(y) != v} == set(done) & set(files(table))
    assert {r[2] for r in changed} <= set(done)


def test_refresh_rewrites_its_years_only(spark):
    rows = [("R", "a", y, m, 90.0) for y, m in months(2000, 2009)]
    table = incremental.build(spark, root(spark, "years"), panel(spark, rows))
    assert incremental.refresh(table, panel(spark, [("R", "a", 2003, 5, 170.0)])) == [2003]  # seen by June to October
    assert incremental.refresh(table, panel(spark, [("R", "a", 2005, 10, 170.0)])) == [2005, 2006]
    assert incremental.refresh(table, panel(spark, [("R", "b", 2012, 1, 170.0)])) == [2012]  # a new entity and year
    assert incremental.refresh(table, panel(spark, rows[:0] or [("R", "a", 2003, 5, 1.0)]).limit(0)) == []
    assert files(table) == {**dict.fromkeys([*range(2000, 2010)], 1), 2003: 2, 2005: 3, 2006: 3, 2012: 4}
    old = table.read(version=1)
    assert old.where("year = 2003 AND month = 5").first()["rainfall_mm"] == 90.0  # readers of the old version go on
    assert table.vacuum() == [] and table.read().count() == 121
    assert table.read({1990}).count() == 0 and table.read({2003}).count() == 12


def test_refresh_goes_on_with_a_run_from_before_the_slice(spark):
    rows = [("R", "a", y, m, 200.0) for y, m in months(2000, 2003)]
    table = incremental.build(spark, root(spark, "years"), panel(spark, rows[:40]))
    assert incremental.refresh(table, panel(spark, rows[40:41])) == [2003]
    got = {(r.year, r.month): r.flood_streak_months for r in table.read().collect()}
    assert got[2003, 5] == 41 and got[2000, 1] == 1


def test_published_whole_or_not_at_all(spark):
    table = YearTable(spark, root(spark, "years"))
    rows = spark.createDataFrame([(2001, 1.0), (2002, 2.0)], "year int, x double")
    assert table.write_years(rows, [2001, 2002]) == 1
    seen = table.version()
    assert table.write_years(rows.where("year = 2001").withColumn("x", F.lit(5.0)), [2001]) == 2
    with pytest.raises(StaleRefresh):
        table.write_years(rows.where("year = 2002"), [2002], based_on=seen)
    with pytest.raises(StaleRefresh):  # the other one publishes while this one writes
        table._publish(2, {2001: "1-lost"})
    with pytest.raises(ValueError):
        table.write_years(rows, [2001])
    assert sorted((r.year, r.x) for r in table.read().collect()) == [(2001, 5.0), (2002, 2.0)]
    table.write_years(rows.limit(0), [2002])  # a year without rows leaves the table
    assert [r.year for r in table.read().collect()] == [2001]
    assert 1 in table.vacuum() and table.read().count() == 1


# -- S4 ---------------------------------------------------------------------------

def event(i, date, region, fatalities, kind="Battles"):
    cells = dict.fromkeys(EVENT_FIELDS)
    cells.update(event_id_cnty=i, event_date=date, admin1=region, fatalities=str(fatalities), event_type=kind)
    return tuple(cells[f] for f in EVENT_FIELDS)


def land(spark, at, name, events):
    os.makedirs(at, exist_ok=True)
    pd.DataFrame(events, columns=EVENT_FIELDS).to_csv(os.path.join(at, name), index=False)


def test_keyed_stream(spark, tmp_path):
    base, store = str(tmp_path), str(tmp_path / "store")
    one = [event("e1", "2020-01-05", "North", 3), event("e2", "2020-01-06", "North", 4, "Flood"), event("e3", "2020-02-01", "South", 1),
           event(None, "2020-01-07", "North", 10), event("e4", "no date", "North", 9), event("e1", "2020-01-05", "North", 3)]
    go = lambda: start_keyed_refresh(spark, f"{base}/in", store, f"{base}/ckpt").awaitTermination()
    result = lambda: {(r.region, r.year, r.month): (r.conflict_events, r.fatalities_total, r.flood_displace_events)
                      for r in conflict_from_partials(spark, f"{store}/partials").collect()}
    land(spark, f"{base}/in", "1.csv", one)
    go()
    first = {("North", 2020, 1): (2, 17.0, 1), ("South", 2020, 2): (1, 1.0, 0)}
    assert result() == first
    land(spark, f"{base}/in", "2.csv", [e for e in one if e[0]])  # sent again
    go()
    assert result() == first
    land(spark, f"{base}/in", "3.csv", [event("e3", "2020-03-09", "North", 5), event("e2", "2020-01-06", "North", 6),
                                        event("e4", "2020-01-01", "North", 2), event("e5", "2020-01-01", "East", 1)])
    go()
    fixed = {("North", 2020, 1): (3, 21.0, 0), ("North", 2020, 3): (1, 5.0, 0), ("East", 2020, 1): (1, 1.0, 0)}
    assert result() == fixed  # the month that e3 left is gone
    land(spark, f"{base}/in", "4.csv", [event("e5", "gone", "East", 1)])
    go()
    assert result() == {k: v for k, v in fixed.items() if k[0] != "East"}


def test_batch_tried_again_counts_once(spark, tmp_path):
    from harvestwatch.streaming import merge_events
    store = str(tmp_path / "store")
    make = lambda x: spark.createDataFrame([(*event("a", "2020-01-01", "N", x), 1, "f")],
                                           ", ".join(f"{f} string" for f in EVENT_FIELDS) + ", landed_at long, landed_in string")
    for n, x in ((0, 1), (1, 5), (1, 5), (0, 1), (1, 5)):  # both batches tried again, out of order too
        merge_events(make(x), store, n)
    got = conflict_from_partials(spark, f"{store}/partials").collect()
    assert [(r.conflict_events, r.fatalities_total) for r in got] == [(1, 5.0)]


def test_last_page_wins(spark, tmp_path):
    import json
    import time
    for n, x in (("b.json", 1), ("a.json", 2)):
        rows = [{"event_id_cnty": "e", "fatalities": str(x)}, {"event_id_cnty": None, "fatalities": "7"}]
        (tmp_path / n).write_text(json.dumps({"data": rows}))
        os.utime(tmp_path / n, (time.time() + x * 10,) * 2)
    got = read_event_pages(spark, str(tmp_path), dedupe=True)
    assert got.columns == list(EVENT_FIELDS)
    assert sorted((r.event_id_cnty or "", r.fatalities) for r in got.collect()) == [("", "7"), ("", "7"), ("e", "2")]
    assert read_event_pages(spark, str(tmp_path)).count() == 4


# -- J4 ---------------------------------------------------------------------------

@pytest.mark.parametrize("seed", range(2))
def test_dense_panel_against_pandas(spark, seed):
    rng = np.random.default_rng(seed)
    rows = [(None if k == 2 else f"d{k}", p // 12, p % 12 + 1, None if rng.random() < 0.1 else float(rng.integers(0, 50)))
            for k in range(3) for p in range(24000, 24060) if rng.random() < 0.4]
    df = spark.createDataFrame(rows, "district string, year int, month int, x double")
    got = interpolate(carry_forward(densify(df), {"x": "carried"}, 2), {"x": "line"})
    got = interpolate(got, {"x": "short"}, max_gap=1).toPandas()
    for k in (0, 1, 2):
        name = None if k == 2 else f"d{k}"
        mine = [r for r in rows if r[0] == name]
        s = pd.Series({r[1] * 12 + r[2] - 1: r[3] for r in mine}, dtype=float).sort_index()
        s = s.reindex(range(s.index.min(), s.index.max() + 1))
        g = got[got.district.isna() if name is None else got.district == name].copy()
        g.index = g.year * 12 + g.month - 1
        g = g.sort_index()
        assert list(g.index) == list(s.index)
        assert set(g.index[g.known == 1]) == {r[1] * 12 + r[2] - 1 for r in mine}
        np.testing.assert_allclose(g.carried.astype(float), s.ffill(limit=2))
        line = s.interpolate(limit_area="inside")
        np.testing.assert_allclose(g.line.astype(float), line)
        gap = s.isna() & (s.shift(1).isna() | s.shift(-1).isna())
        np.testing.assert_allclose(g.short.astype(float), line.where(~gap))


def test_densify_ends_and_plan(spark):
    df = spark.createDataFrame([("a", 2020, 11, 1), ("a", 2021, 2, 2), ("b", None, 1, 3)], "district string, year int, month int, x int")
    assert [(r.year, r.month, r.x) for r in densify(df).orderBy("year", "month").collect()] == [
        (2020, 11, 1), (2020, 12, None), (2021, 1, None), (2021, 2, 2)]
    wide = densify(df, start=F.lit(2020 * 12), end=F.lit(2021 * 12 + 11))
    assert wide.count() == 24
    plan = wide._jdf.queryExecution().optimizedPlan().toString()
    assert "Cross" not in plan
    assert densify(df.limit(0)).count() == 0


# -- W10 / J2 -----------------------------------------------------------------------

def test_profile_without_look_ahead(spark):
    df = spark.createDataFrame([("R", "a", 2020, 1, 1.0), ("R", "b", 2020, 1, 0.0), ("R", "a", 2020, 2, None), ("R", "b", 2020, 2, 1.0),
                                ("R", "a", 2021, 1, 0.0), ("S", "c", 2021, 1, 1.0)],
                               "region string, district string, year int, month int, f double")
    got = {(r.district, r.year, r.month): r.m for r in with_group_mean(df, "region", {"f": "m"}, asof=True).collect()}
    # no row of the same month counts, whichever district it is of
    assert got == {("a", 2020, 1): None, ("b", 2020, 1): None, ("a", 2020, 2): 0.5, ("b", 2020, 2): 0.5, ("a", 2021, 1): 2 / 3,
                   ("c", 2021, 1): None}


# -- A5 ---------------------------------------------------------------------------

@pytest.mark.parametrize("points", [20_000, 50])
def test_quantile_with_half_of_the_values_close_together(spark, monkeypatch, points):
    monkeypatch.setattr(monthly, "SUMMARY_POINTS", points)
    monkeypatch.setattr(monthly, "BRACKET", 5.0 / points)
    rng = np.random.default_rng(1)
    shapes = {"close": np.concatenate([1.0 + rng.random(4000) * 1e-9, rng.normal(0, 1e6, 4000)]),
              "ties": rng.integers(0, 5, 5000).astype(float), "one": np.full(3000, 7.0),
              "wild": np.concatenate([rng.normal(0, 1, 3000), [np.inf, -np.inf, 1e300, -1e300]])}
    for name, x in shapes.items():
        df = spark.createDataFrame(pd.DataFrame({"v": x})).repartition(3)
        for q in (0.0, 0.5, 0.97):
            got = quantile_table(df, "v", q).first()[0]
            ordered = np.sort(x)
            at = (len(x) - 1) * q
            lo, hi = ordered[int(np.floor(at))], ordered[int(np.ceil(at))]
            want = lo if lo == hi else lo * (np.ceil(at) - at) + hi * (at - np.floor(at)) if at % 1 else lo
            assert got == pytest.approx(want, rel=1e-12), (name, q)
    plan = quantile_table(df, "v", 0.5)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in plan and "windowspecdefinition(v" not in plan  # every window has a partition key


# -- S10, A7 --------------------------------------------------------------------------

def test_label_counts(spark):
    from harvestwatch.operators import label_counts
    rows = [("a", 1), ("b", 1), ("a", 2), (None, 3), ("c", None)] + [(f"x{i % 300}", i % 7) for i in range(3000)] + [("hot", 9)] * 1500
    got = label_counts(spark.createDataFrame(rows, "s string, n int").repartition(3), ["s", "n"], k=3, tracked=512).collect()
    by = {c: [(r["value"], r["n"], r["rank"]) for r in sorted(got, key=lambda r: r["rank"]) if r["column"] == c] for c in ("s", "n")}
    assert by["s"] == [("hot", 1500, 1), ("x0", 10, 2), ("x1", 10, 3)]
    assert by["n"] == [("9", 1500, 1), ("1", 431, 2), ("2", 430, 3)]
    assert [r["share"] for r in got if r["value"] == "hot"] == [1500 / 4504]
    assert label_counts(spark.createDataFrame([], "s string"), ["s"]).count() == 0


def test_label_counts_leave_no_label_out(spark):
    # ranks 2 to 4 come twice among 40,000 labels that come once: more than a summary follows
    from harvestwatch.operators import label_counts
    once = spark.range(40_000).selectExpr("concat('x', id) AS s")
    rows = once.union(spark.createDataFrame([("hot",)] * 30 + [("x39990",), ("x20000",), ("x7",)], "s string")).repartition(5)
    got = sorted((r["rank"], r["value"], r["n"]) for r in label_counts(rows, ["s"], k=4).collect())
    assert got == [(1, "hot", 30), (2, "x20000", 2), (3, "x39990", 2), (4, "x7", 2)]
    assert len(label_counts(rows, ["s"], k=20_000).collect()) == 20_000  # not cut to what a summary holds


def test_sketches_unite(spark):
    from harvestwatch.operators import distinct_from, distinct_sketches, sketch_error
    rows = [(y, i) for y in (1, 2, 3) for i in range(y * 1000, y * 1000 + 3000)] + [(1, None)]
    kept = distinct_sketches(spark.createDataFrame(rows, "y int, v int"), ["y"], ["v"])
    one = {r.y: r.n_v for r in distinct_from(kept, ["y"], ["v"]).collect()}
    assert all(abs(n - 3000) <= sketch_error() * 3000 for n in one.values())
    assert abs(distinct_from(kept, [], ["v"]).first()[0] - 5000) <= sketch_error() * 5000  # values of several years count once


def test_log_of_a_batch_holds_what_was(spark, tmp_path):
    from harvestwatch.streaming import merge_events
    store = str(tmp_path / "store")
    make = lambda *xs: spark.createDataFrame([(*event(i, "2020-01-01", "N", x), 1, "f") for i, x in xs],
                                             ", ".join(f"{f} string" for f in EVENT_FIELDS) + ", landed_at long, landed_in string")
    merge_events(make(("a", 1), ("b", 2)), store, 0)
    merge_events(make(("a", 1), ("b", 7)), store, 1)
    log = spark.read.parquet(f"{store}/events")
    assert [(r.event_id_cnty, r.was.fatalities, r.now.fatalities) for r in log.where("batch_id = 1").collect()] == [("b", 2.0, 7.0)]
