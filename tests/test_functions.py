"""Column functions and rules on hand-written edge rows (FIXTURES.md)."""

import numpy as np
from pyspark.sql import functions as F

from harvestwatch import constants as K
from harvestwatch.functions import (fixed, signed_pct, flag_gt, flag_lt, flag_pattern, ipc_phase_rule, ipc_score,
                                    month_year_title, parse_date, parse_double, period_label,
                                    price_direction, season_phase, std_region, risk_tier,
                                    weather_message, price_message, is_lean_season)
from harvestwatch.functions._util import np_round


def test_std_region(spark):
    df = spark.createDataFrame([(" Brong-Ahafo ",), ("Elsewhere",), (None,), ("Tamale",)], "r string")
    got = [r[0] for r in df.select(std_region("r")).collect()]
    assert got == ["Bono", "Elsewhere", "Unknown", "Northern"]


def test_parse_double_and_date(spark):
    df = spark.createDataFrame([("3.12", "2003-01-01"), ("n/a", "oops"), ("NaN", None), (" 2 ", "2003-01-01 00:00:00")],
                               "v string, d string")
    rows = df.select(parse_double("v").alias("v"), parse_date("d").alias("d")).collect()
    assert [r.v for r in rows] == [3.12, None, None, 2.0]
    assert [str(r.d) if r.d else None for r in rows] == ["2003-01-01", None, None, "2003-01-01"]


def test_threshold_flags_boundaries(spark):
    df = spark.createDataFrame([(50.0,), (50.001,), (-40.0,), (-40.001,), (None,)], "a double")
    rows = df.select(flag_gt("a", 50).alias("f"), flag_lt("a", -40).alias("d")).collect()
    assert [r.f for r in rows] == [0, 1, 0, 0, 0]
    assert [r.d for r in rows] == [0, 0, 0, 1, 0]


def test_pattern_flag(spark):
    df = spark.createDataFrame([("FLOOD",), ("Displaced persons",), (None,), ("Battles",)], "t string")
    assert [r[0] for r in df.select(flag_pattern("t")).collect()] == [1, 1, 0, 0]


def test_price_direction_boundaries(spark):
    df = spark.createDataFrame([(5.0,), (5.01,), (-5.0,), (-5.01,), (None,)], "x double")
    got = [r[0] for r in df.select(price_direction("x")).collect()]
    assert got == [K.STABLE, K.RISING, K.STABLE, K.FALLING, K.STABLE]


def test_ipc_score_boundary(spark):
    # 10 conflict events only, southern region, no lean season: 3.0 -> phase 2
    df = spark.createDataFrame([(0.0, 0, 0, 0.0, 10, 0, 1)],
                               "rainfall_anomaly_pct double, flood_flag int, drought_flag int, "
                               "price_change_pct double, conflict_events long, is_lean_season int, "
                               "district_vulnerability int")
    r = df.select(ipc_score().alias("s"), ipc_phase_rule().alias("p")).first()
    assert r.s == 3.0 and r.p == 2


def test_ipc_nan_free_defaults(spark):
    df = spark.createDataFrame([(None, 1, 1, None, None, 1, 2)],
                               "rainfall_anomaly_pct double, flood_flag int, drought_flag int, "
                               "price_change_pct double, conflict_events long, is_lean_season int, "
                               "district_vulnerability int")
    # 0 + 2 + 1 + 0 + 0 + 1 + 1 = 5 -> phase 3
    assert df.select(ipc_phase_rule()).first()[0] == 3


def test_all_seasons(spark):
    rows = [(r, m) for r in ("Northern", "Volta") for m in range(1, 13)]
    df = spark.createDataFrame(rows, "region string, month int")
    phases = {r[0] for r in df.select(season_phase()).collect()}
    assert len(phases) == 11 and phases == set(K.SEASON_PHASES)
    lean = df.select(is_lean_season(season_phase())).collect()
    assert sum(r[0] for r in lean) == 6 + 3  # north: 12,1,2 lean + 3,4,5 pre-planting; south: 12,1,2


def test_np_round_matches_numpy(spark):
    vals = [224247.9715, 2.675, 0.125, -0.125, 1.0005, 10.0025, 3.14159]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(np_round("x", 3)).collect()]
    assert got == [float(np.round(v, 3)) for v in vals]


def test_text_formats(spark):
    df = spark.createDataFrame([(2024, 12), (2003, 1)], "year int, month int")
    rows = df.select(period_label().alias("p"), month_year_title().alias("t")).collect()
    assert [(r.p, r.t) for r in rows] == [("2024-12", "December 2024"), ("2003-01", "January 2003")]


def test_messages_and_tiers(spark):
    df = spark.createDataFrame([(-25.0, 0, K.RISING, 3, 0), (55.0, 1, K.FALLING, 2, 1), (0.0, 0, K.STABLE, 2, 0),
                                (-35.0, 0, K.STABLE, 1, 0)],
                               "rain double, flood int, dir string, phase int, anom int")
    rows = df.select(weather_message("rain", "flood", "bulletin").alias("b"),
                     weather_message("rain", "flood", "dashboard").alias("d"),
                     price_message("dir", "notebook").alias("n"),
                     risk_tier("phase", "anom").alias("t")).collect()
    assert rows[0].b == K.WEATHER_MESSAGES["bulletin"]["dry"]
    assert rows[1].b == K.WEATHER_MESSAGES["bulletin"]["wet"]
    assert rows[1].d == K.WEATHER_MESSAGES["dashboard"]["wet"]
    assert rows[3].d == K.WEATHER_MESSAGES["dashboard"]["dry"]
    assert rows[1].n == K.PRICE_MESSAGES["notebook"]["other"]
    assert [r.t for r in rows] == ["crisis", "unusual", "stressed", "minimal"]


def test_fixed_text_equals_pythons_format(spark):
    import random
    pick = random.Random(7)
    ties = [3.15, 0.25, 0.75, 2.5, 3.5, 0.5, 1.005, 2.675, 1.25, 1.35, 0.05, 0.15, 0.45, 1e15 + 0.5, 1e16, 4503599627370497.5, 0.125, 0.375,
            90071992547409.25, 9007199254740993.0, 1e17, 123456789012345.67, 5e-324, 1e-9, 0.0, 99.95, 9.995, 999999.9999]
    more = [pick.uniform(-1, 1) * 10 ** pick.randint(-4, 12) for _ in range(400)] + [round(pick.uniform(0, 100), 2) for _ in range(400)]
    more += [(2 * k + 1) / 2 ** m for k in range(20) for m in (1, 2, 3, 4)]
    values = [v * s for v in [*ties, *more] for s in (1, -1)] + [float("inf"), float("-inf")]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for digits in (0, 1, 2, 3, 4):
        got = df.select("x", fixed("x", digits).alias("a"), fixed("x", digits, sign=True, width=8).alias("b")).collect()
        assert [(r.x, r.a) for r in got] == [(v, format(v, f".{digits}f")) for v in values]
        assert [(r.x, r.b) for r in got] == [(v, format(v, f"+8.{digits}f")) for v in values]
    odd = spark.createDataFrame([(None,), (float("nan"),)], "x double")
    assert [r[0] for r in odd.select(signed_pct("x")).collect()] == ["+nan", "+nan"]
    assert spark.range(1).select(signed_pct(F.lit(3.15))).first()[0] == "+3.1"


def test_std_region_empty_map(spark):
    df = spark.createDataFrame([(" Accra ",), (None,)], "r string")
    assert [r[0] for r in df.select(std_region("r", {})).collect()] == ["Accra", "Unknown"]
