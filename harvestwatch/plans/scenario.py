"""What-if scorer (R14-R16) as a batch operator over a table of scenarios.

Input columns: rainfall_anom, price_change, conflict_events, population_density,
prev_ipc (numbers), flood_flag (boolean), ndvi_anom (double).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import constants as K
from ..functions import fixed, phase_label
from ..functions._util import np_round

_D = lambda x: F.lit(float(x))
T = K.SCENARIO_DRIVERS


def _fmt0(c) -> Column:
    return fixed(c, 0)


def _text(template: str, **parts) -> Column:
    """Fill a ``{name}`` template with Column parts (concat of pieces)."""
    pieces, rest = [], template
    while "{" in rest:
        pre, rest = rest.split("{", 1)
        name, rest = rest.split("}", 1)
        pieces += [F.lit(pre), parts[name]]
    pieces.append(F.lit(rest))
    return F.concat(*pieces)


def scenario_score(df: DataFrame) -> DataFrame:
    """Score, phase, confidence and driver texts per scenario."""
    rain, price = F.col("rainfall_anom"), F.col("price_change")
    flood = F.coalesce(F.col("flood_flag").cast("boolean"), F.lit(False))
    conflict, ndvi = F.col("conflict_events"), F.col("ndvi_anom")
    prev, dens = F.col("prev_ipc"), F.col("population_density")

    rain_pts = F.when(rain >= 50, _D(2.5)).when(rain <= -40, _D(2.0)).when(rain <= -20, _D(0.8)).otherwise(_D(0))
    price_pts = F.when(price >= 30, _D(2.0)).when(price >= 15, _D(1.0)).when(price <= -10, _D(-0.5)).otherwise(_D(0))
    flood_pts = F.when(flood, _D(1.2)).otherwise(_D(0))
    conflict_pts = F.when(conflict >= 5, _D(1.5)).when(conflict >= 2, _D(0.6)).otherwise(_D(0))
    ndvi_pts = F.when(ndvi <= -0.15, _D(1.0)).when(ndvi >= 0.10, _D(-0.3)).otherwise(_D(0))
    prev_pts = F.when(prev >= 3, _D(0.8)).when(prev == 1, _D(-0.4)).otherwise(_D(0))
    dens_pts = F.when(dens >= 200, _D(0.5)).otherwise(_D(0))
    score = (((((((_D(0) + rain_pts) + price_pts) + flood_pts) + conflict_pts) + ndvi_pts) + prev_pts) + dens_pts)

    r, p = _fmt0("rainfall_anom"), _fmt0("price_change")
    drivers = F.array(
        F.when(rain >= 50, _text(T["flood"], rain=r)).when(rain <= -40, _text(T["drought"], rain=r))
         .when(rain <= -20, _text(T["dry"], rain=r)),
        F.when(price >= 30, _text(T["shock"], price=p)).when(price >= 15, _text(T["elevated"], price=p))
         .when(price <= -10, _text(T["falling"], price=p)),
        F.when(flood, F.lit(T["active_flood"])),
        F.when(conflict >= 5, _text(T["high_conflict"], conflict=conflict.cast("string")))
         .when(conflict >= 2, _text(T["moderate_conflict"], conflict=conflict.cast("string"))),
        F.when(ndvi <= -0.15, _text(T["vegetation"], ndvi=fixed(ndvi, 2))),
        F.when(prev >= 3, _text(T["carry_over"], prev=prev.cast("string"))),
        F.when(dens >= 200, _text(T["density"], density=_fmt0("population_density"))),
    )
    drivers = F.filter(drivers, lambda x: x.isNotNull())
    drivers = F.when(F.size(drivers) == 0, F.array(F.lit(K.SCENARIO_NORMAL_DRIVER))).otherwise(drivers)

    out = df.withColumn("__score", score)
    s = F.col("__score")
    phase = F.when(s <= 0.5, F.lit(1)).when(s <= 1.8, F.lit(2)).when(s <= 3.5, F.lit(3)).otherwise(F.lit(4))
    out = out.withColumn("phase", phase)
    c = K.SCENARIO_PHASE_CENTRES
    centre = (F.when(F.col("phase") == 1, _D(c[1])).when(F.col("phase") == 2, _D(c[2]))
              .when(F.col("phase") == 3, _D(c[3])).otherwise(_D(c[4])))
    conf = F.greatest(_D(0.55), F.least(_D(0.97), _D(0.97) - F.abs(s - centre) * _D(0.12)))
    return (out.withColumns({"confidence": np_round(conf, 2), "score": np_round(s, 2), "drivers": drivers})
            .drop("__score"))


def scenario_status(df: DataFrame, key: str = "scenario_id") -> DataFrame:
    """Long table (key, seq, parameter, value, status) with the seven
    threshold rules; built with ``inline`` over an array of structs."""
    S = K.SCENARIO_STATUS
    rain, price = F.col("rainfall_anom"), F.col("price_change")
    flood = F.coalesce(F.col("flood_flag").cast("boolean"), F.lit(False))
    conflict, ndvi = F.col("conflict_events"), F.col("ndvi_anom")
    prev, dens = F.col("prev_ipc"), F.col("population_density")
    rows = [
        (F.format_string(K.SCENARIO_PCT_FORMAT, rain.cast("int")),
         F.when(rain >= 50, F.lit(S["rain"][0])).when(rain <= -40, F.lit(S["rain"][1])).otherwise(F.lit(S["rain"][2]))),
        (F.format_string(K.SCENARIO_PCT_FORMAT, price.cast("int")),
         F.when(price >= 30, F.lit(S["price"][0])).when(price >= 15, F.lit(S["price"][1])).otherwise(F.lit(S["price"][2]))),
        (F.when(flood, F.lit(K.FLOOD_YES)).otherwise(F.lit(K.FLOOD_NO)),
         F.when(flood, F.lit(S["flood"][0])).otherwise(F.lit(S["flood"][1]))),
        (conflict.cast("string"),
         F.when(conflict >= 5, F.lit(S["conflict"][0])).when(conflict >= 2, F.lit(S["conflict"][1])).otherwise(F.lit(S["conflict"][2]))),
        (fixed(ndvi, 2, sign=True),
         F.when(ndvi <= -0.15, F.lit(S["ndvi"][0])).otherwise(F.lit(S["ndvi"][1]))),
        (F.format_string(K.SCENARIO_DENSITY_FORMAT, dens.cast("int")),
         F.when(dens >= 200, F.lit(S["density"][0])).otherwise(F.lit(S["density"][1]))),
        (F.format_string(K.SCENARIO_PREV_FORMAT, prev.cast("int"), phase_label(prev)),
         F.when(prev >= 3, F.lit(S["prev"][0])).otherwise(F.lit(S["prev"][1]))),
    ]
    structs = [F.struct(F.lit(i + 1).alias("seq"), F.lit(name).alias("parameter"),
                        v.alias("value"), st.alias("status"))
               for i, (name, (v, st)) in enumerate(zip(K.SCENARIO_PARAMETERS, rows))]
    return df.select(key, F.inline(F.array(*structs)))
