"""Attribution per prediction (M16): sampled Shapley values.

A permutation of the features turns a background row into the row to be explained,
one feature at a time; the change that a feature's step makes is its contribution,
averaged over permutations.  Each permutation is used with its reverse (a pair), and
every row is explained against the same background rows in turn, so the contributions
of a row add up to its prediction less the mean prediction of the background, and a
linear model gets its exact values.

Scale: one scoring job over rows x steps, made by a generator from a plan of
``2 * pairs`` permutations and background rows, which is small by its parameters; each
scored step adds to one feature's sum and takes from the next one's.  The rows to be
explained are shuffled by their keys before the generator, so the steps of a row stay
in its task and are summed there: no step is shuffled, written or read again.
"""

from __future__ import annotations

import random
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from .supervised import prepare

PAIRS = 8
Scorer = Callable[[DataFrame], DataFrame]


def regression_scorer(model: PipelineModel) -> Scorer:
    """Adds ``__f``: the prediction of a fitted regressor."""
    return lambda df: model.transform(df).withColumn("__f", F.col("prediction"))


def class_scorer(model: PipelineModel, label) -> Scorer:
    """Adds ``__f``: a classifier's probability of one class."""
    at = list(model.stages[0].labels).index(str(label))
    return lambda df: PipelineModel(stages=model.stages[1:]).transform(df).withColumn(
        "__f", vector_to_array("probability")[at])


def column_scorer(f: Column) -> Scorer:
    """Adds ``__f``: any expression over the feature columns."""
    return lambda df: df.withColumn("__f", f)


def shapley_values(score: Scorer, rows: DataFrame, cols, keys, background: DataFrame, pairs: int = PAIRS,
                   seed: int = 42) -> DataFrame:
    """(keys, feature, contribution, prediction, base) for each row and feature.

    ``background`` is a few rows (at most ``pairs`` different ones are used, in the
    order of their values); missing features are 0, as the models take them.  Rows are told apart
    by ``keys``; rows that repeat a key must be equal."""
    cols, keys, spark = list(cols), list(keys), rows.sparkSession
    held = prepare(background, cols).select(F.array(*cols).alias("z")).distinct().orderBy("z").limit(pairs).collect()
    held = [list(r["z"]) for r in held]  # † a bounded number of rows
    if not held:
        raise ValueError("no background rows")
    pick, plan = random.Random(seed), []
    turns = -(-pairs // len(held)) * len(held)  # whole turns through the background, so that the base is its mean
    for i in range(turns):
        order = pick.sample(range(len(cols)), len(cols))
        for o in (order, order[::-1]):
            place = [0] * len(cols)
            for at, j in enumerate(o):
                place[j] = at
            plan.append((len(plan), held[i % len(held)], place, o))
    plan = F.broadcast(spark.createDataFrame(plan, "p int, z array<double>, place array<int>, o array<int>"))
    n = 2 * turns
    # a fixed number of parts: few rows make many steps, which their bytes do not show
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    x = prepare(rows, cols).dropna(subset=keys).select(*keys, F.array(*cols).alias("x")).repartition(parts, *keys).distinct()
    at = F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("p")  # every row meets the n rows of the plan
    steps = x.select(*keys, "x", at).join(plan, "p").select(
        *keys, "x", "z", "place", "o", F.explode(F.sequence(F.lit(0), F.lit(len(cols)))).alias("k"))
    mixed = F.transform("x", lambda v, j: F.when(F.get(F.col("place"), j) < F.col("k"), v).otherwise(F.get(F.col("z"), j)))
    steps = steps.withColumn("m", mixed)
    scored = score(steps.select(*keys, "k", "o", *[F.col("m")[j].alias(c) for j, c in enumerate(cols)]))
    scored = scored.select(*keys, "__f", "k", F.get("o", F.col("k") - 1).alias("came"), F.get("o", F.col("k")).alias("next"))
    mean = lambda v: F.sum(v) / n
    gain = lambda j: F.when(F.col("came") == j, F.col("__f")).when(F.col("next") == j, -F.col("__f"))
    sums = scored.groupBy(*keys).agg(
        F.array(*[mean(gain(j)) for j in range(len(cols))]).alias("gains"),
        mean(F.when(F.col("k") == len(cols), F.col("__f"))).alias("prediction"),
        mean(F.when(F.col("k") == 0, F.col("__f"))).alias("base"))
    names = F.array(*[F.lit(c) for c in cols])
    return sums.select(*keys, "prediction", "base", F.posexplode("gains").alias("j", "contribution")).select(
        *keys, F.get(names, "j").alias("feature"), "contribution", "prediction", "base")


def attribution_ranking(values: DataFrame, k: int | None = 15) -> DataFrame:
    """(feature, mean_abs_contribution), the ``k`` largest, ties by name."""
    out = values.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("mean_abs_contribution"))
    return out if k is None else out.orderBy(F.col("mean_abs_contribution").desc(), "feature").limit(k)
