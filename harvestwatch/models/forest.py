"""Isolation forest (M7-M9): Spark ML has none, so it is built here.

Method from the published paper (Liu, Ting & Zhou, 2008): each tree isolates a
sub-sample of ``psi`` rows with random axis-parallel splits up to height
``ceil(log2 psi)``; a row's score is ``2^(-E[h(x)] / c(psi))``, where a leaf
holding m rows adds ``c(m)`` to the path length and
``c(n) = 2 (ln(n-1) + 0.5772) - 2 (n-1)/n``.

Spark plan:

* scaling (M7): mean and population std per column in one aggregate, applied
  as column arithmetic;
* sampling: every (row, tree) pair is kept with probability ``psi / n``; a
  row-level pre-filter first keeps about ``trees x psi`` rows whatever ``n``
  is, so the pair expansion is bounded by the forest size, not the table;
* fit (M8): ``groupBy("tree").applyInPandas`` -- each group holds about
  ``1.25 psi`` rows, of which the first ``psi`` by hash are taken, so no group
  grows with the data (rows without a unique key get one for the draw, so that
  copies of a row are drawn one by one); the output is the node table (at most ``trees x (2 psi - 1)`` rows);
* score (M9): the node table is the model -- bounded by the forest size, it
  is shipped to executors as a broadcast variable, and an Arrow-batched
  ``pandas_udf`` walks every tree for a whole batch with numpy.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from .. import constants as K
from ..session import cut_lineage
from ..functions._util import np_round
from ..operators import quantile_table

EULER = 0.5772156649


def c_factor(n):
    n = np.asarray(n, dtype=float)
    out = np.where(n > 2, 2.0 * (np.log(np.maximum(n - 1.0, 1.0)) + EULER) - 2.0 * (n - 1.0) / np.maximum(n, 1.0),
                   np.where(n == 2, 1.0, 0.0))
    return out


def fit_scaler(df: DataFrame, cols) -> dict:
    """M7 †: mean and population std per column from one aggregate row."""
    aggs = []
    for i, c in enumerate(cols):
        x = F.coalesce(F.col(c).cast("double"), F.lit(0.0))
        aggs += [F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}")]
    row = df.agg(*aggs).first()
    return {c: (row[f"m{i}"] or 0.0, row[f"s{i}"] or 0.0) for i, c in enumerate(cols)}


def apply_scaler(df: DataFrame, scaler: dict, prefix: str = "z_") -> DataFrame:
    """Standardise (a zero std keeps the centred value, as scikit-learn does)."""
    cols = {}
    for c, (m, s) in scaler.items():
        x = F.coalesce(F.col(c).cast("double"), F.lit(0.0)) - F.lit(m)
        cols[prefix + c] = x / F.lit(s) if s > 0 else x
    return df.withColumns(cols)


NODE_SCHEMA = T.StructType([
    T.StructField("tree", T.IntegerType()), T.StructField("node", T.IntegerType()),
    T.StructField("feature", T.IntegerType()), T.StructField("threshold", T.DoubleType()),
    T.StructField("left", T.IntegerType()), T.StructField("right", T.IntegerType()),
    T.StructField("size", T.IntegerType()), T.StructField("depth", T.IntegerType()),
])


def _build_tree(pdf: pd.DataFrame, psi: int, n_features: int, max_features: float, seed: int) -> pd.DataFrame:
    tree = int(pdf["tree"].iloc[0])
    pdf = pdf.sort_values("h").head(psi)
    X = np.vstack(pdf["x"].to_numpy()) if len(pdf) else np.zeros((0, n_features))
    rng = np.random.default_rng([seed, tree])
    k = max(1, int(max_features * n_features))
    feats = np.sort(rng.choice(n_features, size=k, replace=False))
    limit = int(math.ceil(math.log2(max(psi, 2))))
    rows = []
    stack = [(0, np.arange(len(X)), 0)]
    next_id = 1
    while stack:
        node, idx, depth = stack.pop()
        size = len(idx)
        if depth >= limit or size <= 1:
            rows.append((tree, node, -1, 0.0, -1, -1, size, depth))
            continue
        sub = X[idx][:, feats]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        usable = np.nonzero(hi > lo)[0]
        if len(usable) == 0:
            rows.append((tree, node, -1, 0.0, -1, -1, size, depth))
            continue
        j = usable[rng.integers(len(usable))]
        thr = float(rng.uniform(lo[j], hi[j]))
        f = int(feats[j])
        left_mask = X[idx, f] < thr
        li, ri = next_id, next_id + 1
        next_id += 2
        rows.append((tree, node, f, thr, li, ri, size, depth))
        stack.append((li, idx[left_mask], depth + 1))
        stack.append((ri, idx[~left_mask], depth + 1))
    return pd.DataFrame(rows, columns=[f.name for f in NODE_SCHEMA])


def fit_forest(df: DataFrame, cols, trees: int = K.FOREST_TREES, psi: int = K.FOREST_SUBSAMPLE,
               max_features: float = K.FOREST_MAX_FEATURES, seed: int = K.SEED, keys=None) -> DataFrame:
    """M8: the node table of an isolation forest over ``cols`` (already
    scaled).  ``keys`` identify rows for the sampling hash, so that a draw can
    be repeated; where they are not given or not unique, the row's place in its
    partition is added and copies are drawn one by one.  A table of fewer than
    ``psi`` rows is its own sub-sample."""
    keys = list(keys or [])
    # † one row decides the sampling rates and whether the keys are unique
    n, most = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n"), F.max("n")).first()
    if not n:
        return df.sparkSession.createDataFrame([], NODE_SCHEMA)
    psi = min(psi, n)
    ident = [F.col(k) for k in keys] if keys else [F.col(c) for c in cols]
    if not keys or most > 1:
        ident.append(F.monotonically_increasing_id())
    f_pair = min(1.0, psi * 1.25 / n)                       # per (row, tree) keep rate
    f_row = min(1.0, 1.0 - (1.0 - f_pair) ** trees)         # P(row used by any tree)
    span = 1 << 40
    rid = F.xxhash64(*ident, F.lit(seed))
    x = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols])
    rows = (df.select(rid.alias("rid"), x.alias("x"))
            .where(F.pmod(F.col("rid"), F.lit(span)) < F.lit(int(f_row * span))))
    cond = f_pair / f_row
    pairs = rows.select("x", F.explode(F.filter(
        F.sequence(F.lit(0), F.lit(trees - 1)),
        lambda t: F.pmod(F.xxhash64(F.col("rid"), t, F.lit(seed + 1)), F.lit(span)) < F.lit(int(cond * span)))
    ).alias("tree"), "rid")
    pairs = pairs.withColumn("h", F.xxhash64(F.col("rid"), F.col("tree"), F.lit(seed + 2)))
    nf = len(cols)
    return (pairs.select("tree", "h", "x").groupBy("tree")
            .applyInPandas(lambda pdf: _build_tree(pdf, psi, nf, max_features, seed), NODE_SCHEMA))


def _forest_arrays(nodes: DataFrame):
    """Collect the node table (bounded by trees x (2 psi - 1)) as arrays."""
    pdf = nodes.toPandas().sort_values(["tree", "node"])
    trees = []
    for _, g in pdf.groupby("tree"):
        m = int(g["node"].max()) + 1
        arr = {k: np.zeros(m, dtype=dt) for k, dt in
               (("feature", np.int64), ("threshold", float), ("left", np.int64), ("right", np.int64),
                ("size", np.int64), ("depth", np.int64))}
        for k in arr:
            arr[k][g["node"].to_numpy()] = g[k].to_numpy()
        trees.append(arr)
    return trees


def score_forest(df: DataFrame, nodes: DataFrame, cols, psi: int = K.FOREST_SUBSAMPLE,
                 out: str = "anomaly_score", digits: int = 4) -> DataFrame:
    """M9: ``out`` = 2^(-mean path / c(psi)) (higher = more anomalous).  ``psi``
    is the number of rows that a tree was built from."""
    spark = df.sparkSession
    bc = spark.sparkContext.broadcast(_forest_arrays(nodes))
    norm = float(c_factor(psi))

    @F.pandas_udf(T.DoubleType())
    def path_score(xs: pd.Series) -> pd.Series:
        X = np.vstack(xs.to_numpy()) if len(xs) else np.zeros((0, len(cols)))
        total = np.zeros(len(X))
        forest = bc.value
        for t in forest:
            node = np.zeros(len(X), dtype=np.int64)
            leaf = t["left"] < 0
            for _ in range(int(t["depth"].max()) + 1):
                inner = ~leaf[node]
                if not inner.any():
                    break
                f = t["feature"][node[inner]]
                go_left = X[np.nonzero(inner)[0], f] < t["threshold"][node[inner]]
                node[inner] = np.where(go_left, t["left"][node[inner]], t["right"][node[inner]])
            total += t["depth"][node] + c_factor(t["size"][node])
        mean = total / max(len(forest), 1)
        return pd.Series(np.power(2.0, -mean / norm) if norm else np.full(len(X), 0.5))

    x = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols])
    return df.withColumn(out, np_round(path_score(x), digits))


FULL_DIGITS = 12  # the decision is taken on the score before display rounding


def _flagged(scored: DataFrame, threshold: float, digits: int) -> DataFrame:
    flag = F.coalesce(F.col("anomaly_score") > F.lit(threshold), F.lit(False))
    return scored.withColumns({"is_anomaly": flag.cast("int"),
                               "anomaly_label": F.when(flag, F.lit(-1)).otherwise(F.lit(1)),
                               "anomaly_score": np_round(F.col("anomaly_score"), digits)})


class ForestModel:
    """A fitted isolation forest: node table, scaler, columns and the score
    threshold fixed at fit time (so new data is flagged against the
    training distribution, as a loaded model does)."""

    def __init__(self, nodes: DataFrame, scaler: dict, cols, threshold: float,
                 psi: int = K.FOREST_SUBSAMPLE):
        self.nodes, self.scaler, self.cols = nodes, scaler, list(cols)
        self.threshold, self.psi = float(threshold), psi

    def transform(self, df: DataFrame, digits: int = 4) -> DataFrame:
        """M9: anomaly_score, anomaly_label (-1/1), is_anomaly."""
        z = apply_scaler(df, self.scaler)
        zcols = ["z_" + c for c in self.cols]
        scored = score_forest(z, self.nodes, zcols, self.psi, digits=FULL_DIGITS).drop(*zcols)
        return _flagged(scored, self.threshold, digits)

    def save(self, path: str) -> None:
        """Node table as Parquet, parameters as a one-row JSON table."""
        import json
        spark = self.nodes.sparkSession
        self.nodes.write.mode("overwrite").parquet(f"{path}/nodes")
        meta = json.dumps({"scaler": self.scaler, "cols": self.cols, "threshold": self.threshold,
                           "psi": self.psi})
        spark.createDataFrame([(meta,)], "meta string").write.mode("overwrite").json(f"{path}/meta")

    @staticmethod
    def load(spark, path: str) -> "ForestModel":
        import json
        meta = json.loads(spark.read.json(f"{path}/meta").first().meta)
        scaler = {k: tuple(v) for k, v in meta["scaler"].items()}
        return ForestModel(spark.read.parquet(f"{path}/nodes"), scaler, meta["cols"], meta["threshold"],
                           meta["psi"])


def fit_isolation_forest(df: DataFrame, cols, contamination: float = K.FOREST_CONTAMINATION,
                         trees: int = K.FOREST_TREES, psi: int = K.FOREST_SUBSAMPLE,
                         max_features: float = K.FOREST_MAX_FEATURES, seed: int = K.SEED,
                         keys=None) -> tuple[ForestModel, DataFrame]:
    """M7 + M8: scale, build the trees, score the training rows and fix the
    threshold at their (1 - contamination) quantile.  Returns the model and
    the scored training rows (materialised once: the threshold and the
    output would otherwise each re-run the Python scoring)."""
    scaler = fit_scaler(df, cols)
    z = apply_scaler(df, scaler)
    zcols = ["z_" + c for c in cols]
    nodes = cut_lineage(fit_forest(z, zcols, trees, psi, max_features, seed, keys))
    # the root of a tree knows how many rows the tree was built from
    psi = nodes.where("node = 0").agg(F.max("size")).first()[0] or psi
    scored = cut_lineage(score_forest(z, nodes, zcols, psi, digits=FULL_DIGITS).drop(*zcols))
    thr = quantile_table(scored, "anomaly_score", 1.0 - contamination).first()[0]  # † one scalar
    model = ForestModel(nodes, scaler, cols, thr if thr is not None else float("inf"), psi)
    return model, _flagged(scored, model.threshold, 4)


def isolation_forest(df: DataFrame, cols, contamination: float = K.FOREST_CONTAMINATION,
                     trees: int = K.FOREST_TREES, psi: int = K.FOREST_SUBSAMPLE,
                     max_features: float = K.FOREST_MAX_FEATURES, seed: int = K.SEED, keys=None) -> DataFrame:
    """M7-M9 end to end on one table: adds ``anomaly_score``,
    ``anomaly_label`` (-1/1) and ``is_anomaly``."""
    return fit_isolation_forest(df, cols, contamination, trees, psi, max_features, seed, keys)[1]
