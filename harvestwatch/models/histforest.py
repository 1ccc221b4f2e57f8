"""Random forests (M5, M6) over more rows than a fit of Spark ML can hold.

Spark ML keeps each training row with a count and a node for every tree: some kilobytes a
row, which go to disk once memory is full.  Here a row is kept as one byte per feature (its
bin) and its label; the draws of a tree are made again from a seed where they are needed,
and so is the node of a row.  The method is that of Spark ML: up to 32 bins of a feature, cut
between its values at even shares of the rows; a tree takes each row Poisson(1) times; each
node tries a random choice of features; the split with the largest drop of the Gini impurity
or the variance; leaves of one node with the same prediction are merged.  The bins come
from all rows, not from a sample of 10,000.

Spark plan:

* bins: tasks reduce each column of a block of rows to a few hundred weighted values (all of
  them where there are no more), and one group per column cuts them into bins;
* blocks: every row is binned once, ``BLOCK`` rows to a table row, dealt evenly and kept;
* levels: a task adds up histograms of its rows for the open nodes of one tree after the
  other, the histograms are dealt by tree and nodes and added up, and only the chosen splits
  come to the driver.  A level is one job for all trees, and shuffles histograms, not rows;
* the trees are written in the format of Spark ML and loaded as its model, so scoring, saving
  and importances are those of Spark ML.
"""

from __future__ import annotations

import pickle
import uuid

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage, delete_path, ship_package, stage_path

BLOCK = 65_536  # rows binned together
BINS = 32
SUMMARY = 256  # values that a column of a block is reduced to
PART_ROWS = 2_000_000  # rows of a task, at a byte per feature
NODES = 64  # nodes whose histograms are added up together

_DRAWS = np.repeat(np.arange(9, dtype=np.uint8), np.diff(np.rint(np.cumsum(np.exp(-1) / np.cumprod(
    [1, 1, 2, 3, 4, 5, 6, 7, 8])) * 65_536).astype(int), prepend=0))  # how often Poisson(1) draws a row
_DRAWS = np.concatenate([_DRAWS, np.zeros(65_536 - len(_DRAWS), np.uint8)])

_NODE = ("treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, "
         "rawCount: bigint, gain: double, leftChild: int, rightChild: int, "
         "split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>")


def _in_blocks(batches, rows: int):
    """The columns of ``rows`` rows at a time, as arrays."""
    held, n = [], 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, rows - n)
            batch = batch.slice(part.num_rows)
            held.append(part)
            n += part.num_rows
            if n == rows:
                yield _columns(held)
                held, n = [], 0
    if n:
        yield _columns(held)


def _columns(batches):
    table = pa.Table.from_batches(batches)
    return [np.asarray(c.to_numpy(), dtype=np.float64) for c in table.columns]


def _summary(x, limit: int):
    """Values of a column with their counts; over ``limit``, values at even ranks with the
    rows up to them."""
    v, n = np.unique(x[np.isfinite(x)], return_counts=True)
    if len(v) > limit:
        total = np.cumsum(n)
        at = np.unique(np.searchsorted(total, (np.arange(limit) + 1) / limit * total[-1]))
        v, n = v[at], np.diff(total[at], prepend=0)
    return v, n


def cuts(values, counts, bins: int = BINS) -> list[float]:
    """The thresholds between the bins of a column, as Spark ML chooses them."""
    v, at = np.unique(values, return_inverse=True)
    n = np.bincount(at, weights=counts)
    if len(v) <= bins:
        return ((v[:-1] + v[1:]) / 2).tolist()
    out, stride = [], n.sum() / bins
    target, seen = stride, np.cumsum(n)
    for i in range(1, len(v)):
        if abs(seen[i - 1] - target) < abs(seen[i] - target):
            out.append(float((v[i - 1] + v[i]) / 2))
            target += stride
    return out[:bins - 1]


def _thresholds(df: DataFrame, cols, y: str, weights=None) -> list[list[float]]:
    def summary(x, label):  # the rows of a class count by its weight
        if weights is None:
            return _summary(x, SUMMARY)
        by = [_summary(x[label == k], SUMMARY) for k in range(len(weights))]
        return np.concatenate([v for v, _ in by]), np.concatenate([n * w for (_, n), w in zip(by, weights)])

    def summaries(batches):
        for *x, label in _in_blocks(batches, BLOCK):
            parts = [summary(c, label) for c in x]
            yield pa.RecordBatch.from_pydict({"i": pa.array(range(len(parts)), pa.int32()),
                                              "s": pa.array([pickle.dumps(p) for p in parts], pa.binary())})

    def cut(pdf):
        import pandas as pd
        parts = [pickle.loads(s) for s in pdf["s"]]
        return pd.DataFrame({"i": pdf["i"].iloc[:1], "t": [cuts(*map(np.concatenate, zip(*parts)))]})

    found = df.select(*cols, F.col(y).cast("double")).mapInArrow(summaries, "i int, s binary").groupBy("i").applyInPandas(cut, "i int, t array<double>")
    by = {r.i: list(r.t) for r in found.collect()}  # † at most 31 numbers a column
    return [by.get(i, []) for i in range(len(cols))]


def _binned(df: DataFrame, cols, y: str, thresholds) -> DataFrame:
    """Blocks of rows: their number, the bins of row after row, the labels."""
    edges = [np.array(t) for t in thresholds]

    def blocks(batches):
        part = TaskContext.get().partitionId()
        for i, (*x, label) in enumerate(_in_blocks(batches, BLOCK)):
            bins = np.empty((len(label), len(x)), np.uint8)
            for j, c in enumerate(x):
                bins[:, j] = np.searchsorted(edges[j], c)  # a value at a threshold is left of it
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "block": pa.array([i], pa.int32()),
                                              "x": pa.array([bins.tobytes()], pa.binary()), "y": pa.array([label.tobytes()], pa.binary())})

    return df.select(*cols, F.col(y).cast("double")).mapInArrow(blocks, "part int, block int, x binary, y binary")


class _Tree:
    """Nodes by number; those of a level follow those of the level above."""

    def __init__(self):
        self.left = np.full(1, -1)  # the right child is the next number
        self.feature, self.bin = np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.gain, self.stats = np.full(1, -1.0), None
        self.open = 0  # first node of the deepest level

    def walk(self, level: int, x, at, carried):
        """The nodes of ``level`` that rows are in; rows that end above are left out."""
        node = np.zeros(len(at), np.int64)
        for _ in range(level):
            after = self.left.take(node)
            inner = after >= 0
            if not inner.all():
                node, after, at = node[inner], after[inner], at[inner]
                carried = [c[inner] for c in carried]
            node = after + (x.take(at + self.feature.take(node)) > self.bin.take(node))
        return node - self.open, at, carried


def _histograms(blocks, tree: _Tree, t: int, level: int, tried, seed: int, n_features: int, classes: int, bagged: bool):
    """Sums over the drawn rows per open node (its totals) and per open node, tried feature
    and bin: of rows by class, or of rows and their labels (and squares, in the totals)."""
    nodes = len(tree.left) - tree.open
    wide = classes or 2
    totals = np.zeros((nodes, classes or 3))
    sums = np.zeros((0 if tried is None else tried.shape[1], nodes * wide * BINS))
    for part, block, x, y in blocks:
        at = np.arange(0, len(x), n_features)
        if bagged:
            rng = np.random.default_rng([seed, t, part, block])
            times = _DRAWS.take(np.frombuffer(rng.bytes(2 * len(y)), np.uint16))
            kept = np.flatnonzero(times > 0)
            at, w, label = at.take(kept), times.take(kept).astype(np.float64), y.take(kept)
        else:
            w, label = np.ones(len(y)), y
        slot, at, (w, label) = tree.walk(level, x, at, [w, label])
        if classes:
            totals += np.bincount(slot * classes + label, w, nodes * classes).reshape(nodes, classes)
            base = (slot * classes + label) * BINS
        else:
            wy = w * label
            for j, v in enumerate((w, wy, wy * label)):
                totals[:, j] += np.bincount(slot, v, nodes)
            base = slot * BINS
        for j in range(len(sums)):
            cell = base + x.take(at + tried[:, j].take(slot))
            if classes:
                sums[j] += np.bincount(cell, w, sums.shape[1])
            else:
                sums[j, :nodes * BINS] += np.bincount(cell, w, nodes * BINS)
                sums[j, nodes * BINS:] += np.bincount(cell, wy, nodes * BINS)
    shape = (len(sums), nodes, classes, BINS) if classes else (len(sums), 2, nodes, BINS)
    sums = sums.reshape(shape) if classes else sums.reshape(shape).transpose(0, 2, 1, 3)
    return totals, sums.transpose(1, 0, 2, 3)  # node, tried feature, class or sum, bin


def _best(totals, sums, weights, min_rows: int):
    """(tried feature or -1, bin, gain) of each node."""
    left = np.cumsum(sums, axis=3)[..., :-1]
    right = left[..., :1] * 0 + np.sum(sums, axis=3, keepdims=True) - left

    def score(part):  # rows, their weight, and what is left of the impurity's square terms
        if weights is None:
            n = part[:, :, 0]
            return n, n, np.divide(part[:, :, 1] ** 2, n, out=np.zeros_like(n), where=n > 0)
        c = part * weights[:, None]
        w = c.sum(axis=2)
        return part.sum(axis=2), w, np.divide((c ** 2).sum(axis=2), w, out=np.zeros_like(w), where=w > 0)

    n_left, w_left, s_left = score(left)
    n_right, w_right, s_right = score(right)
    w = w_left + w_right
    if weights is None:
        whole = np.divide(totals[:, 1] ** 2, totals[:, 0], out=np.zeros(len(totals)), where=totals[:, 0] > 0)
    else:
        c = totals * weights
        whole = np.divide((c ** 2).sum(axis=1), c.sum(axis=1), out=np.zeros(len(totals)), where=c.sum(axis=1) > 0)
    gain = np.divide(s_left + s_right - whole[:, None, None], w, out=np.full(w.shape, -1.0), where=w > 0)
    gain[(n_left < min_rows) | (n_right < min_rows)] = -1.0
    flat = gain.reshape(len(gain), -1)
    best = flat.argmax(axis=1)
    found = flat[np.arange(len(flat)), best]
    return np.where(found > 1e-12, best // (BINS - 1), -1), best % (BINS - 1), found


def grow(held: DataFrame, n_features: int, trees: int, depth: int, tried: int, min_rows: int, seed: int,
         classes: int = 0, weights=None, bagged: bool = True, parts: int = 8) -> list[_Tree]:
    """Trees over the blocks of ``held``, level by level, all trees in one job."""
    forest = [_Tree() for _ in range(trees)]
    weights = None if weights is None else np.asarray(weights, dtype=np.float64)
    for level in range(depth + 1):
        active = [t for t, tree in enumerate(forest) if len(tree.left) > tree.open]
        if not active:
            break
        rng = np.random.default_rng([seed, level])
        choice = {t: None if level == depth else np.argsort(
            rng.random((len(forest[t].left) - forest[t].open, n_features)), axis=1)[:, :tried] if tried < n_features
            else np.tile(np.arange(n_features), (len(forest[t].left) - forest[t].open, 1)) for t in active}

        def local(batches, level=level, active=active, choice=choice):
            blocks = []
            for batch in batches:
                for r in batch.to_pylist():
                    y = np.frombuffer(r["y"], np.float64)
                    blocks.append((r["part"], r["block"], np.frombuffer(r["x"], np.uint8), y.astype(np.int64) if classes else y))
            if not blocks:
                return
            for t in active:
                totals, sums = _histograms(blocks, forest[t], t, level, choice[t], seed, n_features, classes, bagged)
                for lo in range(0, len(totals), NODES):
                    # counts are whole numbers; sums of labels keep their digits
                    some = sums[lo:lo + NODES]
                    packed = (totals[lo:lo + NODES], some.astype(np.int32) if classes else
                              (some[:, :, 0].astype(np.int32), some[:, :, 1].copy()))
                    yield pa.RecordBatch.from_pydict({"tree": pa.array([t], pa.int32()), "lo": pa.array([lo], pa.int32()),
                                                      "h": pa.array([pickle.dumps(packed)], pa.binary())})

        def added(batches, level=level):
            held = {}
            for batch in batches:
                for r in batch.to_pylist():
                    totals, some = pickle.loads(r["h"])
                    some = some.astype(np.float64) if classes else np.stack([some[0], some[1]], axis=2)
                    if (r["tree"], r["lo"]) in held:
                        was = held[r["tree"], r["lo"]]
                        was[0] += totals
                        was[1] += some
                    else:
                        held[r["tree"], r["lo"]] = [totals.copy(), some]
            for (t, lo), (totals, sums) in held.items():
                split = _best(totals, sums, weights, min_rows) if level < depth else None
                yield pa.RecordBatch.from_pydict({"tree": pa.array([t], pa.int32()), "lo": pa.array([lo], pa.int32()),
                                                  "s": pa.array([pickle.dumps((totals, split))], pa.binary())})

        rows = (held.mapInArrow(local, "tree int, lo int, h binary").repartition(parts, "tree", "lo")
                .mapInArrow(added, "tree int, lo int, s binary").collect())  # † the chosen splits
        found: dict[int, list] = {}
        for r in sorted(rows, key=lambda r: (r.tree, r.lo)):
            found.setdefault(r.tree, []).append(pickle.loads(r.s))
        for t in active:
            totals = np.concatenate([f[0] for f in found[t]])
            tree = forest[t]
            tree.stats = totals if tree.stats is None else np.concatenate([tree.stats, totals])
            first, tree.open = tree.open, len(tree.left)
            if level == depth:
                continue
            feature, at, gain = (np.concatenate([f[1][i] for f in found[t]]) for i in range(3))
            inner = np.flatnonzero(feature >= 0)
            tree.left[first + inner] = tree.open + 2 * np.arange(len(inner))
            tree.feature[first + inner] = choice[t][inner, feature[inner]]
            tree.bin[first + inner], tree.gain[first + inner] = at[inner], gain[inner]
            new = 2 * len(inner)
            tree.left = np.concatenate([tree.left, np.full(new, -1)])
            tree.feature, tree.bin = (np.concatenate([a, np.zeros(new, np.int64)]) for a in (tree.feature, tree.bin))
            tree.gain = np.concatenate([tree.gain, np.full(new, -1.0)])
    return forest


def _merged(tree: _Tree, prediction) -> None:
    """Two leaves of a node with the same prediction become one."""
    for i in range(len(tree.left) - 1, -1, -1):
        child = tree.left[i]
        if child >= 0 and tree.left[child] < 0 and tree.left[child + 1] < 0 and prediction[child] == prediction[child + 1]:
            tree.left[i], tree.gain[i] = -1, -1.0


def _node_rows(forest, thresholds, weights):
    for t, tree in enumerate(forest):
        raw = tree.stats.sum(axis=1) if weights is not None else tree.stats[:, 0]
        stats = tree.stats * np.asarray(weights) if weights is not None else tree.stats
        total = np.maximum(stats.sum(axis=1) if weights is not None else raw, 1e-300)
        if weights is not None:
            prediction, impurity = stats.argmax(axis=1).astype(float), 1.0 - ((stats / total[:, None]) ** 2).sum(axis=1)
        else:
            prediction = stats[:, 1] / total
            impurity = np.maximum(stats[:, 2] / total - prediction ** 2, 0.0)
        _merged(tree, prediction)
        reached, number = [0], {}
        for i in reached:  # by levels, so that a child comes after its node
            number[i] = len(number)
            if tree.left[i] >= 0:
                reached += [int(tree.left[i]), int(tree.left[i]) + 1]
        for i in reached:
            inner = tree.left[i] >= 0
            f = int(tree.feature[i])
            split = (f, [thresholds[f][tree.bin[i]]], -1) if inner else (-1, [], -1)
            yield (t, (number[i], float(prediction[i]), float(impurity[i]), stats[i].tolist(), int(round(raw[i])), float(tree.gain[i]),
                       number[int(tree.left[i])] if inner else -1, number[int(tree.left[i]) + 1] if inner else -1, split))


def fit_forest(estimator, df: DataFrame, cols, y: str, classes: int = 0, weights=None):
    """The model that ``estimator`` (a random forest of Spark ML on a column ``features``)
    describes, fitted to all rows of ``df``.  With ``classes``, ``y`` is a class number and
    ``weights`` has the weight of a row per class."""
    spark, cols = df.sparkSession, list(cols)
    ship_package(spark)
    if classes and weights is None:
        weights = np.ones(classes)
    thresholds = _thresholds(df, cols, y, weights)
    cores = spark.sparkContext.defaultParallelism
    blocks = cut_lineage(_binned(df, cols, y, thresholds))
    n = blocks.agg(F.sum(F.length("y"))).first()[0] // 8  # † decides the number of tasks
    held = blocks.repartition(max(cores, -(-n // PART_ROWS))).persist(StorageLevel.MEMORY_AND_DISK)
    trees, tried = estimator.getNumTrees(), estimator.getFeatureSubsetStrategy()
    if tried == "auto":
        tried = "all" if trees == 1 else "sqrt" if classes else "onethird"
    tried = {"all": len(cols), "sqrt": int(np.ceil(np.sqrt(len(cols)))), "onethird": int(np.ceil(len(cols) / 3))}[tried]
    try:
        forest = grow(held, len(cols), trees, estimator.getMaxDepth(), tried,
                      estimator.getMinInstancesPerNode(), estimator.getSeed(), classes, weights, estimator.getBootstrap(), cores)
    finally:
        held.unpersist()
    # a model of the same settings over a few rows, saved: its trees are replaced
    weighted = [estimator.getWeightCol()] if estimator.isDefined("weightCol") else []
    few = [(Vectors.dense([0.0] * len(cols)), float(i), *[1.0] * len(weighted)) for i in range(max(classes, 2))]
    path = stage_path(spark, "forest-" + uuid.uuid4().hex)
    model = estimator.fit(spark.createDataFrame(few, ["features", estimator.getLabelCol(), *weighted]))
    model.write().save(path)
    spark.createDataFrame(list(_node_rows(forest, thresholds, weights)), _NODE).coalesce(1).write.mode("overwrite").parquet(f"{path}/data")
    model = type(model).load(path)
    delete_path(spark, path)
    return model
