"""Embedding near-duplicates by a forest of random-projection trees (operator 10).

Trees are fitted on a bounded sample: each node splits at the median of its
sample along a random direction, and rows within ``SPILL`` quantiles of the
median go to both sides.  All rows are indexed in all trees.  The number of
trees follows from a target: on the sample, partners at exactly the threshold
are made up and the share that meets in a tree is measured; trees are added
until all but ``1 - TARGET`` of such pairs meet somewhere.  Rows of one label
and leaf are compared in double precision; linked rows give one edge each to
their local component.  The components are then compared in full once, which
counts the links, also those between rows that shared no leaf.

Scale: equal vectors of a label are one node with a count, so a hot vector is
one row; leaves and components over ``LIMIT`` are dealt out in pairs of blocks;
only stars of edges and sums leave a task.  The driver sees the sample alone
(at most about ``MAX_SAMPLE`` vectors), the workers the trees fitted to it.

Defined results: a null label, or a vector that is null, empty, zero or holds a
null or non-finite number, links with nothing (0 links, its own component);
vectors of different length never link; rows that repeat a ``vec_id`` count as
rows; a null ``vec_id`` is never a component's name unless all are null; extra
columns are dropped; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import cut_lineage, prepare, table
from ._groups import Labels, by_group, components, in_blocks, stars

THRESHOLD, TARGET = 0.93, 0.9999
MAX_SAMPLE, MIN_LEAF, LEAF, SPILL, LIMIT, MOST_TREES = 50_000, 16, 512, 0.1, 2048, 64


class Tree:
    """Splits in a flat list: (direction, low, high, left, right) or a leaf number."""

    def __init__(self, sample: np.ndarray, depth: int, rng: np.random.Generator):
        self.nodes: list = []
        self.leaves = 0
        self._grow(sample, depth, rng)

    def _grow(self, rows: np.ndarray, depth: int, rng) -> int:
        at = len(self.nodes)
        self.nodes.append(None)
        if depth == 0 or len(rows) < 2 * MIN_LEAF:
            self.nodes[at] = self.leaves
            self.leaves += 1
            return at
        direction = rng.standard_normal(rows.shape[1])
        along = rows @ direction
        low, mid, high = np.quantile(along, [0.5 - SPILL, 0.5, 0.5 + SPILL])
        left = self._grow(rows[along <= mid], depth - 1, rng)
        right = self._grow(rows[along > mid], depth - 1, rng)
        self.nodes[at] = (direction, low, high, left, right)
        return at

    def place(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) for every leaf that a row reaches."""
        at, leaf, todo = [], [], [(0, np.arange(len(rows)))]
        while todo:
            k, some = todo.pop()
            node = self.nodes[k]
            if isinstance(node, int):
                at.append(some)
                leaf.append(np.full(len(some), node, np.int64))
            elif len(some):
                along = rows[some] @ node[0]
                todo += [(node[3], some[along <= node[2]]), (node[4], some[along >= node[1]])]
        return np.concatenate(at), np.concatenate(leaf)


def unit(vectors: np.ndarray) -> np.ndarray:
    # a power of two is taken out first, so that squares neither overflow nor vanish
    _, power = np.frexp(np.abs(vectors).max(axis=1, keepdims=True, initial=0.0))
    vectors = np.ldexp(vectors, -power)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def fit(sample: np.ndarray, largest: int, threshold: float, seed: int = 1) -> list[Tree]:
    """Trees for rows whose most frequent label has ``largest`` rows."""
    rng = np.random.default_rng(seed)
    depth = max(0, math.ceil(math.log2(max(1, largest) / LEAF)))
    probe = sample[rng.permutation(len(sample))[:2000]]
    away = rng.standard_normal(probe.shape)
    away = unit(away - (away * probe).sum(axis=1, keepdims=True) * probe + 1e-12)
    partner = threshold * probe + math.sqrt(1 - threshold * threshold) * away
    trees, missed = [], np.ones(len(probe), bool)
    meet = []
    while len(trees) < MOST_TREES:
        tree = Tree(sample, depth, rng)
        trees.append(tree)
        a, la = tree.place(probe)
        b, lb = tree.place(partner)
        both = np.intersect1d(a * tree.leaves + la, b * tree.leaves + lb)
        met = np.zeros(len(probe), bool)
        met[both // tree.leaves] = True
        missed &= ~met
        meet.append(met.mean())
        if np.prod([1 - m for m in meet]) <= 1 - TARGET and missed.mean() <= max(1 - TARGET, 0):
            break
    return trees


def _vectors(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(n, -1) if n else flat.reshape(0, 0)


def _linked(group: pa.Table, threshold: float):
    """Ids, blocks and a function giving the rows after row i that it links with."""
    ids, side = group["node"].to_numpy(), group["side"].to_numpy()
    rows = unit(_vectors(group["v"]))
    a, b = group["block_a"][0].as_py(), group["block_b"][0].as_py()

    def cosines():
        for i in range(0, len(rows), 256):
            yield i, rows[i:i + 256] @ rows.T >= threshold

    return ids, side, a, b, cosines


def _star_edges(group: pa.Table) -> pa.RecordBatch:
    ids, _, _, _, cosines = _linked(group, THRESHOLD)
    labels = Labels(len(ids))
    for first, hit in cosines():
        for k in np.flatnonzero(hit.sum(axis=1) > 1):
            labels.join(first + k, np.flatnonzero(hit[k]))
    return stars(ids, labels)


def _link_counts(group: pa.Table) -> pa.RecordBatch:
    """Per row the links to rows of the other block (of the same, if it is one)."""
    ids, side, a, b, cosines = _linked(group, THRESHOLD)
    weight, links = group["copies"].to_numpy(), np.zeros(len(ids), np.int64)
    for first, hit in cosines():
        own = side[first:first + len(hit)]
        np.put_along_axis(hit, (first + np.arange(len(hit)))[:, None], False, axis=1)
        if a != b:
            hit &= own[:, None] != side[None, :]
        links[first:first + len(hit)] = hit @ weight
    return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(links)], names=["node", "links"])


def near_duplicates(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` of every row."""
    spark = df.sparkSession
    prepare(spark)
    v = F.col("v")
    ok = F.col("label").isNotNull() & v.isNotNull() & (F.size(v) > 0) & F.forall(
        v, lambda x: x.isNotNull() & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = df.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("v"),
                     F.col(label).alias("label"))
    rows = cut_lineage(rows.withColumn("node", F.when(F.coalesce(ok, F.lit(False)), F.xxhash64("label", "v"))))
    nodes = cut_lineage(rows.filter(F.col("node").isNotNull()).groupBy("node", "label", "v").agg(
        F.count("*").alias("copies"), F.min("vec_id").alias("first")).withColumn("dims", F.size("v")))
    kinds = nodes.groupBy("dims").agg(F.count("*").alias("n")).collect()
    forests = {}
    for kind in sorted(kinds):
        share = min(1.0, MAX_SAMPLE / kind["n"])
        own = nodes.filter(F.col("dims") == kind["dims"])
        largest = own.groupBy("label").count().agg(F.max("count")).first()[0]
        sample = own.filter(F.pmod(F.xxhash64("node"), F.lit(1 << 20)) < math.ceil(share * (1 << 20))).select("v")
        forests[kind["dims"]] = fit(unit(_vectors(sample.toArrow()["v"])), largest, THRESHOLD)
    shared = spark.sparkContext.broadcast(forests)  # bounded by the sample

    def place(batches):
        for batch in batches:
            dims = batch.column("dims").to_numpy()
            for d in np.unique(dims):
                own = batch.take(pa.array(np.flatnonzero(dims == d)))
                found = unit(_vectors(own.column("v")))
                for t, tree in enumerate(shared.value[int(d)]):
                    at, leaf = tree.place(found)
                    got = own.take(pa.array(at))
                    yield pa.RecordBatch.from_arrays(
                        [got.column("label_key"), got.column("dims"), pa.array(leaf + (t << 32)), got.column("node"),
                         got.column("v")], names=["label_key", "dims", "leaf", "node", "v"])

    keyed = nodes.select(F.xxhash64("label").alias("label_key"), "dims", "node", "v")
    leaves = keyed.mapInArrow(place, "label_key long, dims int, leaf long, node long, v array<double>")
    keys = ["label_key", "dims", "leaf"]
    edges = by_group(in_blocks(cut_lineage(leaves), keys, "node", LIMIT), [*keys, "block_a", "block_b"], _star_edges,
                     "a long, b long")
    found = cut_lineage(components(edges))
    members = nodes.join(found, nodes["node"] == found["id"]).select("component", "node", "v", "copies")
    counts = by_group(in_blocks(members, ["component"], "node", LIMIT), ["component", "block_a", "block_b"],
                      _link_counts, "node long, links long").groupBy("node").agg(F.sum("links").alias("links"))
    names = nodes.join(found, nodes["node"] == found["id"]).groupBy("component").agg(F.min("first").alias("name"))
    known = nodes.select("node", "copies", "first").join(
        found.withColumnRenamed("id", "node"), "node", "left").join(names, "component", "left").join(
        counts, "node", "left").select(
        F.col("node").alias("k"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"),
        F.coalesce("name", "first").alias("name"))
    return rows.join(known, rows["node"] == known["k"], "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("name", "vec_id").alias("component_id"),
        F.coalesce(F.coalesce("name", "vec_id") == F.col("vec_id"), F.lit(True)).alias("kept"))


def op10_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))


OP10_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, [x::DOUBLE FOR x IN embedding] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL),
p AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
      WHERE list_inner_product(a.e, b.e) / (sqrt(list_inner_product(a.e, a.e)) * sqrt(list_inner_product(b.e, b.e))) >= 0.93),
r AS (SELECT vec_id AS x, vec_id AS y FROM v UNION SELECT r.x, p.y FROM r JOIN p ON r.y = p.x),
c AS (SELECT x, min(y) AS c FROM r GROUP BY x),
l AS (SELECT x, count(*) AS n FROM p GROUP BY x)
SELECT e.vec_id, coalesce(l.n, 0)::BIGINT AS n_links, coalesce(c.c, e.vec_id) AS component_id,
       coalesce(c.c, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN c ON c.x = e.vec_id LEFT JOIN l ON l.x = e.vec_id
"""
