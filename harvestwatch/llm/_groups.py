"""Groups of rows worked on inside tasks: bounded blocks, stars, components.

The near-duplicate operators find candidate groups, compare rows inside them
with numpy, and hand on one edge per row (to the smallest row of its local
component), never the pairs.  A group over the limit is dealt out as pairs of
blocks, so no task holds more than two blocks of it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import cut_lineage


def in_blocks(df: DataFrame, keys: list[str], row_id: str, limit: int) -> DataFrame:
    """Add ``block_a``, ``block_b`` and ``side`` (the row's own block): groups of
    at most ``limit`` rows are one block; a larger one is cut into blocks by the
    row's id and each row goes to the pairs of its block with every block.
    Groups of one row are left out: they have nothing to be compared with."""
    sizes = df.groupBy(*keys).agg(F.count("*").alias("__m")).filter(F.col("__m") > 1)
    blocks = F.ceil(F.col("__m") / F.lit(limit)).cast("int")
    out = df.join(sizes, keys).withColumn("__nb", blocks).withColumn(
        "side", F.pmod(F.xxhash64(row_id, F.lit(7)), F.col("__nb")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("__nb") - 1))
    return out.withColumn("__other", other).withColumn("block_a", F.least("side", "__other")).withColumn(
        "block_b", F.greatest("side", "__other")).drop("__m", "__nb", "__other")


def by_group(df: DataFrame, keys: list[str], work: Callable[[pa.Table], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``work`` on the rows of each key, many keys to a task; a key's rows must be
    few enough for one task."""
    at = [df.columns.index(k) for k in keys]

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in at]
            edge = np.zeros(batch.num_rows, bool)
            for c in columns:
                edge[1:] |= c[1:] != c[:-1]
            cuts = [0, *np.flatnonzero(edge).tolist(), batch.num_rows]
            for k, (i, j) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                part = batch.slice(i, j - i)
                if held and k == 0 and all(held[-1].column(c)[held[-1].num_rows - 1] == part.column(c)[0] for c in at):
                    held.append(part)
                    continue
                if held:
                    yield pa.Table.from_batches(held)
                held = [part]
        if held:
            yield pa.Table.from_batches(held)

    def run(batches):
        waiting, rows = [], 0
        for group in groups(batches):
            made = work(group)
            if made is not None and made.num_rows:
                waiting.append(made)
                rows += made.num_rows
                if rows > 20_000:
                    yield pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
                    waiting, rows = [], 0
        if waiting:
            yield pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


class Labels:
    """Local components of ``n`` rows, each named by its smallest row."""

    def __init__(self, n: int):
        self.of = np.arange(n)

    def join(self, i: int, others: np.ndarray) -> None:
        found = np.unique(np.append(self.of[others], self.of[i]))
        if len(found) > 1:
            self.of[np.isin(self.of, found[1:])] = found[0]


def stars(ids: np.ndarray, labels: Labels) -> pa.RecordBatch:
    """One edge (a, b) from each row to the smallest id of its component."""
    order = np.lexsort((ids, labels.of))
    of, sorted_ids = labels.of[order], ids[order]
    head = np.flatnonzero(np.diff(of, prepend=-1))
    b = np.repeat(sorted_ids[head], np.diff(np.append(head, len(of))))
    keep = sorted_ids != b
    return pa.RecordBatch.from_arrays([pa.array(sorted_ids[keep]), pa.array(b[keep])], names=["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id of the edges (a, b): the smallest id that
    links lead to.  Large and small stars in turn, each a few joins and sums on
    the edges; every round is written, and ends when a round changes nothing."""
    def small(e):
        low = e.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        joined = e.join(low, e["a"] == low["u"])
        return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").unionByName(
            low.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()

    def large(e):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        low = low.withColumn("m", F.least("u", "m"))
        return both.join(low, both["a"] == low["u"]).filter("b > a").select(
            F.col("b").alias("a"), F.col("m").alias("b")).distinct()

    def state(e):
        return e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    e = cut_lineage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter(
        "a != b").distinct())
    before = state(e)
    while True:
        e = cut_lineage(small(large(e)))
        now = state(e)
        if now == before:
            break
        before = now
    return e.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        e.select(F.col("b").alias("id"), F.col("b").alias("component"))).distinct()
