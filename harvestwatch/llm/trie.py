"""Prefix trie of conversations with a balanced rollup (operator 13).

Conversations that begin with the same turns share the nodes of these turns.  A
node is known by a 128-bit sum of hashes of (position, role, text) over its turns,
and named by its smallest member and its depth, which no two nodes share.

The sums over subtrees come from a centroid decomposition of the parent edges.  The
centroid of a component is its deepest node whose part of the component weighs more
than half; without it the component falls into the parts below its children and the
part above.  The total of the part below the centroid is added to the nodes on the
way from the centroid to the component's top, whose weights shrink by what left, and
every part is split on in the same way.  Each pair of a node and one below it meets
in just one such step, and weights halve, so a conversation of any length takes a
logarithmic number of rounds.

Scale: turns are numbered, and prefixes summed, in slices of a range partitioning by
(conversation, turn), with the sums of earlier slices carried over, so no conversation
sits in one task.  A node weighs the turns at or below it, which is a plain sum over its
members.  Subtrees of at most ``LIMIT`` turns are solved whole inside tasks, many to a
batch; their totals go to their parents.  The few nodes above them are split by rounds
of joins, all components at once, until no component has more than ``LIMIT`` nodes, and
the rest is solved inside tasks again.  Children of the parents of more than a
thousandth of all nodes (fewer than 1,000) find these by broadcast, the others by a
shuffle.  A node's list of ends is hashed from sorted pieces in one stream, as the hash
of a whole list asks for; it is never held.

Defined results: null roles and texts are empty; turns order by turn (null first), then
role, then the MD5 of the text, so ties and repeated rows have one order; rows with a
null ``conv_id`` belong to no conversation; ``%`` has the sign of its left side, as in
SQL; a conversation without turns ends at the root; an empty table has no root and no
rows; extra columns are not read.  Equality of prefixes is that of 128-bit hashes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import cut_lineage, prepare, table

HEADS, FAMILY = 9, 5  # heads have fewer turns than HEADS; FAMILY ids in a row share one
LIMIT = 2048  # nodes of a component, and turns of a subtree, that a task solves whole
ROWS_AT_ONCE = 20_000
IDS_PER_PIECE = 4096
BLOCK = 4096  # depths of a conversation that are searched together
VALUES = ("n_leaves", "saved_tokens")


# -- prefixes -------------------------------------------------------------------

def running(df: DataFrame, key: str, order: list[str], sums: list[str]) -> DataFrame:
    """Add ``rank`` (from 1) within ``key`` in the given order, replace ``sums`` by
    their running sums, and add ``slice``, which with the key spreads a large key."""
    placed = cut_lineage(df.repartitionByRange(key, *order).withColumn("slice", F.spark_partition_id()))
    local = Window.partitionBy("slice", key).orderBy(*order)
    upto = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = placed.select(*[c for c in placed.columns if c not in sums], F.row_number().over(local).cast("long").alias("rank"),
                            *[F.sum(c).over(upto).alias(c) for c in sums])
    earlier = Window.partitionBy(key).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    names = ["rank", *sums]
    carried = placed.groupBy(key, "slice").agg(F.count("*").alias("rank"), *[F.sum(c).alias(c) for c in sums]).select(
        F.col(key).alias("__key"), F.col("slice").alias("__slice"),
        *[F.sum(c).over(earlier).alias(f"__{c}") for c in names]).filter("__rank IS NOT NULL")
    joined = counted.join(F.broadcast(carried),  # at most one key goes on into a slice: fewer rows than slices
                          (F.col(key) == F.col("__key")) & (F.col("slice") == F.col("__slice")), "left")
    return joined.select(*[c for c in counted.columns if c not in names],
                         *[(F.col(c) + F.coalesce(f"__{c}", F.lit(0))).alias(c) for c in names])


def head_size(conv_id: Column) -> Column:
    return F.pmod(F.crc32(conv_id.cast("string")), F.lit(HEADS)).cast("long")


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, n, role, digest, bytes): the turns of every rebuilt conversation by
    position from 1, and one row of position 0; ``n`` is the number of its turns."""
    rows = turns.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.md5(F.coalesce("text", F.lit(""))).alias("digest"),
        F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("bytes"))
    own = cut_lineage(running(rows, "conv_id", ["turn", "role", "digest"], []))
    by_slice = own.groupBy("conv_id", "slice").agg(F.max("rank").alias("n"))
    sizes = cut_lineage(by_slice.groupBy("conv_id").agg(F.max("n").alias("n")).withColumns({
        "h": head_size(F.col("conv_id")), "base": F.col("conv_id") - F.col("conv_id") % FAMILY}))
    bases = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    taken = F.least(F.col("h"), F.coalesce("n_base", F.lit(0)))
    convs = sizes.join(bases, "base", "left").select(
        "conv_id", "base", "h", taken.alias("taken"), (taken + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n"))
    convs = cut_lineage(convs)
    turn = ["role", "digest", "bytes"]
    head = own.filter(F.col("rank") < HEADS).select(F.col("conv_id").alias("base"), "rank", *turn).join(
        convs, "base").filter("rank <= taken").select("conv_id", F.col("rank").alias("pos"), "n", *turn)
    pieces = own.select("conv_id", "slice").distinct().join(convs, "conv_id")
    tail = own.join(pieces, ["conv_id", "slice"]).filter("rank > h").select(
        "conv_id", (F.col("taken") + F.col("rank") - F.col("h")).alias("pos"), "n", *turn)
    root = convs.select("conv_id", F.lit(0).cast("long").alias("pos"), "n", F.lit("").alias("role"),
                        F.lit("").alias("digest"), F.lit(0).cast("long").alias("bytes"))
    return root.unionByName(head).unionByName(tail)


def prefixes(rows: DataFrame) -> DataFrame:
    """(conv_id, slice, pos, n, bytes, k1, k2, p1, p2): each turn with the key of its
    prefix and of the prefix before it."""
    turn = [F.when(F.col("pos") == 0, F.lit(0)).otherwise(F.xxhash64(F.lit(i), "pos", "role", "digest")).cast("decimal(20,0)")
            for i in (1, 2)]
    rows = rows.withColumns({"v1": turn[0], "v2": turn[1], "s1": turn[0], "s2": turn[1]}).drop("role", "digest")
    summed = running(rows, "conv_id", ["pos"], ["s1", "s2"])
    at, before = F.col("pos"), F.col("pos") - 1
    return summed.select(
        "conv_id", "slice", "pos", "n", "bytes",
        F.xxhash64(F.lit(3), at, F.col("s1")).alias("k1"), F.xxhash64(F.lit(4), at, F.col("s2")).alias("k2"),
        F.xxhash64(F.lit(3), before, (F.col("s1") - F.col("v1")).cast(summed.schema["s1"].dataType)).alias("p1"),
        F.xxhash64(F.lit(4), before, (F.col("s2") - F.col("v2")).cast(summed.schema["s2"].dataType)).alias("p2"))


def nodes_of(rows: DataFrame) -> DataFrame:
    """The nodes: named by (conv_id, depth), with parent, counts and own values."""
    nodes = cut_lineage(rows.groupBy("k1", "k2").agg(
        F.min("conv_id").alias("conv_id"), F.min("pos").alias("depth"), F.count("*").alias("n_convs"),
        F.min("bytes").alias("bytes"), F.min("p1").alias("p1"), F.min("p2").alias("p2"),
        F.sum(F.col("n") - F.col("pos") + 1).alias("weight")))
    below = nodes.filter("depth > 0")
    children = below.groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("n_children"))
    nodes = cut_lineage(nodes.join(children, ["k1", "k2"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))))
    below, n = nodes.filter("depth > 0"), nodes.count()
    parents = nodes.filter("n_children > 0").select(
        F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    large = F.broadcast(parents.filter(F.col("n_children") * 1000 > n).drop("n_children"))  # fewer than 1,000
    other = parents.filter(F.col("n_children") * 1000 <= n).drop("n_children")
    named = below.join(large, ["p1", "p2"]).unionByName(
        below.join(large, ["p1", "p2"], "left_anti").join(other, ["p1", "p2"])).unionByName(
        nodes.filter("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long")))
    return named.select("k1", "k2", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "weight",
                        (F.col("n_children") == 0).cast("long").alias("n_leaves"),
                        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens"))


# -- rollup ---------------------------------------------------------------------

def subtree_sums(parent: np.ndarray, depth: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of ``values`` (a row per node) over subtrees by centroid decomposition, for
    all trees of a forest at once; ``parent`` is -1 at the tops."""
    n = len(parent)
    order = np.argsort(depth, kind="stable")
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    up = np.where(parent[order] >= 0, place[parent[order]], -1)
    x = values[order]
    cuts = np.append(np.flatnonzero(np.diff(depth[order], prepend=-1)), n)
    levels = [np.arange(i, j) for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
    top, size = np.arange(n), np.ones(n, np.int64)  # a component is named by its top
    for level in levels:
        inner = level[up[level] >= 0]
        top[inner] = top[up[inner]]
    for level in levels[:0:-1]:
        inner = level[up[level] >= 0]
        np.add.at(size, up[inner], size[inner])
    out, alive = np.zeros_like(x), np.ones(n, bool)
    while alive.any():
        heavy = np.flatnonzero(alive & (2 * size > size[top]))
        chosen = np.full(n, -1)
        np.maximum.at(chosen, top[heavy], heavy)  # by depth, so the last is the deepest
        centroids = chosen[chosen >= 0]
        is_centroid = np.zeros(n, bool)
        is_centroid[centroids] = True
        new, below = top.copy(), is_centroid.copy()
        for level in levels[1:]:
            v = level[alive[level] & (up[level] >= 0)]
            v = v[(top[up[v]] == top[v]) & below[up[v]] & ~is_centroid[v]]
            below[v] = True
            new[v] = np.where(is_centroid[up[v]], v, new[up[v]])
        total = np.zeros_like(x)
        inside = np.flatnonzero(below & alive)
        np.add.at(total, chosen[top[inside]], x[inside])
        out[centroids] += total[centroids]
        at, more, gone = centroids, total[centroids], size[centroids]
        while len(at):  # from the centroids to the tops of their components
            inner = at != top[at]
            at, more, gone = up[at[inner]], more[inner], gone[inner]
            out[at] += more
            size[at] -= gone
        alive[centroids] = False
        top = new
    return out[place]


def solved(df: DataFrame) -> DataFrame:
    """Subtree sums within components (``top_conv``, ``top_depth``), each of which a task
    can hold; to them ``acc_*``, what parts that were split off have added, comes on top."""
    names = ["conv_id", "depth", "parent_conv_id", "top_conv", "top_depth", *VALUES, *[f"acc_{c}" for c in VALUES]]

    def work(rows: pa.Table) -> pa.RecordBatch:
        conv, depth, up, *_ = (rows.column(i).combine_chunks().fill_null(-1).to_numpy(zero_copy_only=False) for i in range(3))
        at = {k: i for i, k in enumerate(zip(conv.tolist(), depth.tolist(), strict=True))}
        is_top = (rows.column(3).to_numpy() == conv) & (rows.column(4).to_numpy() == depth)
        parent = np.array([-1 if t else at[p, d - 1] for t, p, d in zip(is_top.tolist(), up.tolist(), depth.tolist(), strict=True)], np.int64)
        values = np.stack([rows.column(i).to_numpy() for i in (5, 6)], axis=1)
        sums = subtree_sums(parent, depth, values) + np.stack([rows.column(i).to_numpy() for i in (7, 8)], axis=1)
        return pa.RecordBatch.from_arrays([rows.column(0).combine_chunks(), rows.column(1).combine_chunks(), pa.array(sums[:, 0]), pa.array(sums[:, 1])],
                                          names=["conv_id", "depth", *VALUES])

    def run(batches):
        held, count = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            count += batch.num_rows
            if count < ROWS_AT_ONCE:
                continue
            rows = pa.Table.from_batches(held)  # all but the last component, which may go on
            a, b = rows.column(3).to_numpy(), rows.column(4).to_numpy()
            last = int(np.flatnonzero((a != a[-1]) | (b != b[-1]))[-1]) + 1 if (a[0], b[0]) != (a[-1], b[-1]) else 0
            if last:
                yield work(rows.slice(0, last))
                held = rows.slice(last).to_batches()
                count = rows.num_rows - last
        if held:
            yield work(pa.Table.from_batches(held))

    key = ["top_conv", "top_depth"]
    return df.select(*names).repartition(*key).sortWithinPartitions(*key).mapInArrow(
        run, "conv_id long, depth long, n_leaves long, saved_tokens long")


def split_rounds(rows: DataFrame, state: DataFrame) -> DataFrame:
    """Subtree sums of connected nodes (columns of ``solved`` and ``weight``), one
    component named by its top: rounds of centroids while a component has more than
    ``LIMIT`` nodes, then the components inside tasks."""
    state = cut_lineage(state)
    if state.count() <= LIMIT:
        return solved(state)
    # the ways of the members that name a node: (member, pos) -> the node there, and the one above it
    deepest = state.groupBy("conv_id").agg(F.max("depth").alias("deepest"))
    pieces = rows.select("conv_id", "slice").distinct().join(deepest, "conv_id")
    ways = cut_lineage(rows.join(pieces, ["conv_id", "slice"]).filter("pos <= deepest").select(
        F.col("conv_id").alias("member"), "pos", "k1", "k2").join(
        state.select("k1", "k2", F.col("conv_id").alias("at"), F.col("parent_conv_id").alias("above")), ["k1", "k2"]).select(
        "member", "pos", F.floor(F.col("pos") / BLOCK).alias("block"), "at", "above"))
    comp, done = ["top_conv", "top_depth"], []
    while True:
        sizes = state.groupBy(*comp).agg(F.count("*").alias("n"), F.max("weight").alias("whole"))
        large = cut_lineage(sizes.filter(F.col("n") > LIMIT).drop("n"))
        if large.isEmpty():
            break
        done.append(solved(state.join(large, comp, "left_anti")))
        active = state.join(large, comp)
        centroids = cut_lineage(active.filter(2 * F.col("weight") > F.col("whole")).groupBy(*comp).agg(
            F.max(F.struct("depth", "conv_id", "weight")).alias("c")).select(
            *comp, F.col("c.conv_id").alias("c_conv"), F.col("c.depth").alias("c_depth"), F.col("c.weight").alias("c_weight")))
        active = active.drop("whole").join(centroids, comp)
        # the child of the centroid that each deeper node lies below, found by its member
        children = active.filter("depth > c_depth").select("conv_id", *comp, "c_conv", "c_depth").distinct().join(
            ways, (F.col("conv_id") == F.col("member")) & (F.col("pos") == F.col("c_depth") + 1) & (F.col("above") == F.col("c_conv"))
        ).select("conv_id", *comp, F.col("at").alias("child"))
        active = cut_lineage(active.join(children, ["conv_id", *comp], "left").withColumn(
            "is_c", (F.col("conv_id") == F.col("c_conv")) & (F.col("depth") == F.col("c_depth"))).withColumn(
            "child", F.when(F.col("depth") > F.col("c_depth"), F.col("child"))))
        totals = cut_lineage(active.filter(F.col("is_c") | F.col("child").isNotNull()).groupBy(*comp).agg(
            *[F.sum(c).alias(f"t_{c}") for c in VALUES]))
        # the nodes between a centroid and the top of its component, that included
        steps = centroids.filter("c_depth > top_depth").withColumn("block", F.explode(F.sequence(
            F.floor(F.col("top_depth") / BLOCK), F.floor((F.col("c_depth") - 1) / BLOCK))))
        way = steps.join(ways.withColumnRenamed("member", "c_conv"), ["c_conv", "block"]).filter(
            "pos >= top_depth AND pos < c_depth").select(
            F.col("at").alias("conv_id"), F.col("pos").alias("depth"), *comp, F.lit(True).alias("on_way"))
        active = active.join(way, ["conv_id", "depth", *comp], "left").join(totals, comp)
        gains = F.col("is_c") | F.col("on_way").isNotNull()
        active = active.select(
            "k1", "k2", "conv_id", "depth", "parent_conv_id", *VALUES, "is_c",
            (F.col("weight") - F.when(F.col("on_way"), F.col("c_weight")).otherwise(0)).alias("weight"),
            *[(F.col(f"acc_{c}") + F.when(gains, F.col(f"t_{c}")).otherwise(0)).alias(f"acc_{c}") for c in VALUES],
            F.coalesce("child", "top_conv").alias("top_conv"),
            F.when(F.col("child").isNotNull(), F.col("c_depth") + 1).otherwise(F.col("top_depth")).alias("top_depth"))
        active = cut_lineage(active)
        done.append(active.filter("is_c").select("conv_id", "depth", *[F.col(f"acc_{c}").alias(c) for c in VALUES]))
        state = active.filter(~F.col("is_c")).drop("is_c")
    done.append(solved(state))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def rollup(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """(conv_id, depth) with the ``VALUES`` summed over each node's subtree."""
    none = [F.lit(0).cast("long").alias(f"acc_{c}") for c in VALUES]
    light, upper = nodes.filter(F.col("weight") <= LIMIT), nodes.filter(F.col("weight") > LIMIT)
    # the highest light node on the way of each member; a light node has at most LIMIT members
    keys = light.select("k1", "k2", F.col("conv_id").alias("at"))
    tops = rows.select("k1", "k2", "conv_id", "pos").join(keys, ["k1", "k2"]).groupBy("conv_id").agg(
        F.min(F.struct(F.col("pos").alias("top_depth"), F.col("at").alias("top_conv"))).alias("t")).select("conv_id", "t.*")
    tops = cut_lineage(light.join(tops, "conv_id").select(
        "conv_id", "depth", "parent_conv_id", "top_conv", "top_depth", *VALUES, *none))
    low = cut_lineage(solved(tops))
    totals = tops.filter("conv_id = top_conv AND depth = top_depth AND depth > 0").select("conv_id", "depth", "parent_conv_id").join(
        low, ["conv_id", "depth"]).groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(
        *[F.sum(c).alias(f"t_{c}") for c in VALUES])
    root = nodes.agg(F.min("conv_id")).first()[0]  # the root has every conversation
    upper = upper.join(totals, ["conv_id", "depth"], "left").select(
        "k1", "k2", "conv_id", "depth", "parent_conv_id", "weight",
        *[(F.col(c) + F.coalesce(f"t_{c}", F.lit(0))).alias(c) for c in VALUES], *none,
        F.lit(root).cast("long").alias("top_conv"), F.lit(0).cast("long").alias("top_depth"))
    return low.unionByName(split_rounds(rows, upper))


# -- ends -----------------------------------------------------------------------

def end_hashes(rows: DataFrame) -> DataFrame:
    """(k1, k2, ends_sha256) of the nodes where a conversation ends: the digest of their
    ids in order.  Ids are joined to pieces in slices of a range partitioning, and the
    pieces of a node are hashed one after the other."""
    order = ["k1", "k2", "conv_id"]

    def runs(batch):
        k1, k2 = (batch.column(i).to_numpy() for i in (0, 1))
        cuts = np.flatnonzero((np.diff(k1) != 0) | (np.diff(k2) != 0)) + 1
        for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(k1)], strict=True):
            yield (int(k1[i]), int(k2[i])), i, j

    def pieces(batches):
        for batch in batches:
            made = []
            ids = batch.column(2).to_pylist()
            for key, i, j in runs(batch) if batch.num_rows else ():
                for at in range(i, j, IDS_PER_PIECE):
                    part = ids[at:min(j, at + IDS_PER_PIECE)]
                    made.append((*key, part[0], ",".join(map(str, part))))
            if made:
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array([m[i] for m in made], pa.int64()) for i in range(3)], pa.array([m[3] for m in made], pa.string())],
                    names=["k1", "k2", "first", "ids"])

    def hashed(batches):
        held, digest = None, None

        def made(rows):
            return pa.RecordBatch.from_arrays(
                [*[pa.array([r[0][i] for r in rows], pa.int64()) for i in (0, 1)], pa.array([r[1].hexdigest() for r in rows])],
                names=["k1", "k2", "ends_sha256"])

        for batch in batches:
            done = []
            ids = batch.column(3).to_pylist()
            for key, i, j in runs(batch) if batch.num_rows else ():
                if key != held:
                    if held is not None:
                        done.append((held, digest))
                    held, digest = key, hashlib.sha256()
                    digest.update(",".join(ids[i:j]).encode())
                else:
                    digest.update(("," + ",".join(ids[i:j])).encode())
            if done:
                yield made(done)
        if held is not None:
            yield made([(held, digest)])

    ends = rows.filter("pos = n").select(*order)
    made = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        pieces, "k1 long, k2 long, first long, ids string")
    return made.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "first").mapInArrow(
        hashed, "k1 long, k2 long, ends_sha256 string")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations."""
    prepare(turns.sparkSession)
    rows = cut_lineage(prefixes(rebuilt(turns)))
    nodes = cut_lineage(nodes_of(rows))
    return nodes.drop(*VALUES).join(rollup(rows, nodes), ["conv_id", "depth"]).join(end_hashes(rows), ["k1", "k2"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", *VALUES,
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all rebuilt conversations."""
    return prefix_trie(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))


OP13_SQL = r"""
WITH crc AS (SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, k:
             CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b::BIGINT)) AS t),
own AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS r
        FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT conv_id, count(*) AS n FROM own GROUP BY conv_id),
heads AS (SELECT conv_id, n, conv_id - conv_id % 5 AS base,
                 xor(list_reduce(list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
                     lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295::BIGINT), 4294967295) % 9 AS h
          FROM ids, crc),
convs AS (SELECT c.conv_id, c.base, c.h, least(c.h, coalesce(b.n, 0)) AS taken FROM heads c LEFT JOIN ids b ON b.conv_id = c.base),
turns AS (SELECT c.conv_id, o.r AS pos, role, text FROM convs c JOIN own o ON o.conv_id = c.base AND o.r <= c.taken
          UNION ALL
          SELECT c.conv_id, c.taken + o.r - c.h, role, text FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.r > c.h
          UNION ALL SELECT conv_id, 0, '', '' FROM convs),
ways AS (SELECT conv_id, pos, strlen(text) AS bytes, count(*) OVER (PARTITION BY conv_id) - 1 AS n,
                string_agg(md5(role) || md5(text), '') OVER (PARTITION BY conv_id ORDER BY pos) AS k FROM turns),
nodes AS (SELECT k, min(conv_id) AS conv_id, min(pos) AS depth, count(*) AS n_convs, (count(*) - 1) * min(bytes) AS own,
                 sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (pos = n), '')) AS ends_sha256
          FROM ways GROUP BY k),
links AS (SELECT c.k, c.conv_id, c.depth, p.k AS p, p.conv_id AS parent_conv_id FROM nodes c
          LEFT JOIN ways w ON w.conv_id = c.conv_id AND w.pos = c.depth - 1 LEFT JOIN nodes p ON p.k = w.k),
kids AS (SELECT p AS k, count(*) AS n_children FROM links WHERE p IS NOT NULL GROUP BY p),
sums AS (SELECT w.k, count(*) FILTER (kids.k IS NULL) AS n_leaves, sum(v.own) AS saved_tokens
         FROM nodes v JOIN ways w ON w.conv_id = v.conv_id AND w.pos <= v.depth LEFT JOIN kids ON kids.k = v.k GROUP BY w.k)
SELECT nodes.conv_id, nodes.depth::BIGINT AS depth, links.parent_conv_id, n_convs::BIGINT AS n_convs,
       coalesce(n_children, 0)::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, ends_sha256
FROM nodes JOIN links USING (k) LEFT JOIN kids USING (k) JOIN sums USING (k)
"""
