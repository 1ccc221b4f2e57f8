"""Sharding on a consistent-hash ring with bounded loads (operator 9, DataFrame
functions only).

Every shard owns virtual nodes on a ring of ``SLOTS`` places and may hold a
bounded number of rows.  A row goes to the first virtual node clockwise from the
hash of its key; where that shard is full it goes on clockwise to the next node
of a shard with room.  With loads bounded by the mean (``slack = 0``) all counts
are at most one apart, and only the overflow of a full shard leaves its place.

Scale: rows are counted per slot of the ring, and each slot is salted into as
many cells as its share of all rows asks for, so a key holding a third of the
rows spreads over a third of the ``CELLS``.  That histogram is bounded by ``CELLS
+ SLOTS`` whatever the input; the driver walks it once and says which ranks of
which cell go to which shard.  Rows get their rank within the cell, so no window
is larger than a cell (about one part in ``CELLS`` of all rows), and join that
plan, whose size is bounded likewise.  What the salt is made from is written
before it is used, so a redone task sees the same one.

Defined results: a null text has no bytes and size 1; null keys hash like one
key; repeated rows are placed one by one; an empty table gives no rows; extra
columns are dropped.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import cut_lineage, prepare, table

SLOTS, CELLS, NODES = 4096, 32768, 64


def ring(shards: int, nodes: int = NODES) -> list[tuple[int, int]]:
    """Virtual nodes (slot, shard) clockwise."""
    return sorted((zlib.crc32(f"shard {s} node {v}".encode()) % SLOTS, s) for s in range(shards) for v in range(nodes))


def owners(nodes: list[tuple[int, int]], room: list[int]) -> list[int]:
    """The shard of the first node with room, clockwise from each slot."""
    free = [(slot, s) for slot, s in nodes if room[s]]
    out, k = [], 0
    for slot in range(SLOTS):
        while k < len(free) and free[k][0] < slot:
            k += 1
        out.append(free[k % len(free)][1])
    return out


def bounds(n: int, shards: int, slack: float) -> list[int]:
    """The most rows each shard may hold; with no slack they sum to ``n``."""
    if not slack:
        return [n // shards + (s < n % shards) for s in range(shards)]
    return [-(-int(n * (1 + slack)) // shards) + 1] * shards


def plan(cells: list[tuple[int, int, int]], shards: int, slack: float = 0.0) -> list[tuple]:
    """Pieces (slot, salt, first rank, last rank, shard, slot in the shard of the
    first rank) for cells (slot, salt, rows): rounds in which every waiting cell
    goes to the next shard clockwise that had room, in ring order."""
    nodes, room = ring(shards), bounds(sum(c[2] for c in cells), shards, slack)
    held, waiting, out = [0] * shards, [(slot, salt, 0, n) for slot, salt, n in sorted(cells)], []
    while waiting:
        to, left = owners(nodes, room), []
        for slot, salt, first, n in waiting:
            s = to[slot]
            take = min(n, room[s])
            if take:
                out.append((slot, salt, first, first + take - 1, s, held[s]))
                room[s] -= take
                held[s] += take
            if take < n:
                left.append((slot, salt, first + take, n - take))
        waiting = left
    return out


def salted(numbered: DataFrame) -> DataFrame:
    """Add ``__salt``: rows (``__slot``, ``__row``) of a slot dealt to cells of like size."""
    sizes = [(r["__slot"], r["count"]) for r in numbered.groupBy("__slot").count().collect()]  # at most SLOTS rows
    total = sum(n for _, n in sizes)
    cells = numbered.sparkSession.createDataFrame(
        [(slot, -(-n * CELLS // total)) for slot, n in sizes], "c_slot int, c_cells int")
    joined = numbered.join(F.broadcast(cells), F.col("__slot") == F.col("c_slot"))
    return joined.withColumn("__salt", F.pmod(F.xxhash64("__row"), F.col("c_cells")).cast("int")).drop(
        "c_slot", "c_cells")


def assign(df: DataFrame, key: str, shards: int, slack: float = 0.0) -> DataFrame:
    """Add ``shard`` (int) and ``slot`` (long, gapless from 0 in each shard).
    The columns of ``df`` order the rows of a cell, so they should be narrow."""
    spark = df.sparkSession
    columns = df.columns
    numbered = cut_lineage(df.withColumn(
        "__slot", F.pmod(F.xxhash64(key), F.lit(SLOTS)).cast("int")).withColumn(
        "__row", F.monotonically_increasing_id()))
    placed = salted(numbered)
    counts = placed.groupBy("__slot", "__salt").count().collect()  # at most CELLS + SLOTS rows
    pieces = plan([(r["__slot"], r["__salt"], r["count"]) for r in counts], shards, slack)
    plan_df = spark.createDataFrame(
        pieces, "p_slot int, p_salt int, p_first long, p_last long, p_shard int, p_base long")
    ranked = placed.withColumn("__rank", F.row_number().over(
        Window.partitionBy("__slot", "__salt").orderBy(*columns)).cast("long") - 1)
    joined = ranked.join(
        F.broadcast(plan_df),  # at most CELLS + SLOTS + shards ** 2 rows
        (F.col("__slot") == F.col("p_slot")) & (F.col("__salt") == F.col("p_salt"))
        & F.col("__rank").between(F.col("p_first"), F.col("p_last")))
    return joined.select(*columns, F.col("p_shard").alias("shard"),
                         (F.col("p_base") + F.col("__rank") - F.col("p_first")).alias("slot"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards whose counts are at most one apart."""
    prepare(spark)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    return assign(rows, "doc_id", 8).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
