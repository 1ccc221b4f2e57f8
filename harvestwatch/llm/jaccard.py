"""N-gram Jaccard join by chosen paths (operator 6).

A document is the set of its five-word shingles; documents with a Jaccard
similarity of 0.8 or more are linked.  As usual for this join, sets are first
embedded in a fixed number of coordinates (minhash values), where the share of
equal coordinates estimates the similarity.  A run starts a path by one sampled
coordinate: sets with equal values there share a token and go to the same
bucket.  A bucket over ``LIMIT`` is split again, on coordinates chosen by a hash
of its path, unless its sets are so alike that the split leaves most of them
together.  Small buckets are compared in full on the embedding.  ``RUNS``
repeats this until a pair at the threshold is missed with probability under
``1 - TARGET``.

The comparison in the buckets only says which sets may belong together: pairs
whose embedding agrees in ``NEAR`` of the coordinates (six standard deviations
under the threshold) give one edge per set to their local component.  The
components are then compared in full on the exact shingle sets, which decides
every link and counts it.

Scale: equal sets are one node with a count, so a hot group of copies is one
row.  Buckets and components over the limit are dealt out in pairs of blocks.
Paths travel as (path, node); embeddings follow only for buckets of two or more,
shingle sets only for members of components, once per component.

Defined results: a text of one to four words is one shingle of all its words; a
text without words (null, empty) has no set, links with nothing and is its own
class; the class of linked documents is their smallest ``doc_id``; rows that
repeat a ``doc_id`` are told apart by their text, and a fully repeated row is a
copy; a null ``doc_id`` names a class only if all are null.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import cut_lineage, prepare, slices, table
from ._groups import Labels, by_group, components, in_blocks, stars
from ._words import Words, mix

SHINGLE, COORDINATES = 5, 64
SIMILAR_NUM, SIMILAR_DEN = 4, 5  # 0.8 as a ratio of integers
TARGET = 0.9999
RUNS = math.ceil(math.log(1 - TARGET) / math.log(1 - SIMILAR_NUM / SIMILAR_DEN)) + 1
CHILDREN, DEPTH, LIMIT, ALIKE = 3, 3, 2048, 0.5
NEAR = 32  # of COORDINATES
_SEEDS = mix(np.arange(1, COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """All shingle hashes of the texts, sorted and unique in each text, and where each text's begin."""
    words = Words(texts)
    n = len(texts)
    counts = np.diff(words.first)
    long = words.grams(size)
    keep = words.fits(size)
    hashes, docs = [long[keep]], [words.doc[:len(long)][keep]]
    for k in range(1, size):  # short texts: all their words
        rows = np.flatnonzero(counts == k)
        hashes.append(words.grams(k)[words.first[rows]] if len(rows) else np.zeros(0, np.uint64))
        docs.append(rows)
    hashes, docs = np.concatenate(hashes), np.concatenate(docs)
    order = np.lexsort((hashes, docs))
    hashes, docs = hashes[order], docs[order]
    first = np.ones(len(hashes), bool)
    first[1:] = (hashes[1:] != hashes[:-1]) | (docs[1:] != docs[:-1])
    hashes, docs = hashes[first], docs[first]
    return hashes, np.searchsorted(docs, np.arange(n + 1))


def embed(hashes: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Minhash values (rows by coordinates) of non-empty sets."""
    out = np.empty((len(begin) - 1, COORDINATES), np.uint32)
    for k, seed in enumerate(_SEEDS):
        out[:, k] = np.minimum.reduceat(((hashes ^ seed) * seed) >> np.uint64(32), begin[:-1])
    return out


def _signatures(batches):
    for batch in batches:
        for part in slices(batch, 2, 1 << 22):
            hashes, begin = shingle_sets(part.column(2))
            sizes = np.diff(begin)
            full = np.flatnonzero(sizes)
            node, sketch = np.zeros(len(sizes), np.int64), [None] * len(sizes)
            if len(full):
                starts = np.append(begin[:-1][full], len(hashes))
                sums = np.add.reduceat(mix(hashes + np.uint64(1)), starts[:-1]) + sizes[full].astype(np.uint64)
                node[full] = mix(sums).view(np.int64)
                rows = embed(hashes, starts).view(np.int32)
                for i, r in zip(full.tolist(), rows, strict=True):
                    sketch[i] = r
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(node, mask=sizes == 0),
                 pa.array(sketch, pa.list_(pa.int32()))], names=["doc_id", "digest", "node", "sketch"])


def signatures(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, digest of the text, node, sketch); the node names the shingle set."""
    return df.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias(
        "digest"), F.col(text).alias("text")).mapInArrow(
        _signatures, "doc_id long, digest long, node long, sketch array<int>")


def _child(path, coordinate, sketch):
    return F.xxhash64(path, coordinate, F.element_at(sketch, coordinate + 1))


def buckets(nodes: DataFrame, runs: int = RUNS) -> DataFrame:
    """(path, node, sketch) of all final buckets of two sets or more; ``nodes``: (node, sketch)."""
    starts = F.transform(F.array(*[F.lit(r) for r in range(runs)]), lambda r: _child(F.lit(0), r, F.col("sketch")))
    paths = nodes.select("node", F.explode(starts).alias("path"))
    sizes = paths.groupBy("path").agg(F.count("*").alias("m")).filter("m > 1")
    level = cut_lineage(paths.join(sizes, "path").join(nodes, "node"))
    done = level.filter(F.col("m") <= LIMIT)
    for _ in range(DEPTH):
        big = level.filter(F.col("m") > LIMIT)
        if big.isEmpty():
            return done.select("path", "node", "sketch")
        picks = F.transform(F.array(*[F.lit(k) for k in range(CHILDREN)]), lambda k: _child(
            F.col("path"), F.pmod(F.xxhash64("path", k), F.lit(COORDINATES)).cast("int"), F.col("sketch")))
        children = big.select("path", "m", "node", F.explode(picks).alias("child"))
        counts = cut_lineage(children.groupBy("path", "child").agg(F.count("*").alias("c"), F.first("m").alias("m")))
        alike = counts.groupBy("path").agg((F.max("c") > ALIKE * F.first("m")).alias("alike"))
        done = done.unionByName(big.join(alike.filter("alike"), "path").select(level.columns))
        split = counts.filter("c > 1").join(alike.filter("not alike"), "path").select("path", "child", "c")
        level = cut_lineage(children.join(split, ["path", "child"]).select(
            F.col("child").alias("path"), "node", F.col("c").alias("m")).join(nodes, "node"))
        done = done.unionByName(level.filter(F.col("m") <= LIMIT).select(done.columns))
    return done.unionByName(level.filter(F.col("m") > LIMIT).select(done.columns)).select("path", "node", "sketch")


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _near_edges(group: pa.Table) -> pa.RecordBatch:
    ids, rows = group["node"].to_numpy(), _matrix(group["sketch"])
    labels = Labels(len(ids))
    for i in range(len(ids) - 1):
        rest = np.flatnonzero(labels.of[i + 1:] != labels.of[i]) + i + 1
        if len(rest):
            hit = rest[(rows[rest] == rows[i]).sum(axis=1) >= NEAR]
            if len(hit):
                labels.join(i, hit)
    return stars(ids, labels)


def _exact_links(group: pa.Table) -> pa.RecordBatch:
    """Exact similarities of a component (or of two blocks of it): per set its
    links, weighted by copies, and the smallest set of its local component."""
    _, once = np.unique(group["node"].to_numpy(), return_index=True)  # a fully repeated row comes twice
    if len(once) < len(group):
        group = group.take(pa.array(once))
    ids, side, weight = (group[c].to_numpy() for c in ("node", "side", "copies"))
    a, b = group["block_a"][0].as_py(), group["block_b"][0].as_py()
    blobs = group["shingles"].to_pylist()
    sizes = np.array([len(x) // 8 for x in blobs])
    tokens = np.frombuffer(b"".join(blobs), np.uint64)
    _, tokens = np.unique(tokens, return_inverse=True)
    owner = np.repeat(np.arange(len(ids)), sizes)
    order = np.argsort(tokens, kind="stable")
    posting, df = owner[order], np.bincount(tokens)
    starts = np.cumsum(df) - df
    begin = np.cumsum(sizes) - sizes
    labels, links = Labels(len(ids)), np.zeros(len(ids), np.int64)
    for i in range(len(ids)):
        own = tokens[begin[i]:begin[i] + sizes[i]]
        own = own[df[own] > 1]
        n = df[own]
        at = np.repeat(starts[own] - np.cumsum(n) + n, n) + np.arange(n.sum())
        common = np.bincount(posting[at], minlength=len(ids))
        hit = (SIMILAR_NUM + SIMILAR_DEN) * common >= SIMILAR_NUM * (sizes + sizes[i])
        hit[i] = False
        if a != b:
            hit &= side != side[i]
        links[i] = weight[hit].sum()
        js = np.flatnonzero(hit)
        if len(js):
            labels.join(i, js)
    head = np.full(len(ids), np.iinfo(np.int64).max)
    np.minimum.at(head, labels.of, ids)
    return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(links), pa.array(head[labels.of])],
                                      names=["node", "links", "head"])


def _sets(batches):
    for batch in batches:
        for part in slices(batch, 3, 1 << 22):
            hashes, begin = shingle_sets(part.column(3))
            blobs = [hashes[i:j].tobytes() for i, j in zip(begin[:-1], begin[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(blobs, pa.binary())],
                                             names=["component", "node", "copies", "shingles"])


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``digest`` (of the text), ``class_key`` (names the class also
    where ids are null), ``class_id`` and ``n_links`` of every row."""
    spark = df.sparkSession
    prepare(spark)
    rows = cut_lineage(signatures(df, doc_id, text))
    nodes = cut_lineage(rows.filter(F.col("node").isNotNull()).groupBy("node").agg(
        F.count("*").alias("copies"), F.min("doc_id").alias("first"),
        F.min(F.struct("doc_id", "digest")).alias("one"), F.min("sketch").alias("sketch")))
    edges = by_group(in_blocks(buckets(nodes.select("node", "sketch")), ["path"], "node", LIMIT),
                     ["path", "block_a", "block_b"], _near_edges, "a long, b long")
    maybe = cut_lineage(components(edges))
    members = nodes.join(maybe, nodes["node"] == maybe["id"]).select(
        "component", "node", "copies", F.col("one.doc_id").alias("one_id"), F.col("one.digest").alias("one_digest"))
    texts = df.select(F.col(doc_id).cast("long").alias("id"), F.xxhash64(
        F.coalesce(F.col(text), F.lit(""))).alias("digest"), F.col(text).alias("text"))
    # one row of each set that may be linked
    joined = texts.join(members, (texts["digest"] == members["one_digest"])
                        & texts["id"].eqNullSafe(members["one_id"]))
    sets = joined.select("component", "node", "copies", "text").mapInArrow(
        _sets, "component long, node long, copies long, shingles binary")
    checked = cut_lineage(by_group(
        in_blocks(sets, ["component"], "node", LIMIT // 2), ["component", "block_a", "block_b"], _exact_links,
        "node long, links long, head long"))
    links = checked.groupBy("node").agg(F.sum("links").alias("links"))
    classes = cut_lineage(components(checked.select(F.col("node").alias("a"), F.col("head").alias("b"))))
    names = nodes.join(classes, nodes["node"] == classes["id"]).groupBy("component").agg(F.min("first").alias("name"))
    known = nodes.select("node", "copies", "first").join(
        classes.withColumnRenamed("id", "node"), "node", "left").join(names, "component", "left").join(
        links, "node", "left").select(
        F.col("node").alias("k"), F.coalesce("name", "first").alias("name"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"),
        F.coalesce("component", "node").alias("class_key"))
    return rows.join(known, rows["node"] == known["k"], "left").select(
        "doc_id", "digest", F.coalesce("class_key", F.xxhash64("doc_id", "digest")).alias("class_key"), F.coalesce("name", "doc_id").alias("class_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"))


def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document."""
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


OP6_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, [x FOR x IN string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, sh FROM (
        SELECT doc_id, unnest(CASE WHEN len(ws) BETWEEN 1 AND 4 THEN [array_to_string(ws, ' ')]
               ELSE [array_to_string(ws[i:i+4], ' ') FOR i IN range(1, len(ws) - 3)] END) AS sh FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id
      GROUP BY 1, 2),
p AS (SELECT x, y FROM c JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 9 * c >= 4 * (nx.n + ny.n)),
r AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, p.y FROM r JOIN p ON r.y = p.x),
k AS (SELECT x, min(y) AS class_id FROM r GROUP BY x),
l AS (SELECT x, count(*) AS n FROM p GROUP BY x)
SELECT k.x AS doc_id, class_id, coalesce(l.n, 0)::BIGINT AS n_links FROM k LEFT JOIN l ON l.x = k.x
"""
