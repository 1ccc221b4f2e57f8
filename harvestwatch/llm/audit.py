"""Interaction audit of five filters (operator 11).

A document's failures are a mask of five letters.  Under an order of the letters it
is removed by the first letter of its mask, and how it got there depends only on
the letters up to that one.  The 120 orders, numbered by Lehmer rank (their place in
lexicographic order), that share their first ``s`` letters are (5 - s)! consecutive
ranks.  So the documents of a mask are removed at step ``s`` over one interval of
ranks for each way to put ``s - 1`` passed letters before a failed one: their count is
added to a difference array of (step, rank) where the interval begins, taken off where
it ends, and a running sum over the ranks gives all 120 audits at once.

Scale: one pass reads the texts and writes narrow rows (id, part, mask, digest of the
text); texts are not shuffled.  The smallest id of each digest is an aggregate, so a
text that a third of the rows share ships one row per task; rows are first summed by
(id, digest, part, mask), and the joins with labels and smallest ids run on the id or
(digest, id), of which no value is frequent.  What is left is one row per part with a
count for each of 32 masks; the arrays are filled for a bounded run of parts at a time.

Defined results: a null text is empty (fails A, passes B, C and D); a null id has no
labels, fails E never and is no smaller id for another row; rows repeated with one id
and one text all pass E if no smaller id has the text; an id with several rows of
``labels`` counts as good or toxic if one of them says so; a null ``source`` is the
part of the empty string; an empty table has no parts and no rows; columns other than
those named are not read.  Equality of texts is that of 128-bit digests.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import cut_lineage, prepare, slices, table

LETTERS = "ABCDE"
ORDERS = ["".join(p) for p in itertools.permutations(LETTERS)]  # by Lehmer rank
STEPS, RANKS, MASKS = len(LETTERS), len(ORDERS), 1 << len(LETTERS)
# Fixed values of the failure conditions.
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_UPPER_PERCENT = 200, 50, 2
PARTS_AT_ONCE = 64  # parts whose 600 rows a worker makes at a time
MEASURES = ("n", "good", "toxic")
_UPPER = bytes(range(65, 91))
_MARK = re.compile(b"[#$%&*|]").search


def rank(order: str) -> int:
    """Lehmer rank of an order: its place among all orders of its letters."""
    return sum(sum(b < a for b in order[i + 1:]) * math.factorial(len(order) - 1 - i) for i, a in enumerate(order))


def intervals(mask: int) -> list[tuple[int, int, int]]:
    """(step, begin, end): the ranks over which the mask's documents are removed at
    a step; the steps count from 0."""
    failed = [a for i, a in enumerate(LETTERS) if mask >> i & 1]
    passed = [a for a in LETTERS if a not in failed]
    out = []
    for step in range(len(passed) + 1 if failed else 0):
        for before in itertools.permutations(passed, step):
            for letter in failed:
                first = "".join(before) + letter
                begin = rank(first + "".join(a for a in LETTERS if a not in first))
                out.append((step, begin, begin + math.factorial(STEPS - 1 - step)))
    return out


def text_masks(df: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """(doc_id, part, mask of A to D, digest of the text) for each row."""

    def mask_of(t: bytes, points: int) -> int:
        words = t.split()  # at the white space of the word class
        return ((len(words) < MIN_WORDS)
                | (100 * len(set(words)) < MIN_DISTINCT_PERCENT * len(words)) << 1
                | (100 * (len(t) - len(t.translate(None, _UPPER))) > MAX_UPPER_PERCENT * points) << 2
                | (_MARK(t) is not None) << 3)

    def run(batches):
        for batch in batches:
            for rows in slices(batch, 2):
                texts = rows.column(2)
                points = pc.utf8_length(texts).to_pylist()
                raw = texts.cast(pa.binary()).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array(map(mask_of, raw, points), pa.int32()),
                     pa.array([hashlib.md5(t, usedforsecurity=False).digest() for t in raw], pa.binary())],
                    names=["doc_id", "part", "mask", "digest"])

    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
                     F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, part string, mask int, digest binary")


def with_copies(masks: DataFrame) -> DataFrame:
    """(doc_id, part, mask of A to E, n): E is set where a smaller id has the text."""
    rows = masks.groupBy("doc_id", "digest", "part", "mask").agg(F.count("*").alias("n"))
    first = masks.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    copy = F.col("first").isNull() & F.col("doc_id").isNotNull()
    return rows.join(first, ["digest", "doc_id"], "left").select(
        "doc_id", "part", F.when(copy, F.col("mask") + (1 << 4)).otherwise(F.col("mask")).alias("mask"), "n")


def mask_counts(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part: for each measure an array of 32 sums, by mask."""
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    marked = rows.join(marks, "doc_id", "left").select(
        "part", "mask", "n", (F.coalesce("good", F.lit(0)) * F.col("n")).alias("good"),
        (F.coalesce("toxic", F.lit(0)) * F.col("n")).alias("toxic"))
    by_mask = marked.groupBy("part", "mask").agg(*[F.sum(m).alias(m) for m in MEASURES])
    return by_mask.groupBy("part").agg(*[F.array(*[  # at most 32 rows of a part
        F.coalesce(F.sum(F.when(F.col("mask") == k, F.col(m))), F.lit(0)) for k in range(MASKS)]).alias(m) for m in MEASURES])


def audited(counts: DataFrame) -> DataFrame:
    """The 600 rows of each part, from its sums by mask."""
    schema = ("part string, filter_order string, step int, kept long, removed long, redundant long, "
              "unique_fails long, good_lost long, toxic_lost long, shapley long")

    def removed(sums, where):
        """(part, step, rank) removals from sums (part, mask)."""
        ends = np.zeros((len(sums), STEPS, RANKS + 1), np.int64)
        for mask, step, begin, end in where:
            ends[:, step, begin] += sums[:, mask]
            ends[:, step, end] -= sums[:, mask]
        return ends.cumsum(axis=2)[:, :, :RANKS]

    def run(batches):
        where = [(mask, *x) for mask in range(MASKS) for x in intervals(mask)]
        letter = np.array([[LETTERS.index(order[step]) for order in ORDERS] for step in range(STEPS)])  # (step, rank)
        fails = np.array([[mask >> i & 1 for i in range(STEPS)] for mask in range(MASKS)])
        for batch in batches:
            for at in range(0, batch.num_rows, PARTS_AT_ONCE):
                rows = batch.slice(at, PARTS_AT_ONCE)
                k = rows.num_rows
                n, good, toxic = (rows.column(i).flatten().to_numpy().reshape(k, MASKS) for i in (1, 2, 3))
                out, good_lost, toxic_lost = removed(n, where), removed(good, where), removed(toxic, where)
                kept = n.sum(axis=1)[:, None, None] - out.cumsum(axis=1)
                failing = (n @ fails)[:, letter]
                unique = n[:, [1 << i for i in range(STEPS)]][:, letter]
                share = np.stack([np.where(letter == i, out, 0).sum(axis=(1, 2)) for i in range(STEPS)], axis=1)[:, letter]
                flat = [np.swapaxes(x, 1, 2).reshape(-1) for x in
                        (kept, out, failing - out, unique, good_lost, toxic_lost, share)]  # by part, rank, step
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0).take(pa.array(np.repeat(np.arange(k), RANKS * STEPS))),
                     pa.array(np.tile(np.repeat(ORDERS, STEPS), k)), pa.array(np.tile(np.arange(1, STEPS + 1, dtype=np.int32), k * RANKS)),
                     *[pa.array(x, pa.int64()) for x in flat]],
                    names=["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
                           "toxic_lost", "shapley"])

    return counts.mapInArrow(run, schema)


def audit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """All orders of the five filters over ``docs``, per part, order and step."""
    prepare(docs.sparkSession)
    masks = cut_lineage(text_masks(docs, doc_id, text, part))
    return audited(mask_counts(with_copies(masks), labels))


def op11_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order of the five filters over all documents, per source."""
    return audit(table(spark, sf_dir, "documents").select("doc_id", "text", "source"),
                 table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"))


OP11_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, [x FOR x IN string_split_regex(t, '[\x20\x09-\x0D]+') IF x <> ''] AS ws,
             min(doc_id) OVER (PARTITION BY t) AS first_id FROM d),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, len(ws) < 200 AS a, 100 * len(list_distinct(ws)) < 50 * len(ws) AS b,
             100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t) AS c,
             regexp_matches(t, '[#$%&*|]') AS dd, coalesce(w.doc_id > first_id, false) AS e,
             coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
      FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
m AS (SELECT part, CASE WHEN a THEN 'A' ELSE '' END || CASE WHEN b THEN 'B' ELSE '' END || CASE WHEN c THEN 'C' ELSE '' END
             || CASE WHEN dd THEN 'D' ELSE '' END || CASE WHEN e THEN 'E' ELSE '' END AS fails,
             count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT p.x || q.x || r.x || s.x || u.x AS filter_order FROM x p, x q, x r, x s, x u
      WHERE len(list_distinct([p.x, q.x, r.x, s.x, u.x])) = 5),
st AS (SELECT filter_order, k::INT AS step, substr(filter_order, k, 1) AS letter, substr(filter_order, 1, k - 1) AS before
       FROM o, range(1, 6) AS r(k)),
j AS (SELECT m.part, filter_order, step, letter, n, good, toxic, contains(fails, letter) AS fail,
             length(regexp_replace(before, '[' || fails || '-]', '', 'g')) < length(before) AS gone, fails = letter AS only_this
      FROM m, st),
g AS (SELECT part, filter_order, step, letter, sum(n) FILTER (NOT gone AND NOT fail) AS kept, sum(n) FILTER (NOT gone AND fail) AS removed,
             sum(n) FILTER (gone AND fail) AS redundant, sum(n) FILTER (only_this) AS unique_fails,
             sum(good) FILTER (NOT gone AND fail) AS good_lost, sum(toxic) FILTER (NOT gone AND fail) AS toxic_lost
      FROM j GROUP BY ALL)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       (sum(coalesce(removed, 0)) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM g
"""
