"""Quality rules with host verdicts (operator 2, DataFrame functions only).

Each document gets its counts and a base verdict.  Failures are then summed per
host (the ``source`` of a document), the hosts' failure rates are shrunk with a
beta prior fitted to all hosts by moments, and a host whose shrunk rate exceeds
``MAX_HOST_RATE`` takes its remaining documents with it.

Scale: the texts are read once and only the narrow counts are written (to the
shared folder) and used again; sums per host are combined before the shuffle, so
a hot host ships one row per task; the prior is a scalar subquery over hosts;
the verdicts are written and then joined on the host, so that the planner knows
their size: it broadcasts a small table and lets adaptive execution split a hot
host otherwise.  Repeated windows are found
by sorting a document's own window hashes, n log n in its length.

Defined results: a null or empty text has no words and fails; a null host
belongs to no host and gets the base verdict alone; repeated rows count each;
an empty table gives an empty result; columns with the added names are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import SPACE_CLASS, WORD_CLASS, cut_lineage, let, prepare, table, with_columns_replaced

# Fixed values of the base rules.
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 50, 50, 3
SYMBOLS = r"[#*$%&|<>]"
MAX_HOST_RATE = 0.5
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE_CLASS + "+"), "")


def repeated_words(words: Column) -> Column:
    """Words that lie in a window of three words found twice or more."""

    def covered(starts):
        # each repeated window covers three words, less what the one before it covers
        return F.aggregate(
            F.transform(starts, lambda s, k: F.when(k == 0, WINDOW).otherwise(
                F.least(F.lit(WINDOW), s - F.get(starts, k - 1)))),
            F.lit(0), lambda a, x: a + x)

    def repeated(windows):
        return F.transform(F.filter(
            windows, lambda w, k: (F.get(windows, k - 1)["h"] == w["h"]).eqNullSafe(True)
            | (F.get(windows, k + 1)["h"] == w["h"]).eqNullSafe(True)), lambda w: w["i"])

    def in_words(w):
        windows = F.transform(
            F.sequence(F.lit(0), F.size(w) - WINDOW),
            lambda i: F.struct(F.xxhash64(*[F.get(w, i + j) for j in range(WINDOW)]).alias("h"), i.alias("i")))
        return F.when(F.size(w) < WINDOW + 1, F.lit(0)).otherwise(
            let(F.sort_array(windows), lambda s: let(F.sort_array(repeated(s)), covered)))

    return let(words, in_words)


def with_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts (long) and ``base_failed``."""
    df = with_columns_replaced(df, *COUNTS, "base_failed")
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD_CLASS))
    counts = let(words_of(t), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
        (F.char_length(t) - F.char_length(F.regexp_replace(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeated_words(w).cast("long").alias("n_repeat_words")))
    df = df.withColumn("__counts", counts).select(*df.columns, "__counts.*")
    return df.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                         | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def host_rates(df: DataFrame, host: str = "source") -> DataFrame:
    """Hosts with documents, failures and the failure rate shrunk by a beta
    prior whose mean and precision are the moments over all hosts."""
    hosts = df.filter(F.col(host).isNotNull()).groupBy(F.col(host).alias("host")).agg(
        F.count("*").cast("double").alias("n"), F.sum(F.col("base_failed").cast("double")).alias("failures"))
    sums = hosts.agg(F.sum("n").alias("n"), F.sum("failures").alias("f"), F.count("*").alias("hosts"),
                     F.sum(F.col("failures") * F.col("failures") / F.col("n")).alias("f2"))
    mean = F.col("f") / F.col("n")
    noise = mean * (1 - mean)
    spread = F.col("f2") / F.col("n") - mean * mean - noise * F.col("hosts") / F.col("n")
    precision = F.greatest(F.lit(1.0), F.least(F.lit(1e6), noise / F.greatest(spread, F.lit(1e-9)) - 1))
    prior = sums.select(F.struct((mean * precision).alias("a"), precision.alias("m")).alias("p")).scalar()
    return hosts.select("host", "n", "failures",
                        ((F.col("failures") + prior["a"]) / (F.col("n") + prior["m"])).alias("host_rate"))


def judge(counted: DataFrame, host: str = "source", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Add ``kept``: not failed by itself and not on a host that mostly fails.
    ``counted`` is read twice, so it should be a written table."""
    counted = with_columns_replaced(counted, "kept")
    # written first, so that the planner knows its size and need not shuffle the texts for a small one
    bad = cut_lineage(host_rates(counted, host).filter(F.col("host_rate") > max_rate).select(
        F.col("host").alias("__host"), F.lit(True).alias("__bad")))
    return counted.join(bad, counted[host] == bad["__host"], "left").select(
        *[counted[c] for c in counted.columns],
        (~F.col("base_failed") & F.col("__bad").isNull()).alias("kept"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rule and host verdict of every document."""
    prepare(spark)
    counted = cut_lineage(with_counts(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).drop("text"))
    return judge(counted).select("doc_id", *COUNTS, "base_failed", "kept")


OP2_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, source, t, [x FOR x IN string_split_regex(t, '[\x20\x09-\x0D]+') IF x <> ''] AS ws,
             [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS ls FROM d),
tri AS (SELECT doc_id, i, ws[i] || ' ' || ws[i+1] || ' ' || ws[i+2] AS g
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)),
rep AS (SELECT doc_id, i FROM tri QUALIFY count(*) OVER (PARTITION BY doc_id, g) >= 2),
cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i+1, i+2]) AS p FROM rep) GROUP BY doc_id),
base AS (SELECT w.doc_id, source, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
                (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
                (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words
         FROM w LEFT JOIN cov ON w.doc_id = cov.doc_id),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base),
h AS (SELECT source, count(*)::DOUBLE AS n, sum(base_failed::INT)::DOUBLE AS f FROM b WHERE source IS NOT NULL GROUP BY source),
m AS (SELECT sum(f) / sum(n) AS mean, sum(n) AS n, count(*) AS hosts, sum(f * f / n) AS f2 FROM h),
p AS (SELECT mean, greatest(1.0, least(1e6, mean * (1 - mean)
             / greatest(f2 / n - mean * mean - mean * (1 - mean) * hosts / n, 1e-9) - 1)) AS k FROM m),
bad AS (SELECT source FROM h, p WHERE (f + mean * k) / (n + k) > 0.5)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(source IN (SELECT source FROM bad), false) AS kept
FROM b
"""
