"""URL filter: rules, then gradient-boosted trees on lexical features
(operator 5, DataFrame functions and Spark ML only).

Rules judge the urls they fit; those urls are the labelled ones.  Boosted trees
are fitted to them on features of the url's text alone (lengths, depth, digit
ratio, entropy, parameter counts, and the block rate of its suffixes among the
labelled urls) and judge the rest.

Scale: urls are read once (only that column), features are column expressions.
The trees are fitted to at most about ``MAX_TRAIN`` labelled urls, a documented
bound, chosen by a hash of page and url (so the copies of a hot url are chosen
one by one); suffix statistics count all labelled urls,
are combined before the shuffle, and are joined on the suffix (adaptive
execution broadcasts or splits by what it measured).  A labelled url's own fold is
left out of its suffix statistics.

Defined results: a null url, or one without ``://``, has empty host and path,
meets no rule and is judged by the trees on empty features; a url of any length is
read whole; a url of which the trees are unsure to a tie is allowed; without labelled
urls of both kinds every other url gets the one kind there is, or ``allow``;
repeated rows are judged alike; extra columns are dropped; an empty table gives
no rows.
"""

from __future__ import annotations

import math
import string

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import cut_lineage, prepare, table

# Fixed rules: (host, path, verdict).
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block"))
MAX_TRAIN, TREES, DEPTH, PRIOR, FOLDS = 200_000, 10, 4, 10.0, 5
FEATURES = ("url_chars", "host_chars", "path_chars", "host_labels", "depth", "digit_ratio", "entropy", "params",
            "query_chars", "hyphens", "suffix_rate", "domain_rate")


def parts(df: DataFrame, url: str = "url") -> DataFrame:
    """Add ``host``, ``path`` and ``rest`` (the url from its query or fragment on)."""
    u = F.coalesce(F.col(url), F.lit(""))
    at = F.instr(u, "://")
    after = F.when(at > 0, F.substring(u, at + F.lit(3), F.char_length(u))).otherwise("")
    df = df.withColumn("__after", after)
    host = F.regexp_extract("__after", r"(?s)^[^/?#]*", 0)
    lower = F.translate(host, string.ascii_uppercase, string.ascii_lowercase)
    return df.withColumn("host", lower).withColumn(
        "path", F.regexp_extract("__after", r"(?s)^[^/?#]*([^?#]*)", 1)).withColumn(
        "rest", F.regexp_extract("__after", r"(?s)^[^?#]*(.*)$", 1)).drop("__after")


def with_rule(df: DataFrame, rules=RULES) -> DataFrame:
    """Add ``rule`` and ``rule_verdict`` of the longest rule that fits, else null."""
    hits = F.array_compact(F.array(*[
        F.when(((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p),
               F.struct(F.lit(len(h + p)).alias("n"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")))
        for h, p, v in rules]))
    return df.withColumn("__hit", F.array_max(hits)).withColumn("rule", F.col("__hit.rule")).withColumn(
        "rule_verdict", F.col("__hit.verdict")).drop("__hit")


def _entropy(text: Column) -> Column:
    n = F.char_length(text)
    return F.aggregate(
        F.transform(F.array_distinct(F.split(text, "")),
                    lambda c: (n - F.char_length(F.replace(text, c, F.lit("")))) / F.greatest(n, F.lit(1))),
        F.lit(0.0), lambda a, p: a - F.when(p > 0, p * F.log2(p)).otherwise(0.0))


def with_features(df: DataFrame, url: str = "url") -> DataFrame:
    u = F.coalesce(F.col(url), F.lit(""))

    def count(text, pattern):
        return F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))

    host, path, rest = F.col("host"), F.col("path"), F.col("rest")
    made = {
        "url_chars": F.char_length(u), "host_chars": F.char_length(host), "path_chars": F.char_length(path),
        "host_labels": count(host, "[.]"), "depth": count(path, "/"),
        "digit_ratio": count(u, "[0-9]") / F.greatest(F.char_length(u), F.lit(1)), "entropy": _entropy(u),
        "params": count(rest, "="), "query_chars": F.char_length(rest), "hyphens": count(host, "-")}
    df = df.withColumns({k: v.cast("double") for k, v in made.items()})
    return df.withColumn("suffix", F.substring_index("host", ".", -1)).withColumn(
        "domain", F.substring_index("host", ".", -2))


def with_suffix_rates(df: DataFrame, labelled: Column) -> DataFrame:
    """Add the smoothed block rate of a url's suffix and domain among the ``labelled``.
    A labelled url is left out of its own rates, with all others of its fold (a hash of
    the url, so copies go together): the trees see no url's own label."""
    blocked = F.when(F.col("rule_verdict") == "block", 1.0).otherwise(0.0)
    df = df.withColumn("__fold", F.when(labelled, F.pmod(F.xxhash64("url", F.lit(5)), F.lit(FOLDS)).cast("int")))
    known = df.filter(labelled)
    overall = F.coalesce(known.agg(F.avg(blocked)).scalar(), F.lit(0.0))
    for key, name in (("suffix", "suffix_rate"), ("domain", "domain_rate")):
        inside = [F.col("__fold") == k for k in range(FOLDS)]
        rates = known.groupBy(F.col(key).alias("__key")).agg(
            F.array(*[F.sum(F.when(x, blocked).otherwise(0.0)) for x in inside]).alias("__b"),
            F.array(*[F.sum(x.cast("double")) for x in inside]).alias("__n"))

        def others(c):
            every = F.coalesce(F.aggregate(c, F.lit(0.0), lambda a, x: a + x), F.lit(0.0))
            return every - F.coalesce(F.get(c, F.col("__fold")), F.lit(0.0))

        df = df.join(rates, df[key] == rates["__key"], "left").withColumn(
            name, (others(F.col("__b")) + PRIOR * overall) / (others(F.col("__n")) + PRIOR)).drop("__key", "__b", "__n")
    return df.drop("__fold")


def judge(df: DataFrame, rules=RULES, max_train: int = MAX_TRAIN, held_out: Column | None = None) -> DataFrame:
    """Add ``host``, ``path``, ``rule``, ``verdict`` and ``learnt`` (what the trees say, also
    where a rule decides) to rows (page_id, url).  Rows that ``held_out`` tells are not learnt from."""
    rows = cut_lineage(with_features(with_rule(parts(df), rules)).drop("rest"))
    labelled = F.col("rule_verdict").isNotNull()
    if held_out is not None:
        labelled &= ~held_out
    ready = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(with_suffix_rates(rows, labelled))
    seen = {r["rule_verdict"]: r["count"] for r in rows.filter(labelled).groupBy("rule_verdict").count().collect()}
    if len(seen) < 2:
        method = F.lit(next(iter(seen), "allow"))
    else:
        share = min(1.0, max_train / sum(seen.values()))
        train = ready.filter(labelled & (F.pmod(F.xxhash64("page_id", "url"), F.lit(1 << 40)) < math.ceil(share * (1 << 40)))).select(
            "features", F.when(F.col("rule_verdict") == "block", 1.0).otherwise(0.0).alias("label"))
        model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=5, maxBins=32, cacheNodeIds=False).fit(
            cut_lineage(train))
        ready = model.transform(ready)
        method = F.when(F.col("prediction") == 1.0, "block").otherwise("allow")
    return ready.select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", method).alias("verdict"),
                        method.alias("learnt"))


def op5_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by the rules, else by the trees."""
    prepare(spark)
    return judge(table(spark, sf_dir, "pages").select("page_id", "url"))
