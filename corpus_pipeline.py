"""Corpus pipeline: language ID, quality rules, near duplicates, substring dedup, packing.

Each stage takes (spark, docs, sf_dir) and returns the documents that it keeps,
all columns in place, the last one the packed pieces.  ``run`` applies them to
``documents``; every stage's result is written and read again by the next.

Columns are renamed by position while an operator works, so extra columns whose
names clash with the operator's own come through unchanged.  Every stage keeps on
an empty table its columns and no rows.  Null and empty texts: ``language_id`` and
``quality_rules`` reject them, ``near_duplicates`` and ``substring_dedup`` leave them as
they are (they are like no other text), ``pack`` gives them the end sign alone.  Texts of any length
are read whole.  Fully repeated rows count as copies of a document, and of copies with
one id only one row stays; ties of classes go to the smallest id.

What a stage writes for itself is deleted when a later stage of the pipeline starts
that does not read it: the result of a stage must be written (as ``run`` does) or
handed on before the next one is called.  No other query's tables are touched.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestwatch.llm import jaccard, langid, packing, quality, substrings
from harvestwatch.llm._common import cut_lineage, prepare, table
from harvestwatch.session import StageScope


_scopes: list[StageScope] = []  # of the stages called so far, whose tables may still be read


def _stage(fn):
    """A stage with its own scope of tables; those of earlier stages go, unless ``docs`` reads them."""
    @functools.wraps(fn)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for old in [x for x in _scopes if not x.read_by(docs)]:
            old.release()
            _scopes.remove(old)
        _scopes.append(StageScope(spark))
        with _scopes[-1].collecting():
            return fn(spark, docs, sf_dir)
    return run


def _plain(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The documents with columns named by position, and where each name went."""
    names = [f"__c{i}" for i in range(len(docs.columns))]
    return docs.toDF(*names), dict(reversed(list(zip(docs.columns, names, strict=True))))


def _back(df: DataFrame, docs: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"__c{i}").alias(c) for i, c in enumerate(docs.columns)])


@_stage
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter and texts far from every language learnt, which
    are those of all labelled documents: nothing is evaluated here on a fold of them."""
    plain, at = _plain(docs)
    models = langid.learn(plain, at["text"], at["lang"])
    scored = cut_lineage(langid.predict(plain, models, at["text"]))
    return _back(langid.calibrated(scored, F.lit(True), at["lang"]).filter(~F.col("rejected")), docs)


@_stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail by themselves or by their host."""
    prepare(spark)
    plain, at = _plain(docs)
    counted = cut_lineage(quality.with_counts(plain, at["text"]))
    return _back(quality.judge(counted, at["source"]).filter("kept"), docs)


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of smallest id of each class of near duplicates."""
    plain, at = _plain(docs)
    found = cut_lineage(jaccard.near_duplicates(plain, at["doc_id"], at["text"]))
    chosen = found.groupBy("class_key").agg(F.min(F.struct("doc_id", "digest")).alias("one")).select("one.*")
    kept = plain.withColumn("__digest", F.xxhash64(F.coalesce(F.col(at["text"]), F.lit("")))).join(
        chosen, F.col(at["doc_id"]).cast("long").eqNullSafe(chosen["doc_id"])
        & (F.col("__digest") == chosen["digest"]), "left_semi")
    if not found.groupBy("doc_id", "digest").count().filter("count > 1").isEmpty():
        kept = kept.dropDuplicates([at["doc_id"], "__digest"])  # fully repeated rows
    return _back(kept, docs)


@_stage
def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages that start earlier; a text that loses none stays as it is."""
    plain, at = _plain(docs)
    cut = substrings.dedup(plain, at["doc_id"], at["text"])
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col(at["text"]))
    cut = cut.withColumn(at["text"], text)
    if "n_chars" in at:
        n = F.char_length(at["text"]).cast(docs.schema["n_chars"].dataType)
        cut = cut.withColumn(at["n_chars"], F.when(F.col("n_removed") > 0, n).otherwise(F.col(at["n_chars"])))
    return _back(cut, docs)


@_stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the texts into sequences of 2048 tokens."""
    return packing.pack(docs)


STAGES = [("language_id", language_id), ("quality_rules", quality_rules), ("near_duplicates", near_duplicates),
          ("substring_dedup", substring_dedup), ("pack", pack)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = table(spark, sf_dir, "documents"), None
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            written = StageScope(spark)
            with written.collecting():
                docs = cut_lineage(docs)
            if held is not None:
                held.release()  # the documents that this stage has read
            held = written
    return docs
