"""Toxicity by multiple-instance learning (operator 12).

A document is a bag of sentences (between ``.``, ``!``, ``?`` and line ends, those with
a letter).  A sentence has the probability ``p = sigmoid(b + sum of the weights of its
distinct words)``, and the document the noisy-or of its sentences, ``1 - prod(1 - p)``.
Only documents have labels; the weights come from the likelihood of these, whose
gradient reaches a sentence in the share that it has in its document's probability.  A
toxic document that one sentence explains so teaches nothing about its other sentences,
and those of probability ``LOCATE`` or more are the offending ones.

Words that enter the model are those (of at most ``MAX_LETTERS`` letters) found in at
least ``MIN_POSITIVE`` toxic texts and ``MIN_Z`` deviations more often in these than the
share of toxic texts lets expect, the ``MAX_FEATURES`` clearest at most.  They start at
the log odds that their counts give; ``ROUNDS`` damped Newton steps by the diagonal of
the curvature, with a small ridge and shrinkage, do the rest.  Equal texts count as one
with their mean label.

Scale: learning takes about ``MAX_TRAIN`` ids of ``labels`` at most, chosen by hash
(below that all).  Their texts are read in one pass and written; word counts are summed
per task before the shuffle; each round is a job over the written, narrow rows of
selected words that returns one vector from each of ``TRAIN_TASKS`` tasks.  Scoring is
one pass over all whole texts with a model of at most ``MAX_FEATURES`` short words.

Defined results: a null or empty text, or one without a letter, has score 0; a null id
is not learnt from (and not held out); an id with several labels has their mean; null
labels are left out; without labelled or without toxic rows all scores are near 0;
repeated rows get equal results; the order of equally clear words is by name; columns
with the added names are replaced.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import cut_lineage, prepare, slices, table, with_columns_replaced

MAX_TRAIN, MAX_FEATURES, MAX_LETTERS = 100_000, 10_000, 64
MIN_POSITIVE, MIN_Z = 3.0, 4.0
ROUNDS, TRAIN_TASKS = 25, 16
START_BIAS, START_WEIGHT = -6.0, 8.0
RIDGE, SHRINK, DAMPING, FLAT = 0.5, 0.1, 0.5, 1e-3
THRESHOLD, LOCATE = 0.3, 0.3
MAX_HELD = 300_000
_split = re.compile(r"[.!?。！？\n]+").split
_sentences = re.compile(r"[^.!?。！？\n]+").finditer
_words = re.compile(r"[^\W\d_]+").findall
_letter = re.compile(r"[^\W\d_]").search


class Model:
    """Word weights and the bias of a sentence."""

    def __init__(self, bias: float = -20.0, weights: dict[str, float] | None = None):
        self.bias, self.weights = bias, weights or {}

    def sentences(self, text: str):
        """(begin, end, probability) of each sentence, in code points of the text."""
        for m in _sentences(text):
            if words := set(_words(m.group().lower())):
                z = self.bias + sum(self.weights[w] for w in words if w in self.weights)
                yield m.start(), m.end(), 1.0 / (1.0 + np.exp(-z))

    def score(self, text: str) -> tuple[float, int, int | None, int | None]:
        """Probability of the document, sentences that offend, place of the worst."""
        lowered = text.lower()
        if self.weights.keys().isdisjoint(_words(lowered)):
            n = sum(1 for s in _split(lowered) if _letter(s))
            return float(-np.expm1(-n * np.logaddexp(0.0, self.bias))), 0, None, None
        found = list(self.sentences(text))
        p = np.array([s[2] for s in found])
        worst = found[int(p.argmax())]
        return float(-np.expm1(np.log1p(-np.minimum(p, 1 - 1e-12)).sum())), int((p >= LOCATE).sum()), worst[0], worst[1]


# -- learning -------------------------------------------------------------------

def training_texts(docs: DataFrame, labels: DataFrame, learnt: Column, label: str, max_train: int) -> DataFrame:
    """(text, y, weight): whole texts of the chosen labelled ids, written; equal texts
    share a weight of 1 and their mean label."""
    marks = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & learnt).groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(F.avg(F.col(label).cast("double")).alias("y"))
    marks = cut_lineage(marks)
    total = marks.count()
    if total > max_train:  # about max_train ids, the same ones in every run
        marks = marks.filter(F.pmod(F.xxhash64("doc_id", F.lit(12)), F.lit(1 << 30)) < int((1 << 30) * max_train / total))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).join(
        F.broadcast(marks), "doc_id")  # about max_train rows of two numbers
    rows = cut_lineage(rows.select("text", "y", F.md5("text").alias("digest")))
    # texts that occur more than once; written, so that the planner knows its size and need not shuffle the texts
    copies = cut_lineage(rows.groupBy("digest").agg(F.avg("y").alias("mean"), F.count("*").alias("n")).filter("n > 1"))
    return rows.join(copies, "digest", "left").select(
        "text", F.coalesce("mean", "y").alias("y"), (1.0 / F.coalesce("n", F.lit(1))).alias("weight"))


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, positive, everywhere): weights of the texts that hold a word."""

    def flush(held):
        both = np.array(list(held.values())) if held else np.zeros((0, 2))
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(both[:, 0]), pa.array(both[:, 1])],
                                          names=["word", "positive", "everywhere"])

    def run(batches):
        held: dict[str, list[float]] = {}
        for batch in batches:
            for part in slices(batch, 0):
                for t, y, n in zip(*(part.column(i).to_pylist() for i in range(3)), strict=True):
                    for w in set(_words(t.lower())):
                        if len(w) <= MAX_LETTERS:
                            at = held.setdefault(w, [0.0, 0.0])
                            at[0] += y * n
                            at[1] += n
                    if len(held) > MAX_HELD:
                        yield flush(held)
                        held.clear()
        yield flush(held)

    return rows.select("text", "y", "weight").mapInArrow(run, "word string, positive double, everywhere double").groupBy(
        "word").agg(F.sum("positive").alias("positive"), F.sum("everywhere").alias("everywhere"))


def chosen_words(counts: DataFrame, positive: float, everywhere: float) -> list[tuple[str, float, float]]:
    """The words of the model with their two counts, the clearest first."""
    share = positive / everywhere
    z = (F.col("positive") - F.col("everywhere") * share) / F.sqrt(F.col("everywhere") * share * (1 - share))
    rows = counts.filter(F.col("positive") >= MIN_POSITIVE).withColumn("z", z).filter(F.col("z") >= MIN_Z)
    return [(r["word"], r["positive"], r["everywhere"]) for r in rows.orderBy(F.desc("z"), "word").limit(MAX_FEATURES).collect()]


def bags(rows: DataFrame, words: list[str]) -> DataFrame:
    """(y, weight, blank, sizes, words): per text the sentences without a chosen word,
    and the number and places of chosen words in each other sentence."""
    at = {w: i for i, w in enumerate(words)}

    def bag(t):
        blank, sizes, found = 0, [], []
        for s in _split(t.lower()):
            if ws := set(_words(s)):
                if hits := sorted(at[w] for w in ws if w in at):
                    sizes.append(len(hits))
                    found += hits
                else:
                    blank += 1
        return blank, sizes, found

    def run(batches):
        for batch in batches:
            for part in slices(batch, 0):
                made = [bag(t) for t in part.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(1), part.column(2), pa.array([m[0] for m in made], pa.int64()),
                     pa.array([m[1] for m in made], pa.list_(pa.int32())), pa.array([m[2] for m in made], pa.list_(pa.int32()))],
                    names=["y", "weight", "blank", "sizes", "words"])

    return rows.select("text", "y", "weight").mapInArrow(
        run, "y double, weight double, blank long, sizes array<int>, words array<int>")


def _sums(values, sizes):
    upto = np.concatenate([[0.0], np.cumsum(values)])
    end = np.cumsum(sizes)
    return upto[end] - upto[end - sizes]


def step_sums(batch: pa.RecordBatch, bias: float, weights: np.ndarray) -> np.ndarray:
    """Gradient and curvature of the words, then of the bias, over one batch of bags."""
    y, n, blank = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
    sizes, found = (batch.column(i).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for i in (3, 4))
    per_doc = batch.column(3).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    z = bias + _sums(weights[found], sizes)
    p, p0 = 1 / (1 + np.exp(-z)), 1 / (1 + np.exp(-bias))
    q = np.maximum(_sums(np.logaddexp(0, z), per_doc) + blank * np.logaddexp(0, bias), 1e-9)  # -log(1 - P)
    pull = n * ((1 - y) - y / np.expm1(np.minimum(q, 500)))
    d = p * np.repeat(pull, per_doc)
    bend = np.repeat(n, per_doc) * (p * (1 - p) + FLAT)
    return np.concatenate([
        np.bincount(found, np.repeat(d, sizes), len(weights)), [d.sum() + (pull * blank).sum() * p0],
        np.bincount(found, np.repeat(bend, sizes), len(weights)), [bend.sum() + (n * blank).sum() * p0 * (1 - p0)]])


def fit(rows: DataFrame, words: list[tuple[str, float, float]]) -> Model:
    """Newton steps over the bags of ``rows`` for the chosen words."""
    held = cut_lineage(bags(rows, [w for w, *_ in words]).repartition(TRAIN_TASKS))
    k, bias = len(words), START_BIAS
    weights = np.array([min(START_WEIGHT, max(0.0, np.log((a + 1e-9) / (n - a + 2)) - START_BIAS)) for _, a, n in words])
    for _ in range(ROUNDS):
        def run(batches, bias=bias, weights=weights):
            total = np.zeros(2 * k + 2)
            for batch in batches:
                total += step_sums(batch, bias, weights)
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["v"])

        total = np.sum([np.array(r["v"]) for r in held.coalesce(TRAIN_TASKS).mapInArrow(run, "v array<double>").collect()], axis=0)
        gradient, bend = total[:k + 1], total[k + 1:]
        step = 1 / (bend[:k] + RIDGE)
        weights = weights - DAMPING * np.clip(gradient[:k] * step, -1, 1)
        weights = np.sign(weights) * np.maximum(np.abs(weights) - np.minimum(SHRINK * DAMPING * step, 0.2), 0)
        bias -= float(np.clip(gradient[k] / (bend[k] + 1), -0.3, 0.3))
    return Model(bias, {w: float(x) for (w, *_), x in zip(words, weights, strict=True) if x})


def learn(docs: DataFrame, labels: DataFrame, learnt: Column, label: str = "toxic", max_train: int = MAX_TRAIN) -> Model:
    """A model from the rows of ``labels`` that ``learnt`` tells, for ``label``."""
    prepare(docs.sparkSession)
    rows = cut_lineage(training_texts(docs, labels, learnt, label, max_train))
    sums = rows.agg(F.sum(F.col("y") * F.col("weight")).alias("positive"), F.sum("weight").alias("everywhere")).first()
    if not sums["positive"] or sums["positive"] >= sums["everywhere"]:
        return Model()
    return fit(rows, chosen_words(word_counts(rows), sums["positive"], sums["everywhere"]))


# -- scoring --------------------------------------------------------------------

def predict(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``score``, ``predicted``, ``n_offending`` (sentences of probability
    ``LOCATE`` or more) and the code points ``worst_start`` and ``worst_end`` of the
    sentence of highest probability, where a word of the model occurs."""
    prepare(df.sparkSession)
    df = with_columns_replaced(df, "score", "predicted", "n_offending", "worst_start", "worst_end")
    at = [c.lower() for c in df.columns].index(text.lower())

    def run(batches):
        for batch in batches:
            for part in slices(batch, at):
                made = [model.score(t) if t else (0.0, 0, None, None) for t in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([m[0] for m in made], pa.float64()),
                     pa.array([int(m[0] >= THRESHOLD) for m in made], pa.int32()),
                     *[pa.array([m[i] for m in made], pa.int64()) for i in (1, 2, 3)]],
                    names=[*part.schema.names, "score", "predicted", "n_offending", "worst_start", "worst_end"])

    return df.mapInArrow(run, T.StructType([
        *df.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()),
        *[T.StructField(c, T.LongType()) for c in ("n_offending", "worst_start", "worst_end")]]))


def offending(df: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row (doc_id, sentence_start, sentence_end, score, sentence) for each sentence that offends."""
    prepare(df.sparkSession)

    def run(batches):
        for batch in batches:
            for part in slices(batch, 1):
                for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    if t and (found := [s for s in model.sentences(t) if s[2] >= LOCATE]):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([i] * len(found), part.column(0).type), *[pa.array([s[k] for s in found], pa.int64()) for k in (0, 1)],
                             pa.array([float(s[2]) for s in found]), pa.array([t[s[0]:s[1]] for s in found], pa.string())],
                            names=["doc_id", "sentence_start", "sentence_end", "score", "sentence"])

    id_type = df.schema[doc_id].dataType.simpleString()
    return df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {id_type}, sentence_start long, sentence_end long, score double, sentence string")


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(4)) == 2


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, learnt from three folds of four."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = learn(docs, table(spark, sf_dir, "labels"), ~held_out(F.col("doc_id")))
    return predict(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted",
                                       "n_offending", "worst_start", "worst_end")
