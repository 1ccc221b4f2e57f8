"""Language identification with character models (operator 7).

Per language an interpolated Kneser-Ney model of order 4 over the letters of
words, each word framed by start and end signs.  The counts of order 4 come from
every learning document; the lower orders are continuation counts (how many
different letters stand before a gram), made from the table of grams.  The
discount of an order is ``n1 / (n1 + 2 n2)``.  The models are stored as one
sorted array of gram hashes per order with a row of values per language, and
searched by bisection.

A document gets the language of the lowest cross-entropy per letter.  It is
rejected if that lies far above what learning documents of that language show:
over center + ``Z`` * sqrt(spread of documents ** 2 + spread per letter ** 2 /
letters).  Center and spreads are medians (of entropies, of distances from the
center, of distances times the root of letters, the last at least one bit) over
the learning documents whose ``lang`` is the predicted one, copies counted once,
so texts of no learnt language and a minority of odd documents do not move them.
A predicted language without such documents rejects nothing.

Scale: one pass counts grams (a worker holds a bounded table of words and hands
on sums), the shuffle carries distinct grams per task, so hot sources or copies
add nothing; the grams of all documents are summed.  The lower orders and the totals of
contexts are aggregates of that table.  Grams are known by whole 64-bit hashes and
any number of languages is learnt: the model has an entry of 12 bytes for each
gram of each language that was seen, no more where a language lacks a gram, so it grows
with the distinct grams of the corpus (not with its length) and is sent to the workers
in that form.  Another pass scores, with bounded tables per worker; its narrow result is
written and gives the thresholds, from counts per class of entropies.

Defined results: a text that is one long run of letters is one word; an empty table
gives an empty result; a null text, or one without a letter, is ``und`` with score 0
and is rejected; rows with null ``lang`` are not learnt from; with no learning
rows at all every text is ``und``; equal cross-entropies go to the language
first by name; repeated rows get equal results; clashing columns are replaced.
"""

from __future__ import annotations

import functools
import re
import sys
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import cut_lineage, prepare, slices, table, with_columns_replaced
from ._unicode import category_class
from .bpe import LOW

ORDER = 4
START, STOP = "\x02", "\x03"
HASH_SEED = 42  # that of Spark's xxhash64
Z, SAMPLE_LETTERS = 8.0, 20.0
CLASS, NORMAL = 0.01, 1.4826  # width of a class of entropies; a normal deviation by the median one
MAX_HELD = 100_000  # words of the table that a worker holds, learning or scoring
HELD_COSTS = 1_200_000  # numbers of the tables that a scoring worker holds: entries (MAX_HELD at most) times languages
GRAMS_AT_ONCE = 20_000
UNKNOWN = "und"


@functools.lru_cache(maxsize=1)
def _patterns():
    return (re.compile(f"[{category_class('L', LOW)}]+").findall,
            re.compile(f"[{category_class('L')}]+").findall,
            re.compile(f"[^\\x00-\\u{LOW:04x}]").search)


def words_of(text: str) -> list[str]:
    """Runs of letters, lower-cased."""
    low, full, beyond = _patterns()
    text = text.lower()
    return full(text) if beyond(text) else low(text)


# -- learning -------------------------------------------------------------------

def gram_counts(df: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, gram, n): grams of the full order over all rows."""

    def flush(held):
        grams = Counter()
        for (language, word), n in held.items():
            framed = START * (ORDER - 1) + word + STOP
            for i in range(len(word) + 1):
                grams[language, framed[i:i + ORDER]] += n
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in grams]), pa.array([k[1] for k in grams]), pa.array(list(grams.values()), pa.int64())],
            schema=pa.schema([("lang", pa.string()), ("gram", pa.string()), ("n", pa.int64())]))

    def run(batches):
        held: Counter = Counter()
        for batch in batches:
            for part in slices(batch, 0):
                for t, language in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    for word, n in Counter(words_of(t)).items():
                        held[language, word] += n
                if len(held) > MAX_HELD:
                    yield flush(held)
                    held.clear()
        if held:
            yield flush(held)

    rows = df.filter(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(text), F.col(lang).cast("string"))
    return rows.mapInArrow(run, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def counted(grams: DataFrame) -> DataFrame:
    """Rows (lang, size, kind, hash, context, n, types) of all orders: counts of each gram
    with the hash of its context (kind 0), and of each context its total and its
    number of different next letters (kind 1)."""
    out, current = None, grams
    for size in range(ORDER, 0, -1):
        context = F.substring("gram", 1, size - 1)
        order = F.lit(size).cast("byte").alias("size")
        shares = current.select("lang", order, F.lit(0).cast("byte").alias("kind"), F.xxhash64("gram").alias("hash"),
                                F.xxhash64(context).alias("context"), "n", F.lit(0).cast("long").alias("types"))
        contexts = current.groupBy("lang", context.alias("c")).agg(F.sum("n").alias("n"), F.count("*").alias("types")).select(
            "lang", order, F.lit(1).cast("byte").alias("kind"), F.xxhash64("c").alias("hash"),
            F.lit(0).cast("long").alias("context"), "n", "types")
        rows = shares.unionByName(contexts)
        out = rows if out is None else out.unionByName(rows)
        if size > 1:
            current = cut_lineage(current.groupBy("lang", F.substring("gram", 2, size - 1).alias("gram")).agg(
                F.count("*").alias("n")))
    return out


class Entries:
    """A sorted array of hashes, and for each the languages that have it with a value."""

    def __init__(self, hashes: np.ndarray, langs: np.ndarray, values: np.ndarray):
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.first = np.unique(hashes[order], return_index=True)
        self.first = np.append(self.first, len(order)).astype(np.int64)
        self.langs, self.values = langs[order].astype(np.int32), values[order].astype(np.float32)

    def find(self, want: np.ndarray, languages: int) -> np.ndarray:
        """A row of values per hash, 0 for languages that lack it."""
        out = np.zeros((len(want), languages), np.float32)
        if not len(self.hashes):
            return out
        at = np.minimum(np.searchsorted(self.hashes, want), len(self.hashes) - 1)
        hit = np.flatnonzero(self.hashes[at] == want)
        first, size = self.first[at[hit]], self.first[at[hit] + 1] - self.first[at[hit]]
        entry = np.repeat(first - np.cumsum(size) + size, size) + np.arange(size.sum())
        out[np.repeat(hit, size), self.langs[entry]] = self.values[entry]
        return out


def hashes_of(texts: list[str]) -> np.ndarray:
    """Spark's xxhash64 of each text."""
    return np.fromiter((xxhash.xxh64_intdigest(t.encode(), HASH_SEED) for t in texts), np.uint64, len(texts)).view(np.int64)


class Models:
    """Per order and kind a sorted hash array: the discounted share of each gram (kind 0)
    and the weight that a context leaves to the lower order (kind 1)."""

    def __init__(self, rows: pa.Table):
        names = rows.column("lang").combine_chunks().dictionary_encode() if rows.num_rows else pa.array([], pa.string()).dictionary_encode()
        order = np.argsort(np.array(names.dictionary.to_pylist(), object), kind="stable") if rows.num_rows else np.zeros(0, np.int64)
        self.languages = [names.dictionary[int(i)].as_py() for i in order]
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        lang = place[names.indices.to_numpy()] if rows.num_rows else np.zeros(0, np.int32)
        size, kind = rows.column("size").to_numpy(), rows.column("kind").to_numpy()
        whole = {c: rows.column(c).to_numpy() for c in ("hash", "context", "n", "types")}
        count, self.arrays = len(self.languages), {}
        for k in range(1, ORDER + 1):
            gram, context = np.flatnonzero((size == k) & (kind == 0)), np.flatnonzero((size == k) & (kind == 1))
            n = whole["n"][gram]
            n1, n2 = (np.bincount(lang[gram[n == i]], minlength=count) for i in (1, 2))
            discount = np.clip(n1 / np.maximum(n1 + 2 * n2, 1), 0.05, 0.95)
            total = self._totals(whole["hash"][context], lang[context], whole["n"][context], whole["context"][gram], lang[gram])
            d = discount[lang[gram]]
            self.arrays[k, 0] = Entries(whole["hash"][gram], lang[gram], np.maximum(n - d, 0) / total)
            self.arrays[k, 1] = Entries(whole["hash"][context], lang[context],
                                        discount[lang[context]] * whole["types"][context] / whole["n"][context])
        self.uniform = 1.0 / max(1, len(self.arrays[1, 0].hashes))

    @staticmethod
    def _totals(hashes, langs, totals, want, want_lang):
        """The total of each wanted (context, language)."""
        order = np.lexsort((langs, hashes))
        back = np.lexsort((want_lang, want))
        keys = np.rec.fromarrays([np.concatenate([hashes[order], want[back]]), np.concatenate([langs[order], want_lang[back]])])
        _, group = np.unique(keys, return_inverse=True)
        by_group = np.zeros(group.max(initial=-1) + 1)
        by_group[group[:len(order)]] = totals[order]
        out = np.empty(len(want))
        out[back] = by_group[group[len(order):]]
        return out

    def costs(self, grams: list[str]) -> np.ndarray:
        """Bits of the last letter of each gram after its first letters, per language."""
        count, out = len(self.languages), []
        for at in range(0, len(grams), GRAMS_AT_ONCE):
            part = grams[at:at + GRAMS_AT_ONCE]
            p = np.full((len(part), count), self.uniform)
            for size in range(1, ORDER + 1):
                weight = self.arrays[size, 1].find(hashes_of([g[ORDER - size:-1] for g in part]), count)
                share = self.arrays[size, 0].find(hashes_of([g[ORDER - size:] for g in part]), count)
                p = np.where(weight > 0, share + weight * p, p)  # an unseen context says nothing
            out.append(-np.log2(np.maximum(p, 1e-12)).astype(np.float32))
        return np.concatenate(out) if out else np.zeros((0, count), np.float32)


class Scorer:
    """Cross-entropies of texts with bounded tables of grams and words."""

    def __init__(self, models: Models):
        self.models = models
        self._reset()

    def _reset(self):
        self.grams: dict[str, int] = {}
        self.words: dict[str, int] = {}
        self.gram_costs = np.zeros((0, len(self.models.languages)), np.float32)
        self.word_costs = np.zeros((0, len(self.models.languages)), np.float32)

    def score(self, texts: list[str | None]) -> list[tuple[int, np.ndarray]]:
        """Letters scored and their bits, by language, for each text."""
        if len(self.words) + len(self.grams) > min(MAX_HELD, HELD_COSTS // len(self.models.languages)):
            self._reset()
        found, words, new = [words_of(t) if t else [] for t in texts], self.words, []
        for ws in found:
            for w in ws:
                if w not in words:
                    words[w] = len(words)
                    new.append(w)
        if new:
            grams, new_grams, flat, begin = self.grams, [], [], []
            for w in new:
                framed = START * (ORDER - 1) + w + STOP
                begin.append(len(flat))
                for i in range(len(w) + 1):
                    g = framed[i:i + ORDER]
                    k = grams.get(g)
                    if k is None:
                        k = grams[g] = len(grams)
                        new_grams.append(g)
                    flat.append(k)
            if new_grams:
                self.gram_costs = np.concatenate([self.gram_costs, self.models.costs(new_grams)])
            self.word_costs = np.concatenate(
                [self.word_costs, np.add.reduceat(self.gram_costs[np.array(flat)], np.array(begin), axis=0)])
        get = words.__getitem__
        return [(sum(map(len, ws)) + len(ws),
                 self.word_costs[np.fromiter(map(get, ws), np.int64, len(ws))].sum(axis=0, dtype=np.float64)) for ws in found]


def learn(df: DataFrame, text: str = "text", lang: str = "lang") -> Models:
    """Models of all languages in ``lang``, from all rows where it is not null."""
    prepare(df.sparkSession)
    return Models(counted(cut_lineage(gram_counts(df, text, lang))).toArrow())


def predict(df: DataFrame, models: Models, text: str = "text") -> DataFrame:
    """Add ``lang_pred``, ``score``, ``entropy`` (bits a letter) and ``letters``."""
    spark = df.sparkSession
    prepare(spark)
    df = with_columns_replaced(df, "lang_pred", "score", "entropy", "letters")
    at = [c.lower() for c in df.columns].index(text.lower())
    shared = spark.sparkContext.broadcast(models)  # an entry per distinct gram and language: see above

    def run(batches):
        scorer, languages = Scorer(shared.value), shared.value.languages
        for batch in batches:
            for part in slices(batch, at):
                pred, score, entropy, letters = [], [], [], []
                texts = part.column(at).to_pylist()
                for n, bits in scorer.score(texts) if languages else [(0, None)] * len(texts):
                    letters.append(n)
                    if not n:
                        pred.append(UNKNOWN), score.append(0.0), entropy.append(None)
                        continue
                    h = bits / n
                    best = int(np.argmin(h))
                    pred.append(languages[best])
                    score.append(float(1.0 / np.exp2((h[best] - h) * SAMPLE_LETTERS).sum()))
                    entropy.append(float(h[best]))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64()),
                     pa.array(entropy, pa.float64()), pa.array(letters, pa.int64())],
                    names=[*part.schema.names, "lang_pred", "score", "entropy", "letters"])

    return df.mapInArrow(run, T.StructType([
        *df.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
        T.StructField("entropy", T.DoubleType()), T.StructField("letters", T.LongType())]))


def _medians(rows: DataFrame, **classes: Column) -> dict[tuple[str, str], float]:
    """Per predicted language and name the upper edge of the class of width ``CLASS`` that
    holds the median; a task hands on counts per class, a bounded number per language."""
    named = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.floor(c / CLASS).alias("k")) for n, c in classes.items()]))
    counts = rows.select("lang_pred", named.alias("c")).groupBy("lang_pred", "c.name", "c.k").agg(F.count("*").alias("n"))
    held: dict[tuple[str, str], list[tuple[int, int]]] = {}
    for r in counts.collect():
        held.setdefault((r["lang_pred"], r["name"]), []).append((r["k"], r["n"]))
    out = {}
    for key, found in held.items():
        k, n = np.array(sorted(found)).T
        out[key] = float((k[np.searchsorted(2 * np.cumsum(n), n.sum())] + 1) * CLASS)
    return out


def calibrated(scored: DataFrame, learnt: Column, lang: str = "lang", z: float = Z) -> DataFrame:
    """Add ``rejected``; ``learnt`` tells the rows to calibrate on, of which those
    count whose ``lang`` is the predicted one.  ``scored`` is read more than once,
    so it should be a written table."""
    spark = scored.sparkSession
    rows = cut_lineage(scored.filter(learnt & (F.col(lang).cast("string") == F.col("lang_pred"))).select(
        "lang_pred", "entropy", "letters").distinct())  # copies count once
    scored = with_columns_replaced(scored, "rejected")
    center = {k: v for (k, _), v in _medians(rows, center=F.col("entropy")).items()}
    near = rows.join(F.broadcast(spark.createDataFrame(list(center.items()), "__l string, __center double")),  # a row per language
                     F.col("lang_pred") == F.col("__l"))
    far = F.abs(F.col("entropy") - F.col("__center"))
    spread = _medians(near, docs=far, letter=F.log2(F.greatest(far * F.sqrt("letters"), F.lit(1.0))))
    limits = [(k, c, (NORMAL * spread[k, "docs"]) ** 2, (NORMAL * 2 ** spread[k, "letter"]) ** 2) for k, c in center.items()]
    limits = F.broadcast(spark.createDataFrame(limits, "__l string, __center double, __docs double, __letter double"))
    limit = F.col("__center") + z * F.sqrt(F.col("__docs") + F.col("__letter") / F.col("letters"))
    return scored.join(limits, F.col("lang_pred") == F.col("__l"), "left").select(
        *[F.col(f"`{c}`") for c in scored.columns],
        F.coalesce((F.col("lang_pred") == UNKNOWN) | (F.col("entropy") > limit), F.lit(False)).alias("rejected"))


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(5)) == 0


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from four folds of five."""
    docs = table(spark, sf_dir, "documents")
    models = learn(docs.filter(~held_out(F.col("doc_id"))))
    scored = cut_lineage(predict(docs.select("doc_id", "text", "lang"), models).drop("text"))
    return calibrated(scored, ~held_out(F.col("doc_id"))).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "entropy", "rejected")
