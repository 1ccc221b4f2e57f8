"""Substring dedup by relative Lempel-Ziv parsing (operator 8).

Removes every word covered by a window of ``WINDOW`` words that also starts
earlier (in a document of smaller id, or earlier in the same document).

The index holds anchors: in every window of ``WINDOW`` words the run of
``ANCHOR`` words with the least hash, and the first and last run of a text.
Anchors that occur again refer to an earlier occurrence, their reference.  A
document is factored greedily against its references: anchors at one distance
from the same reference text, each reaching the next, form a factor that equals
the reference word by word, and all windows inside are duplicates.  At factor
boundaries (windows that hold an anchor seen elsewhere but lie in no factor) the
windows themselves are compared with all others of that kind.  A window that
also starts earlier holds, like its earliest equal, an anchor seen elsewhere, so
nothing is missed; equality is that of 64-bit hashes of words.

Scale: three passes over the texts and two shuffles of them by document; the
first index carries an anchor per five to six words as packed arrays, one row per task and
bucket.  Equal hashes of one task are settled there: its first occurrence
travels, the others refer to it.  So a passage in a third of all documents sends
one entry per task, and no group of occurrences is ever gathered.

Defined results: a null text has no words; a text under ``WINDOW`` words loses
none; a null ``doc_id`` counts as the smallest; every row is a document of its
own: rows that share a ``doc_id`` come in the order of their texts' digests, and
of fully repeated rows one is the first and the others are its copies; clashing
columns are replaced, other columns stay; an empty table gives no rows.  Only if
an id repeats are the rows sorted and written once more, with a key each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import cut_lineage, prepare, slices, table, with_columns_replaced
from ._words import Words

WINDOW, ANCHOR = 20, 11
REACH = WINDOW - ANCHOR + 1  # runs of ANCHOR words in a window
HELD = 1_000_000
BUCKETS_PER_PARTITION = 4
SMALLEST = -(1 << 63)
OPEN = np.dtype([("hash", "<u8"), ("doc", "<i8"), ("pos", "<i4"), ("again", "?")])
ANCHOR_REF = np.dtype([("doc", "<i8"), ("pos", "<i4"), ("ref_doc", "<i8"), ("ref_pos", "<i4"), ("has_ref", "?")])
SPAN = np.dtype([("doc", "<i8"), ("begin", "<i4"), ("end", "<i4")])  # starts of duplicate windows


def anchor_flags(words: Words) -> np.ndarray:
    """Which word starts an anchor."""
    out = np.zeros(len(words.hash), bool)
    inside = words.fits(WINDOW)
    if not len(inside):
        return out
    grams = words.grams(ANCHOR)
    least, span = grams, 1
    while span < REACH:
        step = min(span, REACH - span)
        least, span = np.minimum(least[:-step], least[step:]), span + step
    for k in range(REACH):
        out[k:k + len(inside)] |= inside & (grams[k:k + len(inside)] == least[:len(inside)])
    counts = np.diff(words.first)
    long = np.flatnonzero(counts >= WINDOW)
    out[words.first[long]] = True
    out[words.first[long + 1] - ANCHOR] = True
    return out


def settle(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sort occurrences by (hash, doc, pos).  Returns them, the index of the
    first of each one's hash, and whether each lies strictly after that first."""
    entries = entries[np.lexsort((entries["pos"], entries["doc"], entries["hash"]))]
    new = np.ones(len(entries), bool)
    new[1:] = entries["hash"][1:] != entries["hash"][:-1]
    first = np.maximum.accumulate(np.where(new, np.arange(len(entries)), 0))
    later = (entries["doc"] != entries["doc"][first]) | (entries["pos"] != entries["pos"][first])
    return entries, first, later


def _references(entries, first, some) -> np.ndarray:
    out = np.zeros(int(some.sum()), ANCHOR_REF)
    own, head = entries[some], entries[first[some]]
    out["doc"], out["pos"], out["ref_doc"], out["ref_pos"] = own["doc"], own["pos"], head["doc"], head["pos"]
    out["has_ref"] = (own["doc"] != head["doc"]) | (own["pos"] != head["pos"])
    return out


def _spans(doc, begin, end) -> np.ndarray:
    out = np.zeros(len(doc), SPAN)
    out["doc"], out["begin"], out["end"] = doc, begin, end
    return out


def _pack(open_: np.ndarray, settled: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Rows (bucket, open entries, settled entries)."""
    at = ((open_["hash"] >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(at, kind="stable")
    at, open_ = at[order], open_[order]
    cuts = np.append(np.flatnonzero(np.diff(at, prepend=-1)), len(at))
    rows = [(int(at[i]), open_[i:j].tobytes(), b"") for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
    for k, i in enumerate(range(0, len(settled), 4096)):
        part = settled[i:i + 4096]
        rows.append(((int(part["doc"][0]) + k) % buckets, b"", part.tobytes()))
    columns = list(zip(*rows, strict=True)) or [(), (), ()]
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.binary())],
        names=["bucket", "open", "settled"])


PACKED = "bucket int, open binary, settled binary"


def _entries(hashes, docs, positions) -> np.ndarray:
    out = np.zeros(len(hashes), OPEN)
    out["hash"], out["doc"], out["pos"] = hashes, docs, positions
    return out


def _anchors(buckets: int):
    def close(held):
        entries, first, later = settle(np.concatenate(held))
        again = np.zeros(len(entries), bool)
        np.logical_or.at(again, first, np.arange(len(entries)) != first)
        heads = np.arange(len(entries)) == first
        entries["again"] = again
        return _pack(entries[heads], _references(entries, first, ~heads), buckets)

    def run(batches):
        held, n = [], 0
        for batch in batches:
            for part in slices(batch, 1, 1 << 22):
                words = Words(part.column(1))
                at = np.flatnonzero(anchor_flags(words))
                rows = words.doc[at]
                docs = part.column(0).to_numpy(zero_copy_only=False)[rows]
                held.append(_entries(words.grams(ANCHOR)[at] if len(at) else [], docs, at - words.first[rows]))
                n += len(at)
                if n > HELD:
                    yield close(held)
                    held, n = [], 0
        if n:
            yield close(held)

    return run


def _gather(batches, kind: np.dtype):
    open_, settled = [np.zeros(0, OPEN)], [np.zeros(0, kind)]
    for b in batches:
        open_ += [np.frombuffer(x, OPEN) for x in b.column("open").to_pylist() if x]
        settled += [np.frombuffer(x, kind) for x in b.column("settled").to_pylist() if x]
    return np.concatenate(open_), np.concatenate(settled)


def _batches(rows: np.ndarray):
    for i in range(0, len(rows), 100_000):
        part = rows[i:i + 100_000]
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(part[c])) for c in rows.dtype.names],
                                         names=list(rows.dtype.names))


def _index(batches):
    """Anchors that occur again, with an earlier occurrence where there is one."""
    open_, settled = _gather(batches, ANCHOR_REF)
    if len(open_):
        entries, first, _ = settle(open_)
        again = entries["again"].copy()
        shared = first != np.arange(len(entries))
        again[shared] = True
        again[first[shared]] = True
        settled = np.concatenate([settled, _references(entries, first, again)])
    yield from _batches(settled)


def _factors(buckets: int):
    """Spans inside factors, and the windows at factor boundaries."""

    def close(held, spans):
        entries, first, later = settle(np.concatenate(held))
        heads = np.arange(len(entries)) == first
        spans.append(_spans(entries["doc"][later], entries["pos"][later], entries["pos"][later] + 1))
        return _pack(entries[heads], np.concatenate(spans), buckets)

    def parse(part):
        words = Words(part.column(1))
        refs = part.column(2)
        n = np.diff(refs.offsets.to_numpy())
        row = np.repeat(np.arange(len(part)), n)
        flat = refs.flatten()
        pos, ref_doc, ref_pos = (flat.field(c).to_numpy(zero_copy_only=False) for c in (0, 1, 2))
        has = flat.field(3).to_numpy(zero_copy_only=False)
        docs = part.column(0).to_numpy(zero_copy_only=False)
        total = len(words.hash)
        near = np.zeros(total + 1, np.int32)
        begin = words.first[row]
        np.add.at(near, begin + np.maximum(0, pos - REACH + 1), 1)
        np.add.at(near, begin + pos + 1, -1)
        # factors: one row, one reference text, one distance, each anchor reaching the next
        order = np.lexsort((pos, (ref_pos - pos), ref_doc, row))
        order = order[has[order]]
        r, p, d, s = row[order], pos[order], ref_doc[order], ref_pos[order] - pos[order]
        fresh = np.ones(len(order), bool)
        fresh[1:] = (r[1:] != r[:-1]) | (d[1:] != d[:-1]) | (s[1:] != s[:-1]) | (p[1:] - p[:-1] > ANCHOR)
        head = np.flatnonzero(fresh)
        tail = np.append(head[1:], len(order)) - 1 if len(head) else head
        ends = p[tail] + ANCHOR - WINDOW + 1
        enough = ends > p[head]
        fr, fb, fe = r[head][enough], p[head][enough], ends[enough]
        inner = np.zeros(total + 1, np.int32)
        np.add.at(inner, words.first[fr] + fb, 1)
        np.add.at(inner, words.first[fr] + fe, -1)
        fits = words.fits(WINDOW)
        check = np.flatnonzero(fits & (np.cumsum(near)[:len(fits)] > 0) & (np.cumsum(inner)[:len(fits)] == 0))
        rows = words.doc[check]
        hashes = words.grams(WINDOW)[check] if len(check) else []
        return _entries(hashes, docs[rows], check - words.first[rows]), _spans(docs[fr], fb, fe)

    def run(batches):
        held, spans, n = [], [], 0
        for batch in batches:
            for part in slices(batch, 1, 1 << 22):
                entries, found = parse(part)
                held.append(entries)
                spans.append(found)
                n += len(entries) + len(found)
                if n > HELD:
                    yield close(held, spans)
                    held, spans, n = [], [], 0
        if n:
            yield close(held, spans)

    return run


def _duplicates(batches):
    open_, spans = _gather(batches, SPAN)
    entries, _, later = settle(open_)
    found = _spans(entries["doc"][later], entries["pos"][later], entries["pos"][later] + 1)
    yield from _batches(np.concatenate([spans, found]))


def with_keys(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Add ``__doc``, a number of each row's own that ascends with ``doc_id`` (nulls
    first), then the digest of the text: the id itself, if no id repeats."""
    df = df.withColumn("__doc", F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(SMALLEST)))
    if df.groupBy("__doc").count().filter("count > 1").isEmpty():
        return df
    # the place in the input parts fully repeated rows, so that many are dealt out too
    df = df.withColumn("__at", F.monotonically_increasing_id())
    df = df.orderBy("__doc", F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))), "__at").drop("__at")
    return cut_lineage(df.withColumn("__doc", F.monotonically_increasing_id()))


def duplicate_spans(df: DataFrame, text: str = "text") -> DataFrame:
    """(doc, begins, ends): the starts of each row's duplicate windows, by ``__doc``."""
    spark = df.sparkSession
    buckets = BUCKETS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = df.select(F.col("__doc").alias("doc"), F.col(text).alias("text"))
    refs = docs.mapInArrow(_anchors(buckets), PACKED).repartition("bucket").mapInArrow(
        _index, "doc long, pos int, ref_doc long, ref_pos int, has_ref boolean")
    refs = refs.groupBy("doc").agg(F.collect_list(F.struct("pos", "ref_doc", "ref_pos", "has_ref")).alias("refs"))
    spans = docs.join(refs, "doc").select("doc", "text", "refs").mapInArrow(_factors(buckets), PACKED).repartition(
        "bucket").mapInArrow(_duplicates, "doc long, begin int, end int")
    return spans.groupBy("doc").agg(F.collect_list("begin").alias("begins"), F.collect_list("end").alias("ends"))


def dedup(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Add ``n_words``, ``n_removed`` and ``kept_text`` (kept words joined by one space)."""
    prepare(df.sparkSession)
    df = with_columns_replaced(df, "n_words", "n_removed", "kept_text", "__doc", "__at", "__begins", "__ends")
    keyed = with_keys(df, doc_id, text)
    spans = cut_lineage(duplicate_spans(keyed, text))
    df.sparkSession.sparkContext._jvm.System.gc()  # else the shuffle files behind it stay until the driver collects garbage
    spans = spans.select(F.col("doc").alias("__key"), F.col("begins").alias("__begins"), F.col("ends").alias("__ends"))
    joined = keyed.join(spans, keyed["__doc"] == spans["__key"], "left").select(
        *[keyed[c] for c in df.columns], "__begins", "__ends")
    at, n = [c.lower() for c in df.columns].index(text.lower()), len(df.columns)

    def run(batches):
        for batch in batches:
            for part in slices(batch, at, 1 << 22):
                words = Words(part.column(at))
                counts, total = np.diff(words.first), len(words.hash)
                change = np.zeros(total + 1, np.int32)
                begins, ends = part.column(n), part.column(n + 1)
                row = np.repeat(np.arange(len(part)), begins.value_lengths().fill_null(0).to_numpy())
                b, e = (x.flatten().to_numpy(zero_copy_only=False) for x in (begins, ends))
                np.add.at(change, words.first[row] + b, 1)
                np.add.at(change, words.first[row] + e + WINDOW - 1, -1)
                kept = np.cumsum(change)[:total] == 0
                kept_counts = np.bincount(words.doc[kept], minlength=len(part))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:n], pa.array(counts, pa.int64()), pa.array(counts - kept_counts, pa.int64()),
                     words.joined(kept)], names=[*part.schema.names[:n], "n_words", "n_removed", "kept_text"])

    return joined.mapInArrow(run, T.StructType([
        *df.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
        T.StructField("kept_text", T.StringType())]))


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the words of windows seen earlier."""
    return dedup(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


OP8_SQL = r"""
WITH w AS (SELECT doc_id, [x FOR x IN string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS ws
           FROM documents),
g AS (SELECT doc_id, s, md5(array_to_string(ws[s:s+19], ' ')) AS h
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS s FROM w WHERE len(ws) >= 20)),
d AS (SELECT doc_id, s FROM g QUALIFY row_number() OVER (PARTITION BY h ORDER BY doc_id, s) > 1),
c AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS p FROM d),
k AS (SELECT doc_id, list(p) AS ps FROM c GROUP BY doc_id),
u AS (SELECT doc_id, unnest(ws) AS x, generate_subscripts(ws, 1) AS p FROM w),
t AS (SELECT u.doc_id, string_agg(x, ' ' ORDER BY p) AS kept FROM u ANTI JOIN c ON u.doc_id = c.doc_id AND u.p = c.p
      GROUP BY u.doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k ON w.doc_id = k.doc_id LEFT JOIN t ON w.doc_id = t.doc_id
"""
