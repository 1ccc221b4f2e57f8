"""The corpus pipeline on a small table, against its stages by brute force."""

import tempfile
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

import corpus_pipeline
from llm_helpers import brute_near_duplicates, brute_substrings, unlearnt_texts

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = {r["doc_id"]: r for r in docs.collect()}
    some = next(r for r in first.values() if r["lang"] == "en" and 100 < len(r["text"].split()) < 400)
    more = [(10**6, None), (10**6 + 1, ""), (10**6 + 2, some["text"]), (10**6 + 3, some["text"]), (10**6 + 3, some["text"]),
            (10**6 + 4, " ".join(sorted(set(some["text"].split()))) + " " + some["text"] * 300)]  # null, empty, copies, a long text
    docs = docs.unionByName(spark.createDataFrame([(i, t, some["lang"], some["source"], len(t or "")) for i, t in more], docs.schema))
    docs = docs.withColumns({"score": F.lit("mine"), "kept": F.lit(1), "rejected": F.lit(2), "digest": F.lit("d"), "class_key": F.lit("c")})
    tables = []
    for name, stage in corpus_pipeline.STAGES:
        path = f"{tempfile.mkdtemp()}/{name}"
        stage(spark, docs, SF).write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        if name != "pack":
            assert docs.dtypes == before.dtypes
        tables.append(docs)
    counts = [t.count() for t in tables]
    total = len(first) + len(more)
    rows = [[(r["doc_id"], r["text"]) for r in t.select("doc_id", "text").collect()] for t in tables[:4]]
    assert not {10**6, 10**6 + 1} & {i for i, _ in rows[0]}  # no letter: rejected
    for i, text in rows[1]:  # what quality keeps passes its base rule
        words = text.split()
        windows = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
        twice = {w for w, n in Counter(windows).items() if n > 1}
        inside = {k + j for k, w in enumerate(windows) if w in twice for j in range(3)}
        assert len(words) >= 50 and 100 * len(inside) <= 50 * len(words)
    assert {i for i, _ in rows[2]} == brute_near_duplicates(rows[1]) and len(rows[2]) == len({i for i, _ in rows[2]})
    assert total >= counts[0] >= counts[1] >= counts[2] == counts[3] > 0 and counts[0] >= 0.95 * total
    before, after = ({r["doc_id"]: r["text"] for r in t.collect()} for t in tables[2:4])
    for i, words in brute_substrings(sorted(before.items())).items():
        assert after[i].split() == words
    pieces = tables[4].collect()
    assert {r["doc_id"] for r in pieces} == set(after)
    held = defaultdict(list)
    for r in pieces:
        held["doc", r["doc_id"]].append((r["start"], r["length"], r["doc_tokens"]))
        held["seq", r["sequence_id"]].append((r["offset"], r["length"]))
    for (kind, _), found in held.items():  # documents are cut and sequences filled without a gap
        ends = 0
        for at, n, *rest in sorted(found):
            assert at == ends and n > 0
            ends += n
        assert ends == rest[0] if kind == "doc" else ends <= 2048


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_language_of_few_documents_is_learnt(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    ids = [i for i in range(10**6, 10**6 + 200) if zlib.crc32(str(i).encode()) % 5 == 0][:7] + [None]
    few = spark.createDataFrame([(i, t, "xx") for i, t in zip(ids, unlearnt_texts(8), strict=True)], docs.schema)
    kept = corpus_pipeline.language_id(spark, docs.unionByName(few), SF)
    assert kept.filter("lang = 'xx'").count() == 8
