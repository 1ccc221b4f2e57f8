"""The ten operators against brute force, the tokenizers library and DuckDB on small tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm_helpers import brute_substrings, unlearnt_texts

from harvestwatch.llm import bpe, chat, embeddings, jaccard, langid, packing, quality, sharding, substrings, urls
from harvestwatch.llm._words import Words
from harvestwatch.llm.queries import oracle_sql, queries

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, ids string, node int, shard int"
EDGE = ["", None, " \t\n", "one", "a b c d", "a " * 30000, "x" * 20000, "Ünïcode ß Σ 你好 😀 <|endoftext|> it's 12",
        "\n".join(["same line"] * 40), "same line\n" * 40]


def edge_docs(spark):
    rows = [(i, t, "en" if i % 2 else None, "s" if i % 3 else None, 1, "z", 3, 4) for i, t in enumerate(EDGE)]
    rows += [rows[5], rows[5], (None, "null id " * 30, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


@pytest.mark.parametrize("name", ["op2_quality", "op3_chat", "op6_jaccard", "op8_substrings", "op10_embeddings"])
def test_against_sql(spark, name):
    got = queries()[name](spark, SF).toPandas()
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.execute(oracle_sql()[name]).df()
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    as_rows = lambda d: sorted(map(tuple, d[cols].astype(str).to_numpy().tolist()))
    assert as_rows(got) == as_rows(want)


def tokenizer():
    tokenizers = pytest.importorskip("tokenizers")
    return tokenizers.Tokenizer.from_file(bpe.default_path())


def test_bpe_equals_the_library(spark):
    tok = tokenizer()
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(
        edge_docs(spark).select("doc_id", "text"))
    for r in bpe.encode(docs, decoded="decoded").collect():
        e = tok.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["ids"] == e and r["decoded"] == tok.decode(e, skip_special_tokens=False)
    again = bpe.decode(bpe.encode(docs)).select("text", "decoded").first()
    assert again["decoded"] == tok.decode(tok.encode(again["text"], add_special_tokens=False).ids, skip_special_tokens=False)


def test_bpe_random_strings():
    tok, b = tokenizer(), bpe.load(bpe.default_path())
    rng = np.random.default_rng(3)
    pool = list("abeinrsthzöéßΣσİ’' \t\x85　你ﬁ²½१0123#$<|>-_́")
    for _ in range(3000):
        s = "".join(rng.choice(pool, rng.integers(0, 40)))
        assert b.encode([s])[0].tolist() == tok.encode(s, add_special_tokens=False).ids


def test_op1_digests(spark):
    tok = tokenizer()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in queries()["op1_bpe"](spark, SF).collect():
        ids = tok.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def check_packing(rows, tokens, capacity):
    seqs, docs = defaultdict(list), defaultdict(list)
    for r in rows:
        seqs[r["sequence_id"]].append(r)
        docs[r["doc_id"]].append(r)
    used = padding = 0
    for pieces in seqs.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
        used += at
        padding += 0 if at & (at - 1) == 0 else capacity - at
    assert padding <= 0.02 * used
    for doc, ids in tokens.items():
        at = 0
        for r in sorted(docs[doc], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            piece = np.array(ids[at:at + r["length"]], "<u4")
            if "ids_crc32" in r.asDict():
                assert r["ids_crc32"] == zlib.crc32(piece.tobytes())
            at += r["length"]
        assert at == len(ids)


def test_packing(spark):
    tok = tokenizer()
    tokens = {r["doc_id"]: tok.encode(r["text"] or "", add_special_tokens=False).ids + [1]
              for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    check_packing(queries()["op4_packing"](spark, SF).collect(), tokens, 2048)
    edge = edge_docs(spark).filter("doc_id != 5")
    tokens = {r["doc_id"]: tok.encode(r["text"] or "", add_special_tokens=False).ids + [1] for r in edge.collect()}
    check_packing(packing.pack(edge).collect(), tokens, 2048)
    assert packing.pack(edge.limit(0)).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 3, 1023, 1500, 2047, 2048, 5000])
def test_cuts_are_class_lengths(n):
    got = packing.cuts(n, 2048)
    assert sum(got) == n and all(2048 // (2048 // c) == c for c in got)


def test_quality_hosts_and_edges(spark):
    good = " ".join(f"w{i}" for i in range(80))
    rows = [(i, good, "good") for i in range(40)] + [(100 + i, "short", "bad") for i in range(35)]
    rows += [(200 + i, good, "bad") for i in range(5)] + [(300, good, None), (301, None, None), (302, "", "good")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r["doc_id"]: r["kept"] for r in quality.judge(quality.with_counts(df)).collect()}
    assert kept[0] and kept[300] and not kept[301] and not kept[302] and not kept[100] and not kept[200]
    assert len(kept) == len(rows)
    r = quality.with_counts(spark.createDataFrame([(1, "a b c x a b c", "s")], "doc_id int, text string, source string")).first()
    assert (r["n_words"], r["n_repeat_words"]) == (7, 6)
    assert quality.judge(quality.with_counts(df.limit(0))).count() == 0
    assert quality.judge(quality.with_counts(edge_docs(spark))).count() == len(EDGE) + 3


def test_chat_round_trip(spark):
    rows = [(1, 0, "user", "</s>[INST] \\ x\\"), (1, 1, "assistant", "a\\\\</s>]<s>["), (1, 2, "we]ird</s>", "x"),
            (2, 0, None, None), (2, 0, "assistant", "tie"), (None, None, "assistant", ""), (3, 1, "user", "\n" * 50)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.format_conversations(df).withColumn("turns", chat.parse(F.col("formatted"))).collect()
    got = {r["conv_id"]: [(t["role"], t["text"]) for t in r["turns"]] for r in out}
    assert got[1] == [(r[2], r[3]) for r in rows[:3]]
    assert got[2] == [("", ""), ("assistant", "tie")] and got[None] == [("assistant", "")]
    assert got[3] == [("user", "\n" * 50)]
    assert chat.format_conversations(df.limit(0)).count() == 0


def test_url_rules(spark):
    rows = [(1, "http://A.B.COM/x?q"), (2, "https://example.com/en/1"), (3, "http://www.example.com/en/2#t"),
            (4, "http://a.net/es/1"), (5, "http://a.net/en/1"), (6, None), (7, "no scheme"), (8, "http://netcom"), (9, "")]
    df = spark.createDataFrame(rows, "page_id long, url string")
    got = {r["page_id"]: r for r in urls.judge(df).collect()}
    assert [got[i]["rule"] for i in range(1, 10)] == [
        "com/", "example.com/en/", "www.example.com/en/", "net/es/", None, None, None, None, None]
    assert got[1]["host"] == "a.b.com" and got[1]["path"] == "/x" and got[6]["host"] == "" and got[7]["path"] == ""
    assert all(got[i]["verdict"] in ("allow", "block") for i in got) and got[2]["verdict"] == "block"
    assert urls.judge(df.limit(0)).count() == 0
    assert {r["verdict"] for r in urls.judge(df.filter("page_id > 4")).collect()} == {"allow"}
    hot = spark.range(3000).select("id", F.when(F.col("id") < 2000, "http://a.net/es/1").otherwise(
        F.concat(F.lit("http://b.com/"), "id")).alias("url")).withColumnRenamed("id", "page_id")
    got = Counter(r["verdict"] for r in urls.judge(hot, max_train=300).collect())
    assert got == {"block": 2000, "allow": 1000}


def test_langid(spark):
    rows = queries()["op7_langid"](spark, SF).join(
        spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.95 and all(0 <= r["score"] <= 1 for r in rows)
    assert sum(r["rejected"] for r in rows) <= 0.02 * len(rows)
    edge = edge_docs(spark)
    got = [r["lang_pred"] for r in langid.predict(edge, langid.learn(edge)).collect()]
    assert got[:3] == ["und"] * 3 and set(got) == {"und", "en"}
    assert set(r["lang_pred"] for r in langid.predict(edge, langid.learn(edge.filter("lang = 'xx'"))).collect()) == {"und"}


def test_langid_probabilities_sum_to_one(spark):
    df = spark.createDataFrame([("abab ba cab", "x")], "text string, lang string")
    m = langid.learn(df)
    letters = ["a", "b", "c", langid.STOP]
    context = langid.START * 2 + "a"
    assert abs(np.exp2(-m.costs([context + x for x in letters]))[:, 0].sum() - 1) < 1e-6


def test_langid_rejects_a_third_of_unlabelled_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    n = docs.count()
    junk = spark.createDataFrame([(10**6 + i, t, None) for i, t in enumerate(unlearnt_texts(n // 2))], docs.schema)
    both = docs.unionByName(junk)
    scored = langid.cut_lineage(langid.predict(both, langid.learn(both)))
    got = langid.calibrated(scored, F.lit(True)).collect()
    assert all(r["rejected"] for r in got if r["doc_id"] >= 10**6)
    assert sum(r["rejected"] for r in got if r["doc_id"] < 10**6) <= 0.02 * n


def test_langid_copies_do_not_narrow_the_limit(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    one = docs.filter("lang = 'en' and length(text) > 500").orderBy("doc_id").limit(1)
    both = docs.unionByName(one.crossJoin(spark.range(2 * docs.count())).select((F.col("id") + 10**6).alias("doc_id"), "text", "lang"))
    scored = langid.cut_lineage(langid.predict(both, langid.learn(docs)))
    got = langid.calibrated(scored, F.lit(True)).collect()
    assert sum(r["rejected"] for r in got) <= 0.02 * docs.count()


def test_sharding(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = queries()["op9_sharding"](spark, SF).collect()
    counts = Counter(r["shard"] for r in rows)
    assert sum(counts.values()) == docs.count() and max(counts.values()) - min(counts.values()) <= 1
    for s in counts:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(counts[s]))
    hot = spark.createDataFrame([(7, "t")] * 900 + [(None, None)] * 5, "doc_id long, text string")
    got = Counter(r["shard"] for r in sharding.assign(hot, "doc_id", 8).collect())
    assert len(got) == 8 and max(got.values()) - min(got.values()) <= 1
    assert sharding.assign(hot.limit(0), "doc_id", 8).count() == 0
    third = spark.range(30000).select((F.when(F.col("id") % 3 > 0, F.col("id"))).alias("doc_id"))
    cells = sharding.salted(third.withColumn("__slot", F.pmod(F.xxhash64("doc_id"), F.lit(sharding.SLOTS)).cast(
        "int")).withColumn("__row", F.monotonically_increasing_id())).groupBy("__slot", "__salt").count().collect()
    assert sum(r["count"] for r in cells) == 30000 and max(r["count"] for r in cells) < 30
    nodes = sharding.ring(8)
    alone = sharding.plan([(s, 0, 1) for s in range(0, 4096, 8)], 8, slack=100.0)
    own = sharding.owners(nodes, [1] * 8)
    assert all(p[4] == own[p[0]] for p in alone)  # with room everywhere each slot has its first node


def test_substrings_brute_force(spark):
    rng = np.random.default_rng(5)
    vocab = [f"w{i}" for i in range(400)]
    passage = list(rng.choice(vocab, 60))
    docs = []
    for i in range(60):
        words = list(rng.choice(vocab, rng.integers(0, 150)))
        if i % 3 == 0:
            at, a = int(rng.integers(0, len(words) + 1)), int(rng.integers(0, 30))
            words[at:at] = passage[a:a + int(rng.integers(15, 40))]
        if i % 7 == 0:
            words += ["ha"] * 70
        docs.append((i, " ".join(words) if i % 4 else "\n".join(words) + "  "))
    docs += [(100, docs[3][1]), (101, docs[3][1]), (102, None), (103, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    want = brute_substrings(docs)
    got = substrings.dedup(df).collect()
    assert {r["doc_id"]: r["kept_text"] for r in got} == {i: " ".join(w) for i, w in want.items()}
    assert substrings.dedup(edge_docs(spark)).count() == len(EDGE) + 3
    assert substrings.dedup(df.limit(0)).count() == 0


def test_substrings_repeated_ids(spark):
    rng = np.random.default_rng(6)
    vocab = [f"w{i}" for i in range(300)]
    passage = " ".join(rng.choice(vocab, 30))
    fresh = lambda n: " ".join(rng.choice(vocab, n))
    ids = [None, None, None, None, 1, 1, 1, 2, 2, 3]
    texts = [f"{passage} {fresh(40)}", f"{passage} {fresh(60)}", fresh(50), None,
             f"{fresh(7)} {passage} {fresh(50)}", fresh(90), fresh(80), f"{passage} {fresh(20)}", fresh(70), fresh(45)]
    docs = list(zip(ids, texts, strict=True)) + [(3, texts[-1])] * 3 + [(None, texts[2]), (4, texts[5])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = df.withColumn("at", F.xxhash64(F.coalesce("text", F.lit("")))).repartition(5)
    inputs = sorted(((substrings.SMALLEST if r["doc_id"] is None else r["doc_id"], r["at"], r["text"]) for r in rows.collect()),
                    key=lambda r: r[:2])
    want = brute_substrings([(k, r[2]) for k, r in enumerate(inputs)])
    want = sorted((r[0], r[1], " ".join(want[k])) for k, r in enumerate(inputs))
    got = substrings.dedup(rows).collect()
    assert sorted((substrings.SMALLEST if r["doc_id"] is None else r["doc_id"], r["at"], r["kept_text"]) for r in got) == want


def test_jaccard_hot_group_and_edges(spark):
    rng = np.random.default_rng(6)
    base = [f"t{i}" for i in rng.integers(0, 10000, 200)]
    docs = [(i, " ".join([*base[:190], f"own{i}"])) for i in range(60)] + [(500 + i, " ".join(base)) for i in range(40)]
    docs += [(900, "a b"), (901, "a b"), (902, None), (903, ""), (904, ""), (905, "a c")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard.near_duplicates(df).collect()}
    assert all(got[i] == (0, 99) for i, _ in docs[:100])
    assert got[900] == (900, 1) and got[901] == (900, 1) and got[905] == (905, 0)
    assert got[902] == (902, 0) and got[903] == (903, 0) and got[904] == (904, 0)
    assert jaccard.near_duplicates(edge_docs(spark)).count() == len(EDGE) + 3
    assert jaccard.near_duplicates(df.limit(0)).count() == 0


def test_jaccard_in_blocks(spark, monkeypatch):
    docs = [(i, " ".join([*map(str, range(100)), f"own{i}"])) for i in range(50)]
    monkeypatch.setattr(jaccard, "LIMIT", 12)
    got = jaccard.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {(r["class_id"], r["n_links"]) for r in got} == {(0, 49)}


def test_embeddings_edges(spark, monkeypatch):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [0.0, 0.0], 1), (5, None, 1),
            (6, [1.0, nan], 1), (7, [1.0, inf], 1), (8, [1.0, 0.0], None), (9, [1.0, None], 1), (10, [], 1),
            (11, [1.0, 0.0], 1), (12, [1.0, 0.0, 0.0], 1), (13, [0.0, 1.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embeddings.near_duplicates(df).collect()}
    assert got.pop(1) == got.pop(2) == got.pop(11) == (2, 1)
    assert all(v == (0, k) for k, v in got.items())
    assert embeddings.near_duplicates(df.limit(0)).count() == 0
    far = [(1, [1e300, 1e299]), (2, [2e300, 2e299]), (3, [1e-300, 1e-301]), (4, [-1e300, 1e299]), (5, [5e-324, 0.0])]
    far = spark.createDataFrame([(*r, 1) for r in far], "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embeddings.near_duplicates(far).collect()}
    assert got == {1: (3, 1), 2: (3, 1), 3: (3, 1), 4: (0, 4), 5: (3, 1)}
    monkeypatch.setattr(embeddings, "LIMIT", 10)
    rng = np.random.default_rng(1)
    near = [(i, (np.ones(8) + 0.01 * rng.standard_normal(8)).tolist(), 1) for i in range(40)]
    got = embeddings.near_duplicates(spark.createDataFrame(near, "vec_id long, embedding array<float>, label int")).collect()
    assert {(r["n_links"], r["component_id"]) for r in got} == {(39, 0)}


def test_word_hashes():
    words = Words(pa.array(["a bb  a", None, "", " bb", "a bb"]))
    assert words.first.tolist() == [0, 3, 3, 3, 4, 6]
    assert words.hash[0] == words.hash[2] == words.hash[4] and words.hash[1] == words.hash[3] != words.hash[0]
    assert words.joined(np.array([1, 0, 1, 1, 0, 1], bool)).to_pylist() == ["a a", "", "", "bb", "bb"]
