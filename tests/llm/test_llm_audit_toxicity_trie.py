"""Filter audit, toxicity and the conversation trie against brute force and DuckDB."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from harvestwatch.llm import audit, toxicity, trie
from harvestwatch.llm.queries import oracle_sql, queries

SF = "/root/testdata/sf0.001"
INSULTS = ["oaf", "churl", "knave"]


@pytest.mark.parametrize("name", ["op11_audit", "op13_trie"])
def test_against_sql(spark, name):
    got = queries()[name](spark, SF).toPandas()
    con = duckdb.connect()
    for t in ("documents", "conversations", "labels"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.execute(oracle_sql()[name]).df()
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    as_rows = lambda d: sorted(map(tuple, d[cols].astype(object).where(d[cols].notna(), None).astype(str).to_numpy().tolist()))
    assert [[x.removesuffix(".0") for x in r] for r in as_rows(got)] == [[x.removesuffix(".0") for x in r] for r in as_rows(want)]


# -- filter audit ---------------------------------------------------------------

def test_ranks_and_intervals():
    assert [audit.rank(o) for o in audit.ORDERS] == list(range(120))
    for mask in range(32):
        at = defaultdict(list)
        for step, begin, end in audit.intervals(mask):
            for r in range(begin, end):
                at[r].append(step)
        for r, order in enumerate(audit.ORDERS):
            first = [s for s, a in enumerate(order) if mask >> "ABCDE".index(a) & 1][:1]
            assert at[r] == first


def brute_audit(docs, labels):
    first = {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    good, toxic = ({i for i, *m in labels if m[k] == 1} for k in (0, 1))
    parts = defaultdict(list)
    for i, t, s in docs:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {a for a, bad in zip("ABCDE", (
            len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            bool(re.search(r"[#$%&*|]", t)), i is not None and i > first[t]), strict=True) if bad}
        parts[s or ""].append((fails, i in good, i in toxic))
    out = set()
    for part, rows in parts.items():
        lines, share = [], defaultdict(int)
        for order in map("".join, itertools.permutations("ABCDE")):
            left = rows
            for step, a in enumerate(order, 1):
                gone = [r for r in left if a in r[0]]
                left = [r for r in left if a not in r[0]]
                share[a] += len(gone)
                lines.append((order, step, len(left), len(gone), sum(a in r[0] for r in rows) - len(gone), sum(r[0] == {a} for r in rows),
                              sum(r[1] for r in gone), sum(r[2] for r in gone)))
        out |= {(part, *x, share[x[0][x[1] - 1]]) for x in lines}
    return out


def test_audit_edges(spark):
    long = " ".join(f"w{i}" for i in range(300))
    docs = [(1, None, "a"), (2, "", "a"), (3, long, "b"), (4, long, None), (4, long, None), (5, long + " #", ""), (6, "UPPER " * 250, "b"),
            (None, long, "b"), (None, long, "b"), (7, "x" * 100_000, "a"), (8, "  \x1f é😀 A", "b"), (9, long.upper(), "hot"),
            *[(100 + i, long, "hot") for i in range(50)], (10, " \t\n", "a"), (2, long, "a")]
    labels = [(1, 1, 1), (2, 1, None), (3, 0, 1), (3, 1, 0), (100, 1, 1), (101, 1, 0), (None, 1, 1), (999, 1, 1)]
    d = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumns(
        {c: F.lit("clash") for c in ("part", "mask", "digest", "n", "good", "first")})
    m = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("n", F.lit(7))
    got = audit.audit(d, m).collect()
    assert len(got) == 600 * len({s or "" for *_, s in docs})
    assert {tuple(r) for r in got} == brute_audit(docs, labels)
    assert audit.audit(d.limit(0), m).count() == 0
    assert audit.audit(d, m.limit(0)).agg(F.sum("good_lost")).first()[0] == 0


# -- toxicity -------------------------------------------------------------------

def toxic_docs(n, seed=1):
    pick = random.Random(seed)
    vocabulary = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnrst"]
    rows, marks = [], []
    for i in range(n):
        sentences = [" ".join(pick.choices(vocabulary, k=8)) for _ in range(pick.randint(1, 6))]
        bad = pick.random() < 0.2
        if bad:
            at = pick.randrange(len(sentences))
            sentences[at] = f"{sentences[at]} you {pick.choice(INSULTS)}"
        rows.append((i, ". ".join(s.capitalize() for s in sentences) + "."))
        if pick.random() < 0.7:
            marks.append((i, 1, int(bad)))
    return rows, marks, {i for i, t in rows if any(f" {w}" in t for w in INSULTS)}


def test_toxicity_held_out_and_places(spark):
    rows, marks, bad = toxic_docs(1500)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    learnt = ~toxicity.held_out(F.col("doc_id"))
    model = toxicity.learn(docs, spark.createDataFrame(marks, "doc_id long, quality int, toxic int"), learnt)
    got = {r["doc_id"]: r for r in toxicity.predict(docs, model).collect()}
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum(got[i]["predicted"] == (i in bad) for i in held) >= 0.98 * len(held)
    texts = dict(rows)
    for i in bad:
        assert any(w in texts[i][got[i]["worst_start"]:got[i]["worst_end"]] for w in INSULTS)
    found = toxicity.offending(docs, model).collect()
    assert {r["doc_id"] for r in found if any(w in r["sentence"] for w in INSULTS)} == bad
    assert all(r["sentence"] == texts[r["doc_id"]][r["sentence_start"]:r["sentence_end"]] for r in found)


def test_toxicity_gradient():
    """The step sums are the derivative of the likelihood of noisy-or."""
    import pyarrow as pa
    rng = np.random.default_rng(3)
    sizes = [[1, 2], [], [3]]
    words = [[0, 1, 2], [], [0, 1, 3]]
    y, n, blank = np.array([1.0, 0.0, 0.5]), np.array([1.0, 0.5, 2.0]), np.array([2, 3, 0])
    batch = pa.RecordBatch.from_arrays(
        [pa.array(y), pa.array(n), pa.array(blank), pa.array(sizes, pa.list_(pa.int32())), pa.array(words, pa.list_(pa.int32()))],
        names=["y", "weight", "blank", "sizes", "words"])

    def loss(v):
        total = 0.0
        for k in range(3):
            at, z = 0, [v[4]] * int(blank[k])
            for s in sizes[k]:
                z.append(v[4] + sum(v[words[k][at + j]] for j in range(s)))
                at += s
            p = 1 - np.prod([1 - 1 / (1 + np.exp(-x)) for x in z])
            total -= n[k] * (y[k] * np.log(p) + (1 - y[k]) * np.log(1 - p))
        return total

    v = rng.normal(size=5)
    got = toxicity.step_sums(batch, v[4], v[:4])[:5]
    want = [(loss(v + e) - loss(v - e)) / 2e-6 for e in np.eye(5) * 1e-6]
    assert np.allclose(got, want, atol=1e-5)


def test_toxicity_edges(spark):
    rows, marks, bad = toxic_docs(400, 2)
    bad_text = next(t for i, t in rows if i in bad)
    edge = [(5000, None), (5001, ""), (5002, " \n!?"), (5003, "123 456"), (None, bad_text), (None, None), (5004, "a" * 100_000),
            (5005, "dal " * 50_000), (1, rows[1][1]), (5006, "ΣΑΣ İ 你好。好！")]
    docs = spark.createDataFrame(rows + edge, "doc_id long, text string").withColumns(
        {"score": F.lit("mine"), "predicted": F.lit("mine"), "y": F.lit(1), "weight": F.lit(2), "digest": F.lit(3), "word": F.lit(4)})
    labels = spark.createDataFrame(marks + [(None, 1, 1), (2, 1, None), (marks[0][0], 0, 1 - marks[0][2])], "doc_id long, quality int, toxic int")
    model = toxicity.learn(docs, labels, F.lit(True))
    got = toxicity.predict(docs, model)
    assert got.columns == ["doc_id", "text", "y", "weight", "digest", "word", "score", "predicted", "n_offending", "worst_start", "worst_end"]
    got = got.collect()
    assert len(got) == len(rows) + len(edge)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    for r in got:
        if not r["text"] or not re.search(r"[^\W\d_]", r["text"]):
            assert (r["score"], r["predicted"], r["n_offending"], r["worst_start"]) == (0.0, 0, 0, None)
    assert [r["predicted"] for r in got if r["doc_id"] is None and r["text"]] == [1]
    few = toxicity.learn(docs, labels, F.lit(True), max_train=100)
    assert few.weights.keys() <= {w for _, t in rows for w in re.findall(r"[a-z]+", t.lower())}
    for nothing in (labels.limit(0), labels.filter("toxic = 0")):
        none = toxicity.predict(docs, toxicity.learn(docs, nothing, F.lit(True)))
        assert none.agg(F.max("score")).first()[0] < 0.01
    assert toxicity.predict(docs.limit(0), model).count() == 0


# -- trie -----------------------------------------------------------------------

def brute_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            key = (turn is not None, turn or 0, role or "", hashlib.md5((text or "").encode()).hexdigest())
            own[c].append((key, role or "", text or ""))
    own = {c: [x[1:] for x in sorted(v, key=lambda x: x[0])] for c, v in own.items()}
    members, made = defaultdict(list), {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        made[c] = own.get(base, [])[:h] + own[c][h:]
        for d in range(len(made[c]) + 1):
            members[tuple(made[c][:d])].append(c)
    below = defaultdict(list)
    for k in members:
        for d in range(len(k) + 1):
            below[k[:d]].append(k)
    inner = {k[:-1] for k in members if k}
    cost = {k: (len(v) - 1) * len(k[-1][1].encode()) if k else 0 for k, v in members.items()}
    children = defaultdict(int)
    for k in members:
        if k:
            children[k[:-1]] += 1
    return {(min(v), len(k), min(members[k[:-1]]) if k else None, len(v), children[k], sum(x not in inner for x in below[k]),
             sum(cost[x] for x in below[k]),
             hashlib.sha256(",".join(str(c) for c in sorted(v) if len(made[c]) == len(k)).encode()).hexdigest())
            for k, v in members.items()}


TURNS = "conv_id long, turn long, role string, text string"


def check_trie(spark, rows):
    df = spark.createDataFrame(rows, TURNS).withColumns(
        {c: F.lit("clash") for c in ("rank", "slice", "n", "h", "base", "bytes", "pos", "depth", "k1", "digest", "weight")})
    got = [tuple(r) for r in trie.prefix_trie(df).collect()]
    want = brute_trie(rows)
    assert len(got) == len(want)
    assert set(got) == want


def conversations(seed, n, most, roles=("user", "assistant"), texts=("a", "b", "é€", "")):
    pick = random.Random(seed)
    return [(c, k, pick.choice(roles), pick.choice(texts)) for c in pick.sample(range(5 * n), n) for k in range(pick.randint(1, most))]


def test_trie_edges(spark):
    rows = conversations(1, 60, 12)
    rows += [(None, 0, "user", "x"), (None, 1, None, None), (1001, None, None, None), (1001, None, "user", "z"), (1001, 1, "user", None),
             (1001, 1, "user", "y"), (1001, 1, "user", "y"), (1004, 0, "user", "x" * 50_000), (-7, 0, "user", "a"), (-5, 0, "user", "b")]
    rows += [(2000 + c, k, "user", "same") for c in range(40) for k in range(4)]
    check_trie(spark, rows)
    assert trie.prefix_trie(spark.createDataFrame([], TURNS)).count() == 0
    check_trie(spark, [(None, 0, "user", "x"), (3, 0, "user", "only")])


def test_trie_rounds_of_centroids(spark, monkeypatch):
    """Components far over the limit: a long conversation, one that leaves it midway,
    a first turn that many share; with small slices, blocks and pieces."""
    monkeypatch.setattr(trie, "LIMIT", 12)
    monkeypatch.setattr(trie, "BLOCK", 7)
    monkeypatch.setattr(trie, "IDS_PER_PIECE", 3)
    monkeypatch.setattr(trie, "ROWS_AT_ONCE", 5)
    rows = [(10, k, "user", "chain") for k in range(70)]
    rows += [(11 + 5 * j, k, "user", "chain" if k < 40 else f"fork{j}") for j in range(3) for k in range(55)]
    rows += [(200 + c, k, "user", "hot" if k == 0 else random.Random(c * 9 + k).choice("pq")) for c in range(60) for k in range(5)]
    check_trie(spark, rows)


@pytest.mark.parametrize("seed", range(3))
def test_subtree_sums(seed):
    rng = np.random.default_rng(seed)
    n = 400
    shape = [lambda i: i - 1, lambda i: int(rng.integers(0, i)), lambda i: max(0, i - int(rng.integers(1, 6)))][seed]
    parent = np.array([-1 if i == 0 or (seed == 1 and i % 50 == 0) else shape(i) for i in range(n)])
    depth = np.zeros(n, np.int64)
    for i in range(n):
        depth[i] = 0 if parent[i] < 0 else depth[parent[i]] + 1
    x = rng.integers(0, 100, (n, 2))
    want = x.copy()
    for i in np.argsort(-depth):
        if parent[i] >= 0:
            want[parent[i]] += want[i]
    mixed = rng.permutation(n)  # any order of the rows
    back = np.argsort(mixed)
    moved = np.array([-1 if parent[i] < 0 else back[parent[i]] for i in mixed])
    assert (trie.subtree_sums(moved, depth[mixed], x[mixed]) == want[mixed]).all()
