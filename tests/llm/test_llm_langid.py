"""Language models against brute-force Kneser-Ney, many languages, clashing columns."""

import random
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from harvestwatch.llm import langid

ORDER = langid.ORDER


def brute(texts):
    """gram -> share of its last letter after the letters before, by interpolated Kneser-Ney."""
    counts = Counter()
    for t in texts:
        for w in langid.words_of(t):
            framed = langid.START * (ORDER - 1) + w + langid.STOP
            counts.update(framed[i:i + ORDER] for i in range(len(w) + 1))
    tables = {ORDER: dict(counts)}
    for size in range(ORDER - 1, 0, -1):
        before = defaultdict(set)
        for g in tables[size + 1]:
            before[g[1:]].add(g[0])
        tables[size] = {g: len(x) for g, x in before.items()}
    discount = {}
    for size, table in tables.items():
        n1, n2 = (sum(n == k for n in table.values()) for k in (1, 2))
        discount[size] = min(0.95, max(0.05, n1 / max(1, n1 + 2 * n2)))

    def share(gram, uniform):
        p = uniform
        for size in range(1, ORDER + 1):
            g, c = gram[ORDER - size:], gram[ORDER - size:-1]
            after = {x: n for x, n in tables[size].items() if x[:-1] == c}
            if after:
                total, d = sum(after.values()), discount[size]
                p = max(after.get(g, 0) - d, 0) / total + d * len(after) / total * p
        return p
    return share, tables[1]


def test_equal_to_brute_force(spark):
    pick = random.Random(4)
    texts = {x: [" ".join("".join(pick.choices(letters, k=pick.randint(1, 6))) for _ in range(12)) for _ in range(6)]
             for x, letters in (("aa", "abcdé"), ("bb", "cdefß你"))}
    rows = [(i, t, x) for i, (x, t) in enumerate((x, t) for x, ts in texts.items() for t in ts)]
    models = langid.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert models.languages == ["aa", "bb"]
    both = {x: brute(ts) for x, ts in texts.items()}
    assert models.uniform == 1 / len(both["aa"][1] | both["bb"][1])
    grams = {(langid.START * 3 + w + langid.STOP)[i:i + ORDER] for ts in texts.values() for t in ts for w in t.split() for i in range(len(w) + 1)}
    grams = sorted(grams) + ["zzzz", "abzz", "\x02\x02\x02z"]
    got = 2.0 ** -models.costs(grams)
    want = [[both[x][0](g, models.uniform) for x in ("aa", "bb")] for g in grams]
    np.testing.assert_allclose(got, want, rtol=1e-5)


def test_many_languages(spark):
    pick = random.Random(5)
    alphabets = [pick.sample("abcdefghijklmnopqrstuvwxyzäöüßéèñçøåæłőğ", 8) for _ in range(90)]
    rows = [(n, " ".join("".join(pick.choices(a, k=5)) for _ in range(30)), f"l{k:02d}") for n, (k, a) in enumerate(
        (k, a) for k, a in enumerate(alphabets) for _ in range(4))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    models = langid.learn(docs)
    assert len(models.languages) == 90
    letters = [*{x for a in alphabets for x in a}, langid.STOP]
    p = 2.0 ** -models.costs([langid.START * 3 + x for x in letters]).astype(float)
    assert np.abs(p.sum(axis=0) - 1).max() < 1e-4  # every language shares out one over all letters
    got = langid.predict(docs, models).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.95 * len(got)


def test_clashing_columns_and_empty_table(spark):
    pick = random.Random(6)
    rows = [(i, " ".join("".join(pick.choices("abcd" if i % 2 else "wxyz", k=4)) for _ in range(20)), "ab" if i % 2 else "yz") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns(
        {c: F.lit("mine") for c in ("rejected", "lang_pred", "score", "entropy", "letters", "n", "gram")})
    models = langid.learn(docs)
    got = langid.calibrated(langid.predict(docs, models), F.lit(True))
    assert got.columns == ["doc_id", "text", "lang", "n", "gram", "lang_pred", "score", "entropy", "letters", "rejected"]
    assert got.filter("rejected").count() == 0 and got.filter("lang = lang_pred").count() == 40
    none = langid.learn(docs.limit(0))
    assert none.languages == []
    assert langid.calibrated(langid.predict(docs, none), F.lit(True)).filter("rejected AND lang_pred = 'und' AND score = 0").count() == 40
    assert langid.calibrated(langid.predict(docs.limit(0), none), F.lit(True)).count() == 0
    same = docs.select("doc_id", "text", F.explode(F.array(F.lit("zz"), F.lit("aa"))).alias("lang"))
    assert {r["lang_pred"] for r in langid.predict(same, langid.learn(same)).collect()} == {"aa"}  # equal entropies
