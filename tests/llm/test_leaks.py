import random

from pyspark.sql import functions as F

from podium.llm import leaks


def text(r, n):
    return [f"{r.choice('bcdfglmnprst')}{r.choice('aeiou')}{r.choice('bcdfglmnprst')}{r.choice('aeiou')}{r.randrange(9)}" for _ in range(n)]


def test_planted_passages(spark):
    r = random.Random(2)
    items = [(i, " ".join(text(r, 60)), "t") for i in range(20)] + [(50, None, "t"), (51, "too short", "t"), (3, None, "x")]
    words = [i[1].split() if i[1] else [] for i in items]
    docs, want = [], set()
    for d in range(60):
        body = text(r, 120)
        n = [0, 11, 12, 30][d % 4]
        k = d % 20
        at = r.randrange(0, 60 - n)
        body[50:50] = [w.upper() if d % 3 == 0 else w for w in words[k][at : at + n]]
        docs.append((d, (" ,\n" if d % 2 else " ").join(body), 1))
        if n >= 12:
            want.add((d, k))
    docs += [(100, None, 1), (101, "", 1), (102, "Überführung " + " ".join(words[0][:12]).replace("a", "á"), 1), (0, docs[0][1], 2), (None, " ".join(words[0]), 1), (103, " ".join(text(r, 20000) + words[5][:12]), 1)]
    want |= {(102, 0), (103, 5)}
    d = spark.createDataFrame(docs, "doc_id bigint, text string, run int")
    i = spark.createDataFrame(items, "item_id bigint, text string, shared string")
    for block in (2000, 7):
        got = leaks.leaks(d, i, rank=64, block=block).where(F.col("run") >= 12).select("doc_id", "item_id").collect()
        assert len(got) == len(want) and {tuple(x) for x in got} == want
    assert leaks.leaks(d.limit(0), i).count() == 0 and leaks.leaks(d, i.limit(0)).count() == 0


def test_a_run_of_light_words_among_heavy_ones(spark):
    """An excerpt that a third of all documents hold, in text that shares nothing else with the items."""
    r = random.Random(4)
    items = [(i, " ".join(text(r, 60)), "t") for i in range(20)]
    excerpt = items[3][1].split()[20:32]
    docs = [(d, " ".join([*text(r, 40), *(excerpt if d % 3 == 0 else []), *text(r, 40)]), 1) for d in range(3000)]
    d, i = spark.createDataFrame(docs, "doc_id bigint, text string, run int"), spark.createDataFrame(items, "item_id bigint, text string, shared string")
    for least in (0, 12):
        got = leaks.leaks(d, i, rank=64, least_run=least).where(F.col("run") >= 12).select("doc_id", "item_id").collect()
        assert {tuple(x) for x in got} == {(k, 3) for k in range(0, 3000, 3)}


def test_pieces():
    assert leaks.words("L’Été à 3,5 ﬁx") == ["l", "ete", "a", "3", "5", "fix"]
    assert leaks.common_subsequence("a b c d".split(), "x a c y d".split()) == 3
    assert leaks.common_run("a b c d".split(), "b c z c d".split()) == 2
    for n in range(1, 80):
        s = leaks.starts(n, 24)
        assert all(any(k <= at and at + 12 <= k + 24 for k in s) for at in range(n - 11))


def test_runs_of_words_that_all_documents_hold(spark):
    """Excerpts of words found in nearly every document, set between rare words."""
    r = random.Random(6)
    common = text(r, 40)
    items = [(i, " ".join(r.choice(common) for _ in range(60)), "t") for i in range(20)]
    want, docs = set(), []
    for d in range(400):
        body = text(r, 40) + r.sample(common, 40) + text(r, 40)
        if d < 20:
            n = 12 + d % 5
            at = r.randrange(60 - n)
            body = text(r, 60) + items[d][1].split()[at : at + n] + text(r, 60)
            want.add((d, d))
        docs.append((d, " ".join(body), 1))
    d, i = spark.createDataFrame(docs, "doc_id bigint, text string, run int"), spark.createDataFrame(items, "item_id bigint, text string, shared string")
    got = {tuple(x) for x in leaks.leaks(d, i, rank=64, least_run=12).where(F.col("run") >= 12).select("doc_id", "item_id").collect()}
    assert want <= got


def test_paraphrases_are_found(spark):
    """Items retold with a quarter of their words replaced, some dropped and some swapped, inside other text."""
    r = random.Random(8)
    pool = text(r, 3000)
    items = [(i, " ".join(r.choice(pool) for _ in range(60)), "t") for i in range(60)]

    def retold(words):
        out = [r.choice(pool) if r.random() < 0.25 else w for w in words if r.random() > 0.05]
        for k in range(0, len(out) - 1, 9):
            out[k], out[k + 1] = out[k + 1], out[k]
        return out

    docs = [(d, " ".join([r.choice(pool) for _ in range(150)] + (retold(items[d % 60][1].split()) if d < 200 else []) + [r.choice(pool) for _ in range(150)]), 1) for d in range(600)]
    d, i = spark.createDataFrame(docs, "doc_id bigint, text string, run int"), spark.createDataFrame(items, "item_id bigint, text string, shared string")
    got = {tuple(x) for x in leaks.kinds(leaks.leaks(d, i)).select("doc_id", "item_id").collect()}
    want = {(k, k % 60) for k in range(200)}
    print("paraphrases: recall", len(got & want) / len(want), "precision", len(got & want) / max(1, len(got)))
    assert len(got & want) >= 0.9 * len(want) and len(got & want) >= 0.98 * len(got)
