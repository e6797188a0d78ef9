import random

from podium.llm.splitting import split_long


def pieces(spark, texts, **how):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "k int, body string, piece string")
    out = {}
    for r in split_long(df, ["k"], "body", **how).collect():
        out.setdefault(r.k, []).append(r)
    return {k: sorted(v, key=lambda r: r.piece_no) for k, v in out.items()}


def check(text, rows, limit, overlap):
    assert "".join(r.piece[r.core - r.start :] for r in rows) == text
    at = 0
    for r in rows:
        assert r.core == at and len(r.piece) <= limit and r.core - r.start <= overlap
        assert r.piece == text[r.start : r.start + len(r.piece)]
        at += len(r.piece) - (r.core - r.start)
    assert len(rows) >= 2


def test_whole_and_within_the_limit(spark):
    rnd = random.Random(3)
    words = ["alpha", "beta.", "gamma,", "delta!\n\n", "橋は安全か？", "😀😀", "\n", "e" * 70]
    texts = [" ".join(rnd.choice(words) for _ in range(n)) for n in (3, 30, 100, 400, 3000)] + ["x" * 5000, " " * 2500, "語" * 1001, "😀" * 1500, None, "", "y" * 1000]
    for limit, overlap in ((1000, 100), (50, 10)):
        got = pieces(spark, texts, limit=limit, overlap=overlap)
        for i, t in enumerate(texts):
            if t is None or len(t) <= limit:
                assert i not in got
            else:
                check(t, got[i], limit, overlap)


def test_strong_boundaries_first(spark):
    text = "a" * 400 + ". " + "b" * 100 + "\n\n" + "c" * 100 + ". " + "d" * 700
    rows = pieces(spark, [text])[0]
    assert rows[0].piece.endswith("b\n\n")


def test_repeats_and_nothing(spark):
    df = spark.createDataFrame([(1, "z" * 1200), (1, "z" * 1200)], "k int, body string")
    assert split_long(df, ["k"], "body").count() == 2
    assert split_long(df.limit(0), ["k"], "body").count() == 0
