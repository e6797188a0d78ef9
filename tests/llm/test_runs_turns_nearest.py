import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from podium.llm.nearest import XFastTrie, nearest
from podium.llm.clocks import isotonic, offsets, repaired
from podium.llm.runs import collapse_runs
from podium.llm.turns import clean_utterance, opening_number, speaker_turns, spoken


def brute_runs(rows):
    out = []
    for g in {r[0] for r in rows if r[0] is not None}:
        ordered = sorted((r for r in rows if r[0] == g and None not in (r[1], r[3])), key=lambda r: (r[3], r[1]))
        run = []
        for r in [*ordered, (g, None, object(), None, None)]:
            if run and r[2] != run[-1][2]:
                if run[0][2] is not None:
                    out.append((g, run[0][2], run[0][1], run[-1][1], len(run), run[0][3], max(max(x[3], x[4] or x[3]) for x in run)))
                run = []
            run.append(r)
    return sorted(out)


@pytest.mark.parametrize("chunk", [5, 40, 10_000])
def test_runs_against_brute_force(spark, chunk):
    r = random.Random(chunk)
    rows = [(r.choice("ab"), i, r.choice([1, 1, 1, 2, None]), s := r.randrange(300), r.choice([None, s - 3, s + 4, s + 50])) for i in range(200)]
    rows += [(None, 1, 1, 1, 1), ("a", None, 1, 1, 1), ("a", 999, 1, None, 1)]
    df = spark.createDataFrame([(*x, "x", 3, True) for x in rows], "g string, i int, v int, s bigint, t bigint, text string, chunk int, edge boolean")
    got = collapse_runs(df, F.col("g"), F.col("i"), F.col("v"), F.col("s"), F.col("t"), chunk).collect()
    assert sorted(tuple(x) for x in got) == brute_runs(rows)
    assert collapse_runs(df.limit(0), F.col("g"), F.col("i"), F.col("v"), F.col("s"), F.col("t")).count() == 0


def test_texts_of_runs_stay_in_order(spark):
    rows = [("m", i, 1 if i < 70 else 2, i * 10, i * 10 + 5, f"w{i}") for i in range(100)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "g string, i int, v int, s bigint, t bigint, w string")
    got = collapse_runs(df, F.col("g"), F.col("i"), F.col("v"), F.col("s"), F.col("t"), 100, text=F.col("w")).orderBy("v").collect()
    assert [x.text for x in got] == [" ".join(f"w{i}" for i in range(70)), " ".join(f"w{i}" for i in range(70, 100))]


def test_isotonic_is_the_nearest_monotone_sequence():
    assert isotonic(np.array([1, 3, 2, 4])).tolist() == [1, 3, 3, 4]
    y = np.array([5, 1, 9, 3, 3, 20])
    z = isotonic(y)
    assert (np.diff(z) >= 0).all() and abs(z.sum() - y.sum()) <= 3
    assert isotonic(np.array([], int)).tolist() == []
    r = random.Random(3)
    for _ in range(200):
        y = np.array([r.randrange(30) for _ in range(r.randrange(1, 9))])
        fit = [max(min(y[a : b + 1].mean() for b in range(i, len(y))) for a in range(i + 1)) for i in range(len(y))]
        assert isotonic(y).tolist() == [int(np.floor(f + 0.5)) for f in fit]


def test_clocks_are_repaired_in_bins_as_in_one_piece(spark):
    r = random.Random(9)
    rows, clock = [], 0
    for i in range(600):
        if i == 350:
            clock = 5  # the second file
        clock += r.randrange(30)
        rows.append(("m", 1000 - i, i, max(0, clock - r.choice([0, 0, 0, 15, 40]))))
    rows += [("m", 2000, 601, 777), ("m", 2001, 602, 30), ("n", 1, None, 5), (None, 1, 1, 1), ("n", 2, 1, None)]
    df = spark.createDataFrame([(*x, "x") for x in rows], "g string, id int, pos int, s bigint, fit string")
    for width in (300, 10**6):
        got = {(x.g, x.id): (x.file, x.fit) for x in repaired(df, late=50, fresh=60, pause=100, width=width).collect()}
        want = {("n", 1): (0, 5)}
        for file, part in enumerate((rows[:350], rows[350:602])):
            top, kept = 0, []
            for _, i, _, s in part:
                top = max(top, s)
                if s < top - 50:
                    want["m", i] = (file, s)
                else:
                    kept.append((i, s))
            want |= {("m", i): (file, int(f)) for (i, _), f in zip(kept, isotonic(np.array([s for _, s in kept])), strict=True)}
        assert got == want
    placed = offsets(spark.createDataFrame([("m", 0, 70), ("m", 0, 90), ("m", 1, 40), ("m", 2, 5)], "g string, file bigint, t bigint")).collect()
    assert {x.file: x.offset for x in placed} == {0: 0, 1: 90, 2: 130}


def test_a_clock_that_starts_anew_orders_turns_by_file(spark):
    at = [(1, 10.0), (1, 4000.0), (1, 4010.0), (2, 3.0), (2, 9.0), (1, 11.0), (1, 4005.0)]
    rows = [("m", i, i, s, s + 1, f"SPEAKER_0{n}", "word", None) for i, (n, s) in enumerate(at)]
    df = spark.createDataFrame(rows, "meeting_id string, pos int, segment_id int, start_time double, end_time double, speaker_label string, text string, speaker_name string")
    got = [(x.v, x.first_id, x.last_id, x.start) for x in sorted(speaker_turns(df, clocks=True).collect(), key=lambda x: x.start)]
    assert got == [(1, 0, 2, 10_000), (2, 3, 4, 4_014_000), (1, 5, 6, 4_022_000)]


def test_trie_finds_neighbours():
    r = random.Random(6)
    for size in (1, 2, 50, 400):
        keys = np.array(sorted(r.sample(range(3000), size)))
        trie = XFastTrie(keys)
        q = np.array([r.randrange(-10, 9000) for _ in range(500)])
        before, after = trie.around(q)
        assert (before == np.searchsorted(keys, q, side="right") - 1).all()
        assert (after == np.searchsorted(keys, q, side="left")).all()


def test_nearest_against_brute_force(spark):
    r = random.Random(8)
    left = [(r.choice("ab"), i, r.randrange(-50, 400)) for i in range(80)] + [("c", 1, 5), (None, 2, 5), ("a", None, 5), ("a", 700, None)]
    right = [(r.choice("ab"), i, r.randrange(-50, 400)) for i in range(60)] + [("a", 500, 77), ("a", 501, 77)]
    a = spark.createDataFrame([(*x, 1) for x in left], "g string, id int, point bigint, side int")
    b = spark.createDataFrame([(*x, "s") for x in right], "g string, id int, point bigint, shard string")
    want = set()
    for g, i, p in left:
        near = min(((abs(p - y), j) for h, j, y in right if h == g), default=None) if None not in (g, i, p) else None
        if near and near[0] <= 6:
            want.add((g, i, near[1]))
    for shard in (10, 64, 10_000):
        got = nearest(a, b, 6, shard).collect()
        assert len(got) == len(want) and {tuple(x) for x in got} == want
    assert nearest(a.limit(0), b, 6).count() == 0 and nearest(a, b.limit(0), 6).count() == 0


def test_utterances(spark):
    said = {
        "[00:01:02] >> Speaker 7 - Uh, we er, heard (coughs) you.": ("we heard you.", 7, True),
        "[gavel]": ("", None, False), "Uhm, er...": ("", None, False), "00:01:02.003 --> ♪ ♪": ("", None, False), "Aye.": ("Aye.", None, True), "SPEAKER_O3: [laughter]": ("", 3, False),
        "a. b. smith: {sighs}": ("a. b. smith:", None, False), "D. R. Jones: Present.": ("Present.", None, True), "[Speaker 12] Nay.": ("Nay.", 12, True), "Umbrella stands": ("Umbrella stands", None, True), "": ("", None, False), None: (None, None, False),
        "e-er I-um yes": ("yes", None, True), "<00:00:01.000> <crosstalk> {sighs} uh": ("", None, False), "uh " * 20000: ("", None, False), "[music plays " + "on and on " * 30 + "]": ("", None, False), "(thank you)": ("(thank you)", None, True), "(long applause from the public gallery)": ("", None, False),
    }
    df = spark.createDataFrame([(k,) for k in said], "t string")
    rows = df.select("t", clean_utterance(F.col("t")).alias("c"), opening_number(F.col("t")).alias("n"), spoken(F.col("t")).alias("s")).collect()
    assert {r.t: (r.c, r.n, r.s) for r in rows} == said


def test_said_is_what_the_cleaning_leaves(spark):
    r = random.Random(2)
    bits = ["[00:01:02]", "00:01:02.003 -->", "-->", ">>", "–", "SPEAKER_07:", "Speaker 7 -", "[Speaker 12]", "Spkr 3", "Ann Smith:", "Mayor:", "note:", "I move:", "uh", "er...", "hmm", "[gavel]", "(coughs)", "((bell))", "♪", "(laughs", "*", "yes", "So", "Harm", "7", "10:30", "?"]
    texts = sorted({" ".join(r.choice(bits) for _ in range(r.randrange(1, 5))) for _ in range(5000)})
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", clean_utterance(F.col("t")).alias("c"), spoken(F.col("t")).alias("s")).collect()
    assert [x for x in rows if x.s != any(k.isalnum() for k in x.c)] == []


def test_turns(spark):
    rows = [
        ("m", 1, 0.0, 2.0, "SPEAKER_01", "Hello", "Ann"), ("m", 2, 2.0, None, "s1", "[gavel]", None), ("m", 3, 3.0, 2.5, None, "Speaker 1: still me", None), ("m", 4, 4.0, 5.0, "UNKNOWN", "me too", " ANN "),
        ("m", 5, 6.0, 7.0, "", "who?", "Bob"), ("m", 6, 8.0, 9.0, "SPEAKER_1", "back", None), ("m", 6, 8.0, 9.0, "Spkr 1", "back", None), ("m", 7, None, 9.0, "SPEAKER_1", "no time", None), (None, 8, 1.0, 2.0, "SPEAKER_1", "x", None),
    ]
    df = spark.createDataFrame(rows, "meeting_id string, segment_id int, start_time double, end_time double, speaker_label string, text string, speaker_name string").withColumn("edge", F.lit(7))
    got = sorted(speaker_turns(df, with_text=True).collect(), key=lambda r: r.start)
    assert [(r.v, r.first_id, r.last_id, r.n, r.text) for r in got] == [(1, 1, 4, 3, "Hello still me me too"), (1, 6, 6, 1, "back")]
    assert got[0].end == 5000
    assert speaker_turns(df.limit(0)).count() == 0
