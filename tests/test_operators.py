import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from podium.functions.labels import speaker_number
from podium.operators.components import components
from podium.operators.ordered import dense_index, islands, running_sum, with_next, with_previous
from podium.operators.overlap import overlapping
from podium.operators.pairs import similar_pairs
from podium.operators.periods import periods_and_gaps
from podium.plans.people import lookup, ratio, slug_of, surname
from podium.plans.render import roll_call_markdown, votes_markdown


def test_speaker_number(spark):
    cases = {"SPEAKER_07": 7, " SPEAKER_90": 90, "[SPEAKER_91]": 91, "SPEAKER_O9": 9, "S91": 91, "spk9": 9, "Spkr 12": 12, "SPEAKER 008": 8, "SPK-31": 31, "speaker": None, "UNKNOWN": None, "SPEAKER_??": None, "": None, None: None, "SPEAKER_103": 103, "9" * 30: None}
    rows = spark.createDataFrame([(k,) for k in cases], "l string").select("l", speaker_number("l").alias("n")).collect()
    assert {r.l: r.n for r in rows} == cases


def test_times_that_are_none(spark):
    from podium.sources.tables import millis

    df = spark.createDataFrame([(1.2345,), (float("nan"),), (float("inf"),), (-3.0,), (1e18,), (None,), (0.0,), (1_700_000_000.25,)], "s double")
    assert [r.m for r in df.select(millis("s").alias("m")).collect()][1:] == [None, None, -3000, None, None, 0, 1_700_000_000_250]


def brute_periods(rows):
    by = defaultdict(list)
    for g, e, s, t in rows:
        if None not in (g, e, s, t) and t > s:
            by[g, e].append((s, t))
    out = set()
    for (g, e), spans in by.items():
        merged = []
        for s, t in sorted(spans):
            if merged and s <= merged[-1][1]:
                merged[-1][1], merged[-1][2] = max(merged[-1][1], t), merged[-1][2] + 1
            else:
                merged.append([s, t, 1])
        out |= {(g, e, 0, s, t, n) for s, t, n in merged}
        out |= {(g, e, 1, a[1], b[0], 0) for a, b in zip(merged, merged[1:])}
    return out


@pytest.mark.parametrize("shard", [7, 50, 100_000])
def test_periods_against_brute_force(spark, shard):
    r = random.Random(shard)
    rows = [(r.choice(["m", "n"]), r.choice([1, 2, None]), s := r.randrange(400), r.choice([s - 1, s, s + r.randrange(1, 30), s + 90, None])) for _ in range(160)]
    rows += rows[:5] + [(None, 1, 1, 5), ("m", 1, None, 5)]
    df = spark.createDataFrame([(*x, "k", 1) for x in rows], "g string, e int, s bigint, t bigint, kind string, shard int")
    got = periods_and_gaps(df, F.col("g"), F.col("e"), F.col("s"), F.col("t"), shard).collect()
    assert len(got) == len({tuple(x) for x in got}) and {tuple(x) for x in got} == brute_periods(rows)
    assert periods_and_gaps(df.limit(0), F.col("g"), F.col("e"), F.col("s"), F.col("t")).count() == 0


def test_periods_of_intervals_of_all_lengths(spark):
    r = random.Random(12)
    rows = [("m", r.choice([1, 2, 3]), s := r.randrange(-10**6, 10**7), s + r.choice([3, 40, 3000, 10**4, 3 * 10**6])) for _ in range(300)] + [("m", 1, 1_700_000_000_000, 1_700_000_005_000), ("m", 3, -5, 1_700_000_000_000)]
    df = spark.createDataFrame(rows, "g string, e int, s bigint, t bigint")
    got = periods_and_gaps(df, F.col("g"), F.col("e"), F.col("s"), F.col("t"), 10_000).collect()
    assert len(got) == len({tuple(x) for x in got}) and {tuple(x) for x in got} == brute_periods(rows)


def test_containers_come_back():
    from podium.operators.periods import decode, encode

    s, t, n = np.array([105, 120, 7, 9]), np.array([110, 130, 8, 19]), np.array([1, 2, 0, 3])
    coded = encode(s, t, n, np.array([0, 2, 4]), np.array([100, 0]))
    assert [x.tolist() for x in decode(coded.to_pylist(), np.array([100, 0]))] == [[0, 0, 1, 1], s.tolist(), t.tolist(), n.tolist()]


def test_ordered_operators_across_chunks(spark):
    n = 50
    df = spark.createDataFrame([(k, i * 3, (i * 7) % 5) for k in ("a", "b") for i in range(n)], "k string, pos int, v int")
    rows = dense_index(df, ["k"], "pos", "i", tie="v", width=10)
    assert [r.i for r in rows.where("k = 'a'").orderBy("pos").collect()] == list(range(n))
    before = with_previous(rows, ["k"], "i", ["v"], width=8).where("k = 'b'").orderBy("i").collect()
    assert [r.prev_v for r in before] == [None, *[r.v for r in before][:-1]]
    after = with_next(rows, ["k"], "i", ["v"], 4, width=8).where("k = 'b'").orderBy("i").collect()
    assert [[x.v for x in r.following] for r in after] == [[x.v for x in after[i + 1 : i + 5]] for i in range(n)]
    total = running_sum(rows, ["k"], ["i"], F.col("v"), "s", width=8).where("k = 'a'").orderBy("i").collect()
    assert [r.s for r in total] == [sum(x.v for x in total[: i + 1]) for i in range(n)]
    marked = islands(rows, ["k"], "i", F.col("v") == 0, width=8).where("k = 'a'").orderBy("i").collect()
    assert [r.island for r in marked] == [sum(x.v == 0 for x in marked[: i + 1]) for i in range(n)]


def test_turns_fold_as_a_loop_does(spark):
    from podium.plans.sequences import merge_turns

    r = random.Random(4)
    rows, t = [], 0
    for i in range(300):
        t += r.choice([0, 200, 500, 900])
        rows.append(("m", i, r.choice("AB"), t, t + r.choice([100, 3000])))
    df = spark.createDataFrame(rows, "meeting_id string, idx bigint, label string, start_ms bigint, end_ms bigint")
    got = merge_turns(df, 500, F.col("label")).groupBy("island").agg(F.min_by("start_ms", "idx").alias("s"), F.max_by("end_ms", "idx").alias("e")).orderBy("island").collect()
    want = []
    for _, _, label, s, e in rows:
        if want and want[-1][0] == label and s - want[-1][2] < 500:
            want[-1][2] = e
        else:
            want.append([label, s, e])
    assert [(x.s, x.e) for x in got] == [(s, e) for _, s, e in want]


def test_overlaps_against_brute_force(spark):
    r = random.Random(1)
    a = [("m", i, s := r.randrange(500), s + r.randrange(0, 200)) for i in range(60)]
    b = [("m", i, s := r.randrange(500), s + r.randrange(0, 200)) for i in range(60)]
    left = spark.createDataFrame(a, "m string, i int, l_start bigint, l_end bigint")
    right = spark.createDataFrame(b, "m string, j int, r_start bigint, r_end bigint")
    got = [(x.i, x.j) for x in overlapping(left, right, "m", bucket=37).collect()]
    want = {(x[1], y[1]) for x in a for y in b if x[2] < y[3] and y[2] < x[3] and x[3] > x[2] and y[3] > y[2]}
    assert len(got) == len(set(got)) and set(got) == want


def test_overlaps_of_intervals_of_all_lengths(spark):
    r = random.Random(2)
    span = lambda i: ("m", i, s := r.randrange(10**7), s + r.choice([100, 5000, 9 * 10**4, 3 * 10**6, 10**9]))
    a, b = [span(i) for i in range(60)], [span(i) for i in range(60)]
    left = spark.createDataFrame(a, "m string, i int, l_start bigint, l_end bigint")
    right = spark.createDataFrame(b, "m string, j int, r_start bigint, r_end bigint")
    got = [(x.i, x.j) for x in overlapping(left, right, "m", bucket=500).collect()]
    want = {(x[1], y[1]) for x in a for y in b if x[2] < y[3] and y[2] < x[3]}
    assert len(got) == len(set(got)) and set(got) == want


def test_components_against_union_find(spark):
    r = random.Random(2)
    edges = [(r.randrange(60), r.randrange(60)) for _ in range(40)] + [(100 + i, 101 + i) for i in range(40)] + [(5, 5)]
    nodes = list(range(150))
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    got = components(spark.createDataFrame(edges, "a bigint, b bigint"), spark.createDataFrame([(n,) for n in nodes], "node bigint")).collect()
    assert {x.node: x.component for x in got} == {n: find(n) for n in nodes}


def test_pairs_in_blocks(spark):
    r = random.Random(3)
    rows = [("g", i, [r.gauss(0, 1) for _ in range(3)]) for i in range(80)] + [("g", 99, [0.0, 0.0, 0.0]), ("g", 98, None), ("h", 1, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "g string, k bigint, v array<double>")
    some = {(x.a, x.b) for x in similar_pairs(df, "g", "k", "v", 0.9, block=16).collect()}
    whole = {(x.a, x.b) for x in similar_pairs(df, "g", "k", "v", 0.9).collect()}
    assert some == whole and len(some) > 20


def test_names(spark):
    import pandas as pd

    assert ratio(pd.Series(["hartmont", "tide", "diet"]), pd.Series(["hratmont", "diet", "tide"])).tolist() == [0.875, 0.25, 0.5]
    df = spark.createDataFrame([("Council Member Jane Adams",), ("Mayor",), ("Jane",), (" Clerk  O'Neil ",)], "n string")
    rows = df.select(surname(F.col("n")).alias("s"), slug_of(F.col("n")).alias("g")).collect()
    assert [r.s for r in rows] == ["Adams", "Mayor", "Jane", "O'Neil"]
    assert [r.g for r in rows] == ["adams_council", "mayor", "jane", "o'neil"]


def test_names_in_phrases(spark):
    from podium.plans.people import best_of, name_candidates

    said = [("A", "Councilmember Jane Adams?"), ("B", "Here."), ("A", "The chair recognizes Mayor Peter Quill"), ("C", "Thank you"), ("C", "I am Clerk Ana Ruiz speaking"), ("A", "Commissioner Lee, go on"), ("D", "ok"), ("D", "Speaking as the city attorney"), ("A", "Councilmember Thank You?"), ("D", "")]
    rows = [("m", i, i, label, text) for i, (label, text) in enumerate(said)]
    found = name_candidates(spark.createDataFrame(rows, "meeting_id string, segment_id int, idx bigint, label string, text string"))
    assert sorted((r.idx, r.target, r.name, r.method) for r in found.collect()) == [(0, "B", "Jane Adams", "roll_call"), (2, "C", "Peter Quill", "chair_recognition"), (4, "C", "Ana Ruiz", "self_identification"), (5, "D", "Lee", "name_addressing"), (7, "D", "Attorney", "title_context")]
    assert {r.label: (r.name, r.confidence) for r in best_of(found).collect()} == {"B": ("Jane Adams", 0.95), "C": ("Peter Quill", 0.92), "D": ("Lee", 0.8)}


def test_roster_tiers(spark):
    members = spark.createDataFrame([(1, 0, "President Okoro", 0, "Okoro"), (1, 0, "President Okoro", 1, "Ines Okoro"), (1, 1, "Clerk Hartmont", 0, "Hartmont"), (1, 2, "Mayor None", None, None)], "roster_id int, member_ord int, name string, alias_ord int, alias string")
    names = spark.createDataFrame([(1, n) for n in ("president okoro", "OKORO", "Ms Okoro", "Mr Hratmont", "mayor none", " Zed ")], "roster_id int, name string")
    got = {r.name: (r.corrected, r.tier) for r in lookup(names, members).collect()}
    assert got == {"president okoro": ("President Okoro", 1), "OKORO": ("President Okoro", 2), "Ms Okoro": ("President Okoro", 3), "Mr Hratmont": ("Clerk Hartmont", 4), "mayor none": ("Mayor None", 1), " Zed ": ("Zed", 0)}


def test_answers_as_markdown(spark):
    df = spark.createDataFrame([('x {"present": ["A", "B"], "absent": []} y',), ("none",), ("{broken}",), (None,)], "a string")
    assert [r.m for r in df.select(roll_call_markdown(F.col("a")).alias("m")).collect()][:3] == ["**Present:** A, B\n**Absent:** None", "_Roll call data could not be extracted._", "_Roll call data could not be parsed._"]
    v = spark.createDataFrame([('{"votes": [{"result": "passed", "yea": ["A"], "nay": []}]}',), ("{}",)], "a string").select(votes_markdown(F.col("a")).alias("m")).collect()
    assert v[0].m == "**Motion** — PASSED\nYea: A\n" and v[1].m == ""


def test_models_answer_in_batches_and_in_order(spark):
    from podium.operators.model import ask, ask_in_order
    from podium.plans.render import name_answers

    prompts = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k bigint, p string")
    answers = ask(prompts, "k", "p", lambda ps: [f'ok {{"name": "{p.upper()}"}}' if p != "b" else '{"name": "null"}' for p in ps])
    assert sorted((r.key, r.name) for r in name_answers(answers).collect()) == [(1, "A"), (3, "C")]

    def broken(ps):
        raise ValueError

    assert all(r.answer is None for r in ask(prompts, "k", "p", broken).collect())

    def poisoned(ps):
        if "b" in ps:
            raise ValueError
        return ps

    assert {r.key: r.answer for r in ask(prompts, "k", "p", poisoned).collect()} == {1: "a", 2: None, 3: "c"}
    rows = spark.createDataFrame([("m", i, f"q{i}") for i in (2, 0, 1)], "m string, o bigint, p string")
    got = ask_in_order(rows, "m", "o", "p", lambda p, known: f"{p}:{len(known)}").orderBy("ord").collect()
    assert [r.answer for r in got] == ["q0:0", "q1:1", "q2:2"]


def test_a_query_set_in_blocks_scores_as_a_whole(spark):
    from podium.operators.pairs import query_scores

    r = random.Random(5)
    vec = lambda: [r.gauss(0, 1) for _ in range(4)]
    q = spark.createDataFrame([(f"q{i}", vec()) for i in range(9)], "label string, v array<double>")
    b = spark.createDataFrame([(i, vec()) for i in range(50)], "ord bigint, v array<double>")
    whole = {(x.label, x.ord) for x in query_scores(q, b, 0.5).collect()}
    assert whole == {(x.label, x.ord) for x in query_scores(q, b, 0.5, block=4, width=7).collect()} and whole
    best = query_scores(q, b, 0.0, best_only=True, block=4, width=7).groupBy("label").agg(F.max("score").alias("s"))
    top = query_scores(q, b, 0.0).groupBy("label").agg(F.max("score").alias("s"))
    assert {x.label: round(x.s, 9) for x in best.collect()} == {x.label: round(x.s, 9) for x in top.collect()}
    assert query_scores(q.limit(0), b, 0.5).count() == 0
