import random

import pytest
from pyspark.sql import functions as F

from podium.llm import names


def test_variants_and_strangers(spark):
    members = [(1, "Mayor Jane Adams", ["J. Adams", None, " "]), (2, "Edward Fenwick", []), (3, "Clerk Priya Lanirado", None), (4, "Department of Water Reclamation", ["DWR"]), (5, "Trustee Gregory Pelannell", []), (6, "Commissioner Cornelius Pelannell", [])]
    roster = spark.createDataFrame([(1, "C", "B", members), (2, "C", "D", [(9, "Jane Adams", [])]), (3, "E", "F", None)], "roster_id int, city string, body string, members array<struct<member_id bigint, name string, aliases array<string>>>")
    typed = {
        "Jane Adams": 1, "ADAMS, JANE": 1, "adams jane": 1, "Mayor Adams": 1, "J. B. Adams": 1, "Jane Adsam": 1, "Jane  Adams (remote)": 1, "Janet Adams": 1, "Ned Fenwick": 2, "Fenwick, Ted R.": 2, "Gregory Fenwick": None, "E. Fenwik": 2,
        "Priya Laneerado": 3, "Prya Lanirado": 3, "Hana Lanirado": None, "Water Reclamation Dept.": 4, "D.W.R.": 4, "Depratment of Water Reclamation": 4, "Department of Street Works": None, "Pelannell": None, "Trustee Pelannell": 5, "Neil Pelannell": 6,
        "Unknown": None, "": None, "  ": None, "N/A": None, None: None, "SPEAKER_04": None, "?": None,
    }
    typed |= {"Jane " + "Adams" * 20_000: None, "Jane " * 3_000: None}
    rows = [("mapping", i, 1, n, "x") for i, n in enumerate(typed)] + [("profile", 1, 2, "Jane Adams", "x"), ("profile", 2, 3, "Jane Adams", "x"), ("profile", 3, None, "Jane Adams", "x"), ("profile", 4, 77, "Jane Adams", "x")]
    df = spark.createDataFrame(rows, "source string, record_id bigint, roster_id int, name string, canonical string")
    got = names.attribute(df, roster).collect()
    by = {r.record_id: r.member_id for r in got if r.source == "mapping"}
    assert {n: by.get(i) for i, n in enumerate(typed)} == typed
    assert [(r.record_id, r.member_id) for r in got if r.source == "profile"] == [(1, 9)]
    assert len(got) == len({(r.source, r.record_id) for r in got})
    assert names.attribute(df.limit(0), roster).count() == 0 and names.attribute(df, roster.limit(0)).count() == 0


def test_a_frequent_stranger_keeps_its_own_typos(spark):
    roster = spark.createDataFrame([(1, [(1, "Jane Fenwick", [])])], "roster_id int, members array<struct<member_id bigint, name string, aliases array<string>>>")
    rows = [("m", i, 1, "Jane Felwack") for i in range(30)] + [("m", 100, 1, "Jane Felwock"), ("m", 101, 1, "Jane Fenwikc")] + [("m", 200 + i, 1, "Jane Fenwick") for i in range(5)]
    got = {r.record_id for r in names.attribute(spark.createDataFrame(rows, "source string, record_id bigint, roster_id int, name string"), roster).collect()}
    assert got == {101, *range(200, 205)}


@pytest.mark.parametrize("times", [1, 10, 100])
def test_ten_times_the_records_change_no_attribution(spark, times):
    members = [(1, "Jane Fenwick", []), (2, "Priya Lanirado", []), (3, "Tobias Okongwe", [])]
    roster = spark.createDataFrame([(1, members)], "roster_id int, members array<struct<member_id bigint, name string, aliases array<string>>>")
    counts = {"Jane Fenwick": 12, "Priya Lanirado": 300, "Jane Femwick": 1, "Priya Lanbrafo": 1, "Tobias Okomgwe": 1, "Jane Felwack": 90, "Jane Felwock": 1}
    rows = [("m", i, 1, name) for i, (name, n) in enumerate(counts.items()) for _ in range(n * times)]
    df = spark.createDataFrame(rows, "source string, record_id bigint, roster_id int, name string")
    got = {tuple(r) for r in names.attribute(df, roster).select("record_id", "member_id").distinct().collect()}
    assert got == {(0, 1), (1, 2), (2, 1), (3, 2), (4, 3)}


def test_distances():
    assert names.edits("abcd", "abdc") == 1 and names.edits("abc", "xyz", 2) == 3 and names.edits("", "ab") == 2
    assert names.sound("Lanirado".lower()) == names.sound("laneerado") and names.sound("elvould") == names.sound("elvooold")
    assert names.given_cost("bob", "robert") < names.given_cost("robret", "robert") < names.NEVER <= names.given_cost("x", "robert")


def test_another_known_name_is_no_double_typo():
    assert names.given_cost("becky", "elizabeth") == names.NEVER and names.given_cost("betyt", "elizabeth") < names.NEVER


def test_deletions(spark):
    df = spark.createDataFrame([("abc",), ("a",), ("",), ("x" * 100_000,)], "w string")
    rows = df.select(names.deletions(F.col("w")).alias("d")).collect()
    assert [sorted(r.d) for r in rows] == [["ab", "abc", "ac", "bc"], ["", "a"], [""], ["x" * 100_000]]


def test_names_outside_every_list(spark):
    """Recall of typed variants of given names that no list of short forms knows, and of strangers left alone."""
    r = random.Random(11)
    syllable = lambda: r.choice("bdfgklmnprstvz") + r.choice("aeiou") + r.choice(["", "", "n", "r", "l"])
    word = lambda k: "".join(syllable() for _ in range(k)).capitalize()
    people = list({(word(3), word(4)) for _ in range(40)})
    assert not {g.lower() for g, _ in people} & (set(names.NICKNAMES) | set(names._GIVEN))

    def typo(w):
        i = r.randrange(1, len(w) - 1)
        return r.choice([w[:i] + w[i + 1 :], w[:i] + w[i + 1] + w[i] + w[i + 2 :], w[:i] + w[i] + w[i:], w[:i] + r.choice("aeioutn") + w[i + 1 :]])

    def variant(g, s):
        return r.choice([f"{g} {s}", f"{s}, {g}", f"{s.upper()} {g}", f"{g[0]}. {s}", s, f"Mayor {s}", f"{g} {r.choice('ABC')}. {s}", f"{typo(g)} {s}", f"{g} {typo(s)}", f"{typo(s)}, {g}", f"Trustee {g} {typo(s)}"])

    roster = spark.createDataFrame([(1, [(i, f"{g} {s}", []) for i, (g, s) in enumerate(people[:30])])], "roster_id int, members array<struct<member_id bigint, name string, aliases array<string>>>")
    rows, want = [], {}
    for i in range(1200):
        k = r.randrange(40)
        rows.append(("m", i, 1, variant(*people[k])))
        if k < 30:
            want[i] = k
    df = spark.createDataFrame(rows, "source string, record_id bigint, roster_id int, name string")
    got = {x.record_id: x.member_id for x in names.attribute(df, roster).collect()}
    right = sum(want.get(i) == k for i, k in got.items())
    print("recall", right / len(want), "precision", right / len(got))
    assert right >= 0.95 * len(want) and right >= 0.97 * len(got)


def test_many_members_are_joined(spark, monkeypatch):
    roster = spark.createDataFrame([(1, [(1, "Jane Fenwick", []), None, (2, None, [])]), (2, None)], "roster_id int, members array<struct<member_id bigint, name string, aliases array<string>>>")
    df = spark.createDataFrame([("m", 1, 1, "Jane Fenwikc"), ("m", 2, 2, "Jane Fenwick"), ("m", 3, 9, "Jane Fenwick")], "source string, record_id bigint, roster_id int, name string")
    for most in (100, 0):
        monkeypatch.setattr(names, "SENT", most)
        assert [tuple(x) for x in names.attribute(df, roster).collect()] == [("m", 1, 1)]
