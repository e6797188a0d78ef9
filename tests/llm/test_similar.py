import numpy as np
import pytest
from pyspark.sql import functions as F

from podium.functions.vectors import mean_of
from podium.llm import similar


def brute(vectors, k, floor):
    ids = sorted(vectors)
    x = np.array([vectors[i] for i in ids])
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = x @ x.T
    np.fill_diagonal(s, -9)
    out = set()
    for row, i in enumerate(ids):
        order = sorted(range(len(ids)), key=lambda c: (-round(s[row, c], 12), ids[c]))[:k]
        out |= {(i, ids[c]) for c in order if s[row, c] >= floor}
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "id bigint, v array<double>, rep string, u int")


def test_recall(spark):
    r = np.random.default_rng(5)
    centers = r.standard_normal((60, 64))
    vectors = {i: (centers[i % 60] + 0.35 * r.standard_normal(64)).tolist() for i in range(600)}
    got = similar.most_similar(frame(spark, [(i, v, "x", 1) for i, v in vectors.items()]), "id", F.col("v"), floor=0.8)
    want = brute(vectors, 5, 0.8)
    found = {(x.id, x.other) for x in got.collect()}
    assert len(found & want) >= 0.95 * len(want) and len(found & want) >= 0.95 * len(found)


def test_long_files_are_cut_without_loss(spark, monkeypatch):
    r = np.random.default_rng(6)
    vectors = {i: (r.standard_normal(64) * 0.2 + 1).tolist() for i in range(300)}
    df = frame(spark, [(i, v, "x", 1) for i, v in vectors.items()])
    whole = {(x.id, x.other) for x in similar.most_similar(df, "id", F.col("v")).collect()}
    monkeypatch.setattr(similar, "BLOCK", 16)
    cut = {(x.id, x.other) for x in similar.most_similar(df, "id", F.col("v")).collect()}
    assert whole == cut


def test_a_hot_group_of_similar_vectors_loses_nothing(spark, monkeypatch):
    r = np.random.default_rng(7)
    center = r.standard_normal(64)
    vectors = {i: (center + 0.4 * r.standard_normal(64) if i % 3 == 0 else r.standard_normal(64)).tolist() for i in range(1200)}
    df, want = frame(spark, [(i, v, "x", 1) for i, v in vectors.items()]), brute(vectors, 5, 0.8)
    assert len(want) > 1900
    for block in (similar.EXACT, 250):
        monkeypatch.setattr(similar, "EXACT", block)
        got = [(x.id, x.other) for x in similar.most_similar(df, "id", F.col("v"), floor=0.8).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_more_neighbours_and_many_pivots(spark, monkeypatch):
    r = np.random.default_rng(8)
    centers = r.standard_normal((100, 64))
    vectors = {i: (centers[i % 100] + 0.35 * r.standard_normal(64)).tolist() for i in range(1500)}
    df, want = frame(spark, [(i, v, "x", 1) for i, v in vectors.items()]), brute(vectors, 12, 0.8)
    monkeypatch.setattr(similar, "GROUPED", 100)
    got = {(x.id, x.other) for x in similar.most_similar(df, "id", F.col("v"), k=12, floor=0.8).collect()}
    assert len(got & want) >= 0.98 * len(want) and len(got & want) >= 0.98 * len(got)


def test_footrule():
    r = np.random.default_rng(9)
    perm = np.array([r.permutation(12)[:5] for _ in range(20)])
    place = lambda row, p: list(row).index(p) if p in row else 5
    want = [[30 - sum(abs(place(a, p) - place(b, p)) for p in range(12)) for b in perm] for a in perm]
    assert (2 * similar.footrule(perm) == np.array(want)).all()


def test_copies_and_what_takes_no_part(spark):
    a, b = [1.0] * 64, [1.0] * 63 + [0.9]
    rows = [(i, a, "x", 1) for i in range(1, 201)] + [(300, b, "x", 1), (301, [0.0] * 64, "", 0), (302, None, "", 0), (303, [], "", 0), (304, [float("nan")] * 64, "", 0), (None, a, "", 0), (305, [1.0], "", 0), (300, b, "y", 2)]
    got = similar.most_similar(frame(spark, rows), "id", F.col("v"), floor=0.8).collect()
    near = {}
    for x in got:
        near.setdefault(x.id, []).append(x.other)
    assert set(near) == set(range(1, 201)) | {300}
    assert all(len(v) == 5 for v in near.values())
    assert sorted(near[7]) == [1, 2, 3, 4, 5] and sorted(near[2]) == [1, 3, 4, 5, 6] and sorted(near[300]) == [1, 2, 3, 4, 5]


@pytest.mark.parametrize("n", [0, 1, 2])
def test_few(spark, n):
    df = frame(spark, [(i, [float(i + 1)] + [1.0] * 63, "x", 1) for i in range(n)])
    assert similar.most_similar(df, "id", F.col("v")).count() == (2 if n == 2 else 0)


def test_profiles_against_brute_force(spark):
    """p5_found over all profiles of a table."""
    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/profiles.parquet").select("ord", similar.voice().alias("v")).where("v is not null").collect()
    vectors = {r.ord: r.v for r in rows if len(r.v) == 64 and any(r.v)}
    want = {(min(p), max(p)) for p in brute(vectors, 5, 0.8)}
    got = {tuple(r) for r in similar.p5_found(spark, sf).collect()}
    print("recall", len(got & want) / len(want), "precision", len(got & want) / len(got))
    assert len(got & want) >= 0.99 * max(len(want), len(got))


def test_mean_of(spark):
    df = spark.createDataFrame([([[1.0, 2.0], [3.0, 4.0], [], None],), ([],), (None,)], "v array<array<double>>")
    assert [r.m for r in df.select(mean_of(F.col("v")).alias("m")).collect()] == [[2.0, 3.0], None, None]
