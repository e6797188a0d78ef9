import importlib
import re

import pytest
from pyspark.sql import functions as F

from podium.plans import registry
from tests.oracle import connect, same

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    if name in registry.SQL:
        same(df, duck, registry.SQL[name])
    else:
        assert df.count() > 0


def test_entry(spark):
    entry = importlib.import_module("__spark_entry__")
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", ["apply_mappings", "section_times", "caption_alignment", "overlap_lengths", "turn_merge", "p2_found"])
def test_plans_have_no_product_of_tables(spark, name):
    df = registry.QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["p2_found", "turn_merge", "time_formats", "overlap_lengths", "section_times", "audible_segments", "merged_segments"])
def test_scans_read_only_what_they_need(spark, name):
    plan = registry.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    schemas = re.findall(r"ReadSchema: (struct<.*?>)(?:\n|$)", plan)
    assert schemas or name == "merged_segments"
    assert not [s for s in schemas if re.search(r"\b(text|words|speaker_name):", s)]


def test_thin_rows_are_aggregated_by_hash(spark):
    for name in ("turn_merge", "p2_found", "time_formats"):
        assert "SortAggregate" not in registry.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_epoch_seconds_are_times_like_others(spark, tmp_path):
    t = spark.read.parquet(f"{SF}/segments.parquet")
    late = t.withColumns({c: F.col(c) + 1.7e9 for c in ("start_time", "end_time")})
    late.write.parquet(f"{tmp_path}/segments.parquet")
    a, b = (registry.QUERIES["p2_found"](spark, d).select("meeting_id", "speaker_no", "kind").groupBy("meeting_id", "speaker_no", "kind").count() for d in (SF, str(tmp_path)))
    assert {tuple(x) for x in a.collect()} == {tuple(x) for x in b.collect()}


def test_correction_totals_count_fuzzy_surnames(spark, tmp_path):
    rows = {
        "meetings": [{"meeting_id": "d", "city": "HERE ", "body": "Council"}],
        "roster": [{"roster_id": 1, "city": "Here", "body": "council", "members": [(1, "Jane Fenwick", ["Fenwick", "J. Fenwick"])]}],
        "mappings": [{"mapping_id": i, "meeting_id": m, "speaker_label": f"SPEAKER_0{i}", "speaker_name": n, "roster_id": 1 if m != "d" else None} for i, (m, n) in enumerate([("a", "Jane Fenwik"), ("b", "J. Fenwick"), ("b", "Fenwikc"), ("b", "Jane Fenwick"), ("c", "Xu"), ("d", "Fenwicke")])],
    }
    for name, some in rows.items():
        schema = spark.read.parquet(f"{SF}/{name}.parquet").schema
        spark.createDataFrame([[r.get(c) for c in schema.names] for r in some], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    got = {tuple(r) for r in registry.QUERIES["correction_totals"](spark, str(tmp_path)).collect()}
    assert got == {("a", 1, 1), ("b", 2, 2), ("c", 0, 0), ("d", 1, 1)}
