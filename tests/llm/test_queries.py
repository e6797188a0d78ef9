import pytest
from pyspark.sql import functions as F

from podium.llm import queries
from tests.oracle import connect, same

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, duck, name):
    assert same(queries.QUERIES[name](spark, SF), duck, queries.SQL[name]) > 0


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_other_queries_give_rows(spark, name):
    assert queries.QUERIES[name](spark, SF).count() > 0


def test_epoch_seconds_are_times_like_others(spark, tmp_path):
    for name, times in (("segments", ("start_time", "end_time")), ("cues", ("start", "end"))):
        t = spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
        t.withColumns({c: F.col(c) + 1_700_000_000.0 for c in times}).write.parquet(f"{tmp_path}/{name}.parquet")
    for name in ("p1_found", "p3_found", "p6_found"):
        a, b = (queries.QUERIES[name](spark, d).collect() for d in ("/root/testdata/sf0.001", str(tmp_path)))
        assert a and {tuple(x) for x in a} == {tuple(x) for x in b}


def test_turns_of_odd_utterances_and_late_rows_equal_their_sql(spark, tmp_path):
    said = ["Hello.", "I move the following:", "so", "[gavel]", "here it is: uh", "vote:", "we have two:", "no, 7:", "Ann Smith: um", "item 4: [laughter]", "Speaker 3 - hmm", "So -", "00:01:02.003 --> yes", None, "uh, er..."]
    rows = [("m", i, i, 100.0 * i, 100.0 * i + 1, f"SPEAKER_0{i % 2}", t, None) for i, t in enumerate(said)]
    # Late rows from the opening look like a clock that starts anew; the order by start_time stays.
    rows += [("m", 50, 50, 5.0, 6.0, "SPEAKER_01", "Late.", None), ("m", 51, 51, 250.0, 251.0, "SPEAKER_01", "Later.", None)]
    df = spark.createDataFrame(rows, "meeting_id string, pos int, segment_id int, start_time double, end_time double, speaker_label string, text string, speaker_name string")
    df.write.parquet(f"{tmp_path}/segments.parquet")
    # Nothing is said in 3, 8, 10, 13 and 14; 50 and 1 are one turn, and so are 7, 9 and 11.
    assert same(queries.QUERIES["p6_found"](spark, str(tmp_path)), connect(tmp_path), queries.SQL["p6_found"]) == 9
