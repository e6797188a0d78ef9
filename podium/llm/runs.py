"""Problem 1: runs of consecutive equal events, collapsed with their count and duration.

Method: boundary interval lookup. Events are cut into chunks of an entity by time; in each chunk
the positions at which a run starts form a sorted array, every event is assigned to its run by
binary search in it, and the runs are aggregated. Only the first and the last run of a chunk can
go on in a neighbouring chunk; those are collapsed once more over the whole entity, by the same
function. So one entity may hold a third of all rows, and no task sees more than one chunk of it.

Defined cases: events without a value (null) belong to no run and break one; ties in time are
ordered by id; null entities, ids or times leave an event out; a run's duration is its last end
minus its first start, an end that is null or before the start counting as the start; an empty
input gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.functions.labels import speaker_number
from podium.operators.stream import map_groups, numbers
from podium.plans.periods import SEGMENTS_SQL
from podium.sources.tables import millis, once, table

CHUNK_MS = 3_600_000
_NONE = -(2**31)
_SCHEMA = "g string, chunk bigint, v int, a bigint, b bigint, a_id int, b_id int, n bigint, s bigint, t bigint, edge boolean"
_ARROW = pa.schema([("g", pa.string()), ("chunk", pa.int64()), ("v", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("a_id", pa.int32()), ("b_id", pa.int32()), ("n", pa.int64()), ("s", pa.int64()), ("t", pa.int64()), ("edge", pa.bool_())])


def _collapse(final: bool, chunk: int, text: bool = False):
    """Runs of each (g, chunk); rows come sorted by chunk, time and id, and may be runs themselves."""
    schema = _ARROW.append(pa.field("text", pa.string())) if text else _ARROW

    def fn(work: pa.Table, begins: np.ndarray) -> pa.Table:
        v = numbers(work, "v", _NONE)
        starts = begins.copy()
        starts[1:] |= v[1:] != v[:-1]
        if final:  # the first and the last run of one chunk are two runs
            home = numbers(work, "a") // chunk
            starts[1:] |= home[1:] == home[:-1]
        where = np.flatnonzero(starts)  # the sorted array of run starts
        run = np.searchsorted(where, np.arange(len(v)), side="right") - 1
        last = np.append(where[1:], len(v)) - 1
        n = np.bincount(run, weights=numbers(work, "n"), minlength=len(where)).astype(np.int64)
        key = work.select(["g", "chunk"]).take(pa.array(where))
        head = begins[where]
        edge = np.zeros(len(where), bool) if final else head | np.append(head[1:], True)
        t = numbers(work, "t")
        columns = {
            "g": key["g"], "chunk": key["chunk"], "v": v[where], "a": numbers(work, "a")[where], "b": numbers(work, "b")[last],
            "a_id": numbers(work, "a_id")[where], "b_id": numbers(work, "b_id")[last], "n": n,
            "s": numbers(work, "s")[where], "t": np.maximum.reduceat(t, where), "edge": edge,
        }
        if text:
            said = work.column("text").to_pylist()
            columns["text"] = [" ".join(filter(None, said[lo : hi + 1])) for lo, hi in zip(where, last, strict=True)]
        return pa.table(columns).cast(schema)

    return fn


def collapse_runs(df: DataFrame, entity: Column, event_id: Column, value: Column, start: Column, end: Column, chunk: int = CHUNK_MS, text: Column | None = None, shown: Column | None = None) -> DataFrame:
    """(g, v, first_id, last_id, n, start, end): the maximal runs of equal value of each entity by start.

    With text, also the events' texts in order, joined by spaces. shown is the start that is reported,
    where it is not the one that orders the events.
    """
    said, more = ([], "") if text is None else (["text"], ", text string")
    events = df.select(*([] if text is None else [text.alias("text")]), entity.alias("g"), event_id.cast("int").alias("id"), value.cast("int").alias("v"), start.cast("bigint").alias("a"), (start if shown is None else shown).cast("bigint").alias("s"), end.cast("bigint").alias("t")).where("g is not null and id is not null and a is not null")
    rows = events.select(
        "g", F.floor(F.col("a") / chunk).alias("chunk"), F.coalesce("v", F.lit(_NONE)).alias("v"), "a", F.col("a").alias("b"),
        F.col("id").alias("a_id"), F.col("id").alias("b_id"), F.lit(1).cast("bigint").alias("n"), "s", F.greatest("s", F.coalesce("t", "s")).alias("t"), *said,
    )
    local = map_groups(rows, ["g", "chunk"], ["a", "a_id"], _collapse(False, chunk, bool(said)), _SCHEMA + more)
    # Only edges are shuffled on, to meet by entity; finished runs pass them by.
    edges = local.where("edge").withColumn("chunk", F.lit(-1).cast("bigint"))
    whole = local.where("not edge").unionByName(map_groups(edges, ["g", "chunk"], ["a", "a_id"], _collapse(True, chunk, bool(said)), _SCHEMA + more))
    return whole.where(F.col("v") != _NONE).select("g", "v", F.col("a_id").alias("first_id"), F.col("b_id").alias("last_id"), "n", F.col("s").alias("start"), F.col("t").alias("end"), *said)


def speaker_runs(segments: DataFrame) -> DataFrame:
    rows = once(segments, ["meeting_id", "segment_id"], no=speaker_number("speaker_label"), start_ms=millis("start_time"), end_ms=millis("end_time"))
    return collapse_runs(rows, F.col("meeting_id"), F.col("segment_id"), F.col("no"), F.col("start_ms"), F.col("end_ms"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = speaker_runs(table(spark, sf_dir, "segments")).where("n >= 2")
    return runs.select(F.col("g").alias("meeting_id"), F.col("first_id").alias("first_segment_id"), F.col("last_id").alias("last_segment_id"))


def p1_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every run, with its count and its duration."""
    return speaker_runs(table(spark, sf_dir, "segments")).select(
        F.col("g").alias("meeting_id"), F.col("v").alias("speaker_no"), F.col("first_id").alias("first_segment_id"), F.col("last_id").alias("last_segment_id"),
        F.col("n").alias("n_segments"), F.col("start").alias("start_ms"), (F.col("end") - F.col("start")).alias("duration_ms"),
    )


_RUNS_SQL = f"""
WITH {SEGMENTS_SQL},
o AS (SELECT *, lag(no) OVER w AS before, row_number() OVER w AS rn FROM seg WHERE start_ms IS NOT NULL WINDOW w AS (PARTITION BY meeting_id ORDER BY start_ms, segment_id)),
r AS (SELECT *, sum(CASE WHEN rn > 1 AND no IS NOT DISTINCT FROM before THEN 0 ELSE 1 END) OVER (PARTITION BY meeting_id ORDER BY rn) AS run FROM o),
c AS (SELECT meeting_id, run, min(no) AS no, arg_min(segment_id, rn) AS a, arg_max(segment_id, rn) AS b, count(*) AS n, min(start_ms) AS s, max(greatest(start_ms, coalesce(end_ms, start_ms))) AS e FROM r WHERE no IS NOT NULL GROUP BY 1, 2)
"""
P1_SQL = _RUNS_SQL + "SELECT meeting_id, a AS first_segment_id, b AS last_segment_id FROM c WHERE n >= 2"
P1_RUNS_SQL = _RUNS_SQL + "SELECT meeting_id, no AS speaker_no, a AS first_segment_id, b AS last_segment_id, n AS n_segments, s AS start_ms, e - s AS duration_ms FROM c"
