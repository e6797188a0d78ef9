"""Problem 2: each speaker's continuous periods and the gaps between them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.functions.labels import speaker_number
from podium.operators.periods import periods_and_gaps
from podium.sources.tables import longest, millis, once, table

#: Segment ids that come together before their containers are built.
BLOCK = 512


def speaker_periods(segments: DataFrame) -> DataFrame:
    """(g meeting, e speaker number, kind, s, t, n) over segments, repeats of a key counted once.

    Rows come together by blocks of segment ids, so that the containers built from them hold what is near in time.
    """
    near = segments.withColumn("block", F.floor(F.col("segment_id") / BLOCK)).repartition("meeting_id", "block")
    rows = once(near, ["meeting_id", "block", "segment_id"], no=speaker_number("speaker_label"), start_ms=millis("start_time"), end_ms=millis("end_time"))
    return periods_and_gaps(rows, F.col("meeting_id"), F.col("no"), F.col("start_ms"), F.col("end_ms"), longest=longest(segments, ("start_time", "end_time")))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = speaker_periods(table(spark, sf_dir, "segments")).where("kind = 1 or n >= 2")
    return out.select(
        F.col("g").alias("meeting_id"),
        F.col("e").alias("speaker_no"),
        F.when(F.col("kind") == 1, "gap").otherwise("period").alias("kind"),
        F.col("s").alias("start_ms"),
        F.col("t").alias("end_ms"),
    )


#: Shared by the SQL of several queries: the segments, once each, with numbers and milliseconds.
SEGMENTS_SQL = """
seg AS (
  SELECT meeting_id, segment_id,
         min(TRY_CAST(translate(regexp_extract(translate(speaker_label, '０１２３４５６７８９', '0123456789'), '([OolI]*[0-9][0-9OolI]*)', 1), 'OolI', '0011') AS INTEGER)) AS no,
         min(CAST(round(start_time * 1000) AS BIGINT)) AS start_ms,
         min(CAST(round(end_time * 1000) AS BIGINT)) AS end_ms
  FROM segments WHERE meeting_id IS NOT NULL AND segment_id IS NOT NULL GROUP BY 1, 2
)"""

P2_SQL = f"""
WITH {SEGMENTS_SQL},
t AS (SELECT *, max(end_ms) OVER (PARTITION BY meeting_id, no ORDER BY start_ms, segment_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
      FROM seg WHERE no IS NOT NULL AND end_ms > start_ms),
i AS (SELECT *, sum(CASE WHEN reach IS NULL OR start_ms > reach THEN 1 ELSE 0 END) OVER (PARTITION BY meeting_id, no ORDER BY start_ms, segment_id) AS island FROM t),
p AS (SELECT meeting_id, no, island, min(start_ms) AS s, max(end_ms) AS e, count(*) AS n FROM i GROUP BY 1, 2, 3),
g AS (SELECT *, lag(e) OVER (PARTITION BY meeting_id, no ORDER BY s) AS before FROM p)
SELECT meeting_id, no AS speaker_no, 'period' AS kind, s AS start_ms, e AS end_ms FROM p WHERE n >= 2
UNION ALL
SELECT meeting_id, no, 'gap', before, s FROM g WHERE before IS NOT NULL
"""
