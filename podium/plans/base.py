"""The cleaned relations on which the transcript queries work, in Spark and in SQL.

A row that is delivered again counts once: the first by arrival is kept. Times are whole
milliseconds, so that gaps and sums are exact; an end that is missing or not after the start is the
start. A label is SPEAKER_nn by its number, or as written, or UNKNOWN. idx numbers a meeting's
segments from 0 in arrival order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from podium.functions.labels import speaker_number
from podium.operators.ordered import dense_index
from podium.sources.tables import millis, table


def first_delivery(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row a key: the least by the order columns.

    A window of which the first row is kept: the limit is applied before the shuffle too, so a key that is
    delivered very often costs one row a task, and columns that a query does not use are not read.
    """
    rows = df
    for k in keys:
        rows = rows.where(F.col(k).isNotNull())
    return rows.withColumn("_place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_place = 1").drop("_place")


def label_of(column: str = "speaker_label") -> Column:
    n = speaker_number(column)
    return F.when(n.isNotNull(), F.format_string("SPEAKER_%02d", n)).otherwise(F.coalesce(F.nullif(F.trim(column), F.lit("")), F.lit("UNKNOWN")))


def segments(spark: SparkSession, sf_dir: str, *more: str, indexed: bool = True) -> DataFrame:
    """(meeting_id, segment_id, pos, label, start_ms, end_ms, text, speaker_name, ...[, idx])."""
    raw = table(spark, sf_dir, "segments")
    columns = raw.select("meeting_id", "segment_id", "pos", "ingested_at", "speaker_label", "start_time", "end_time", "text", "speaker_name", *more)
    one = first_delivery(columns, ["meeting_id", "segment_id"], ["ingested_at", "pos"])
    start, end = millis("start_time"), millis("end_time")
    rows = one.select("meeting_id", "segment_id", "pos", label_of().alias("label"), start.alias("start_ms"), F.when(end > start, end).otherwise(start).alias("end_ms"), "text", "speaker_name", *more)
    return dense_index(rows, ["meeting_id"], "pos", "idx", tie="segment_id") if indexed else rows


SEG = """
raw_seg AS (SELECT *, row_number() OVER (PARTITION BY meeting_id, segment_id ORDER BY ingested_at NULLS FIRST, pos NULLS FIRST) AS rn FROM segments WHERE meeting_id IS NOT NULL AND segment_id IS NOT NULL),
num_seg AS (SELECT *, TRY_CAST(translate(regexp_extract(translate(speaker_label, '０１２３４５６７８９', '0123456789'), '([OolI]*[0-9][0-9OolI]*)', 1), 'OolI', '0011') AS INTEGER) AS no,
  CAST(round(start_time * 1000) AS BIGINT) AS start_ms, CAST(round(end_time * 1000) AS BIGINT) AS e_ms FROM raw_seg WHERE rn = 1),
seg AS (SELECT meeting_id, segment_id, pos, CASE WHEN no IS NOT NULL THEN 'SPEAKER_' || lpad(CAST(no AS VARCHAR), CAST(greatest(2, length(CAST(no AS VARCHAR))) AS INTEGER), '0') ELSE coalesce(nullif(trim(speaker_label), ''), 'UNKNOWN') END AS label,
  start_ms, CASE WHEN e_ms > start_ms THEN e_ms ELSE start_ms END AS end_ms, text, speaker_name, confidence, id_method, words,
  row_number() OVER (PARTITION BY meeting_id ORDER BY pos, segment_id) - 1 AS idx FROM num_seg)"""


def meetings(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "meetings")
    return t.where("meeting_id is not null").groupBy("meeting_id").agg(*[F.min(c).alias(c) for c in t.columns if c != "meeting_id"])


MEET = "meet AS (SELECT meeting_id, min(city) AS city, min(body) AS body, min(date) AS date, min(meeting_type) AS meeting_type, min(audio_source) AS audio_source, min(duration_seconds) AS duration_seconds FROM meetings WHERE meeting_id IS NOT NULL GROUP BY 1)"


def cues(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "cues")
    one = t.where("meeting_id is not null and pos is not null").groupBy("meeting_id", "pos").agg(F.min(millis("start")).alias("start_ms"), F.min(millis("end")).alias("end_ms"), F.min("text").alias("text"))
    return one


CUES = """cue AS (SELECT meeting_id, pos, min(CAST(round("start" * 1000) AS BIGINT)) AS start_ms, min(CAST(round("end" * 1000) AS BIGINT)) AS end_ms, min(text) AS text FROM cues WHERE meeting_id IS NOT NULL AND pos IS NOT NULL GROUP BY 1, 2)"""


def mappings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a (meeting_id, label): of several mappings of a label the first by mapping_id."""
    t = table(spark, sf_dir, "mappings").where("mapping_id is not null and meeting_id is not null")
    one = t.groupBy("mapping_id").agg(*[F.min(c).alias(c) for c in ("meeting_id", "speaker_label", "speaker_name", "confidence", "id_method", "needs_review", "roster_id")])
    named = one.withColumn("label", label_of()).drop("speaker_label")
    return first_delivery(named, ["meeting_id", "label"], ["mapping_id"])


MAPS = """
map1 AS (SELECT mapping_id, min(meeting_id) AS meeting_id, min(speaker_label) AS speaker_label, min(speaker_name) AS speaker_name, min(confidence) AS confidence, min(id_method) AS id_method, min(needs_review) AS needs_review, min(roster_id) AS roster_id
  FROM mappings WHERE mapping_id IS NOT NULL AND meeting_id IS NOT NULL GROUP BY 1),
map2 AS (SELECT *, TRY_CAST(translate(regexp_extract(translate(speaker_label, '０１２３４５６７８９', '0123456789'), '([OolI]*[0-9][0-9OolI]*)', 1), 'OolI', '0011') AS INTEGER) AS no FROM map1),
map3 AS (SELECT *, CASE WHEN no IS NOT NULL THEN 'SPEAKER_' || lpad(CAST(no AS VARCHAR), CAST(greatest(2, length(CAST(no AS VARCHAR))) AS INTEGER), '0') ELSE coalesce(nullif(trim(speaker_label), ''), 'UNKNOWN') END AS label FROM map2),
map AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY meeting_id, label ORDER BY mapping_id) AS rk FROM map3) WHERE rk = 1)"""


def homes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(meeting_id, home): the roster of a meeting's city and body, the least of several."""
    key = lambda c: F.lower(F.trim(F.col(c))).alias(c)
    rosters = table(spark, sf_dir, "roster").select(key("city"), key("body"), "roster_id").groupBy("city", "body").agg(F.min("roster_id").alias("home"))
    return meetings(spark, sf_dir).select("meeting_id", key("city"), key("body")).join(rosters, ["city", "body"]).select("meeting_id", "home")


def with_bodies(spark: SparkSession, sf_dir: str, df: DataFrame) -> DataFrame:
    """Adds roster_id to rows of meetings: their own one, where they have such a column and it is not null, else the meeting's."""
    own = F.col("own") if "own" in df.columns else F.lit(None).cast("int")
    return df.join(homes(spark, sf_dir), "meeting_id", "left").withColumn("roster_id", F.coalesce(own, "home")).drop("own", "home")


HOMES = """ci AS (SELECT lower(trim(city)) AS city, lower(trim(body)) AS body, min(roster_id) AS roster_id FROM roster GROUP BY 1, 2),
home AS (SELECT meeting_id, roster_id FROM meet JOIN ci ON lower(trim(meet.city)) = ci.city AND lower(trim(meet.body)) = ci.body)"""
BODIES = HOMES + ", mapb AS (SELECT map.* EXCLUDE (roster_id), coalesce(map.roster_id, home.roster_id) AS roster_id FROM map LEFT JOIN home ON home.meeting_id = map.meeting_id)"


def voices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(meeting_id, label, ord, v): the voice of each speaker of a meeting.

    No table holds what a diariser would deliver, so each speaker is given the first embedding of a
    profile, chosen by a digest of meeting and label; whose profile has none has no voice.
    """
    p = profiles(spark, sf_dir).select("ord", F.get("embeddings", F.lit(0)).alias("v"))
    n = table(spark, sf_dir, "profiles").agg(F.max("ord")).first()[0] or 1
    labels = segments(spark, sf_dir, indexed=False).select("meeting_id", "label").distinct()
    digest = F.conv(F.substring(F.md5(F.concat_ws("|", "meeting_id", "label")), 1, 7), 16, 10).cast("bigint")
    some = labels.withColumn("ord", (digest % n + 1).cast("int"))
    return some.join(p.where((F.size("v") == 64) & F.exists("v", lambda x: x != 0)), "ord").select("meeting_id", "label", "ord", "v")


VOICES = """vo AS (SELECT DISTINCT meeting_id, label, CAST(CAST('0x' || substr(md5(meeting_id || '|' || label), 1, 7) AS BIGINT) % (SELECT max(ord) FROM profiles) + 1 AS INTEGER) AS ord FROM seg),
voice AS (SELECT meeting_id, label, vo.ord, embeddings[1] AS v FROM vo JOIN prof ON prof.ord = vo.ord WHERE len(embeddings[1]) = 64 AND list_max(list_transform(embeddings[1], lambda x: abs(x))) > 0)"""


def sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "sections").where("meeting_id is not null and pos is not null")
    return t.groupBy("meeting_id", "pos").agg(*[F.min(c).alias(c) for c in ("type", "start_segment", "end_segment", "title", "content", "start_time", "end_time")])


SECT = "sect AS (SELECT meeting_id, pos, min(type) AS type, min(start_segment) AS start_segment, min(end_segment) AS end_segment, min(title) AS title, min(content) AS content, min(start_time) AS start_time, min(end_time) AS end_time FROM sections WHERE meeting_id IS NOT NULL AND pos IS NOT NULL GROUP BY 1, 2)"


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "profiles").where("ord is not null")
    return t.groupBy("ord").agg(*[F.min(c).alias(c) for c in ("slug", "display_name", "embeddings", "centroid", "meetings_seen", "total_segments_confirmed", "roster_id")])


PROF = "prof AS (SELECT ord, min(slug) AS slug, min(display_name) AS display_name, min(embeddings) AS embeddings, min(centroid) AS centroid, min(meetings_seen) AS meetings_seen, min(total_segments_confirmed) AS total_segments_confirmed, min(roster_id) AS roster_id FROM profiles WHERE ord IS NOT NULL GROUP BY 1)"


def roster_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(roster_id, member_ord, name, alias_ord, alias): members in order, with their aliases in order; members without get none."""
    one = table(spark, sf_dir, "roster").where("roster_id is not null").groupBy("roster_id").agg(F.min("members").alias("members"))
    m = one.select("roster_id", F.posexplode("members").alias("member_ord", "m")).select("roster_id", "member_ord", "m.name", "m.aliases")
    return m.select("roster_id", "member_ord", "name", F.posexplode_outer("aliases").alias("alias_ord", "alias"))


ROST = """
ro1 AS (SELECT roster_id, min(members) AS members FROM roster WHERE roster_id IS NOT NULL GROUP BY 1),
ro2 AS (SELECT roster_id, unnest(range(len(members))) AS member_ord, unnest(members) AS m FROM ro1),
rost AS (SELECT roster_id, member_ord, m.name AS name, unnest(CASE WHEN coalesce(len(m.aliases), 0) = 0 THEN [NULL] ELSE range(len(m.aliases)) END) AS alias_ord, unnest(CASE WHEN coalesce(len(m.aliases), 0) = 0 THEN [NULL] ELSE m.aliases END) AS alias FROM ro2)"""
