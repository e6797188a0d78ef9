"""Ordered-sequence queries: merges of turns, segments and sections, responders, context, chunks, statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from podium.operators.ordered import dense_index, islands, with_next, with_previous
from podium.plans import base as B

#: Default thresholds in milliseconds and rows (fixed values).
TURN_GAP, SEGMENT_GAP, SECTION_SLACK, REACH, CONTEXT, CHUNK = 500, 2000, 2, 4, 10, 150
RESPONSE = r"(?i)\b(?:present|here|aye|yes)\b"


def present(column: str) -> Column:
    """Neither null nor empty; blanks count as present."""
    return F.coalesce(F.col(column) != "", F.lit(False))


def ordered_text(text: Column, order: str, sep: str = " ") -> Column:
    """The non-empty texts of a group in order, joined."""
    rows = F.array_sort(F.collect_list(F.when(text != "", F.struct(F.col(order).alias("i"), text.alias("t")))))
    return F.array_join(F.transform(rows, lambda r: r["t"]), sep)


def merge_turns(seg: DataFrame, gap: int, key: Column) -> DataFrame:
    """Numbers stretches of one key whose gaps to the row before are less than `gap`; negative gaps merge."""
    rows = with_previous(seg.withColumn("_key", key), ["meeting_id"], "idx", ["_key", "end_ms"])
    starts = (F.col("_key") != F.col("prev__key")) | (F.col("start_ms") - F.col("prev_end_ms") >= gap)
    return islands(rows, ["meeting_id"], "idx", starts)


def turn_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw turns: the merged end is the last row's, which may lie before an earlier one's."""
    rows = merge_turns(B.segments(spark, sf_dir), TURN_GAP, F.col("label"))
    return rows.groupBy("meeting_id", "island", "label").agg(
        F.min_by("start_ms", "idx").alias("start_ms"), F.max_by("end_ms", "idx").alias("end_ms"), F.count(F.lit(1)).alias("n")
    ).withColumn("turn_id", F.col("island") - 1).drop("island")


_ISLAND = """
p AS (SELECT *, lag({key}) OVER w AS pk, lag(end_ms) OVER w AS pe FROM seg WINDOW w AS (PARTITION BY meeting_id ORDER BY idx)),
i AS (SELECT *, sum(CASE WHEN pk = {key} AND start_ms - pe < {gap} THEN 0 ELSE 1 END) OVER (PARTITION BY meeting_id ORDER BY idx) - 1 AS island FROM p)"""
TURN_SQL = f"""WITH {B.SEG}, {_ISLAND.format(key="label", gap=TURN_GAP)}
SELECT meeting_id, arg_min(label, idx) AS label, arg_min(start_ms, idx) AS start_ms, arg_max(end_ms, idx) AS end_ms, count(*) AS n, island AS turn_id FROM i GROUP BY meeting_id, island"""


def display_name() -> Column:
    """The name, or the label where it is null or empty."""
    return F.coalesce(F.nullif("speaker_name", F.lit("")), F.col("label"))


def segment_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adjacent segments of one display name: texts and words joined in order, the rest from the first."""
    rows = merge_turns(B.segments(spark, sf_dir, "confidence", "id_method", "words"), SEGMENT_GAP, display_name())
    words = F.flatten(F.transform(F.array_sort(F.collect_list(F.when(F.size("words") > 0, F.struct("idx", "words")))), lambda r: r["words"]))
    out = rows.groupBy("meeting_id", "island").agg(
        F.min_by("label", "idx").alias("label"), F.min_by("speaker_name", "idx").alias("speaker_name"), F.min_by("confidence", "idx").alias("confidence"), F.min_by("id_method", "idx").alias("id_method"),
        F.min_by("start_ms", "idx").alias("start_ms"), F.max_by("end_ms", "idx").alias("end_ms"), ordered_text(F.col("text"), "idx").alias("text"), F.size(words).alias("n_words"),
        F.try_element_at(F.transform(words, lambda w: w["word"]), F.lit(-1)).alias("last_word"),
    )
    return out.withColumn("segment_id", F.col("island") - 1).drop("island")


SEGMENT_SQL = f"""WITH {B.SEG}, {_ISLAND.format(key="coalesce(nullif(speaker_name, ''), label)", gap=SEGMENT_GAP)},
l AS (SELECT meeting_id, island, CAST(sum(CASE WHEN len(words) > 0 THEN len(words) ELSE 0 END) AS INTEGER) AS n_words, arg_max(CASE WHEN len(words) > 0 THEN words[len(words)].word END, CASE WHEN len(words) > 0 THEN idx END) AS last_word FROM i GROUP BY 1, 2)
SELECT meeting_id, first(label ORDER BY idx) AS label, first(speaker_name ORDER BY idx) AS speaker_name, first(confidence ORDER BY idx) AS confidence, first(id_method ORDER BY idx) AS id_method, arg_min(start_ms, idx) AS start_ms, arg_max(end_ms, idx) AS end_ms,
  coalesce(string_agg(nullif(text, ''), ' ' ORDER BY idx), '') AS text, any_value(n_words) AS n_words, any_value(last_word) AS last_word, island AS segment_id
FROM i JOIN l USING (meeting_id, island) GROUP BY meeting_id, island"""


def section_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbouring sections of one type, at most two segments apart; the longest title, the first of equals.

    Only in meetings of more segments than a chunk holds, as only these were classified in several chunks.
    """
    big = B.segments(spark, sf_dir, indexed=False).groupBy("meeting_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CHUNK).select("meeting_id", F.lit(True).alias("big"))
    s = dense_index(B.sections(spark, sf_dir), ["meeting_id"], "pos", "idx", tie="pos")
    rows = with_previous(s, ["meeting_id"], "idx", ["type", "end_segment"]).join(big, "meeting_id", "left")
    starts = F.col("big").isNull() | (F.col("type") != F.col("prev_type")) | (F.col("start_segment") > F.col("prev_end_segment") + SECTION_SLACK)
    out = islands(rows, ["meeting_id"], "idx", starts)
    title = F.max_by("title", F.struct(F.char_length(F.coalesce("title", F.lit(""))), -F.col("idx")))
    return out.groupBy("meeting_id", "island").agg(F.min_by("type", "idx").alias("type"), F.min_by("start_segment", "idx").alias("start_segment"), F.max_by("end_segment", "idx").alias("end_segment"), title.alias("title"))


SECTION_SQL = f"""WITH {B.SEG}, {B.SECT}, p AS (SELECT *, meeting_id IN (SELECT meeting_id FROM seg GROUP BY 1 HAVING count(*) > {CHUNK}) AS big, lag(type) OVER w AS pt, lag(end_segment) OVER w AS pe FROM sect WINDOW w AS (PARTITION BY meeting_id ORDER BY pos)),
i AS (SELECT *, sum(CASE WHEN big AND pt = type AND start_segment <= pe + {SECTION_SLACK} THEN 0 ELSE 1 END) OVER (PARTITION BY meeting_id ORDER BY pos) AS island FROM p)
SELECT meeting_id, CAST(island AS BIGINT) AS island, first(type ORDER BY pos) AS type, first(start_segment ORDER BY pos) AS start_segment, last(end_segment ORDER BY pos) AS end_segment, first(title ORDER BY length(coalesce(title, '')) DESC, pos) AS title FROM i GROUP BY 1, 2"""


def responders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the next four rows, the first other speaker, and the first other speaker who responds."""
    seg = B.segments(spark, sf_dir).select("meeting_id", "segment_id", "idx", "label", "text")
    rows = with_next(seg, ["meeting_id"], "idx", ["label", "text"], REACH)
    other = F.filter("following", lambda r: r["label"] != F.col("label"))
    answers = F.filter(other, lambda r: r["text"].rlike(RESPONSE))
    out = rows.select("meeting_id", "segment_id", F.get(other, F.lit(0))["label"].alias("next_speaker"), F.get(answers, F.lit(0))["label"].alias("responder"))
    return out.where("next_speaker is not null")


_LEADS = ", ".join(f"lead(label, {k}) OVER w AS l{k}, lead(text, {k}) OVER w AS t{k}" for k in range(1, REACH + 1))
RESPONDER_SQL = f"""WITH {B.SEG}, n AS (SELECT *, {_LEADS} FROM seg WINDOW w AS (PARTITION BY meeting_id ORDER BY idx))
SELECT meeting_id, segment_id, coalesce({", ".join(f"CASE WHEN l{k} <> label THEN l{k} END" for k in range(1, REACH + 1))}) AS next_speaker,
  coalesce({", ".join(f"CASE WHEN l{k} <> label AND regexp_matches(t{k}, '(?i)\\b(?:present|here|aye|yes)\\b') THEN l{k} END" for k in range(1, REACH + 1))}) AS responder
FROM n WHERE next_speaker IS NOT NULL"""


def context_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each speaker the rows around the occurrence a third into their own: ten before to nine after."""
    seg = B.segments(spark, sf_dir).select("meeting_id", "segment_id", "idx", "label", "text")
    own = dense_index(seg, ["meeting_id", "label"], "idx", "k", tie="segment_id")
    n = own.groupBy("meeting_id", "label").agg(F.count(F.lit(1)).alias("n"))
    pick = own.join(n, ["meeting_id", "label"]).where(F.col("k") == F.when(F.col("n") >= 3, F.expr("n div 3")).otherwise(0))
    around = pick.select("meeting_id", "label", F.col("idx").alias("center"), F.explode(F.sequence(F.greatest(F.lit(0), F.col("idx") - CONTEXT), F.col("idx") + CONTEXT - 1)).alias("idx"))
    return around.join(seg.select("meeting_id", "idx", "segment_id"), ["meeting_id", "idx"]).select("meeting_id", "label", "center", "idx", "segment_id")


CONTEXT_SQL = f"""WITH {B.SEG}, o AS (SELECT *, row_number() OVER (PARTITION BY meeting_id, label ORDER BY idx) - 1 AS k, count(*) OVER (PARTITION BY meeting_id, label) AS n FROM seg),
c AS (SELECT meeting_id, label, idx AS center FROM o WHERE k = CASE WHEN n >= 3 THEN n // 3 ELSE 0 END)
SELECT c.meeting_id, c.label, center, s.idx, s.segment_id FROM c JOIN seg s ON s.meeting_id = c.meeting_id AND s.idx BETWEEN greatest(0, center - {CONTEXT}) AND center + {CONTEXT} - 1"""


def transcript_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of 150 of the segments with text; the chunk's range and length."""
    seg = B.segments(spark, sf_dir).where(present("text")).select("meeting_id", "segment_id", "idx", F.char_length("text").alias("chars"))
    rows = dense_index(seg, ["meeting_id"], "idx", "k", tie="segment_id").withColumn("chunk", F.floor(F.col("k") / CHUNK))
    return rows.groupBy("meeting_id", "chunk").agg(F.min_by("segment_id", "k").alias("first_segment"), F.max_by("segment_id", "k").alias("last_segment"), F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"))


CHUNK_SQL = f"""WITH {B.SEG}, k AS (SELECT *, (row_number() OVER (PARTITION BY meeting_id ORDER BY idx) - 1) // {CHUNK} AS chunk FROM seg WHERE text <> '')
SELECT meeting_id, chunk, arg_min(segment_id, idx) AS first_segment, arg_max(segment_id, idx) AS last_segment, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars FROM k GROUP BY 1, 2"""


def speaker_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each speaker's segments, speech, first segment, sample and rank by speech, ties by first appearance.

    The sample is the segment at a third of those with text, else of all.
    """
    seg = B.segments(spark, sf_dir, indexed=False).select("meeting_id", "label", "segment_id", "pos", "start_ms", "end_ms", "text")
    seq = F.shiftleft(F.coalesce("pos", F.lit(-1)).cast("bigint"), 32) + F.col("segment_id")  # arrival order in one number
    spoken = F.coalesce(F.trim(F.regexp_replace("text", r"\s+", " ")) != "", F.lit(False))
    keys = ["meeting_id", "label"]
    rows = dense_index(seg.withColumns({"has_text": spoken, "seq": seq}).drop("text"), [*keys, "has_text"], "pos", "k", tie="segment_id")
    per = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("seg_count"), F.sum(F.col("end_ms") - F.col("start_ms")).alias("speech_ms"), F.min("seq").alias("first_seq"), F.min_by("segment_id", "seq").alias("first_segment"), F.count_if("has_text").alias("n_text")
    )
    n = F.when(F.col("n_text") > 0, F.col("n_text")).otherwise(F.col("seg_count"))
    at = F.greatest(F.lit(0), F.floor(n / 3) - 1)
    wanted = per.select(*keys, (F.col("n_text") > 0).alias("has_text"), at.alias("k"))
    sample = rows.join(wanted, [*keys, "has_text", "k"]).select(*keys, F.col("segment_id").alias("sample_segment"))
    # A meeting's speakers are few: one small window orders them.
    ranked = per.join(sample, keys)
    w = Window.partitionBy("meeting_id").orderBy(F.desc("speech_ms"), "first_seq")
    return ranked.withColumn("speech_rank", F.row_number().over(w)).select(*keys, "seg_count", "speech_ms", "first_segment", "sample_segment", "speech_rank")


STATS_SQL = f"""WITH {B.SEG}, h AS (SELECT *, coalesce(trim(regexp_replace(text, '\\s+', ' ', 'g')) <> '', false) AS has_text FROM seg),
k AS (SELECT *, row_number() OVER (PARTITION BY meeting_id, label, has_text ORDER BY idx) - 1 AS k FROM h),
p AS (SELECT meeting_id, label, count(*) AS seg_count, CAST(sum(end_ms - start_ms) AS BIGINT) AS speech_ms, min(idx) AS first_idx, arg_min(segment_id, idx) AS first_segment, count(*) FILTER (has_text) AS n_text FROM h GROUP BY 1, 2)
SELECT p.meeting_id, p.label, seg_count, speech_ms, first_segment, k.segment_id AS sample_segment, CAST(row_number() OVER (PARTITION BY p.meeting_id ORDER BY speech_ms DESC, first_idx) AS INTEGER) AS speech_rank
FROM p JOIN k ON k.meeting_id = p.meeting_id AND k.label = p.label AND k.has_text = (n_text > 0) AND k.k = greatest(0, (CASE WHEN n_text > 0 THEN n_text ELSE seg_count END) // 3 - 1)"""


def meeting_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Speakers, segments, segments with text, and whether any has text, of each meeting."""
    seg = B.segments(spark, sf_dir, indexed=False)
    return seg.groupBy("meeting_id").agg(F.countDistinct("label").alias("n_speakers"), F.count(F.lit(1)).alias("n_segments"), F.count_if(present("text")).alias("n_aligned"), F.bool_or(present("text")).alias("any_text"))


COUNTS_SQL = f"WITH {B.SEG} SELECT meeting_id, count(DISTINCT label) AS n_speakers, count(*) AS n_segments, count(*) FILTER (text <> '') AS n_aligned, coalesce(bool_or(text <> ''), false) AS any_text FROM seg GROUP BY 1"

QUERIES = {"speaker_stats": speaker_stats, "turn_merge": turn_merge, "segment_merge": segment_merge, "section_merge": section_merge, "responders": responders, "context_windows": context_windows, "transcript_chunks": transcript_chunks, "meeting_counts": meeting_counts}
SQL = {"speaker_stats": STATS_SQL, "turn_merge": TURN_SQL, "segment_merge": SEGMENT_SQL, "section_merge": SECTION_SQL, "responders": RESPONDER_SQL, "context_windows": CONTEXT_SQL, "transcript_chunks": CHUNK_SQL, "meeting_counts": COUNTS_SQL}
