"""Captions: alignment with segments, word times, and the timing of subtitles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.functions import text as T
from podium.operators.ordered import running_sum
from podium.operators.overlap import overlapping
from podium.plans import base as B
from podium.plans.sequences import display_name, ordered_text, present
from podium.sources.tables import longest, table

#: Shares of a caption that a segment must cover to take all of it, or a part of its words (fixed values).
WHOLE, PART, LINE = 0.5, 0.2, 80


def _words(c: Column) -> Column:
    return F.filter(F.split(c, r"\s+"), lambda w: w != "")


def _longest(spark: SparkSession, sf_dir: str) -> int:
    return max(longest(table(spark, sf_dir, "segments"), ("start_time", "end_time")), longest(table(spark, sf_dir, "cues"), ("start", "end")))


def caption_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each segment's text from the captions it covers, in caption order; without any it keeps its own.

    A caption covered by half or more gives all its text, to every segment that covers so much; one
    covered by a fifth gives as many of its words, from its front if the segment begins before it.
    """
    seg = B.segments(spark, sf_dir, indexed=False).select("meeting_id", "segment_id", F.col("start_ms").alias("l_start"), F.col("end_ms").alias("l_end"), F.col("text").alias("own"))
    cues = B.cues(spark, sf_dir).select("meeting_id", "pos", F.col("start_ms").alias("r_start"), F.col("end_ms").alias("r_end"), F.trim("text").alias("cue")).where("cue <> ''")
    both = overlapping(seg, cues, "meeting_id", longest=_longest(spark, sf_dir))
    share = (F.least("l_end", "r_end") - F.greatest("l_start", "r_start")) / (F.col("r_end") - F.col("r_start"))
    w = _words(F.col("cue"))
    k = F.greatest(F.lit(1), F.floor(F.size(w) * share)).cast("int")
    taken = F.when(share >= WHOLE, F.col("cue")).when(share >= PART, F.array_join(F.when(F.col("l_start") <= F.col("r_start"), F.slice(w, 1, k)).otherwise(F.slice(w, F.greatest(F.lit(1), F.size(w) - k + 1), k)), " "))
    texts = both.withColumn("taken", taken).where("taken is not null").groupBy("meeting_id", "segment_id").agg(ordered_text(F.col("taken"), "pos").alias("from_cues"))
    out = seg.join(texts, ["meeting_id", "segment_id"], "left")
    return out.select("meeting_id", "segment_id", F.coalesce("from_cues", "own").alias("text"), F.col("from_cues").isNotNull().alias("aligned"))


_ALIGN = f"""{B.SEG}, {B.CUES},
ov AS (SELECT s.meeting_id, s.segment_id, c.pos, trim(c.text) AS cue, s.start_ms <= c.start_ms AS front, CAST(least(s.end_ms, c.end_ms) - greatest(s.start_ms, c.start_ms) AS DOUBLE) / (c.end_ms - c.start_ms) AS share
  FROM seg s JOIN cue c ON s.meeting_id = c.meeting_id AND s.start_ms < c.end_ms AND c.start_ms < s.end_ms AND c.end_ms > c.start_ms AND trim(c.text) <> ''),
ow AS (SELECT *, list_filter(string_split_regex(cue, '\\s+'), lambda w: w <> '') AS w FROM ov),
ok AS (SELECT *, CAST(greatest(1, trunc(len(w) * share)) AS BIGINT) AS k FROM ow),
ot AS (SELECT meeting_id, segment_id, string_agg(CASE WHEN share >= {WHOLE} THEN cue ELSE array_to_string(CASE WHEN front THEN w[1:k] ELSE w[greatest(1, len(w) - k + 1):len(w)] END, ' ') END, ' ' ORDER BY pos) AS from_cues FROM ok WHERE share >= {PART} GROUP BY 1, 2)"""
ALIGN_SQL = f"WITH {_ALIGN} SELECT s.meeting_id, s.segment_id, coalesce(from_cues, text) AS text, from_cues IS NOT NULL AS aligned FROM seg s LEFT JOIN ot USING (meeting_id, segment_id)"


def word_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of each text, spread evenly over its segment; milliseconds rounded."""
    seg = B.segments(spark, sf_dir, indexed=False).where("end_ms > start_ms").select("meeting_id", "segment_id", "start_ms", "end_ms", _words(F.col("text")).alias("w")).where("size(w) > 0")
    step = (F.col("end_ms") - F.col("start_ms")) / F.size("w")
    rows = seg.select("meeting_id", "segment_id", "start_ms", step.alias("step"), F.posexplode("w").alias("i", "word"))
    at = lambda i: F.round(F.col("start_ms") + i * F.col("step")).cast("bigint")
    return rows.select("meeting_id", "segment_id", "i", "word", at(F.col("i")).alias("start_ms"), at(F.col("i") + 1).alias("end_ms"))


WORDS_SQL = f"""WITH {B.SEG}, w AS (SELECT meeting_id, segment_id, start_ms, end_ms, list_filter(string_split_regex(text, '\\s+'), lambda w: w <> '') AS w FROM seg WHERE end_ms > start_ms),
x AS (SELECT meeting_id, segment_id, start_ms, CAST(end_ms - start_ms AS DOUBLE) / len(w) AS step, CAST(unnest(range(len(w))) AS INTEGER) AS i, unnest(w) AS word FROM w WHERE len(w) > 0)
SELECT meeting_id, segment_id, i, word, CAST(round(start_ms + i * step) AS BIGINT) AS start_ms, CAST(round(start_ms + (i + 1) * step) AS BIGINT) AS end_ms FROM x"""


def overlap_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How long each segment and each caption of its meeting overlap."""
    seg = B.segments(spark, sf_dir, indexed=False).select("meeting_id", "segment_id", F.col("start_ms").alias("l_start"), F.col("end_ms").alias("l_end"))
    cues = B.cues(spark, sf_dir).select("meeting_id", "pos", F.col("start_ms").alias("r_start"), F.col("end_ms").alias("r_end"))
    return overlapping(seg, cues, "meeting_id", longest=_longest(spark, sf_dir)).select("meeting_id", "segment_id", "pos", (F.least("l_end", "r_end") - F.greatest("l_start", "r_start")).alias("overlap_ms"))


OVERLAP_SQL = f"WITH {B.SEG}, {B.CUES} SELECT s.meeting_id, segment_id, c.pos, least(s.end_ms, c.end_ms) - greatest(s.start_ms, c.start_ms) AS overlap_ms FROM seg s JOIN cue c ON s.meeting_id = c.meeting_id AND s.start_ms < c.end_ms AND c.start_ms < s.end_ms AND s.end_ms > s.start_ms AND c.end_ms > c.start_ms"


def srt_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(meeting_id, idx, part, counter, start_ms, end_ms, speaker, line): one entry a short segment, else one a sentence.

    Sentences share the segment's time by length; times are whole milliseconds, cut off.
    """
    seg = B.segments(spark, sf_dir).where(present("text")).select("meeting_id", "idx", "start_ms", "end_ms", display_name().alias("speaker"), "text")
    parts = T.sentences(F.col("text"))
    seg = seg.withColumn("parts", parts).where("size(parts) > 0")
    whole = (F.char_length("text") <= LINE) | (F.size("parts") == 1)
    lines = seg.select("meeting_id", "idx", "start_ms", "end_ms", "speaker", F.when(whole, F.array("text")).otherwise(F.col("parts")).alias("lines"))
    total = F.aggregate("lines", F.lit(0), lambda s, x: s + F.char_length(x))
    rows = lines.withColumn("total", total).select("meeting_id", "idx", "start_ms", "end_ms", "speaker", "total", "lines", F.posexplode("lines").alias("part", "line"))
    before = F.aggregate(F.slice("lines", 1, F.col("part")), F.lit(0), lambda s, x: s + F.char_length(x))
    at = lambda n: (F.col("start_ms") + F.floor((F.col("end_ms") - F.col("start_ms")) * n / F.col("total"))).cast("bigint")
    timed = rows.withColumn("before", before).select("meeting_id", "idx", "part", at(F.col("before")).alias("start_ms"), at(F.col("before") + F.char_length("line")).alias("end_ms"), "speaker", "line")
    return running_sum(timed, ["meeting_id"], ["idx", "part"], F.lit(1).cast("bigint"), "counter")


def srt_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = srt_rows(spark, sf_dir)
    entry = F.concat(F.col("counter").cast("string"), F.lit("\n"), T.srt_time(F.col("start_ms")), F.lit(" --> "), T.srt_time(F.col("end_ms")), F.lit("\n["), "speaker", F.lit("] "), "line", F.lit("\n"))
    return r.select("meeting_id", "counter", entry.alias("entry"))


SRT_SQL = f"""WITH {B.SEG}, d AS (SELECT meeting_id, idx, start_ms, end_ms, coalesce(nullif(speaker_name, ''), label) AS speaker, text, {T.SENTENCES_SQL} AS parts FROM seg WHERE text <> ''),
l AS (SELECT *, CASE WHEN length(text) <= {LINE} OR len(parts) = 1 THEN [text] ELSE parts END AS lines FROM d WHERE len(parts) > 0),
x AS (SELECT meeting_id, idx, start_ms, end_ms, speaker, list_sum(list_transform(lines, lambda x: length(x))) AS total, unnest(range(len(lines))) AS part, unnest(lines) AS line FROM l),
y AS (SELECT *, coalesce(sum(length(line)) OVER (PARTITION BY meeting_id, idx ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM x),
z AS (SELECT meeting_id, speaker, line, row_number() OVER (PARTITION BY meeting_id ORDER BY idx, part) AS counter, CAST(start_ms + floor(CAST((end_ms - start_ms) * before AS DOUBLE) / total) AS BIGINT) AS s, CAST(start_ms + floor(CAST((end_ms - start_ms) * (before + length(line)) AS DOUBLE) / total) AS BIGINT) AS e FROM y)
SELECT meeting_id, counter, counter || chr(10) || {T.srt_time_sql("s")} || ' --> ' || {T.srt_time_sql("e")} || chr(10) || '[' || speaker || '] ' || line || chr(10) AS entry FROM z"""

QUERIES = {"caption_alignment": caption_alignment, "word_times": word_times, "overlap_lengths": overlap_lengths, "srt_entries": srt_entries}
SQL = {"caption_alignment": ALIGN_SQL, "word_times": WORDS_SQL, "overlap_lengths": OVERLAP_SQL, "srt_entries": SRT_SQL}
