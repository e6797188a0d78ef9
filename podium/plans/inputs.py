"""Queries of the readers, predicates and batch control, over inputs composed from the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.functions import text as T
from podium.functions.labels import normal_label
from podium.plans import base as B
from podium.plans.people import LLM, VOICE, _cascade_sql, cascade, named_mappings, slug_of
from podium.plans.sequences import present
from podium.sources import formats as S
from podium.sources.tables import table

BASE, MEDIA, ARCHIVE, CITY, KIND = "https://media.example/archive", "media.example", "archive.example", "Granford", "Regular Session"
RATE = 16_000


def segment_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments written as JSON without null fields and read back."""
    t = B.first_delivery(table(spark, sf_dir, "segments").select("meeting_id", "segment_id", "ingested_at", "pos", "start_time", "end_time", "text", "words", "speaker_name", "confidence"), ["meeting_id", "segment_id"], ["ingested_at", "pos"])
    s = t.select("meeting_id", S.segment_from_json(S.segment_to_json("segment_id", "start_time", "end_time", "text", "words", "speaker_name", "confidence")).alias("s"))
    return s.select("meeting_id", "s.segment_id", "s.start_time", "s.end_time", "s.text", F.size("s.words").alias("n_words"), "s.speaker_name", "s.confidence")


SEGMENT_SQL = f"WITH {B.SEG} SELECT meeting_id, segment_id, start_time, end_time, coalesce(text, '') AS text, CAST(coalesce(len(words), 0) AS INTEGER) AS n_words, speaker_name, confidence FROM num_seg"


def meeting_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Meetings as JSON documents and back, with the id made from date and type where it is missing."""
    m = B.meetings(spark, sf_dir)
    s = F.from_json(F.to_json(F.struct("meeting_id", "city", "date", "meeting_type", "duration_seconds")), S.MEETING)
    d = m.select("meeting_id", s.alias("d"))
    made = F.concat_ws("-", F.coalesce("d.date", F.lit("")), F.replace(F.lower(F.coalesce("d.meeting_type", F.lit(""))), F.lit(" "), F.lit("-")))
    return d.select("meeting_id", "d.city", "d.date", "d.meeting_type", "d.duration_seconds", made.alias("made_id"))


MEETING_SQL = f"WITH {B.MEET} SELECT meeting_id, city, date, meeting_type, duration_seconds, coalesce(date, '') || '-' || replace(lower(coalesce(meeting_type, '')), ' ', '-') AS made_id FROM meet"


def embedding_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maps of label to vector as JSON, read back."""
    p = B.profiles(spark, sf_dir).where("size(centroid) > 0")
    j = p.select("ord", F.to_json(F.create_map("slug", "centroid")).alias("j"))
    return S.embeddings_from_json(j, "j", "ord").select("ord", "label", F.size("embedding").alias("dim"), F.get("embedding", F.lit(0)).alias("first"))


EMBEDDING_SQL = f"WITH {B.PROF} SELECT ord, slug AS label, CAST(len(centroid) AS INTEGER) AS dim, centroid[1] AS first FROM prof WHERE len(centroid) > 0"


def caption_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Caption files of up to 50 captions, composed from the cues and parsed."""
    c = B.cues(spark, sf_dir).where("start_ms >= 0 and start_ms < 360000000 and end_ms >= 0 and end_ms < 360000000")
    line = F.concat(T.srt_time(F.col("start_ms")), F.lit(" --> "), F.replace(T.srt_time(F.col("end_ms")), F.lit(","), F.lit(".")), F.lit(" align:start\n<v Speaker>"), F.replace(F.regexp_replace(F.coalesce("text", F.lit("")), r"\s+", " "), F.lit("-->"), F.lit("→")), F.lit("</v>"))
    rows = F.transform(F.array_sort(F.collect_list(F.struct("pos", line.alias("l")))), lambda r: r["l"])
    files = c.groupBy("meeting_id", F.floor(F.col("pos") / 50).alias("file")).agg(F.concat(F.lit("WEBVTT\n\n"), F.array_join(rows, "\n\n"), F.lit("\n")).alias("content"))
    return S.parse_vtt(files.where(S.is_vtt(F.col("content"))), "content", "meeting_id", "file").select("meeting_id", "start_ms", "end_ms", "text")


CAPTIONS_SQL = f"WITH {B.CUES}, c AS (SELECT meeting_id, start_ms, end_ms, trim(regexp_replace(replace(regexp_replace(text, '\\s+', ' ', 'g'), '-->', '→'), '<[^>]+>', '', 'g')) AS t FROM cue WHERE start_ms >= 0 AND start_ms < 360000000 AND end_ms >= 0 AND end_ms < 360000000) SELECT meeting_id, start_ms, end_ms, t AS text FROM c WHERE t <> ''"


def archive_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive pages composed from the meetings, listed."""
    m = B.meetings(spark, sf_dir)
    tag = F.concat(F.lit('<li><a href="#" data-m4v="'), F.coalesce("audio_source", F.lit("")), F.lit('" data-name=" '), F.coalesce("meeting_type", F.lit("")), F.lit(' " data-date="'), F.coalesce("date", F.lit("")), F.lit('" data-hasagenda="'), F.when(F.col("duration_seconds").isNull(), "False").otherwise("TRUE"), F.lit('">x</a></li>'))
    pages = m.select("meeting_id", F.concat(F.lit("<html><ul>"), tag, F.lit('<a href="/about">About</a></ul></html>')).alias("html"))
    return S.archive_listing(pages, "html", BASE, "meeting_id").select("meeting_id", "name", "date", "m4v", "video_url", "vtt_url", "has_agenda")


ARCHIVE_SQL = f"WITH {B.MEET} SELECT meeting_id, trim(coalesce(meeting_type, '')) AS name, trim(coalesce(date, '')) AS date, audio_source AS m4v, '{BASE}/' || audio_source AS video_url, '{BASE}/' || regexp_replace(audio_source, '\\.[^.]*$', '') || '.vtt' AS vtt_url, duration_seconds IS NOT NULL AS has_agenda FROM meet WHERE audio_source <> ''"


def page_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The video of pages with a player's configuration, with a link, or with neither; and how their URLs are routed."""
    m = B.meetings(spark, sf_dir)
    k = F.char_length("meeting_id") % 3
    html = F.when(k == 0, F.concat(F.lit("<script>jP({m4v: '"), "meeting_id", F.lit(".m4v'})</script>"))).when(k == 1, F.concat(F.lit('<a class="r" data-m4v="'), F.lit("https://media.example/x/"), "meeting_id", F.lit('.m4v">v</a>'))).otherwise("<p>none</p>")
    url = F.when(k == 0, F.lit("https://media.example/v/1.m4v")).when(k == 1, F.lit("http://www.archive.example/m.php?q=1")).otherwise(F.col("audio_source"))
    return m.select("meeting_id", S.page_video(html, BASE).alias("video_url"), S.is_url(url).alias("is_url"), S.route(url, MEDIA, ARCHIVE).alias("route"))


PAGE_SQL = f"""WITH {B.MEET}, k AS (SELECT *, length(meeting_id) % 3 AS k FROM meet) SELECT meeting_id, CASE k WHEN 0 THEN '{BASE}/' || meeting_id || '.m4v' WHEN 1 THEN 'https://media.example/x/' || meeting_id || '.m4v' END AS video_url,
  CASE WHEN k < 2 THEN true ELSE coalesce(regexp_matches(audio_source, '^https?://'), false) END AS is_url, CASE k WHEN 0 THEN 'file' WHEN 1 THEN 'page' ELSE 'as_is' END AS route FROM k"""


def batch_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a batch list composed from the meetings, parsed, without the meetings that are identified already."""
    m = B.meetings(spark, sf_dir)
    k = F.char_length("meeting_id") % 4
    line = F.when(k == 0, F.concat(F.lit("  "), "meeting_id", F.lit(".mp4"))).when(k == 1, F.concat(F.lit("# "), "meeting_id")).when(k == 2, F.concat_ws(" ", F.concat("meeting_id", F.lit(".m4v")), F.lit("2024-05-06"), "city")).otherwise(F.concat_ws("  ", F.concat("meeting_id", F.lit(".mkv")), F.lit("2024-05-06"), "city", F.lit("Special  Session")))
    return S.batch_lines(m.select("meeting_id", line.alias("line")), "line", CITY, KIND, "meeting_id")


BATCH_SQL = f"""WITH {B.MEET}, k AS (SELECT *, length(meeting_id) % 4 AS k FROM meet) SELECT meeting_id, meeting_id || CASE k WHEN 0 THEN '.mp4' WHEN 2 THEN '.m4v' ELSE '.mkv' END AS input, CASE WHEN k = 0 THEN '' ELSE '2024-05-06' END AS date,
  CASE WHEN k = 0 THEN '{CITY}' ELSE coalesce(city, CASE WHEN k = 2 THEN '{CITY}' ELSE 'Special' END) END AS city, CASE WHEN k = 3 THEN 'Special  Session' ELSE '{KIND}' END AS meeting_type FROM k WHERE k <> 1"""


def batch_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dated entries whose meeting is not identified yet; here a meeting is, if someone has named a speaker of it by hand."""
    entries = batch_entries(spark, sf_dir)
    done = named_mappings(spark, sf_dir).where("method = 'manual'").select("meeting_id").distinct()
    left = entries.join(done.withColumn("done", F.lit(True)), "meeting_id", "left")
    return left.where("date = '' or done is null").select("meeting_id", "input", "date")


RESUME_SQL = f"WITH {B.MAPS}, e AS ({BATCH_SQL}) SELECT meeting_id, input, date FROM e WHERE date = '' OR NOT EXISTS (SELECT 1 FROM map m WHERE m.meeting_id = e.meeting_id AND id_method = 'manual')"


def batch_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of statuses, failures by their beginning."""
    m = B.meetings(spark, sf_dir)
    status = F.when(F.col("duration_seconds").isNull(), F.concat(F.lit("failed: "), F.coalesce("audio_source", F.lit("")))).when(F.col("audio_source") == "", "skipped").otherwise("completed")
    return m.select(status.alias("s")).agg(F.count_if(F.col("s") == "completed").alias("completed"), F.count_if(F.col("s") == "skipped").alias("skipped"), F.count_if(F.col("s").startswith("failed")).alias("failed"))


STATUS_SQL = f"WITH {B.MEET} SELECT count(*) FILTER (duration_seconds IS NOT NULL AND (audio_source <> '' OR audio_source IS NULL)) AS completed, count(*) FILTER (duration_seconds IS NOT NULL AND audio_source = '') AS skipped, count(*) FILTER (duration_seconds IS NULL) AS failed FROM meet"


def video_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of several files of a meeting the preferred one, and the entries of a folder's videos."""
    m = B.meetings(spark, sf_dir).select("meeting_id", F.explode(F.array(*[F.concat(F.lit("/in/"), "meeting_id", F.lit(x)) for x in (".txt", ".MKV", ".webm", ".mp4")])).alias("path"))
    pick = S.preferred_video(m, "meeting_id", "path")
    entries = S.video_files(m, "path", CITY, KIND)
    return pick.join(entries, pick["video"] == entries["input"]).select("meeting_id", "video", "date")


CHOICE_SQL = f"WITH {B.MEET} SELECT meeting_id, '/in/' || meeting_id || '.mp4' AS video, regexp_extract(meeting_id, '\\d{{4}}-\\d{{2}}-\\d{{2}}', 0) AS date FROM meet"


def listing_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 25 listings as shown: type and source, cut to 60 characters."""
    m = B.meetings(spark, sf_dir).orderBy("meeting_id").limit(25)
    t = F.concat_ws(" — ", F.coalesce("meeting_type", F.lit("")), "meeting_id")
    return m.select("meeting_id", F.when(F.char_length(t) > 60, F.concat(F.substring(t, 1, 57), F.lit("..."))).otherwise(t).alias("title"))


DISPLAY_SQL = f"WITH {B.MEET}, t AS (SELECT meeting_id, coalesce(meeting_type, '') || ' — ' || meeting_id AS t FROM meet ORDER BY meeting_id LIMIT 25) SELECT meeting_id, CASE WHEN length(t) > 60 THEN substr(t, 1, 57) || '...' ELSE t END AS title FROM t"


def audible_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a segment has samples enough to embed (0.3 s) and to transcribe (0.1 s), cut at the recording's end."""
    s = B.segments(spark, sf_dir, indexed=False)
    m = B.meetings(spark, sf_dir).select("meeting_id", F.round(F.col("duration_seconds") * 1000).cast("bigint").alias("total"))
    cut = lambda c: F.floor(F.least(F.col(c), F.coalesce("total", c)) * RATE / 1000)
    rows = s.join(m, "meeting_id", "left").select("meeting_id", "segment_id", (cut("end_ms") - cut("start_ms")).alias("samples"))
    return rows.select("meeting_id", "segment_id", "samples", (F.col("samples") >= RATE * 0.3).alias("embed"), (F.col("samples") >= RATE * 0.1).alias("transcribe"))


AUDIBLE_SQL = f"WITH {B.SEG}, {B.MEET}, d AS (SELECT s.meeting_id, segment_id, start_ms, end_ms, CAST(round(duration_seconds * 1000) AS BIGINT) AS total FROM seg s LEFT JOIN meet m USING (meeting_id)), x AS (SELECT *, least(end_ms, coalesce(total, end_ms)) * {RATE} // 1000 - least(start_ms, coalesce(total, start_ms)) * {RATE} // 1000 AS samples FROM d) SELECT meeting_id, segment_id, samples, samples >= {RATE} * 0.3 AS embed, samples >= {RATE} * 0.1 AS transcribe FROM x"


def text_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that are there, and those that are not blank either."""
    s = B.segments(spark, sf_dir, indexed=False)
    return s.where(present("text")).select("meeting_id", "segment_id", (F.trim(F.regexp_replace("text", r"\s+", " ")) != "").alias("not_blank"))


PRESENCE_SQL = f"WITH {B.SEG} SELECT meeting_id, segment_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) <> '' AS not_blank FROM seg WHERE text <> ''"


def normal_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every label as people type it; bare digits are a speaker's number."""
    return table(spark, sf_dir, "segments").where("speaker_label is not null").select("speaker_label").distinct().select("speaker_label", normal_label("speaker_label").alias("label"))


LABELS_SQL = "SELECT DISTINCT speaker_label, CASE WHEN regexp_matches(speaker_label, '^[0-9]+$') THEN 'SPEAKER_' || lpad(speaker_label, CAST(greatest(2, length(speaker_label)) AS INTEGER), '0') ELSE speaker_label END AS label FROM segments WHERE speaker_label IS NOT NULL"


def shifted_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words timed from their segment's start, as a recogniser of single segments gives them, put onto the recording's clock, to the millisecond.

    The segments' stored words are taken back to their own clock first.
    """
    s = B.segments(spark, sf_dir, "words", indexed=False).where("start_ms is not null and size(words) > 0")
    w = s.select("meeting_id", "segment_id", F.col("start_ms").alias("at"), F.posexplode("words").alias("i", "w"))
    own = lambda t: F.round(w["w"][t] * 1000).cast("bigint") - F.col("at")
    return w.select("meeting_id", "segment_id", "i", F.trim(F.col("w")["word"]).alias("word"), *[F.round((F.col("at") + own(t)) / 1000, 3).alias(t) for t in ("start", "end")])


SHIFTED_SQL = f"WITH {B.SEG}, w AS (SELECT meeting_id, segment_id, CAST(unnest(range(len(words))) AS INTEGER) AS i, unnest(words) AS w FROM seg WHERE start_ms IS NOT NULL AND len(words) > 0) SELECT meeting_id, segment_id, i, trim(w.word) AS word, round(w.start, 3) AS start, round(w.end, 3) AS end FROM w"


def centroids_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.profiles(spark, sf_dir).where("centroid is not null").select("ord", "slug", F.size("centroid").alias("dim"))


CENTROIDS_SQL = f"WITH {B.PROF} SELECT ord, slug, CAST(len(centroid) AS INTEGER) AS dim FROM prof WHERE centroid IS NOT NULL"


def enrol_eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sure mappings of persons that have a stored voice."""
    m = named_mappings(spark, sf_dir).where((F.trim("name") != "") & (F.col("confidence") >= VOICE)).select("mapping_id", slug_of(F.col("name")).alias("person"))
    voices = B.profiles(spark, sf_dir).where("size(embeddings) > 0 and trim(display_name) <> ''").select(slug_of(F.col("display_name")).alias("person")).distinct()
    return m.join(voices, "person", "left_semi").select("mapping_id", "person")


def _eligible_sql() -> str:
    from podium.plans.people import _slug_sql

    return f"WITH {B.MAPS}, {B.PROF} SELECT mapping_id, {_slug_sql('speaker_name')} AS person FROM map WHERE trim(speaker_name) <> '' AND confidence >= {VOICE} AND {_slug_sql('speaker_name')} IN (SELECT {_slug_sql('display_name')} FROM prof WHERE len(embeddings) > 0 AND trim(display_name) <> '')"


def identification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The identification of all meetings in one job: layers, then names on segments; who is named how, by method."""
    named = cascade(spark, sf_dir)
    seg = B.segments(spark, sf_dir, indexed=False).groupBy("meeting_id", "label").agg(F.count(F.lit(1)).alias("n"))
    out = seg.join(named, ["meeting_id", "label"], "left")
    return out.groupBy("meeting_id").agg(F.sum("n").alias("segments"), F.sum(F.when(F.col("name").isNotNull(), F.col("n")).otherwise(0)).alias("named"), F.count_if("needs_review").alias("to_review"), F.count_if(F.col("confidence") == LLM).alias("at_model_confidence"))


IDENTIFICATION_SQL = f"""WITH {_cascade_sql()}, n AS (SELECT meeting_id, label, count(*) AS n FROM seg GROUP BY 1, 2)
SELECT meeting_id, CAST(sum(n) AS BIGINT) AS segments, CAST(sum(CASE WHEN name IS NOT NULL THEN n ELSE 0 END) AS BIGINT) AS named, count(*) FILTER (needs_review) AS to_review, count(*) FILTER (confidence = {LLM}) AS at_model_confidence FROM n LEFT JOIN casc USING (meeting_id, label) GROUP BY 1"""

QUERIES = {
    "segment_json": segment_json, "meeting_json": meeting_json, "embedding_json": embedding_json, "caption_files": caption_files, "archive_pages": archive_pages, "page_videos": page_videos, "batch_entries": batch_entries, "batch_resume": batch_resume,
    "batch_status": batch_status, "video_choice": video_choice, "listing_display": listing_display, "audible_segments": audible_segments, "text_presence": text_presence, "normal_labels": normal_labels, "shifted_words": shifted_words, "centroids_present": centroids_present, "enrol_eligible": enrol_eligible, "identification": identification,
}
SQL = {
    "segment_json": SEGMENT_SQL, "meeting_json": MEETING_SQL, "embedding_json": EMBEDDING_SQL, "caption_files": CAPTIONS_SQL, "archive_pages": ARCHIVE_SQL, "page_videos": PAGE_SQL, "batch_entries": BATCH_SQL, "batch_resume": RESUME_SQL,
    "batch_status": STATUS_SQL, "video_choice": CHOICE_SQL, "listing_display": DISPLAY_SQL, "audible_segments": AUDIBLE_SQL, "text_presence": PRESENCE_SQL, "normal_labels": LABELS_SQL, "shifted_words": SHIFTED_SQL, "centroids_present": CENTROIDS_SQL, "enrol_eligible": _eligible_sql(), "identification": IDENTIFICATION_SQL,
}
