"""Readers of the domain's own formats: caption files, JSON documents, archive pages, batch lists, URLs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORDS = "array<struct<word: string, start: double, end: double>>"
SEGMENT = f"segment_id int, start_time double, end_time double, speaker_label string, text string, words {WORDS}, speaker_name string, confidence double, id_method string"
_NESTED = ", ".join(f.strip().replace(" ", ": ", 1) for f in SEGMENT.replace(WORDS, "W").split(",")).replace("words: W", f"words: {WORDS}")
MAPPING = "speaker_label: string, speaker_name: string, confidence: double, id_method: string, needs_review: boolean"
SECTION = "section_type: string, title: string, content: string, start_time: double, end_time: double, start_segment: int, end_segment: int"
SUMMARY = f"executive_summary: string, key_decisions: array<string>, sections: array<struct<{SECTION}>>, model: string, generated_at: string"
METADATA = "pipeline_version: string, diarization_model: string, transcription_model: string, gpu_used: boolean, processing_time_seconds: double"
MEETING = f"meeting_id string, city string, date string, meeting_type string, audio_source string, duration_seconds double, segments array<struct<{_NESTED}>>, speakers map<string, struct<{MAPPING}>>, summary struct<{SUMMARY}>, processing_metadata struct<{METADATA}>"
ROSTER = "city string, body string, members array<struct<name: string, aliases: array<string>>>"
#: What fields that a document leaves out are taken for (fixed values).
KIND, PIPELINE = "Regular Session", "1.0.0"
_STAMP = r"(?:(\d{1,2}):)?(\d{2}):(\d{2})[.,](\d{3})"
_LINE = rf"{_STAMP}\s*-->\s*{_STAMP}"
#: Video suffixes in order of preference (fixed values).
VIDEO = ["m4v", "mp4", "mkv", "webm", "avi", "mov"]


def segment_from_json(json: Column) -> Column:
    """A segment's fields; absent text and words are empty, absent name, confidence and method null."""
    s = F.from_json(json, SEGMENT)
    return s.withField("text", F.coalesce(s["text"], F.lit(""))).withField("words", F.coalesce(s["words"], F.from_json(F.lit("[]"), WORDS)))


def segment_to_json(*columns: Column) -> Column:
    """Null fields are left out."""
    return F.to_json(F.struct(*columns))


def _or(value: Column, default: object) -> Column:
    return F.coalesce(value, F.lit(default))


def with_defaults(meetings: DataFrame) -> DataFrame:
    """Meeting documents with the fields that were left out at their defaults; a summary that was left out stays null."""
    segments = F.transform(F.coalesce("segments", F.from_json(F.lit("[]"), f"array<struct<{_NESTED}>>")), lambda s: s.withField("text", _or(s["text"], "")).withField("words", F.coalesce(s["words"], F.from_json(F.lit("[]"), WORDS))))
    speakers = F.transform_values(F.coalesce("speakers", F.from_json(F.lit("{}"), f"map<string, struct<{MAPPING}>>")), lambda _, m: m.withField("confidence", _or(m["confidence"], 0.0)).withField("needs_review", _or(m["needs_review"], False)))
    m, q = F.col("processing_metadata"), F.col("summary")
    metadata = F.struct(_or(m["pipeline_version"], PIPELINE).alias("pipeline_version"), _or(m["diarization_model"], "").alias("diarization_model"), _or(m["transcription_model"], "").alias("transcription_model"), _or(m["gpu_used"], False).alias("gpu_used"), m["processing_time_seconds"].alias("processing_time_seconds"))
    sections = F.transform(F.coalesce(q["sections"], F.from_json(F.lit("[]"), f"array<struct<{SECTION}>>")), section_defaults)
    summary = F.when(q.isNotNull(), F.struct(_or(q["executive_summary"], "").alias("executive_summary"), F.coalesce(q["key_decisions"], F.array().cast("array<string>")).alias("key_decisions"), sections.alias("sections"), _or(q["model"], "").alias("model"), _or(q["generated_at"], "").alias("generated_at")))
    return meetings.withColumns({"meeting_type": _or(F.col("meeting_type"), KIND), "audio_source": _or(F.col("audio_source"), ""), "duration_seconds": _or(F.col("duration_seconds"), 0.0), "segments": segments, "speakers": speakers, "summary": summary, "processing_metadata": metadata})


def section_defaults(s: Column) -> Column:
    for field, default in (("content", ""), ("start_time", 0.0), ("end_time", 0.0), ("start_segment", 0), ("end_segment", 0)):
        s = s.withField(field, _or(s[field], default))
    return s


def read_meetings(spark: SparkSession, path: str) -> DataFrame:
    """Whole meeting documents, one file each: segments, speakers, summary and metadata."""
    return with_defaults(spark.read.schema(MEETING).option("multiLine", True).json(path))


def read_roster(spark: SparkSession, path: str) -> DataFrame:
    """Rosters (city, body, members) of JSON files, one each; an empty table where there is no file."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at):
        return spark.createDataFrame([], ROSTER)
    raw = spark.read.schema(ROSTER).option("multiLine", True).json(path)
    members = F.transform(F.coalesce("members", F.from_json(F.lit("[]"), ROSTER.split("members ")[1])), lambda m: m.withField("aliases", F.coalesce(m["aliases"], F.array().cast("array<string>"))))
    return raw.select(_or(F.col("city"), "").alias("city"), _or(F.col("body"), "").alias("body"), members.alias("members"))


def read_embeddings(spark: SparkSession, path: str) -> DataFrame:
    """(label, embedding) of JSON maps, one map a file."""
    raw = spark.read.text(path, wholetext=True)
    return embeddings_from_json(raw, "value")


def embeddings_from_json(df: DataFrame, column: str, *keep: str) -> DataFrame:
    return df.select(*keep, F.explode(F.from_json(column, "map<string, array<double>>")).alias("label", "embedding"))


def vtt_millis(line: Column) -> tuple[Column, Column]:
    """Start and end of a stamp line in milliseconds; nulls if it is none. Hours may be missing, the point may be a comma."""
    good = line.rlike(_LINE)

    def at(k: int) -> Column:
        part = lambda i: F.coalesce(F.nullif(F.regexp_extract(line, _LINE, i), F.lit("")).cast("bigint"), F.lit(0))
        return F.when(good, part(k) * 3_600_000 + part(k + 1) * 60_000 + part(k + 2) * 1000 + part(k + 3))

    return at(1), at(5)


def parse_vtt(df: DataFrame, content: str, *keep: str) -> DataFrame:
    """(keep, block, start_ms, end_ms, text) of caption files' contents.

    Blocks lie between blank lines. Of a block's lines with an arrow the last is the stamp; the lines
    without one behind the first arrow are text, joined by spaces, without tags. Blocks without a
    stamp that can be read or without text are left out.
    """
    blocks = df.select(*keep, F.posexplode(F.split(content, r"\n\s*\n")).alias("block", "b"))
    lines = F.split(F.regexp_replace("b", r"^\s+|\s+$", ""), "\n")
    stamped = blocks.withColumn("lines", lines)
    first = F.array_position(F.transform("lines", lambda x: x.contains("-->")), F.lit(True))
    stamp = F.try_element_at(F.filter("lines", lambda x: x.contains("-->")), F.lit(-1))
    text = F.array_join(F.filter(F.slice("lines", F.greatest(first, F.lit(1)).cast("int"), F.size("lines")), lambda x: ~x.contains("-->")), " ")
    start, end = vtt_millis(F.col("stamp"))
    rows = stamped.withColumns({"stamp": stamp, "text": F.trim(F.regexp_replace(text, "<[^>]+>", ""))}).where("stamp is not null and text <> ''")
    return rows.select(*keep, "block", start.alias("start_ms"), end.alias("end_ms"), "text").where("start_ms is not null")


def read_vtt(spark: SparkSession, path: str) -> DataFrame:
    """Captions of whole files that begin as such; others give none."""
    raw = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.col("value").alias("content"))
    return parse_vtt(raw.where(is_vtt(F.col("content"))), "content", "file")


def is_vtt(content: Column) -> Column:
    return F.ltrim(F.regexp_replace(content, r"^[﻿\s]+", "")).startswith("WEBVTT")


def _attribute(tag: Column, name: str) -> Column:
    quoted = F.regexp_extract(tag, rf"""(?i)\bdata-{name}\s*=\s*(?:"([^"]*)"|'([^']*)')""", 0)
    return F.trim(F.regexp_replace(quoted, r"""^[^"']*["']|["']$""", ""))


def _absolute(path: Column, base: str) -> Column:
    return F.when(path.startswith("http"), path).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), path))


def archive_listing(df: DataFrame, html: str, base: str, *keep: str) -> DataFrame:
    """The recordings that an archive page lists: every link with a video, its captions beside it."""
    tags = df.select(*keep, F.posexplode(F.regexp_extract_all(html, F.lit(r"(?is)<a\b[^>]*\bdata-m4v\b[^>]*>"), F.lit(0))).alias("place", "tag"))
    video = _attribute(F.col("tag"), "m4v")
    rows = tags.withColumn("m4v", video).where("m4v <> ''")
    stem = F.regexp_replace("m4v", r"\.[^.]*$", "")
    return rows.select(
        *keep, "place", _attribute(F.col("tag"), "name").alias("name"), _attribute(F.col("tag"), "subtitle").alias("subtitle"), _attribute(F.col("tag"), "date").alias("date"), _attribute(F.col("tag"), "duration").alias("duration"), "m4v",
        _absolute(F.col("m4v"), base).alias("video_url"), F.when(stem != "", _absolute(F.concat(stem, F.lit(".vtt")), base)).otherwise("").alias("vtt_url"), _attribute(F.col("tag"), "permalink").alias("permalink"),
        (F.lower(_attribute(F.col("tag"), "hasagenda")) == "true").alias("has_agenda"), _attribute(F.col("tag"), "documentsurl").alias("documents_url"),
    )


def page_video(html: Column, base: str) -> Column:
    """The video of a page: that of an inline player's configuration, else of the first link with one; null if none."""
    inline = F.nullif(F.regexp_extract(html, r"""m4v:\s*["']([^"']+\.m4v)["']""", 1), F.lit(""))
    link = F.nullif(F.regexp_extract(html, r'(?is)<a\b[^>]*\bdata-m4v\s*=\s*"([^"]+)"', 1), F.lit(""))
    return _absolute(F.coalesce(inline, link), base)


def is_url(text: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(text, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1)).isin("http", "https"), F.lit(False))


def route(url: Column, media_host: str, archive_host: str) -> Column:
    """What must be done with a URL: it is a file, a page to look through, or taken as it is."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    return F.when(host.contains(media_host), "file").when(host.contains(archive_host), "page").otherwise("as_is")


def batch_lines(df: DataFrame, line: str, city: str, kind: str, *keep: str) -> DataFrame:
    """Entries of a batch list: input, date, city and type; comments and blank lines are left out, the rest has defaults."""
    t = df.withColumn("_t", F.regexp_replace(line, r"^\s+|\s+$", "")).where("_t <> '' and not startswith(_t, '#')")
    p = F.split("_t", r"\s+", 4)
    part = lambda i, default: F.coalesce(F.get(p, F.lit(i)), F.lit(default))
    return t.select(*keep, part(0, "").alias("input"), part(1, "").alias("date"), part(2, city).alias("city"), part(3, kind).alias("meeting_type"))


def video_files(df: DataFrame, path: str, city: str, kind: str) -> DataFrame:
    """Entries of the video files among paths, with the date that the name holds first."""
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    suffix = F.lower(F.regexp_extract(name, r"\.([^.]+)$", 1))
    return df.where(suffix.isin(VIDEO)).select(F.col(path).alias("input"), F.regexp_extract(F.regexp_replace(name, r"\.[^.]+$", ""), r"\d{4}-\d{2}-\d{2}", 0).alias("date"), F.lit(city).alias("city"), F.lit(kind).alias("meeting_type"))


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length) of the files of a folder, without reading them."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "false").load(folder).select("path", "length")


def preferred_video(df: DataFrame, group: str, path: str) -> DataFrame:
    """Of each group's files the one whose suffix comes first in the order of preference."""
    suffix = F.lower(F.regexp_extract(path, r"\.([^.]+)$", 1))
    rank = F.array_position(F.array(*map(F.lit, VIDEO)), suffix)
    return df.withColumn("_r", rank).where("_r > 0").groupBy(group).agg(F.min_by(path, F.struct("_r", path)).alias("video"))


def slice_samples(samples: Column, start_ms: Column, end_ms: Column, rate: int = 16_000) -> Column:
    """The samples of an array from start to end, both cut off to whole samples; empty where the end is not after the start."""
    a, b = (F.greatest(F.floor(t * rate / 1000), F.lit(0)).cast("int") for t in (start_ms, end_ms))
    return F.slice(samples, a + 1, F.greatest(b - a, F.lit(0)))


def data_root(spark: SparkSession, named: str | None, *folders: str) -> str:
    """Where the data lie: the folder that is named, else the first that exists, else the last."""
    if named:
        return named
    jvm = spark.sparkContext._jvm
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            return folder
    return folders[-1]


def env_lines(lines: list[str]) -> dict[str, str]:
    """k=v lines of an environment file; comments and lines without = are left out, the first of a key wins."""
    out: dict[str, str] = {}
    for raw in lines:
        t = raw.strip()
        if t and not t.startswith("#") and "=" in t:
            k, _, v = t.partition("=")
            out.setdefault(k.strip(), v.strip().strip("\"'"))
    return out
