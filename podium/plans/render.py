"""Renderers: transcripts, summaries and prompts as text, and the structured answers they hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.functions import text as T
from podium.operators.ordered import dense_index
from podium.plans import base as B
from podium.plans.people import HINT_SELECT, named_mappings, roster_hint
from podium.plans.sequences import CHUNK, CONTEXT, context_windows, display_name, ordered_text, present
from podium.sources import formats as S
from podium.sources.tables import millis

#: Widths and budgets (fixed values): condensed text, prompt tokens kept for the transcript, characters a token.
CONDENSED, BUDGET, PER_TOKEN = 120, 8192 - 200, 3
#: The prompt's fixed parts (fixed values).
_HEAD = "You are analyzing a city council meeting transcript to identify speakers.\n"
_EXACT = "\nIMPORTANT: Use the exact names from this roster when identifying speakers. Transcription may misspell names.\n"
_CONSIDER = "? Consider:\n- How other speakers address them\n- What topics they discuss and their role\n- Conversational patterns and turn-taking\n\nRespond with ONLY a JSON object:\n{\"name\": \"Speaker Name or null\", \"reasoning\": \"brief explanation\"}"
_TAIL = '\n---\n\nRespond with ONLY a JSON object:\n{"name": "Speaker Name or null", "reasoning": "brief explanation"}'


def time_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every format of a segment's start."""
    s = B.segments(spark, sf_dir, indexed=False)
    ms = F.col("start_ms")
    return s.select("meeting_id", "segment_id", T.clock(ms).alias("clock"), T.srt_time(ms).alias("srt"), T.short_clock(ms).alias("short"), T.minutes(ms).alias("minutes"))


TIMES_SQL = f"WITH {B.SEG} SELECT meeting_id, segment_id, {T.clock_sql('start_ms')} AS clock, {T.srt_time_sql('start_ms')} AS srt, {T.short_clock_sql('start_ms')} AS short, {T.minutes_sql('start_ms')} AS minutes FROM seg"


def sentence_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sentences of each segment's text by the simple rule of subtitles."""
    s = B.segments(spark, sf_dir, indexed=False).where(present("text"))
    return s.select("meeting_id", "segment_id", F.posexplode(T.sentences(F.col("text"))).alias("part", "sentence"))


SENTENCES_SQL = f"WITH {B.SEG}, p AS (SELECT meeting_id, segment_id, {T.SENTENCES_SQL} AS parts FROM seg WHERE text <> '') SELECT meeting_id, segment_id, CAST(unnest(range(len(parts))) AS INTEGER) AS part, unnest(parts) AS sentence FROM p"


def markdown_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transcript as Markdown, a block a segment with text; idx orders them and -1 is the title."""
    seg = B.segments(spark, sf_dir).where(present("text"))
    body = seg.select("meeting_id", "idx", F.concat(F.lit("**["), T.clock(F.col("start_ms")), F.lit("] "), display_name(), F.lit(":**\n"), "text", F.lit("\n")).alias("block"))
    m = B.meetings(spark, sf_dir)
    title = m.select("meeting_id", F.lit(-1).cast("bigint").alias("idx"), F.concat(F.lit("# "), F.concat_ws(" ", "city", "meeting_type"), F.lit(" — "), F.coalesce("date", F.lit("")), F.lit("\n")).alias("block"))
    return title.unionByName(body)


MARKDOWN_SQL = f"""WITH {B.SEG}, {B.MEET} SELECT meeting_id, CAST(-1 AS BIGINT) AS idx, '# ' || concat_ws(' ', city, meeting_type) || ' — ' || coalesce(date, '') || chr(10) AS block FROM meet
UNION ALL SELECT meeting_id, idx, '**[' || {T.clock_sql("start_ms")} || '] ' || coalesce(nullif(speaker_name, ''), label) || ':**' || chr(10) || text || chr(10) FROM seg WHERE text <> ''"""


def condensed_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of 150 segments with text as short lines, for a classifier."""
    seg = dense_index(B.segments(spark, sf_dir).where(present("text")), ["meeting_id"], "idx", "k", tie="segment_id")
    line = F.concat(F.lit("["), T.short_clock(F.col("start_ms")), F.lit("] (seg "), F.col("segment_id").cast("string"), F.lit(") "), display_name(), F.lit(": "), T.shorten(F.col("text"), CONDENSED))
    rows = seg.select("meeting_id", F.floor(F.col("k") / CHUNK).alias("chunk"), "k", line.alias("line"))
    return rows.groupBy("meeting_id", "chunk").agg(ordered_text(F.col("line"), "k", "\n").alias("text"))


CONDENSED_SQL = f"""WITH {B.SEG}, k AS (SELECT *, row_number() OVER (PARTITION BY meeting_id ORDER BY idx) - 1 AS k FROM seg WHERE text <> '')
SELECT meeting_id, k // {CHUNK} AS chunk, string_agg('[' || {T.short_clock_sql("start_ms")} || '] (seg ' || segment_id || ') ' || coalesce(nullif(speaker_name, ''), label) || ': ' || CASE WHEN length(text) > {CONDENSED} THEN substr(text, 1, {CONDENSED}) || '...' ELSE text END, chr(10) ORDER BY k) AS text FROM k GROUP BY 1, 2"""


def section_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of each section's segments (both ends included), joined in order, and what is done with its type."""
    seg = B.segments(spark, sf_dir, indexed=False).where(present("text"))
    line = F.concat(F.lit("["), T.short_clock(F.col("start_ms")), F.lit("] "), display_name(), F.lit(": "), "text")
    seg = seg.select("meeting_id", "segment_id", line.alias("line")).withColumn("block", F.floor(F.col("segment_id") / 64))
    sec = B.sections(spark, sf_dir).select("meeting_id", "pos", "type", "start_segment", "end_segment")
    wide = sec.where("end_segment >= start_segment").withColumn("block", F.explode(F.sequence(F.floor(F.col("start_segment") / 64), F.floor(F.col("end_segment") / 64))))
    lines = wide.join(seg, ["meeting_id", "block"]).where("segment_id between start_segment and end_segment")
    text = lines.groupBy("meeting_id", "pos").agg(ordered_text(F.col("line"), "segment_id", "\n").alias("text"))
    out = sec.join(text, ["meeting_id", "pos"], "left")
    return out.select("meeting_id", "pos", task(F.col("type")).alias("task"), F.coalesce("text", F.lit("")).alias("text"))


def task(kind: Column) -> Column:
    """What is asked of a section of this type; none means a procedural one."""
    k = F.coalesce(kind, F.lit("procedural"))
    return F.when(k == "roll_call", "extract_roll_call").when(k.isin("discussion", "public_comment", "consent_agenda"), "summarize").when(k == "vote", "extract_votes").otherwise("brief")


_TASK_SQL = "CASE coalesce(type, 'procedural') WHEN 'roll_call' THEN 'extract_roll_call' WHEN 'discussion' THEN 'summarize' WHEN 'public_comment' THEN 'summarize' WHEN 'consent_agenda' THEN 'summarize' WHEN 'vote' THEN 'extract_votes' ELSE 'brief' END"
SECTION_TEXT_SQL = f"""WITH {B.SEG}, {B.SECT}, l AS (SELECT meeting_id, segment_id, '[' || {T.short_clock_sql("start_ms")} || '] ' || coalesce(nullif(speaker_name, ''), label) || ': ' || text AS line FROM seg WHERE text <> '')
SELECT s.meeting_id, s.pos, any_value({_TASK_SQL}) AS task, coalesce(string_agg(line, chr(10) ORDER BY segment_id), '') AS text FROM sect s LEFT JOIN l ON l.meeting_id = s.meeting_id AND l.segment_id BETWEEN s.start_segment AND s.end_segment GROUP BY 1, 2"""


def section_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each section's times from its first and last segment, 0 where there is none."""
    seg = B.segments(spark, sf_dir, indexed=False).select("meeting_id", "segment_id", "start_ms", "end_ms")
    sec = B.sections(spark, sf_dir).select("meeting_id", "pos", "start_segment", "end_segment")
    a = seg.select("meeting_id", F.col("segment_id").alias("start_segment"), "start_ms")
    b = seg.select("meeting_id", F.col("segment_id").alias("end_segment"), "end_ms")
    out = sec.join(a, ["meeting_id", "start_segment"], "left").join(b, ["meeting_id", "end_segment"], "left")
    return out.select("meeting_id", "pos", F.coalesce("start_ms", F.lit(0)).alias("start_ms"), F.coalesce("end_ms", F.lit(0)).alias("end_ms"))


SECTION_TIMES_SQL = f"WITH {B.SEG}, {B.SECT} SELECT s.meeting_id, s.pos, coalesce(a.start_ms, 0) AS start_ms, coalesce(b.end_ms, 0) AS end_ms FROM sect s LEFT JOIN seg a ON a.meeting_id = s.meeting_id AND a.segment_id = s.start_segment LEFT JOIN seg b ON b.meeting_id = s.meeting_id AND b.segment_id = s.end_segment"


def summary_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A meeting's summary: title, executive part and decisions if any, a rule, and the sections in order."""
    sec = B.sections(spark, sf_dir)
    a, b = millis("start_time"), millis("end_time")
    head = F.concat(F.lit("### "), F.coalesce("title", F.lit("")), F.lit(" ["), T.clock(F.coalesce(a, F.lit(0))), F.when(b > 0, F.concat(F.lit("–"), T.clock(b))).otherwise(""), F.lit("]\n"))
    block = F.concat(head, F.when(present("content"), F.concat(F.lit("\n"), "content", F.lit("\n"))).otherwise(""))
    body = sec.select("meeting_id", "pos", block.alias("b"), F.when((F.col("type") == "vote") & present("title"), F.concat(F.lit("- "), "title")).alias("d"), F.when((F.col("type") == "opening") & (F.col("pos") == 0) & present("content"), F.col("content")).alias("e"))
    per = body.groupBy("meeting_id").agg(ordered_text(F.col("b"), "pos", "\n").alias("sections"), ordered_text(F.col("d"), "pos", "\n").alias("decisions"), F.max("e").alias("executive"))
    m = B.meetings(spark, sf_dir).join(per, "meeting_id")
    title = F.concat(F.lit("# "), F.concat_ws(" ", "city", "meeting_type"), F.lit(" — "), F.coalesce("date", F.lit("")), F.lit("\n\n"))
    executive = F.when(F.col("executive").isNotNull(), F.concat(F.lit("## Executive Summary\n\n"), "executive", F.lit("\n\n"))).otherwise("")
    decisions = F.when(F.col("decisions") != "", F.concat(F.lit("## Key Decisions\n\n"), "decisions", F.lit("\n\n"))).otherwise("")
    return m.select("meeting_id", F.concat(title, executive, decisions, F.lit("---\n\n"), "sections").alias("summary"))


SUMMARY_SQL = f"""WITH {B.SECT}, {B.MEET}, t AS (SELECT *, coalesce(CAST(round(start_time * 1000) AS BIGINT), 0) AS a, CAST(round(end_time * 1000) AS BIGINT) AS b FROM sect),
p AS (SELECT meeting_id, string_agg('### ' || coalesce(title, '') || ' [' || {T.clock_sql("a")} || CASE WHEN b > 0 THEN '–' || {T.clock_sql("b")} ELSE '' END || ']' || chr(10) || CASE WHEN content <> '' THEN chr(10) || content || chr(10) ELSE '' END, chr(10) ORDER BY pos) AS sections,
  string_agg(CASE WHEN type = 'vote' AND title <> '' THEN '- ' || title END, chr(10) ORDER BY pos) AS decisions, max(CASE WHEN type = 'opening' AND pos = 0 AND content <> '' THEN content END) AS executive FROM t GROUP BY 1)
SELECT meeting_id, '# ' || concat_ws(' ', city, meeting_type) || ' — ' || coalesce(date, '') || chr(10) || chr(10) || CASE WHEN executive IS NOT NULL THEN '## Executive Summary' || chr(10) || chr(10) || executive || chr(10) || chr(10) ELSE '' END
  || CASE WHEN decisions <> '' THEN '## Key Decisions' || chr(10) || chr(10) || decisions || chr(10) || chr(10) ELSE '' END || '---' || chr(10) || chr(10) || sections AS summary FROM meet JOIN p USING (meeting_id)"""


def executive_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sections' summaries as one text without separators, under the meeting's header."""
    sec = B.sections(spark, sf_dir)
    part = F.concat(F.lit("### "), F.coalesce("title", F.lit("")), F.lit(" ("), F.coalesce("type", F.lit("")), F.lit(") ["), T.short_clock(F.coalesce(millis("start_time"), F.lit(0))), F.lit("]"), F.coalesce("content", F.lit("")))
    per = sec.groupBy("meeting_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", part.alias("p")))), lambda r: r["p"]), "").alias("sections"))
    m = B.meetings(spark, sf_dir).join(per, "meeting_id")
    head = F.concat(F.lit("Meeting: "), F.concat_ws(" ", "city", "meeting_type"), F.lit(" — "), F.coalesce("date", F.lit("")), F.lit("\nDuration: "), T.short_clock(F.coalesce(millis("duration_seconds"), F.lit(0))), F.lit("\n\nSection summaries:\n\n"))
    return m.select("meeting_id", F.concat(head, "sections").alias("prompt"))


EXECUTIVE_SQL = f"""WITH {B.SECT}, {B.MEET}, t AS (SELECT *, coalesce(CAST(round(start_time * 1000) AS BIGINT), 0) AS a FROM sect),
p AS (SELECT meeting_id, string_agg('### ' || coalesce(title, '') || ' (' || coalesce(type, '') || ') [' || {T.short_clock_sql("a")} || ']' || coalesce(content, ''), '' ORDER BY pos) AS sections FROM t GROUP BY 1), d AS (SELECT *, coalesce(CAST(round(duration_seconds * 1000) AS BIGINT), 0) AS ms FROM meet)
SELECT meeting_id, 'Meeting: ' || concat_ws(' ', city, meeting_type) || ' — ' || coalesce(date, '') || chr(10) || 'Duration: ' || {T.short_clock_sql("ms")} || chr(10) || chr(10) || 'Section summaries:' || chr(10) || chr(10) || sections AS prompt FROM d JOIN p USING (meeting_id)"""


def speaker_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each speaker without a name the excerpt around them, with known names, cut to the budget."""
    seg = B.segments(spark, sf_dir).select("meeting_id", "idx", F.col("label").alias("said_by"), "text")
    named = named_mappings(spark, sf_dir).where("name <> ''").select("meeting_id", "label", "name")
    windows = context_windows(spark, sf_dir).join(named.select("meeting_id", "label"), ["meeting_id", "label"], "left_anti")
    rows = windows.join(seg, ["meeting_id", "idx"]).join(named.withColumnsRenamed({"label": "said_by", "name": "known"}), ["meeting_id", "said_by"], "left")
    who = F.coalesce("known", F.when(F.col("said_by") == F.col("label"), F.concat(F.lit("[UNKNOWN - "), "label", F.lit("]"))).otherwise(F.col("said_by")))
    line = F.concat(who, F.lit(": "), F.coalesce("text", F.lit("")))
    excerpt = rows.groupBy("meeting_id", "label").agg(ordered_text(line, "idx", "\n").alias("excerpt"))
    known = named.groupBy("meeting_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("label", "name"))), lambda r: F.concat(F.lit("  - "), r["label"], F.lit(" = "), r["name"])), "\n").alias("list"))
    hints = B.homes(spark, sf_dir).join(roster_hint(spark, sf_dir).withColumnRenamed("roster_id", "home"), "home").select("meeting_id", "hint")
    out = excerpt.join(known, "meeting_id", "left").join(hints, "meeting_id", "left")
    roster = F.when(F.col("hint").isNotNull(), F.concat(F.lit("\n"), "hint", F.lit(_EXACT))).otherwise("")
    prompt = F.concat(F.lit(_HEAD), roster, F.lit("\nKnown speakers:\n"), F.coalesce("list", F.lit("  (none identified yet)")), F.lit("\n\nUnknown speaker to identify: "), "label", F.lit("\n\nTranscript excerpt:\n---\n"), "excerpt", F.lit("\n---\n\nBased on the context, who is "), "label", F.lit(_CONSIDER))
    long = F.floor(F.char_length("prompt") / PER_TOKEN) > BUDGET
    return out.withColumn("prompt", prompt).select("meeting_id", "label", F.when(long, F.concat(F.substring("prompt", 1, BUDGET * PER_TOKEN), F.lit(_TAIL))).otherwise(F.col("prompt")).alias("prompt"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


PROMPTS_SQL = f"""WITH {B.SEG}, {B.MAPS}, {B.MEET}, {B.ROST}, {B.HOMES}, hi AS (SELECT meeting_id, hint FROM home JOIN ({HINT_SELECT}) USING (roster_id)), nm AS (SELECT meeting_id, label, speaker_name AS name FROM map WHERE speaker_name <> ''),
o AS (SELECT *, row_number() OVER (PARTITION BY meeting_id, label ORDER BY idx) - 1 AS k, count(*) OVER (PARTITION BY meeting_id, label) AS n FROM seg),
c AS (SELECT meeting_id, label, idx AS center FROM o WHERE k = CASE WHEN n >= 3 THEN n // 3 ELSE 0 END AND NOT EXISTS (SELECT 1 FROM nm WHERE nm.meeting_id = o.meeting_id AND nm.label = o.label)),
x AS (SELECT c.meeting_id, c.label, string_agg(coalesce(nm.name, CASE WHEN s.label = c.label THEN '[UNKNOWN - ' || c.label || ']' ELSE s.label END) || ': ' || coalesce(text, ''), chr(10) ORDER BY s.idx) AS excerpt
  FROM c JOIN seg s ON s.meeting_id = c.meeting_id AND s.idx BETWEEN greatest(0, center - {CONTEXT}) AND center + {CONTEXT} - 1 LEFT JOIN nm ON nm.meeting_id = s.meeting_id AND nm.label = s.label GROUP BY 1, 2),
kn AS (SELECT meeting_id, string_agg('  - ' || label || ' = ' || name, chr(10) ORDER BY label) AS list FROM nm GROUP BY 1),
p AS (SELECT x.meeting_id, label, {_quoted(_HEAD)} || CASE WHEN hint IS NOT NULL THEN chr(10) || hint || {_quoted(_EXACT)} ELSE '' END || chr(10) || 'Known speakers:' || chr(10) || coalesce(list, '  (none identified yet)') || chr(10) || chr(10) || 'Unknown speaker to identify: ' || label || chr(10) || chr(10) || 'Transcript excerpt:' || chr(10) || '---' || chr(10) || excerpt || chr(10) || '---' || chr(10) || chr(10) || 'Based on the context, who is ' || label || {_quoted(_CONSIDER)} AS prompt FROM x LEFT JOIN kn USING (meeting_id) LEFT JOIN hi USING (meeting_id))
SELECT meeting_id, label, CASE WHEN length(prompt) // {PER_TOKEN} > {BUDGET} THEN substr(prompt, 1, {BUDGET * PER_TOKEN}) || {_quoted(_TAIL)} ELSE prompt END AS prompt FROM p"""


def name_answers(answers: DataFrame) -> DataFrame:
    """(key, name, confidence, method) of model answers (key, answer): the JSON between the outermost braces, if it names somebody."""
    json = F.nullif(F.regexp_extract("answer", r"(?s)\{.*\}", 0), F.lit(""))
    name = F.get_json_object(json, "$.name")
    good = name.isNotNull() & (name != "") & ~F.lower(name).isin("null", "unknown")
    return answers.where(good).select("key", name.alias("name"), F.lit(0.75).alias("confidence"), F.lit("llm").alias("method"))


def parsed_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers composed from the mappings' names, with talk around the JSON, parsed again."""
    m = named_mappings(spark, sf_dir)
    answer = F.concat(F.lit("Sure! "), F.to_json(F.struct(F.coalesce("name", F.lit("null")).alias("name"), F.lit("a } brace").alias("reasoning"))), F.lit(" Bye"))
    return name_answers(m.select(F.col("mapping_id").alias("key"), F.when(F.col("mapping_id") % 7 == 0, F.lit("no idea")).otherwise(answer).alias("answer")))


ANSWERS_SQL = f"WITH {B.MAPS} SELECT mapping_id AS key, speaker_name AS name, CAST(0.75 AS DOUBLE) AS confidence, 'llm' AS method FROM map WHERE mapping_id % 7 <> 0 AND speaker_name <> '' AND lower(speaker_name) NOT IN ('null', 'unknown')"

ROLL_CALL = "present array<string>, absent array<string>, notes string"
VOTES = "votes array<struct<resolution: string, description: string, result: string, vote_type: string, yea: array<string>, nay: array<string>, abstain: array<string>, absent: array<string>>>"


def _json_of(answer: Column) -> Column:
    return F.nullif(F.regexp_extract(answer, r"(?s)\{.*\}", 0), F.lit(""))


def roll_call_markdown(answer: Column) -> Column:
    """Who is present and absent; nobody absent reads None; fixed texts where there is no JSON or none that parses."""
    json = _json_of(answer)
    d = F.from_json(json, ROLL_CALL, {"mode": "PERMISSIVE"})
    valid = F.try_parse_json(json).isNotNull()
    some = lambda c: F.coalesce(F.size(c) > 0, F.lit(False))
    lines = F.concat_ws(
        "\n", F.when(some(d["present"]), F.concat(F.lit("**Present:** "), F.array_join(d["present"], ", "))), F.when(some(d["absent"]), F.concat(F.lit("**Absent:** "), F.array_join(d["absent"], ", "))).otherwise("**Absent:** None"),
        F.when(d["notes"] != "", F.concat(F.lit("\n_"), d["notes"], F.lit("_"))),
    )
    return F.when(json.isNull(), "_Roll call data could not be extracted._").when(~valid, "_Roll call data could not be parsed._").otherwise(lines)


def votes_markdown(answer: Column) -> Column:
    """Each vote's result; a unanimous one in short, else the names that voted."""
    json = _json_of(answer)
    d = F.from_json(json, VOTES)
    valid = F.try_parse_json(json).isNotNull()

    def one(v: Column) -> Column:
        names = lambda k, t: F.when(F.coalesce(F.size(v[k]) > 0, F.lit(False)), F.concat(F.lit(f"{t}: "), F.array_join(v[k], ", ")))
        named = F.concat_ws("\n", names("yea", "Yea"), names("nay", "Nay"), names("abstain", "Abstain"))
        how = F.when(F.coalesce(v["vote_type"] == "unanimous", F.lit(False)), F.lit("Vote: Unanimous")).otherwise(F.nullif(named, F.lit("")))
        head = F.concat(F.lit("**"), F.coalesce(v["resolution"], F.lit("Motion")), F.lit("** — "), F.upper(F.coalesce(v["result"], F.lit("unknown"))))
        return F.concat_ws("\n", head, F.when(v["description"] != "", F.concat(F.lit("_"), v["description"], F.lit("_"))), how, F.lit(""))

    votes = F.array_join(F.transform(F.coalesce(d["votes"], F.from_json(F.lit("[]"), VOTES.split(" ", 1)[1])), one), "\n")
    return F.when(json.isNull(), "_Vote data could not be extracted._").when(~valid, "_Vote data could not be parsed._").otherwise(votes)


def roll_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers composed from a meeting's mappings, rendered."""
    m = named_mappings(spark, sf_dir).where("name <> ''")
    names = lambda c: F.array_sort(F.collect_list(F.when(c, F.col("name"))))
    per = m.groupBy("meeting_id").agg(names(F.col("mapping_id") % 5 != 0).alias("present"), names(F.col("mapping_id") % 5 == 0).alias("absent"))
    k = F.char_length("meeting_id") + F.size("present")
    answer = F.when(k % 5 == 0, "nothing").when(k % 5 == 1, "{broken").when(k % 5 == 2, "{broken}").otherwise(F.concat(F.lit("Here: "), F.to_json(F.struct("present", "absent", F.lit("quorum").alias("notes")))))
    return per.select("meeting_id", roll_call_markdown(answer).alias("markdown"))


ROLL_SQL = f"""WITH {B.MAPS}, p AS (SELECT meeting_id, list(speaker_name ORDER BY speaker_name) FILTER (mapping_id % 5 <> 0) AS pr, list(speaker_name ORDER BY speaker_name) FILTER (mapping_id % 5 = 0) AS ab FROM map WHERE speaker_name <> '' GROUP BY 1), k AS (SELECT *, (length(meeting_id) + coalesce(len(pr), 0)) % 5 AS k FROM p)
SELECT meeting_id, CASE WHEN k IN (0, 1) THEN '_Roll call data could not be extracted._' WHEN k = 2 THEN '_Roll call data could not be parsed._' ELSE concat_ws(chr(10), '**Present:** ' || array_to_string(pr, ', '), CASE WHEN len(ab) > 0 THEN '**Absent:** ' || array_to_string(ab, ', ') ELSE '**Absent:** None' END, chr(10) || '_quorum_') END AS markdown FROM k"""


def votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = named_mappings(spark, sf_dir).where("name <> ''")
    names = lambda c: F.array_sort(F.collect_list(F.when(c, F.col("name"))))
    per = m.groupBy("meeting_id").agg(names(F.col("mapping_id") % 3 == 0).alias("yea"), names(F.col("mapping_id") % 3 == 1).alias("nay"))
    first = F.struct(F.lit("Resolution 1").alias("resolution"), F.lit("A fee").alias("description"), F.lit("passed").alias("result"), F.lit("roll call").alias("vote_type"), "yea", "nay")
    second = F.to_json(F.struct(F.lit("unanimous").alias("vote_type")))
    answer = F.concat(F.lit('{"votes": ['), F.to_json(first), F.lit(", "), second, F.lit("]}"))
    return per.select("meeting_id", votes_markdown(answer).alias("markdown"))


VOTES_SQL = f"""WITH {B.MAPS}, p AS (SELECT meeting_id, list(speaker_name ORDER BY speaker_name) FILTER (mapping_id % 3 = 0) AS y, list(speaker_name ORDER BY speaker_name) FILTER (mapping_id % 3 = 1) AS n FROM map WHERE speaker_name <> '' GROUP BY 1)
SELECT meeting_id, concat_ws(chr(10), '**Resolution 1** — PASSED', '_A fee_', CASE WHEN len(y) > 0 THEN 'Yea: ' || array_to_string(y, ', ') END, CASE WHEN len(n) > 0 THEN 'Nay: ' || array_to_string(n, ', ') END, '', '**Motion** — UNKNOWN', 'Vote: Unanimous', '') AS markdown FROM p"""


def meeting_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(meeting_id, part, place, fragment): the fragments of each meeting's JSON document; joined in order they are the document.

    Segments, speakers and sections are a fragment each, so a meeting of any size is never one row or one task.
    """
    m = B.meetings(spark, sf_dir)
    ids = m.select("meeting_id")
    row = lambda df, part, place, text: df.select("meeting_id", F.lit(part).alias("part"), place.cast("bigint").alias("place"), text.alias("fragment"))
    one = F.lit(0)
    head = F.to_json(F.struct("meeting_id", F.coalesce("city", F.lit("")).alias("city"), F.coalesce("date", F.lit("")).alias("date"), F.coalesce("meeting_type", F.lit(S.KIND)).alias("meeting_type"), F.coalesce("audio_source", F.lit("")).alias("audio_source"), F.coalesce("duration_seconds", F.lit(0.0)).alias("duration_seconds")))
    seg = B.segments(spark, sf_dir, "confidence", "id_method", "words").join(ids, "meeting_id", "left_semi")
    said = F.to_json(F.struct("segment_id", (F.col("start_ms") / 1000).alias("start_time"), (F.col("end_ms") / 1000).alias("end_time"), F.col("label").alias("speaker_label"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce("words", F.from_json(F.lit("[]"), S.WORDS)).alias("words"), "speaker_name", "confidence", "id_method"))
    comma = lambda first: F.when(first, F.lit("")).otherwise(F.lit(","))
    speakers = meeting_speakers(spark, sf_dir).join(ids, "meeting_id", "left_semi")
    speakers = speakers.join(speakers.groupBy("meeting_id").agg(F.min("label").alias("least")), "meeting_id")
    entry = F.to_json(F.create_map("label", F.struct(F.col("label").alias("speaker_label"), "speaker_name", "confidence", "id_method", "needs_review")), {"ignoreNullFields": "false"})
    named = row(speakers, 3, F.hash("label"), F.concat(comma(F.col("label") == F.col("least")), F.substring(entry, F.lit(2), F.char_length(entry) - 2)))
    named = named.withColumn("place", F.when(F.col("fragment").startswith(","), F.col("place")).otherwise(F.lit(-(1 << 40))))
    sec = meeting_summaries(spark, sf_dir).join(ids, "meeting_id", "left_semi")
    least = sec.groupBy("meeting_id").agg(F.min("place").alias("least"), F.min(F.when(F.col("section_type") == "vote", F.col("place"))).alias("vote"), F.max("executive_summary").alias("executive"))
    sec = sec.join(least.select("meeting_id", "least", "vote"), "meeting_id")
    section = F.to_json(F.struct("section_type", "title", "content", "start_time", "end_time", "start_segment", "end_segment"))
    title = F.to_json(F.array("title"))
    quote = lambda c: F.substring(F.to_json(F.array(c)), F.lit(2), F.char_length(F.to_json(F.array(c))) - 2)
    metadata = '{"pipeline_version":"%s","diarization_model":"","transcription_model":"","gpu_used":false}' % S.PIPELINE
    have = m.select("meeting_id").join(least, "meeting_id", "left")
    summary = F.when(F.col("least").isNotNull(), F.concat(F.lit(',"summary":{"executive_summary":'), quote(F.coalesce("executive", F.lit(""))), F.lit(',"sections":['))).otherwise("}")
    parts = [
        row(m, 0, one, F.concat(F.substring(head, F.lit(1), F.char_length(head) - 1), F.lit(',"segments":['))),
        row(seg, 1, F.col("idx"), F.concat(comma(F.col("idx") == 0), said)),
        row(m, 2, one, F.lit('],"speakers":{')),
        named,
        row(have, 4, one, F.concat(F.lit('},"processing_metadata":' + metadata), summary)),
        row(sec, 5, F.col("place"), F.concat(comma(F.col("place") == F.col("least")), section)),
        row(least, 6, one, F.lit('],"key_decisions":[')),
        row(sec.where("section_type = 'vote' and title <> ''"), 7, F.col("place"), F.concat(comma(F.lit(False)), F.substring(title, F.lit(2), F.char_length(title) - 2))),
        row(least, 8, one, F.lit('],"model":"","generated_at":""}}')),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    # The first decision of a meeting takes no comma.
    first = out.where("part = 7").groupBy("meeting_id").agg(F.min("place").alias("first"))
    return out.join(first, "meeting_id", "left").select("meeting_id", "part", "place", F.when((F.col("part") == 7) & (F.col("place") == F.col("first")), F.expr("substring(fragment, 2)")).otherwise(F.col("fragment")).alias("fragment"))


def meeting_speakers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The speakers map of each meeting, written as JSON and read back with its defaults, an entry a row."""
    m = B.mappings(spark, sf_dir)
    j = m.select("meeting_id", F.to_json(F.create_map("label", F.struct(F.col("label").alias("speaker_label"), "speaker_name", "confidence", "id_method", "needs_review"))).alias("j"))
    rows = j.select("meeting_id", F.explode(F.from_json("j", f"map<string, struct<{S.MAPPING}>>")).alias("label", "v"))
    return rows.select("meeting_id", "label", "v.speaker_name", F.coalesce("v.confidence", F.lit(0.0)).alias("confidence"), "v.id_method", F.coalesce("v.needs_review", F.lit(False)).alias("needs_review"))


SPEAKERS_SQL = f"WITH {B.MAPS} SELECT meeting_id, label, speaker_name, coalesce(confidence, 0) AS confidence, id_method, coalesce(needs_review, false) AS needs_review FROM map"


def meeting_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sections of each meeting's summary, written as JSON and read back with their defaults; the opening's text is the executive summary."""
    sec = B.sections(spark, sf_dir)
    j = sec.select("meeting_id", F.col("pos").alias("place"), F.to_json(F.struct(F.col("type").alias("section_type"), F.coalesce("title", F.lit("")).alias("title"), "content", "start_time", "end_time", "start_segment", "end_segment")).alias("j"))
    rows = j.select("meeting_id", "place", S.section_defaults(F.from_json("j", f"struct<{S.SECTION}>")).alias("s")).select("meeting_id", "place", "s.*")
    return rows.withColumn("executive_summary", F.when((F.col("section_type") == "opening") & (F.col("place") == 0) & (F.col("content") != ""), F.col("content")))


SUMMARIES_SQL = f"WITH {B.SECT} SELECT meeting_id, pos AS place, type AS section_type, coalesce(title, '') AS title, coalesce(content, '') AS content, coalesce(start_time, 0) AS start_time, coalesce(end_time, 0) AS end_time, coalesce(start_segment, 0) AS start_segment, coalesce(end_segment, 0) AS end_segment, CASE WHEN type = 'opening' AND pos = 0 AND content <> '' THEN content END AS executive_summary FROM sect"


def write_exports(spark: SparkSession, sf_dir: str, out: str) -> None:
    """The sinks: Markdown, subtitles, summaries and whole meeting documents, a folder a meeting.

    Rows are ranged by meeting and place, so a long meeting is written by several tasks; its files in
    the order of their names are its text.
    """
    from podium.plans.captions import srt_entries

    def put(df: DataFrame, order: list[str], value: str, name: str) -> None:
        ranged = df.repartitionByRange("meeting_id", *order).sortWithinPartitions("meeting_id", *order)
        ranged.select("meeting_id", value).write.mode("overwrite").partitionBy("meeting_id").text(f"{out}/{name}")

    put(markdown_lines(spark, sf_dir), ["idx"], "block", "markdown")
    put(srt_entries(spark, sf_dir), ["counter"], "entry", "srt")
    put(summary_markdown(spark, sf_dir), [], "summary", "summary")
    put(meeting_document(spark, sf_dir), ["part", "place"], "fragment", "json")


QUERIES = {
    "time_formats": time_formats, "sentence_parts": sentence_parts, "markdown_lines": markdown_lines, "condensed_chunks": condensed_chunks, "section_transcripts": section_transcripts, "section_times": section_times,
    "summary_markdown": summary_markdown, "meeting_document": meeting_document, "meeting_speakers": meeting_speakers, "meeting_summaries": meeting_summaries, "executive_prompts": executive_prompts, "speaker_prompts": speaker_prompts, "parsed_answers": parsed_answers, "roll_calls": roll_calls, "votes": votes,
}
SQL = {
    "time_formats": TIMES_SQL, "sentence_parts": SENTENCES_SQL, "markdown_lines": MARKDOWN_SQL, "condensed_chunks": CONDENSED_SQL, "section_transcripts": SECTION_TEXT_SQL, "section_times": SECTION_TIMES_SQL, "summary_markdown": SUMMARY_SQL, "meeting_speakers": SPEAKERS_SQL, "meeting_summaries": SUMMARIES_SQL,
    "executive_prompts": EXECUTIVE_SQL, "speaker_prompts": PROMPTS_SQL, "parsed_answers": ANSWERS_SQL, "roll_calls": ROLL_SQL, "votes": VOTES_SQL,
}
