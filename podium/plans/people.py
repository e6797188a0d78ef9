"""Queries about who speaks: name patterns, identification, rosters, voices, profiles and their upkeep."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from podium.functions.vectors import mean_by
from podium.operators.components import components
from podium.operators.ordered import dense_index, with_next
from podium.operators.pairs import query_scores, similar_pairs
from podium.plans import base as B
from podium.plans.sequences import REACH, RESPONSE
from podium.sources.tables import table

#: Titles before names, the name group, and what no name begins with (fixed values).
TITLES = r"(?:Councilmember|Council\s*Member|Councilwoman|Councilman|Alderman|Alderwoman|Commissioner|Mayor|Vice[\s-]?Mayor|President|Vice[\s-]?President|Clerk|Secretary|Treasurer|Supervisor|Representative)"
NAME = r"(?-i:([A-Z][a-zA-Z'’-]+(?:\s+[A-Z][a-zA-Z'’-]+){0,2}))"
NOT_NAMES = "here present yes no thank thanks okay the this that what how who where when".split()
#: pattern, confidence, place of the named speaker: one who responds, the next other one, oneself (fixed values).
PATTERNS = [
    ("roll_call", rf"(?i){TITLES}\s+{NAME}\s*\?", 0.95, "responder"),
    ("chair_recognition", rf"(?i)(?:the\s+)?chair\s+recognizes\s+{TITLES}\s+{NAME}", 0.92, "next"),
    ("self_identification", rf"(?i)(?:this\s+is|I\s+am|I'm)\s+{TITLES}\s+{NAME}", 0.90, "self"),
    ("name_addressing", rf"(?i){TITLES}\s+{NAME}\s*,", 0.80, "next"),
    ("title_context", r"(?i)as\s+(?:the\s+)?(?:city\s+)?(attorney|clerk|mayor|treasurer|manager|administrator|auditor|comptroller)", 0.75, "self"),
]
#: Length of a voice; thresholds (fixed values).
DIM = 64
VOICE, RETURNING_2, RETURNING_3, SOFT, REVIEW, MERGE, FUZZY, LLM = 0.85, 0.78, 0.70, 0.50, 0.70, 0.80, 0.80, 0.75
#: What is never learned as an alias (fixed values).
NO_ALIASES = "speaker unknown unidentified none n/a".split()
#: Words left out before a surname, and before a slug (fixed values).
SLUG_TITLES = "councilmember councilwoman councilman alderman alderwoman commissioner mayor vice-mayor president vice-president clerk secretary treasurer supervisor representative".split()
SURNAME_TITLES = [*SLUG_TITLES, "city", "council", "member"]


def _sql_list(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


# -- Names in speech ---------------------------------------------------------------------------------

def spoken_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored texts in arrival order; a null text says nothing."""
    return B.segments(spark, sf_dir).select("meeting_id", "segment_id", "idx", "label", F.coalesce("text", F.lit("")).alias("text"))


_SPOKEN = "spoken AS (SELECT meeting_id, segment_id, idx, label, coalesce(text, '') AS text FROM seg)"


def plausible(name: Column) -> Column:
    """One to three words of at most 40 characters in all, of which the first opens no reply."""
    words = F.filter(F.split(name, r"\s+"), lambda w: w != "")
    return F.coalesce(F.size(words).between(1, 3) & (F.char_length(name) <= 40) & ~F.lower(F.get(words, F.lit(0))).isin(NOT_NAMES), F.lit(False))


def name_candidates(seg: DataFrame) -> DataFrame:
    """(meeting_id, idx, pattern_ord, target, name, confidence, method): the first hit of each pattern in a segment."""
    rows = with_next(seg, ["meeting_id"], "idx", ["label", "text"], REACH)
    other = F.filter("following", lambda r: r["label"] != F.col("label"))
    target = {"self": F.col("label"), "next": F.get(other, F.lit(0))["label"], "responder": F.get(F.filter(other, lambda r: r["text"].rlike(RESPONSE)), F.lit(0))["label"]}
    found = []
    for i, (method, pattern, confidence, who) in enumerate(PATTERNS):
        name = F.nullif(F.regexp_extract("text", pattern, 1), F.lit(""))
        name = F.initcap(name) if method == "title_context" else name
        found.append(F.when(plausible(name), F.struct(F.lit(i).alias("pattern_ord"), target[who].alias("target"), name.alias("name"), F.lit(confidence).alias("confidence"), F.lit(method).alias("method"))))
    out = rows.select("meeting_id", "idx", F.explode(F.filter(F.array(*found), lambda c: c.isNotNull())).alias("c"))
    return out.select("meeting_id", "idx", "c.*").where("target is not null")


def pattern_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return name_candidates(spoken_names(spark, sf_dir))


_CAND = f"""{_SPOKEN},
led AS (SELECT *, {", ".join(f"lead(label, {k}) OVER w AS l{k}, lead(text, {k}) OVER w AS t{k}" for k in range(1, REACH + 1))} FROM spoken WINDOW w AS (PARTITION BY meeting_id ORDER BY idx)),
who AS (SELECT *, label AS "self", coalesce({", ".join(f"CASE WHEN l{k} <> label THEN l{k} END" for k in range(1, REACH + 1))}) AS "next",
  coalesce({", ".join(f"CASE WHEN l{k} <> label AND regexp_matches(t{k}, '(?i)\\b(?:present|here|aye|yes)\\b') THEN l{k} END" for k in range(1, REACH + 1))}) AS responder FROM led),
hit AS ({" UNION ALL ".join(f'''SELECT meeting_id, idx, {i} AS pattern_ord, "{who}" AS target, {("upper(left(n, 1)) || lower(substr(n, 2))" if m == "title_context" else "n")} AS name, CAST({c} AS DOUBLE) AS confidence, '{m}' AS method FROM (SELECT *, nullif(regexp_extract(text, '{p.replace("'", "''")}', 1), '') AS n FROM who)''' for i, (m, p, c, who) in enumerate(PATTERNS))}),
cand AS (SELECT * FROM hit WHERE name IS NOT NULL AND target IS NOT NULL AND length(name) <= 40 AND len(string_split_regex(name, '\\s+')) BETWEEN 1 AND 3 AND NOT list_contains({_sql_list(NOT_NAMES)}, lower(string_split_regex(name, '\\s+')[1])))"""
CANDIDATES_SQL = f"WITH {B.SEG}, {_CAND} SELECT * FROM cand"


def best_of(candidates: DataFrame) -> DataFrame:
    """Of each speaker's candidates that of the greatest confidence, the first of equals."""
    return candidates.groupBy("meeting_id", F.col("target").alias("label")).agg(F.max_by(F.struct("name", "confidence", "method"), F.struct("confidence", -F.col("idx"), -F.col("pattern_ord"))).alias("b")).select("meeting_id", "label", "b.*")


def best_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_of(pattern_candidates(spark, sf_dir))


_BEST = f"{_CAND}, best AS (SELECT meeting_id, target AS label, name, confidence, method FROM (SELECT *, row_number() OVER (PARTITION BY meeting_id, target ORDER BY confidence DESC, idx, pattern_ord) AS rn FROM cand) WHERE rn = 1)"
BEST_SQL = f"WITH {B.SEG}, {_BEST} SELECT * FROM best"


def named_mappings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.mappings(spark, sf_dir).select("meeting_id", "label", F.col("speaker_name").alias("name"), "confidence", F.col("id_method").alias("method"), "mapping_id", "needs_review")


def voice_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(meeting_id, label, name, confidence, method): speakers whose voice a profile matches, for the stated query set of voices."""
    of = B.voices(spark, sf_dir).where("ord % 100 = 0").select("meeting_id", "label", F.concat(F.lit("SPEAKER_"), "ord").alias("q"))
    return of.join(voice_match(spark, sf_dir).withColumnRenamed("label", "q"), "q").drop("q")


def cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layers of identification: voices, phrases, then models and people, whose answers are the stored mappings.

    A later layer replaces an earlier one only if it is strictly surer; who stays unsure is flagged.
    """
    stored = named_mappings(spark, sf_dir).where("name <> '' and confidence is not null").select("meeting_id", "label", "name", "confidence", "method", F.lit(2).alias("layer"))
    layers = voice_layer(spark, sf_dir).withColumn("layer", F.lit(0)).unionByName(best_candidates(spark, sf_dir).withColumn("layer", F.lit(1))).unionByName(stored)
    top = layers.groupBy("meeting_id", "label").agg(F.max_by(F.struct("name", "confidence", "method"), F.struct("confidence", -F.col("layer"))).alias("b")).select("meeting_id", "label", "b.*")
    labels = B.segments(spark, sf_dir, indexed=False).select("meeting_id", "label").distinct()
    out = labels.join(top, ["meeting_id", "label"], "left")
    return out.withColumn("needs_review", F.coalesce(F.col("confidence") < REVIEW, F.lit(True)))


def _cascade_sql() -> str:
    return f""" {B.SEG}, {B.MAPS}, {_BEST}, {_AGAINST}, {B.VOICES}, vm AS ({_VOICE_SELECT}),
layers AS (SELECT v.meeting_id, v.label, vm.name, vm.confidence, vm.method, 0 AS layer FROM voice v JOIN vm ON vm.label = 'SPEAKER_' || v.ord WHERE v.ord % 100 = 0 UNION ALL SELECT *, 1 FROM best UNION ALL SELECT meeting_id, label, speaker_name, confidence, id_method, 2 FROM map WHERE speaker_name <> '' AND confidence IS NOT NULL),
t AS (SELECT *, row_number() OVER (PARTITION BY meeting_id, label ORDER BY confidence DESC, layer) AS rn FROM layers),
casc AS (SELECT l.meeting_id, l.label, name, confidence, method, coalesce(confidence < {REVIEW}, true) AS needs_review FROM (SELECT DISTINCT meeting_id, label FROM seg) l LEFT JOIN t ON t.meeting_id = l.meeting_id AND t.label = l.label AND rn = 1)"""


# -- Mappings onto segments --------------------------------------------------------------------------

def apply_mappings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names, confidences and methods of the mapping, where it has a name; else the segment's own."""
    seg = B.segments(spark, sf_dir, "confidence", "id_method", indexed=False)
    m = named_mappings(spark, sf_dir).select("meeting_id", "label", F.col("name").alias("m_name"), F.col("confidence").alias("m_conf"), F.col("method").alias("m_method"))
    named = F.coalesce(F.col("m_name") != "", F.lit(False))
    pick = lambda new, old: F.when(named, F.col(new)).otherwise(F.col(old)).alias(old)
    return seg.join(m, ["meeting_id", "label"], "left").select("meeting_id", "segment_id", "label", pick("m_name", "speaker_name"), pick("m_conf", "confidence"), pick("m_method", "id_method"))


APPLY_SQL = f"""WITH {B.SEG}, {B.MAPS} SELECT s.meeting_id, segment_id, s.label, CASE WHEN m.speaker_name <> '' THEN m.speaker_name ELSE s.speaker_name END AS speaker_name, CASE WHEN m.speaker_name <> '' THEN m.confidence ELSE s.confidence END AS confidence,
  CASE WHEN m.speaker_name <> '' THEN m.id_method ELSE s.id_method END AS id_method FROM seg s LEFT JOIN map m ON m.meeting_id = s.meeting_id AND m.label = s.label"""


def override_mappings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Given identities replace the current ones if there is none or they are strictly surer."""
    current = named_mappings(spark, sf_dir).select("meeting_id", "label", "name", "confidence")
    given = best_candidates(spark, sf_dir).select("meeting_id", "label", F.col("name").alias("g_name"), F.col("confidence").alias("g_conf"))
    out = current.withColumn("has", F.lit(True)).join(given, ["meeting_id", "label"], "full")
    use = F.col("g_conf").isNotNull() & (F.col("has").isNull() | (F.col("g_conf") > F.coalesce("confidence", F.lit(0.0))))
    return out.select("meeting_id", "label", F.when(use, F.col("g_name")).otherwise(F.col("name")).alias("name"), F.when(use, F.col("g_conf")).otherwise(F.col("confidence")).alias("confidence"))


OVERRIDE_SQL = f"""WITH {B.SEG}, {B.MAPS}, {_BEST} SELECT coalesce(m.meeting_id, b.meeting_id) AS meeting_id, coalesce(m.label, b.label) AS label, CASE WHEN b.label IS NOT NULL AND (m.label IS NULL OR b.confidence > coalesce(m.confidence, 0)) THEN b.name ELSE m.speaker_name END AS name,
  CASE WHEN b.label IS NOT NULL AND (m.label IS NULL OR b.confidence > coalesce(m.confidence, 0)) THEN b.confidence ELSE m.confidence END AS confidence FROM map m FULL JOIN best b ON m.meeting_id = b.meeting_id AND m.label = b.label"""


def unresolved_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of segments without a named mapping, and whether a partial result for them exists already."""
    labels = B.segments(spark, sf_dir, indexed=False).select("meeting_id", "label").distinct()
    named = named_mappings(spark, sf_dir).where("name <> ''").select("meeting_id", "label")
    return labels.join(named, ["meeting_id", "label"], "left_anti")


UNRESOLVED_SQL = f"WITH {B.SEG}, {B.MAPS} SELECT DISTINCT meeting_id, label FROM seg s WHERE NOT EXISTS (SELECT 1 FROM map m WHERE m.meeting_id = s.meeting_id AND m.label = s.label AND m.speaker_name <> '')"


def pending_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unresolved labels that have no partial result yet; results are those of the pattern layer."""
    return unresolved_labels(spark, sf_dir).join(best_candidates(spark, sf_dir), ["meeting_id", "label"], "left_anti")


PENDING_SQL = f"WITH {B.SEG}, {B.MAPS}, {_BEST} SELECT DISTINCT meeting_id, label FROM seg s WHERE NOT EXISTS (SELECT 1 FROM map m WHERE m.meeting_id = s.meeting_id AND m.label = s.label AND m.speaker_name <> '') AND NOT EXISTS (SELECT 1 FROM best b WHERE b.meeting_id = s.meeting_id AND b.label = s.label)"


def review_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = table(spark, sf_dir, "mappings")
    return m.where("mapping_id is not null").groupBy("mapping_id").agg(F.min("meeting_id").alias("meeting_id"), F.min("needs_review").alias("needs_review")).where("needs_review").select("mapping_id", "meeting_id")


REVIEW_SQL = "SELECT mapping_id, meeting_id FROM (SELECT mapping_id, min(meeting_id) AS meeting_id, min(needs_review) AS r FROM mappings WHERE mapping_id IS NOT NULL GROUP BY 1) WHERE r"


def corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corrections typed as `LABEL=Name, LABEL=Name` for the mappings of a meeting that need a review; unknown labels are ignored, the last of a label wins."""
    m = named_mappings(spark, sf_dir)
    typed = m.where("name <> '' and needs_review").groupBy("meeting_id").agg(F.array_join(F.array_sort(F.collect_list(F.concat("label", F.lit("= Dr. "), F.regexp_replace("name", ",", "")))), ", ").alias("typed"))
    pairs = typed.select("meeting_id", F.posexplode(F.split("typed", ",")).alias("i", "pair")).where(F.col("pair").contains("="))
    parsed = pairs.select("meeting_id", "i", F.trim(F.split_part("pair", F.lit("="), F.lit(1))).alias("label"), F.trim(F.regexp_replace("pair", "^[^=]*=", "")).alias("corrected"))
    last = parsed.groupBy("meeting_id", "label").agg(F.max_by("corrected", "i").alias("corrected"))
    out = m.join(last, ["meeting_id", "label"], "left")
    use = F.col("corrected").isNotNull()
    return out.select("meeting_id", "label", F.coalesce("corrected", "name").alias("name"), F.when(use, 1.0).otherwise(F.col("confidence")).alias("confidence"), F.when(use, F.lit("human_review")).otherwise(F.col("method")).alias("method"))


CORRECTIONS_SQL = f"WITH {B.MAPS} SELECT meeting_id, label, CASE WHEN u THEN trim('Dr. ' || replace(speaker_name, ',', '')) ELSE speaker_name END AS name, CASE WHEN u THEN 1.0 ELSE confidence END AS confidence, CASE WHEN u THEN 'human_review' ELSE id_method END AS method FROM (SELECT *, coalesce(speaker_name <> '' AND needs_review, false) AS u FROM map)"


# -- Rosters -----------------------------------------------------------------------------------------

def surname(name: Column, titles: list[str] = SURNAME_TITLES) -> Column:
    """The last word that is no title; the whole name if all are."""
    words = F.filter(F.split(F.trim(name), r"\s+"), lambda w: (w != "") & ~F.lower(w).isin(titles))
    return F.when(F.size(words) > 0, F.element_at(words, -1)).otherwise(name)


def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([SequenceMatcher(None, x.lower(), y.lower()).ratio() if x is not None and y is not None else None for x, y in zip(a, b, strict=True)], dtype="float64")


similarity = F.pandas_udf(ratio, DoubleType())


def lookup(names: DataFrame, members: DataFrame) -> DataFrame:
    """(roster_id, name, corrected, tier): exact name, exact alias, alias within, likest surname, else as it is.

    names holds distinct (roster_id, name); the string similarity runs on what the first tiers leave.
    """
    typed = names.withColumn("t", F.trim(F.regexp_replace("name", r"^\s+|\s+$", "")))
    pairs = typed.join(members.withColumnRenamed("name", "member"), "roster_id")
    low, alias = F.lower("t"), F.lower("alias")
    single = ~F.col("alias").contains(" ")
    words = F.split(low, r"\s+")
    tier = (
        F.when(low == F.lower("member"), 1).when(low == alias, 2).when(single & F.array_contains(words, alias), 3).when(~single & low.contains(alias), 3)
    )
    keyed = pairs.withColumn("tier", tier)
    best = keyed.where("tier is not null").groupBy("roster_id", "name").agg(F.min_by(F.struct("tier", F.col("member").alias("corrected")), F.struct("tier", "member_ord", F.coalesce("alias_ord", F.lit(-1)))).alias("b"))
    left = keyed.where("alias is not null").join(best, ["roster_id", "name"], "left_anti").select("roster_id", "name", "member", "member_ord", "alias_ord", surname(F.col("t")).alias("a"), surname(F.col("alias")).alias("b"))
    scored = left.join(left.select("a", "b").distinct().withColumn("score", similarity("a", "b")), ["a", "b"]).where(F.col("score") > 0)
    fuzzy = scored.groupBy("roster_id", "name").agg(F.max_by(F.struct("score", F.col("member").alias("corrected")), F.struct("score", -F.col("member_ord"), -F.col("alias_ord"))).alias("f")).where(F.col("f.score") >= FUZZY)
    out = typed.join(best, ["roster_id", "name"], "left").join(fuzzy, ["roster_id", "name"], "left")
    return out.select("roster_id", "name", F.coalesce("b.corrected", "f.corrected", "t").alias("corrected"), F.coalesce("b.tier", F.when(F.col("f").isNotNull(), 4), F.lit(0)).alias("tier"))


def _mapped_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Named mappings with the roster of their body; where they name none, that of their meeting's city and body."""
    return B.with_bodies(spark, sf_dir, named_mappings(spark, sf_dir).where("name <> ''").join(B.mappings(spark, sf_dir).select("mapping_id", F.col("roster_id").alias("own")), "mapping_id")).where("roster_id is not null")


def roster_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact tiers, which SQL can express; roster_correct has them all."""
    names = _mapped_names(spark, sf_dir).select("roster_id", "name").distinct()
    return lookup(names, B.roster_aliases(spark, sf_dir)).where("tier between 1 and 3")


LOOKUP_SQL = f"""WITH {B.MAPS}, {B.MEET}, {B.BODIES}, {B.ROST}, n AS (SELECT DISTINCT roster_id, speaker_name AS name, trim(regexp_replace(speaker_name, '^\\s+|\\s+$', '', 'g')) AS t FROM mapb WHERE speaker_name <> '' AND roster_id IS NOT NULL),
k AS (SELECT n.roster_id, n.name, r.name AS corrected, member_ord, coalesce(alias_ord, -1) AS alias_ord, CASE WHEN lower(t) = lower(r.name) THEN 1 WHEN lower(t) = lower(alias) THEN 2 WHEN NOT contains(alias, ' ') AND list_contains(string_split_regex(lower(t), '\\s+'), lower(alias)) THEN 3 WHEN contains(alias, ' ') AND contains(lower(t), lower(alias)) THEN 3 END AS tier FROM n JOIN rost r USING (roster_id))
SELECT roster_id, name, corrected, tier FROM (SELECT *, row_number() OVER (PARTITION BY roster_id, name ORDER BY tier, member_ord, alias_ord) AS rn FROM k WHERE tier IS NOT NULL) WHERE rn = 1"""


def roster_correct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every mapping's name as its roster has it, by all four tiers (distinct names first, then joined back)."""
    m = _mapped_names(spark, sf_dir)
    fixed = lookup(m.select("roster_id", "name").distinct(), B.roster_aliases(spark, sf_dir))
    return m.join(fixed, ["roster_id", "name"]).select("roster_id", "meeting_id", "label", "name", "corrected", "tier")


def correction_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over all meetings at once: changed mappings and learnable aliases, a meeting at a time."""
    fixed = roster_correct(spark, sf_dir)
    changed = F.col("name") != F.col("corrected")
    alias = F.trim("name")
    learn = changed & (F.char_length(alias) >= 3) & ~F.lower(alias).isin(NO_ALIASES) & ~F.col("name").startswith("SPEAKER_")
    return fixed.groupBy("meeting_id").agg(F.count_if(changed).alias("corrections"), F.count_if(learn & (F.col("tier") > 0)).alias("aliases"))


def _segment_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    seg = B.segments(spark, sf_dir, indexed=False).where("speaker_name <> ''").select("meeting_id", "segment_id", F.col("speaker_name").alias("name"))
    return B.with_bodies(spark, sf_dir, seg).where("roster_id is not null")


def fixed_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The segments of all transcripts whose speaker's name the roster of their meeting's body changes, by all tiers."""
    named = _segment_names(spark, sf_dir)
    fixed = lookup(named.select("roster_id", "name").distinct(), B.roster_aliases(spark, sf_dir)).where("name <> corrected")
    return named.join(fixed, ["roster_id", "name"]).select("meeting_id", "segment_id", "name", "corrected", "tier")


def fixed_segments_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Those that the exact tiers change, which SQL can express."""
    return fixed_segments(spark, sf_dir).where("tier between 1 and 3").select("meeting_id", "segment_id", "name", "corrected")


FIXED_SQL = f"""WITH {B.SEG}, {B.MEET}, {B.ROST}, {B.HOMES}, sn AS (SELECT s.meeting_id, segment_id, speaker_name AS name, roster_id, trim(regexp_replace(speaker_name, '^\\s+|\\s+$', '', 'g')) AS t FROM seg s JOIN home USING (meeting_id) WHERE speaker_name <> ''),
k AS (SELECT n.roster_id, n.name, r.name AS corrected, member_ord, coalesce(alias_ord, -1) AS alias_ord, CASE WHEN lower(t) = lower(r.name) THEN 1 WHEN lower(t) = lower(alias) THEN 2 WHEN NOT contains(alias, ' ') AND list_contains(string_split_regex(lower(t), '\\s+'), lower(alias)) THEN 3 WHEN contains(alias, ' ') AND contains(lower(t), lower(alias)) THEN 3 END AS tier FROM (SELECT DISTINCT roster_id, name, t FROM sn) n JOIN rost r USING (roster_id)),
f AS (SELECT roster_id, name, corrected FROM (SELECT *, row_number() OVER (PARTITION BY roster_id, name ORDER BY tier, member_ord, alias_ord) AS rn FROM k WHERE tier IS NOT NULL) WHERE rn = 1)
SELECT meeting_id, segment_id, name, corrected FROM sn JOIN f USING (roster_id, name) WHERE name <> corrected"""


def learned_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(roster_id, name, alias): what people typed and the roster corrected, as new aliases of the member, where it has none such."""
    fixed = roster_correct(spark, sf_dir).where((F.col("name") != F.col("corrected")) & (F.col("tier") > 0))
    alias = F.trim("name")
    ok = (F.char_length(alias) >= 3) & ~F.lower(alias).isin(NO_ALIASES) & ~alias.startswith("SPEAKER_")
    new = fixed.where(ok).select("roster_id", F.col("corrected").alias("member"), alias.alias("alias"), F.lower(alias).alias("low")).distinct()
    have = B.roster_aliases(spark, sf_dir)
    known = have.select("roster_id", F.col("name").alias("member"), F.lower("alias").alias("low")).unionByName(have.select("roster_id", F.col("name").alias("member"), F.lower("name").alias("low"))).distinct()
    return new.join(known, ["roster_id", "member", "low"], "left_anti").select("roster_id", "member", "alias")


def roster_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.roster_aliases(spark, sf_dir).select("roster_id", "member_ord", "name", "alias_ord", "alias")


MEMBERS_SQL = f"WITH {B.ROST} SELECT roster_id, CAST(member_ord AS INTEGER) AS member_ord, name, CAST(alias_ord AS INTEGER) AS alias_ord, alias FROM rost"


def roster_hint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The roster's names in order, for a prompt."""
    m = B.roster_aliases(spark, sf_dir).select("roster_id", "member_ord", "name").distinct()
    names = F.transform(F.array_sort(F.collect_list(F.struct("member_ord", "name"))), lambda r: r["name"])
    return m.groupBy("roster_id").agg(F.concat(F.lit("Known council members for this body: "), F.array_join(names, ", ")).alias("hint"))


HINT_SELECT = "SELECT roster_id, 'Known council members for this body: ' || string_agg(name, ', ' ORDER BY member_ord) AS hint FROM (SELECT DISTINCT roster_id, member_ord, name FROM rost) GROUP BY 1"
HINT_SQL = f"WITH {B.ROST} {HINT_SELECT}"


def alias_additions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aliases that may be added: long enough, no placeholder, not there yet, to the first member of the name."""
    rost = B.roster_aliases(spark, sf_dir)
    first = rost.groupBy("roster_id", F.lower("name").alias("low")).agg(F.min("member_ord").alias("member_ord"))
    new = _mapped_names(spark, sf_dir).select("roster_id", F.col("name").alias("alias"), F.lower(F.trim("name")).alias("low_alias")).distinct()
    ok = (F.char_length(F.trim("alias")) >= 3) & ~F.lower(F.trim("alias")).isin(NO_ALIASES) & ~F.trim("alias").startswith("SPEAKER_")
    word = F.element_at(F.split("low_alias", r"\s+"), -1)
    target = rost.select("roster_id", "member_ord", F.lower("name").alias("low")).distinct().join(first, ["roster_id", "low", "member_ord"]).withColumn("word", F.element_at(F.split("low", r"\s+"), -1))
    pairs = new.where(ok).withColumn("word", word).join(target, ["roster_id", "word"]).where("low_alias <> low")
    have = rost.select("roster_id", "member_ord", F.lower("alias").alias("low_alias")).where("low_alias is not null").distinct()
    return pairs.join(have, ["roster_id", "member_ord", "low_alias"], "left_anti").select("roster_id", "member_ord", F.trim("alias").alias("alias")).distinct()


ALIAS_SQL = f"""WITH {B.MAPS}, {B.MEET}, {B.BODIES}, {B.ROST}, f AS (SELECT roster_id, lower(name) AS low, min(member_ord) AS member_ord FROM rost GROUP BY 1, 2),
n AS (SELECT DISTINCT roster_id, trim(speaker_name) AS alias, lower(trim(speaker_name)) AS la FROM mapb WHERE speaker_name <> '' AND roster_id IS NOT NULL)
SELECT DISTINCT n.roster_id, CAST(f.member_ord AS INTEGER) AS member_ord, n.alias FROM n JOIN f ON f.roster_id = n.roster_id AND string_split_regex(n.la, '\\s+')[-1] = string_split_regex(f.low, '\\s+')[-1] AND n.la <> f.low
WHERE length(n.alias) >= 3 AND n.la NOT IN ('speaker', 'unknown', 'unidentified', 'none', 'n/a') AND NOT starts_with(n.alias, 'SPEAKER_') AND NOT EXISTS (SELECT 1 FROM rost r WHERE r.roster_id = n.roster_id AND r.member_ord = f.member_ord AND lower(r.alias) = n.la)"""


def slug_of(name: Column) -> Column:
    """surname_given in lower case without titles; one word is itself, titles alone count as words."""
    all_ = F.filter(F.split(F.trim(name), r"\s+"), lambda w: w != "")
    kept = F.filter(all_, lambda w: ~F.lower(w).isin(SLUG_TITLES))
    w = F.when(F.size(kept) > 0, kept).otherwise(all_)
    return F.lower(F.when(F.size(w) >= 2, F.concat(F.element_at(w, -1), F.lit("_"), F.get(w, F.lit(0)))).otherwise(F.get(w, F.lit(0))))


def _slug_sql(name: str) -> str:
    words = f"list_filter(string_split_regex(trim({name}), '\\s+'), lambda w: w <> '')"
    kept = f"list_filter({words}, lambda w: NOT list_contains({_sql_list(SLUG_TITLES)}, lower(w)))"
    w = f"CASE WHEN len({kept}) > 0 THEN {kept} ELSE {words} END"
    return f"lower(CASE WHEN len({w}) >= 2 THEN ({w})[len({w})] || '_' || ({w})[1] ELSE ({w})[1] END)"


def name_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Surname, slug and plausibility of every name of mappings and profiles."""
    a = named_mappings(spark, sf_dir).select("name")
    names = a.union(B.profiles(spark, sf_dir).select("display_name")).where("name is not null and trim(name) <> ''").distinct()
    return names.select("name", surname(F.col("name")).alias("surname"), slug_of(F.col("name")).alias("slug"), plausible(F.col("name")).alias("plausible"))


KEYS_SQL = f"""WITH {B.MAPS}, {B.PROF}, n AS (SELECT DISTINCT name FROM (SELECT speaker_name AS name FROM map UNION ALL SELECT display_name FROM prof) WHERE trim(name) <> ''),
w AS (SELECT name, list_filter(string_split_regex(trim(name), '\\s+'), lambda w: w <> '' AND NOT list_contains({_sql_list(SURNAME_TITLES)}, lower(w))) AS k, list_filter(string_split_regex(name, '\\s+'), lambda w: w <> '') AS a FROM n)
SELECT name, CASE WHEN len(k) > 0 THEN k[len(k)] ELSE name END AS surname, {_slug_sql("name")} AS slug, len(a) BETWEEN 1 AND 3 AND length(name) <= 40 AND NOT list_contains({_sql_list(NOT_NAMES)}, lower(a[1])) AS plausible FROM w"""

# -- Voices ------------------------------------------------------------------------------------------

def _centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles with a centroid that is no zero vector."""
    p = B.profiles(spark, sf_dir).where("size(centroid) = 64")
    return p.where(F.exists("centroid", lambda x: x != 0)).select("ord", "slug", "display_name", "centroid", F.size(F.coalesce("meetings_seen", F.array())).alias("n_meetings"))


def _queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stated query set: the first stored embedding of every hundredth profile."""
    p = B.profiles(spark, sf_dir).where("ord % 100 = 0 and size(embeddings) > 0")
    v = p.select("ord", F.get("embeddings", F.lit(0)).alias("v")).where("size(v) = 64")
    return v.where(F.exists("v", lambda x: x != 0)).select(F.concat(F.lit("SPEAKER_"), "ord").alias("label"), F.col("v").alias("voice"))


def _against_all(spark: SparkSession, sf_dir: str, least: float, best_only: bool) -> DataFrame:
    """The query set against all centroids, in blocks: (label, ord, slug, display_name, n_meetings, score)."""
    c = _centroids(spark, sf_dir)
    scores = query_scores(_queries(spark, sf_dir).select("label", F.col("voice").alias("v")), c.select("ord", F.col("centroid").alias("v")), least, best_only)
    return scores.join(c.drop("centroid"), "ord")


def voice_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best positive match of each voice, if it passes the threshold that its meetings allow."""
    s = _against_all(spark, sf_dir, 0.0, best_only=True).where("score > 0")
    best = s.groupBy("label").agg(F.max_by(F.struct("slug", "n_meetings", "score"), F.struct("score", -F.col("ord"))).alias("b")).select("label", "b.*")
    n = F.col("n_meetings")
    limit = F.when(n >= 3, RETURNING_3).when(n >= 2, RETURNING_2).otherwise(VOICE)
    tag = F.when(n >= 3, "returning_3+").when(n >= 2, "returning_2")
    method = F.when(tag.isNotNull() & (F.col("score") < VOICE), F.concat(F.lit("voice_profile ("), tag, F.lit(")"))).otherwise("voice_profile")
    return best.where(F.col("score") >= limit).select("label", F.col("slug").alias("name"), F.round("score", 3).alias("confidence"), method.alias("method"))


_AGAINST = f"""{B.PROF}, q AS (SELECT 'SPEAKER_' || ord AS label, embeddings[1] AS v FROM prof WHERE ord % 100 = 0 AND len(embeddings) > 0), q2 AS (SELECT * FROM q WHERE len(v) = 64 AND list_max(list_transform(v, lambda x: abs(x))) > 0),
c AS (SELECT ord, slug, display_name, centroid, coalesce(len(meetings_seen), 0) AS n FROM prof WHERE len(centroid) = 64 AND list_max(list_transform(centroid, lambda x: abs(x))) > 0),
s AS (SELECT label, ord, slug, display_name, n, list_cosine_similarity(v, centroid) AS score FROM q2, c)"""
_VOICE_SELECT = f"""SELECT label, slug AS name, round(score, 3) AS confidence, CASE WHEN n >= 2 AND score < {VOICE} THEN 'voice_profile (' || CASE WHEN n >= 3 THEN 'returning_3+' ELSE 'returning_2' END || ')' ELSE 'voice_profile' END AS method
FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY score DESC, ord) AS rn FROM s WHERE score > 0) WHERE rn = 1 AND score >= CASE WHEN n >= 3 THEN {RETURNING_3} WHEN n >= 2 THEN {RETURNING_2} ELSE {VOICE} END"""
VOICE_SQL = f"WITH {_AGAINST} {_VOICE_SELECT}"
CASCADE_SQL = f"WITH {_cascade_sql()} SELECT * FROM casc"


def soft_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All matches of each voice above a low bar, by rounded score, then in profile order."""
    s = _against_all(spark, sf_dir, SOFT, best_only=False).withColumn("r", F.round("score", 3))
    rows = F.array_sort(F.collect_list(F.struct((-F.col("r")).alias("k"), "ord", F.coalesce("display_name", "slug").alias("name"))))
    return s.groupBy("label").agg(F.transform(rows, lambda x: F.concat(x["name"], F.lit("="), F.format_number(-x["k"], 3))).alias("hints"))


SOFT_SQL = f"WITH {_AGAINST} SELECT label, list(coalesce(display_name, slug) || '=' || printf('%.3f', round(score, 3)) ORDER BY round(score, 3) DESC, ord) AS hints FROM s WHERE score >= {SOFT} GROUP BY 1"


def rounded(x: Column) -> Column:
    """To six places, halves up: the same in every engine."""
    return F.floor(x * 1e6 + 0.5) / 1e6


def profile_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean of each profile's stored embeddings, summed by place; rounded for comparison."""
    p = B.profiles(spark, sf_dir).select("ord", F.explode("embeddings").alias("v")).where("size(v) > 0")
    return mean_by(p, ["ord"], "v", "m").select("ord", F.transform("m", rounded).alias("centroid"))


CENTROID_SQL = f"WITH {B.PROF}, v AS (SELECT ord, unnest(embeddings) AS v FROM prof), x AS (SELECT ord, generate_subscripts(v, 1) AS i, unnest(v) AS f FROM v WHERE len(v) > 0), m AS (SELECT ord, i, avg(f) AS m FROM x GROUP BY 1, 2) SELECT ord, list(floor(m * 1e6 + 0.5) / 1e6 ORDER BY i) AS centroid FROM m GROUP BY 1"

def voice_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of speakers of one meeting whose voices are alike enough to be one."""
    v = B.voices(spark, sf_dir)
    return similar_pairs(v, "meeting_id", "label", "v", MERGE).select(F.col("g").alias("meeting_id"), "a", "b")


_PAIRS = f"""{B.SEG}, {B.PROF}, {B.VOICES},
vp AS (SELECT x.meeting_id, x.label AS a, y.label AS b FROM voice x JOIN voice y ON x.meeting_id = y.meeting_id AND x.label < y.label AND list_cosine_similarity(x.v, y.v) >= {MERGE})"""
PAIRS_SQL = f"WITH {_PAIRS} SELECT * FROM vp"


def merged_speakers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(meeting_id, label, representative, members): speakers joined through like voices; the one who spoke longest stands for them, the least label of equals."""
    v = B.voices(spark, sf_dir).select("meeting_id", "label")
    node = lambda label: F.concat_ws("\u001f", "meeting_id", label)
    comp = components(voice_pairs(spark, sf_dir).select(node("a").alias("a"), node("b").alias("b")), v.select(node("label").alias("node")))
    speech = B.segments(spark, sf_dir, indexed=False).groupBy("meeting_id", "label").agg(F.sum(F.col("end_ms") - F.col("start_ms")).alias("ms"))
    rows = v.withColumn("node", node("label")).join(comp, "node").join(speech, ["meeting_id", "label"])
    rep = rows.groupBy("component").agg(F.min_by("label", F.struct(-F.col("ms"), "label")).alias("representative"), F.count(F.lit(1)).alias("members"))
    return rows.join(rep, "component").select("meeting_id", "label", "representative", "members")


_MERGED = f"""{_PAIRS}, e AS (SELECT meeting_id, a, b FROM vp UNION ALL SELECT meeting_id, b, a FROM vp), r(meeting_id, node, reach) AS (SELECT meeting_id, label, label FROM voice UNION SELECT r.meeting_id, r.node, e.b FROM r JOIN e ON e.meeting_id = r.meeting_id AND e.a = r.reach),
c AS (SELECT meeting_id, node AS label, min(reach) AS component FROM r GROUP BY 1, 2), sp AS (SELECT meeting_id, label, sum(end_ms - start_ms) AS ms FROM seg GROUP BY 1, 2),
mg AS (SELECT c.meeting_id, c.label, first_value(c.label) OVER (PARTITION BY c.meeting_id, component ORDER BY ms DESC, c.label) AS representative, count(*) OVER (PARTITION BY c.meeting_id, component) AS members FROM c JOIN sp ON sp.meeting_id = c.meeting_id AND sp.label = c.label)"""
MERGED_SQL = f"WITH RECURSIVE {_MERGED} SELECT * FROM mg"


def merged_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every segment under the label of the one who stands for its speaker."""
    seg = B.segments(spark, sf_dir, indexed=False).select("meeting_id", "segment_id", "label")
    m = merged_speakers(spark, sf_dir).select("meeting_id", "label", "representative")
    return seg.join(m, ["meeting_id", "label"], "left").select("meeting_id", "segment_id", F.coalesce("representative", "label").alias("label"))


MERGED_SEGMENTS_SQL = f"WITH RECURSIVE {_MERGED} SELECT s.meeting_id, segment_id, coalesce(representative, s.label) AS label FROM seg s LEFT JOIN mg ON mg.meeting_id = s.meeting_id AND mg.label = s.label"


def merge_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line for each group of several speakers: who was merged into whom."""
    others = merged_speakers(spark, sf_dir).where("members > 1 and label <> representative")
    per = others.groupBy("meeting_id", "representative").agg(F.array_join(F.array_sort(F.collect_list("label")), " + ").alias("others"))
    return per.select("meeting_id", F.concat("others", F.lit(" merged into "), "representative").alias("line"))


LOG_SQL = f"WITH RECURSIVE {_MERGED} SELECT meeting_id, string_agg(label, ' + ' ORDER BY label) || ' merged into ' || representative AS line FROM mg WHERE label <> representative GROUP BY meeting_id, representative"


def merged_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unweighted mean of the voices that one speaker of a meeting stands for; single ones keep theirs."""
    rows = B.voices(spark, sf_dir).join(merged_speakers(spark, sf_dir), ["meeting_id", "label"])
    return mean_by(rows, ["meeting_id", "representative"], "v", "m").select("meeting_id", "representative", F.transform("m", rounded).alias("centroid"))


MERGED_CENTROID_SQL = f"""WITH RECURSIVE {_MERGED}, x AS (SELECT mg.meeting_id, representative, generate_subscripts(v, 1) AS i, unnest(v) AS f FROM voice JOIN mg ON mg.meeting_id = voice.meeting_id AND mg.label = voice.label)
SELECT meeting_id, representative, list(floor(m * 1e6 + 0.5) / 1e6 ORDER BY i) AS centroid FROM (SELECT meeting_id, representative, i, avg(f) AS m FROM x GROUP BY 1, 2, 3) GROUP BY 1, 2"""

# -- Profiles ----------------------------------------------------------------------------------------

def upsert(rows: DataFrame) -> DataFrame:
    """Profiles by slug of rows (slug, ord, display_name, embeddings, meetings_seen, segments).

    The first display name by ord, the counts of embeddings and distinct meetings, summed segments, and
    the centroid recomputed as the mean of all embeddings of the right length. Sums and counts, never a
    list of all that a slug has: a common name costs no task more than its rows.
    """
    per = rows.groupBy("slug").agg(F.min_by("display_name", "ord").alias("display_name"), F.sum("segments").alias("segments"), F.sum(F.size("embeddings")).alias("n_embeddings"))
    seen = rows.select("slug", F.explode("meetings_seen").alias("m")).distinct().groupBy("slug").agg(F.count(F.lit(1)).alias("n_meetings"))
    vectors = rows.select("slug", F.explode("embeddings").alias("v")).where(f"size(v) = {DIM}")
    centroid = mean_by(vectors, ["slug"], "v", "m").select("slug", F.transform("m", rounded).alias("centroid"))
    return per.join(seen, "slug", "left").join(centroid, "slug", "left").select("slug", "display_name", "n_embeddings", F.coalesce("n_meetings", F.lit(0)).alias("n_meetings"), "segments", "centroid")


def _upsert_sql(rows: str) -> str:
    """The same over the SQL of rows (slug, ord, display_name, es, ms, s)."""
    return f"""u AS ({rows}), me AS (SELECT slug, count(DISTINCT meeting) AS nm FROM (SELECT slug, unnest(ms) AS meeting FROM u) WHERE meeting IS NOT NULL GROUP BY 1),
v AS (SELECT slug, unnest(es) AS v FROM u), x AS (SELECT slug, generate_subscripts(v, 1) AS i, unnest(v) AS f FROM v WHERE len(v) = {DIM}), ce AS (SELECT slug, list(floor(m * 1e6 + 0.5) / 1e6 ORDER BY i) AS centroid FROM (SELECT slug, i, avg(f) AS m FROM x GROUP BY 1, 2) GROUP BY 1)
SELECT u.slug, first(display_name ORDER BY ord) AS display_name, CAST(sum(len(es)) AS BIGINT) AS n_embeddings, coalesce(any_value(nm), 0) AS n_meetings, CAST(sum(s) AS BIGINT) AS segments, any_value(ce.centroid) AS centroid FROM u LEFT JOIN me USING (slug) LEFT JOIN ce USING (slug) GROUP BY 1"""


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = B.profiles(spark, sf_dir)
    return p.select("slug", F.col("ord").cast("bigint").alias("ord"), "display_name", F.coalesce("embeddings", F.array()).alias("embeddings"), F.coalesce("meetings_seen", F.array()).alias("meetings_seen"), F.coalesce("total_segments_confirmed", F.lit(0)).cast("bigint").alias("segments"))


def enrolments(spark: SparkSession, sf_dir: str, which: str) -> DataFrame:
    """Named mappings that have a voice and meet a condition, as profile rows with the segments of their label."""
    m = named_mappings(spark, sf_dir).where("trim(name) <> ''").where(which)
    n = B.segments(spark, sf_dir, indexed=False).groupBy("meeting_id", "label").agg(F.count(F.lit(1)).alias("segments"))
    rows = m.join(B.voices(spark, sf_dir).select("meeting_id", "label", "v"), ["meeting_id", "label"]).join(n, ["meeting_id", "label"], "left")
    return rows.select(slug_of(F.col("name")).alias("slug"), (F.col("mapping_id") + 1_000_000_000).cast("bigint").alias("ord"), F.col("name").alias("display_name"), F.array("v").alias("embeddings"), F.array("meeting_id").alias("meetings_seen"), F.coalesce("segments", F.lit(0)).alias("segments"))


def _by_person(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored profiles under the slugs of their names, so that enrolment finds them."""
    return _stored(spark, sf_dir).withColumn("slug", F.when(F.trim("display_name") != "", slug_of(F.col("display_name"))).otherwise(F.col("slug")))


SURE, CONFIRMED = f"confidence >= {VOICE}", "method = 'manual'"


def enrol(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Speakers with a voice who are identified surely enough, added to the store or appended to their profile."""
    return upsert(_by_person(spark, sf_dir).unionByName(enrolments(spark, sf_dir, SURE)))


def enrol_confirmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Speakers with a voice whom someone named by hand, whatever their confidence."""
    return upsert(_by_person(spark, sf_dir).unionByName(enrolments(spark, sf_dir, CONFIRMED)))


_PERSONS = f"SELECT CASE WHEN trim(display_name) <> '' THEN {_slug_sql('display_name')} ELSE slug END AS slug, CAST(ord AS BIGINT) AS ord, display_name, coalesce(embeddings, []) AS es, coalesce(meetings_seen, []) AS ms, coalesce(total_segments_confirmed, 0) AS s FROM prof"


def _enrol_sql(where: str) -> str:
    new = f"SELECT {_slug_sql('speaker_name')}, mapping_id + 1000000000, speaker_name, [voice.v], [map.meeting_id], coalesce(n, 0) FROM map JOIN voice ON voice.meeting_id = map.meeting_id AND voice.label = map.label LEFT JOIN n ON n.meeting_id = map.meeting_id AND n.label = map.label WHERE trim(speaker_name) <> '' AND {where}"
    return f"WITH {B.SEG}, {B.MAPS}, {B.PROF}, {B.VOICES}, n AS (SELECT meeting_id, label, count(*) AS n FROM seg GROUP BY 1, 2), " + _upsert_sql(f"{_PERSONS} UNION ALL {new}")


def rename_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every profile re-keyed by the slug of its own name; those that meet under one are merged."""
    return upsert(_by_person(spark, sf_dir))


def merge_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles of odd place merged into their neighbour of even place, where it exists; others stay."""
    p = _stored(spark, sf_dir)
    into = p.where("ord % 2 = 0").select((F.col("ord") - 1).alias("ord"), F.col("slug").alias("dest"))
    moved = p.join(into, "ord", "left").withColumns({"slug": F.coalesce("dest", "slug"), "ord": F.when(F.col("dest").isNotNull(), F.col("ord") + 1_000_000_000).otherwise(F.col("ord"))}).drop("dest")
    return upsert(moved)


def delete_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store without the profiles whose names are blank."""
    p = _stored(spark, sf_dir)
    gone = p.where("display_name is null or trim(display_name) = ''").select("slug")
    return p.join(gone, "slug", "left_anti").select("slug", "display_name", "segments")


def roster_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles renamed by their roster, re-keyed by the slug of the new name, and merged under it; a profile without a roster keeps its name."""
    p = _stored(spark, sf_dir).join(B.profiles(spark, sf_dir).select(F.col("ord").cast("bigint").alias("ord"), "roster_id"), "ord")
    fixed = lookup(p.where("display_name <> '' and roster_id is not null").select("roster_id", F.col("display_name").alias("name")).distinct(), B.roster_aliases(spark, sf_dir))
    new = p.join(fixed.withColumnRenamed("name", "display_name"), ["roster_id", "display_name"], "left")
    name = F.coalesce("corrected", "display_name")
    return upsert(new.select(F.when(F.trim(name) != "", slug_of(name)).otherwise(F.col("slug")).alias("slug"), "ord", name.alias("display_name"), "embeddings", "meetings_seen", "segments"))


def borderline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Named speakers with a voice whose confidence asks for a confirmation, the surest of a meeting first, with speech and a sample that has text."""
    m = named_mappings(spark, sf_dir).where((F.col("name") != "") & (F.col("confidence") >= REVIEW) & (F.col("confidence") < VOICE))
    m = m.join(B.voices(spark, sf_dir).select("meeting_id", "label"), ["meeting_id", "label"], "left_semi")
    m = m.withColumn("place", F.row_number().over(Window.partitionBy("meeting_id").orderBy(F.desc("confidence"), "label")))
    seg = B.segments(spark, sf_dir).select("meeting_id", "label", "segment_id", "idx", "start_ms", "end_ms", F.coalesce(F.col("text") != "", F.lit(False)).alias("has_text"))
    rows = dense_index(seg, ["meeting_id", "label", "has_text"], "idx", "k", tie="segment_id")
    per = rows.groupBy("meeting_id", "label").agg(F.count(F.lit(1)).alias("seg_count"), F.sum(F.col("end_ms") - F.col("start_ms")).alias("speech_ms"), F.count_if("has_text").alias("n_text"))
    sample = rows.where("has_text").join(per, ["meeting_id", "label"]).where(F.col("k") == F.greatest(F.lit(0), F.expr("n_text div 3 - 1"))).select("meeting_id", "label", F.col("segment_id").alias("sample_segment"))
    return m.join(per, ["meeting_id", "label"], "left").join(sample, ["meeting_id", "label"], "left").select("meeting_id", "label", "name", "confidence", "place", F.coalesce("seg_count", F.lit(0)).alias("seg_count"), F.coalesce("speech_ms", F.lit(0)).alias("speech_ms"), "sample_segment")


BORDERLINE_SQL = f"""WITH {B.SEG}, {B.MAPS}, {B.PROF}, {B.VOICES}, k AS (SELECT *, row_number() OVER (PARTITION BY meeting_id, label, coalesce(text <> '', false) ORDER BY idx) - 1 AS k, count(*) FILTER (text <> '') OVER (PARTITION BY meeting_id, label) AS nt FROM seg),
s AS (SELECT meeting_id, label, segment_id AS sample_segment FROM k WHERE text <> '' AND k = greatest(0, nt // 3 - 1)), p AS (SELECT meeting_id, label, count(*) AS c, sum(end_ms - start_ms) AS ms FROM seg GROUP BY 1, 2)
SELECT m.meeting_id, m.label, speaker_name AS name, confidence, CAST(row_number() OVER (PARTITION BY m.meeting_id ORDER BY confidence DESC, m.label) AS INTEGER) AS place, coalesce(c, 0) AS seg_count, CAST(coalesce(ms, 0) AS BIGINT) AS speech_ms, sample_segment FROM map m LEFT JOIN p USING (meeting_id, label) LEFT JOIN s USING (meeting_id, label) WHERE speaker_name <> '' AND confidence >= {REVIEW} AND confidence < {VOICE} AND EXISTS (SELECT 1 FROM voice v WHERE v.meeting_id = m.meeting_id AND v.label = m.label)"""

QUERIES = {
    "pattern_candidates": pattern_candidates, "best_candidates": best_candidates, "cascade": cascade, "apply_mappings": apply_mappings, "override_mappings": override_mappings, "unresolved_labels": unresolved_labels,
    "pending_labels": pending_labels, "review_queue": review_queue, "corrections": corrections, "roster_members": roster_members, "roster_hint": roster_hint, "roster_lookup": roster_lookup, "roster_correct": roster_correct,
    "correction_totals": correction_totals, "alias_additions": alias_additions, "name_keys": name_keys, "voice_match": voice_match, "soft_match": soft_match, "profile_centroids": profile_centroids, "voice_pairs": voice_pairs,
    "merged_speakers": merged_speakers, "merged_segments": merged_segments, "merge_log": merge_log, "merged_centroids": merged_centroids, "fixed_segments": fixed_segments, "fixed_segments_exact": fixed_segments_exact, "learned_aliases": learned_aliases, "enrol": enrol, "enrol_confirmed": enrol_confirmed, "rename_profiles": rename_profiles, "merge_profiles": merge_profiles, "delete_profiles": delete_profiles,
    "roster_rename": roster_rename, "borderline": borderline,
}
SQL = {
    "pattern_candidates": CANDIDATES_SQL, "best_candidates": BEST_SQL, "cascade": CASCADE_SQL, "apply_mappings": APPLY_SQL, "override_mappings": OVERRIDE_SQL, "unresolved_labels": UNRESOLVED_SQL, "pending_labels": PENDING_SQL,
    "review_queue": REVIEW_SQL, "corrections": CORRECTIONS_SQL, "roster_members": MEMBERS_SQL, "roster_hint": HINT_SQL, "roster_lookup": LOOKUP_SQL, "alias_additions": ALIAS_SQL, "name_keys": KEYS_SQL, "voice_match": VOICE_SQL,
    "soft_match": SOFT_SQL, "profile_centroids": CENTROID_SQL, "voice_pairs": PAIRS_SQL, "merged_speakers": MERGED_SQL, "merged_segments": MERGED_SEGMENTS_SQL, "merge_log": LOG_SQL, "merged_centroids": MERGED_CENTROID_SQL, "fixed_segments_exact": FIXED_SQL,
    "enrol": _enrol_sql(f"confidence >= {VOICE}"), "enrol_confirmed": _enrol_sql("id_method = 'manual'"), "rename_profiles": f"WITH {B.PROF}, " + _upsert_sql(_PERSONS),
    "merge_profiles": f"WITH {B.PROF}, " + _upsert_sql("SELECT coalesce(d.slug, p.slug) AS slug, CAST(CASE WHEN d.slug IS NOT NULL THEN p.ord + 1000000000 ELSE p.ord END AS BIGINT) AS ord, p.display_name, coalesce(p.embeddings, []) AS es, coalesce(p.meetings_seen, []) AS ms, coalesce(p.total_segments_confirmed, 0) AS s FROM prof p LEFT JOIN prof d ON d.ord = p.ord + 1 AND d.ord % 2 = 0"),
    "delete_profiles": f"WITH {B.PROF} SELECT slug, display_name, CAST(coalesce(total_segments_confirmed, 0) AS BIGINT) AS segments FROM prof WHERE slug NOT IN (SELECT slug FROM prof WHERE display_name IS NULL OR trim(display_name) = '')", "borderline": BORDERLINE_SQL,
}
