"""Problem 4: names as people type them, traced to the members whom they mean.

Method: a noisy channel. Every distinct spelling of a body is parsed (order of parts, title,
initials, brackets) and explained by candidate canonical forms: the members of the body's roster,
and the body's frequent other spellings, ranked by their counts. A candidate's score is the log of
its prior, its share of the body's records, plus the log likelihood of the channel: typing errors
by edit distance and sound, nicknames, initials, dropped parts, abbreviations and acronyms. The
spelling is attached to the candidate of the greatest posterior; only members give rows.

The work is on distinct spellings with counts, pre-aggregated before the shuffle. Up to SENT members
are sent to the workers, more reach a spelling by a join on the body, so a body of any number of records is spread over tasks; frequent
spellings meet the rare ones through the deletion variants of their surnames, not all pairs.

Where the method is narrowed: members are told apart by the channel, and the prior only decides against
strangers; a spelling that two members explain alike means nobody in particular, however often
either speaks. The channel's costs are stated constants, not estimates.

Defined cases: null, blank and placeholder names, unknown bodies and empty rosters give no row; an
exact alias counts as the member's name; of equal posteriors the lesser member_id wins where one
fits better by title, else there is no row, as the name means nobody in particular; repeats of a
key count once with the least name; extra columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.session import cut_lineage
from podium.sources.tables import table

#: Titles and their abbreviations (fixed values).
TITLES = {
    "mayor": "mayor myr", "councilmember": "councilmember councilmbr cmbr cm councilor councillor councilman councilwoman council member",
    "commissioner": "commissioner comm cmsr commr comr", "trustee": "trustee tr trst", "supervisor": "supervisor supv sup supr", "clerk": "clerk clk",
    "president": "president pres", "vice-president": "vice-president vice vp v-p vpres", "alderman": "alderman ald alderwoman alderperson aldm",
    "chair": "chair chairman chairwoman chairperson chr", "": "mr mrs ms miss dr prof hon honorable sir madam rev sgt judge director deputy",
}
#: Short forms of given names (fixed values).
NICKNAMES = {
    "abigail": "abby abbie gail", "alexandra": "alex sandra sasha lexi", "alexander": "alex sasha sandy", "andrew": "andy drew", "anthony": "tony", "barbara": "barb babs", "benjamin": "ben benny",
    "charles": "charlie chuck", "christina": "chris tina", "christopher": "chris kit topher", "cornelius": "neil con corny neal", "daniel": "dan danny", "daniela": "dani ella", "david": "dave",
    "deborah": "deb debbie", "dorothy": "dot dottie", "edward": "ed eddie ned ted", "elizabeth": "liz beth betty eliza lizzie betsy libby", "frederick": "fred freddie fritz rick", "gregory": "greg",
    "hana": "hannah", "harriet": "hattie harri hat", "ingrid": "inge inga", "james": "jim jimmy", "jennifer": "jen jenny", "john": "jack johnny", "joseph": "joe joey", "josephine": "josie jo fina",
    "katherine": "kate kathy katie kit kay", "lawrence": "larry", "leonard": "len lenny leo", "margaret": "peggy maggie meg greta marge", "marisol": "mari sol", "michael": "mike mick",
    "nicholas": "nick nicky", "oliver": "ollie noll", "patricia": "trish pat patty tricia", "patrick": "pat paddy", "priya": "pri", "quentin": "quint", "rebecca": "becky becca", "richard": "rick dick rich",
    "robert": "bob rob bobby robbie bert", "samuel": "sam", "stephen": "steve", "susannah": "sue susan susie suzy", "theodore": "ted teddy theo", "thomas": "tom", "tobias": "toby tobi",
    "uma": "", "victoria": "vicky vicki tori", "virginia": "ginny", "william": "bill will billy liam willie", "yusuf": "yus", "zachary": "zack zach zac",
}
#: Words of offices and their abbreviations; words that carry nothing (fixed values).
OFFICES = {
    "department": "department dept dpt", "bureau": "bureau bur", "office": "office ofc off", "board": "board bd", "commission": "commission comm comm'n commn", "authority": "authority auth",
    "division": "division div", "committee": "committee cmte", "agency": "agency agcy", "council": "council cncl",
}
SMALL_WORDS = frozenset("of for on the and".split())
PLACEHOLDER = r"^(?:unknown(?: speaker| person)?|n/?a|none|null|nil|tbd|tba|anonymous|unidentified(?: speaker)?|speaker|public|audience|inaudible|\?+|-+|\.+|(?:speaker|spkr|spk|s)[\s_#.-]*[o\d?]+|no name|not given|name)$"

_TITLE = {w: t for t, words in TITLES.items() for w in words.split()}
_OFFICE = {w: t for t, words in OFFICES.items() for w in words.split()}
_GIVEN: dict[str, set[str]] = {}
for _full, _short in NICKNAMES.items():
    for _n in _short.split():
        _GIVEN.setdefault(_n, set()).add(_full)

#: Costs in nats: an edit, a sound-alike, a nickname, an initial, a dropped given name, parts reordered.
EDIT, SOUND, NICK, INITIAL, DROPPED, ORDER = 4.0, 1.5, 1.0, 2.0, 3.0, 1.0
#: What a name that is no member's must pay for being like one by chance, and a title that is another's.
STRANGER, OTHER_TITLE = 7.0, 2.0
#: The least share of a body's records that a member counts for, and that makes a stranger's form frequent.
UNSEEN, FREQUENT = 0.03, 0.0066
#: Members of all rosters up to which they are sent to the workers; beyond, they are joined to the spellings.
SENT = 100_000
#: A mistyped form that has so many times the member's share is a name of its own.
OWN = 3
NEVER = 1e9
#: The least cost at which frequent strangers compete for a spelling with the member that explains it best.
DOUBTFUL = EDIT


def plain(s: str) -> str:
    """Lower case without accents, bracketed asides and doubled spaces."""
    s = re.sub(r"\([^)]*\)", " ", s)
    s = "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c)).lower()
    return " ".join(s.replace("’", "'").split())


@lru_cache(maxsize=200_000)
def edits(a: str, b: str, most: int = 3) -> int:
    """Edit distance with swaps of neighbours, up to `most` (beyond it, most + 1)."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        older, before, row = before, row, [i]
        for j, y in enumerate(b, 1):
            d = min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, older[j - 2] + 1)
            row.append(d)
        if min(row) > most:
            return most + 1
    return row[-1]


@lru_cache(maxsize=100_000)
def sound(s: str) -> str:
    """A key under which sound-alike spellings agree."""
    for a, b in (("cks", "x"), ("kw", "qu"), ("ck", "k"), ("ph", "f"), ("ieth", "ith"), ("ee", "i"), ("oo", "u"), ("uo", "u"), ("ou", "u"), ("ie", "y"), ("iy", "y"), ("ey", "y"), ("oh", "o"), ("ah", "a"), ("th", "t"), ("cz", "z"), ("v", "f"), ("w", "f"), ("q", "k"), ("c", "k"), ("z", "s")):
        s = s.replace(a, b)
    s = s.replace("i", "y")
    return re.sub(r"(.)\1+", r"\1", s)


@lru_cache(maxsize=200_000)
def word_cost(typed: str, meant: str) -> float:
    if typed == meant:
        return 0.0
    if sound(typed) == sound(meant):
        return SOUND
    most = 1 if len(meant) < 5 else 2 if len(meant) < 8 else 3
    d = min(edits(typed, meant), edits(sound(typed), sound(meant)) + 1)
    return EDIT * d if d <= most else NEVER


@lru_cache(maxsize=200_000)
def given_cost(typed: str, meant: str) -> float:
    if typed == meant:
        return 0.0
    if len(typed) == 1:
        return INITIAL if meant.startswith(typed) else NEVER
    if len(meant) == 1:
        return INITIAL if typed.startswith(meant) else NEVER
    best = word_cost(typed, meant)
    for n in NICKNAMES.get(meant, "").split():
        best = min(best, NICK + (word_cost(typed, n) if len(n) > 3 else 0.0 if typed == n else NEVER))
    # A name that is known is itself rather than another one mistyped twice.
    return NEVER if best > NICK + EDIT and (typed in NICKNAMES or typed in _GIVEN) else best


class Parsed:
    """A spelling taken apart: title, words, whether a comma put the surname first; or an office."""

    __slots__ = ("comma", "office", "plain", "title", "words")

    def __init__(self, text: str):
        s = self.plain = plain(text)
        s = re.sub(r"(?<=\b\w)\.(?=\w\b)", " ", s) if re.fullmatch(r"(?:\w\.){2,}\w?\.?", s) is None else s.replace(".", "")
        left, comma, right = s.partition(",")
        self.comma = bool(comma and right.strip())
        tokens = [re.sub(r"[^\w'-]", "", t) for t in (f"{left} , {right}" if self.comma else s).split()]
        raw = [t for t in tokens if t]
        key = {_OFFICE.get(t) for t in raw}
        # An office names its kind, or has a small word; "comm" before a name is a title.
        self.office = bool(SMALL_WORDS & set(raw)) or bool(key - {None, "commission"}) or raw[-1:] in (["commission"], ["comm'n"], ["commn"]) or (len(raw) > 1 and "commission" in raw)
        self.title = ""
        if not self.office:
            while len(raw) > 1 and raw[0] in _TITLE:
                t = _TITLE[raw.pop(0)]
                if t == "vice-president" and raw and _TITLE.get(raw[0]) == "president" and len(raw) > 1:
                    raw.pop(0)
                self.title = self.title or t
            # A title that was mistyped, before at least one more word.
            if len(raw) > 1 and not self.title and len(raw[0]) > 4 and not self.comma:
                near = [t for t in TITLES if t and len(t) > 4 and edits(raw[0], t, 1) <= 1]
                if near and raw[0] not in NICKNAMES:
                    self.title = near[0]
                    raw.pop(0)
            while len(raw) > 1 and raw[-1] in ("jr", "sr", "ii", "iii", "iv", "phd", "esq"):
                raw.pop()
        self.words = tuple(raw)

    def canonical(self) -> str:
        """given|surname of a full name that is written out; else ''."""
        if self.office or len(self.words) < 2:
            return ""
        w = [x for x in self.words if len(x) > 1]
        if len(w) != 2:
            return ""
        surname, given = (w[0], w[1]) if self.comma or (w[1] in NICKNAMES or w[1] in _GIVEN) and w[0] not in NICKNAMES and w[0] not in _GIVEN else (w[1], w[0])
        return f"{given}|{surname}"


@lru_cache(maxsize=500_000)
def parsed(text: str) -> Parsed:
    return Parsed(text)


def _office_words(p: Parsed) -> tuple[list[str], str]:
    words = [w for w in p.words if w not in SMALL_WORDS]
    return [_OFFICE.get(w, w) for w in words], "".join(w[0] for w in p.words if w not in SMALL_WORDS)


def office_cost(typed: Parsed, meant: Parsed) -> float:
    """Words in any order, abbreviated or mistyped; or the initials of the words that count."""
    full, initials = _office_words(meant)
    if len(typed.words) == 1:
        return INITIAL if typed.words[0].replace(".", "") == initials and len(initials) > 1 else NEVER
    got, _ = _office_words(typed)
    if len(got) != len(full):
        return NEVER
    left, cost = list(full), 0.0 if got == full else ORDER / 2
    for w in got:
        best = min(left, key=lambda m: (_office_word(w, m), m))
        cost += _office_word(w, best)
        if cost >= NEVER:
            return NEVER
        left.remove(best)
    return cost


def _office_word(typed: str, meant: str) -> float:
    best = word_cost(typed, meant)
    if meant in OFFICES:
        best = min(best, *[1.0 + word_cost(typed, a) for a in OFFICES[meant].split() if len(a) > 3])
    return best


def person_cost(typed: Parsed, given: str, surname: str) -> float:
    """The channel's cost of typing this for a person of that given name and surname."""
    w = typed.words
    if not w:
        return NEVER
    if len(w) == 1:
        return DROPPED + word_cost(w[0], surname)
    best = NEVER
    straight = [(w[0], w[-1], w[1:-1], 0.0)] if not typed.comma else []
    turned = [(w[1], w[0], w[2:], ORDER if not typed.comma else 0.0)]
    for g, s, middle, cost in straight + turned:
        if len(s) == 1 or any(len(x) > 1 for x in middle):
            continue
        by_surname = word_cost(s, surname)
        if by_surname < NEVER:
            best = min(best, cost + by_surname + given_cost(g, given) + 0.5 * len(middle))
    return best


class Member:
    def __init__(self, ident: int, name: str, aliases: list[str | None] | None):
        self.id, self.name = ident, parsed(name or "")
        self.exact = {plain(a) for a in [name, *(aliases or [])] if a and plain(a)}
        self.office = self.name.office
        self.given, self.surname = ("", "") if self.office or not self.name.words else (self.name.words[0] if len(self.name.words) > 1 else "", self.name.words[-1])

    def cost(self, p: Parsed) -> float:
        if p.plain in self.exact and (self.office or len(p.words) > 1):
            return 0.0
        if self.office:
            return office_cost(p, self.name)
        if p.office or not self.surname:
            return NEVER
        c = person_cost(p, self.given, self.surname)
        if c < NEVER and p.title and self.name.title != p.title:
            c += OTHER_TITLE if self.name.title else OTHER_TITLE / 2
        return c


def _explain(sent):
    """(roster_id, spelling, n[, members]) to the members that may be meant, with costs, and the canonical form.

    sent is a broadcast of the members of all bodies, or None where they come with the rows.
    """
    rosters: dict[int, list[Member]] = {}

    def body(batch: pa.RecordBatch, row: int, r: int) -> list[Member]:
        if r not in rosters:
            found = sent.value.get(r, ()) if sent is not None else [(m["member_id"], m["name"], m["aliases"]) for m in batch.column(3)[row].as_py() or [] if m]
            rosters[r] = [Member(i, name, aliases) for i, name, aliases in found if name and i is not None]
        return rosters[r]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _explained(batch, body)

    return run


def _explained(batch: pa.RecordBatch, body) -> Iterator[pa.RecordBatch]:
    if batch.num_rows:  # an empty batch has nothing to say
        ids, spellings, counts = (batch.column(i).to_pylist() for i in range(3))
        out = []
        for row, (r, s, n) in enumerate(zip(ids, spellings, counts, strict=True)):
            p = parsed(s)
            near = sorted((c, m.id) for m in body(batch, row, r) if (c := m.cost(p)) < NEVER)[:2]
            best, second = [*near, (NEVER, 0), (NEVER, 0)][:2]
            canonical = p.canonical()
            surname = canonical.partition("|")[2] or (p.words[-1] if p.words and not p.office else "")
            out.append((r, s, n, best[1] if best[0] < NEVER else None, best[0], second[0] if second[0] < NEVER else NEVER, canonical, surname))
        names = ["roster_id", "spelling", "n", "member_id", "cost", "next_cost", "canonical", "surname"]
        kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True) if out else [[]] * 8, kinds, strict=True)], names=names)


_EXPLAINED = "roster_id int, spelling string, n bigint, member_id bigint, cost double, next_cost double, canonical string, surname string"


def _strangers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(roster_id, spelling, canonical of a frequent stranger) to the cost of meaning that stranger."""
    for batch in batches:
        ids, spellings, forms = (batch.column(i).to_pylist() for i in range(3))
        costs = []
        for s, c in zip(spellings, forms, strict=True):
            given, _, surname = c.partition("|")
            costs.append(person_cost(parsed(s), given, surname))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(spellings), pa.array(forms), pa.array(costs, pa.float64())], names=["roster_id", "spelling", "form", "stranger_cost"])


def deletions(word: Column) -> Column:
    """The word and all its variants with one letter left out: words one edit apart share one.

    A word of more than 64 letters, which is no surname, is its own only key.
    """
    places = F.when(F.char_length(word) <= 64, F.sequence(F.lit(1), F.greatest(F.lit(1), F.char_length(word)))).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.concat(F.array(word), F.transform(places, lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, F.lit(64))))))


def _tasks(spark: SparkSession) -> int:
    """As many as a shuffle has, but no more than two for each core: the rows are few and dear."""
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)


def attribute(records: DataFrame, roster: DataFrame) -> DataFrame:
    """(source, record_id, member_id) for records (source, record_id, roster_id, name) of a body."""
    spelling = F.trim(F.regexp_replace(F.lower("name"), r"(?U)\s+", " "))
    named = records.where("roster_id is not null and record_id is not null and name is not null").select("source", "record_id", "roster_id", spelling.alias("spelling"))
    named = named.where((F.col("spelling") != "") & ~F.col("spelling").rlike(PLACEHOLDER) & F.col("spelling").rlike(r"\p{L}"))
    counts = named.groupBy("roster_id", "spelling").agg(F.count(F.lit(1)).alias("n"))
    bodies = roster.where("roster_id is not null").groupBy("roster_id").agg(F.max_by("members", F.size("members")).alias("members"))
    # The parsing is the dear part and its result is read several times: spread it, and keep it.
    spark = records.sparkSession
    spread = counts.repartition(_tasks(spark), "spelling")
    size = bodies.agg(F.sum(F.size("members"))).first()[0] or 0
    if size <= SENT:  # the members' number is known, so they may be sent out
        sent = spark.sparkContext.broadcast({r.roster_id: [(m.member_id, m.name, m.aliases) for m in r.members if m] for r in bodies.where("members is not null").collect()})
        spread = spread.where("roster_id is not null")
    else:
        sent, spread = None, spread.join(bodies, "roster_id").select("roster_id", "spelling", "n", "members")
    explained = cut_lineage(spread.mapInArrow(_explain(sent), _EXPLAINED))
    # Priors: the share of a body's records that are surely a member's, or a canonical form's.
    total = explained.groupBy("roster_id").agg(F.sum("n").alias("total"))
    sure = explained.where(F.col("cost") <= SOUND).groupBy("roster_id", "member_id").agg(F.sum("n").alias("sure"))
    forms = explained.where("canonical <> ''").groupBy("roster_id", "canonical").agg(F.sum("n").alias("form_n"), F.min("cost").alias("form_cost"))
    scored = explained.join(total, "roster_id").join(sure, ["roster_id", "member_id"], "left").join(forms, ["roster_id", "canonical"], "left")
    # All scores are of shares of the body, so that a table of ten times the records judges alike.
    share = F.greatest(F.coalesce("sure", F.lit(0)) / F.col("total"), F.lit(UNSEEN))
    scored = scored.withColumn("member_score", F.log(share) - F.col("cost"))
    # A form of its own, frequent or not, is a stranger's if that explains it better than errors in a member's.
    form = F.coalesce("form_n", F.lit(1)) / F.col("total")
    fresh = F.when((F.col("canonical") != "") & (F.col("form_cost") >= EDIT) & (form > OWN * share), F.lit(0.0))
    fresh = fresh.when(F.col("canonical") != "", F.log(form) - STRANGER).otherwise(F.lit(-NEVER))
    first = scored.withColumn("fresh_score", fresh)
    frequent = first.where((F.col("canonical") != "") & (F.col("form_n") >= FREQUENT * F.col("total"))).groupBy("roster_id", "canonical").agg(F.max("form_n").alias("form_n"), F.max("total").alias("total"), F.min("form_cost").alias("form_cost"), F.max("member_score").alias("m"), F.max("fresh_score").alias("f"))
    strangers = frequent.where((F.col("m").isNull()) | (F.col("f") > F.col("m")) | (F.col("form_cost") >= NEVER / 2))
    strangers = strangers.select("roster_id", F.col("canonical").alias("form"), F.log(F.col("form_n") / F.col("total")).alias("form_prior"), F.explode(deletions(F.split_part("canonical", F.lit("|"), F.lit(2)))).alias("key"))
    doubtful = first.where(F.col("member_id").isNotNull() & (F.col("cost") >= DOUBTFUL)).select("roster_id", "spelling", F.explode(deletions(F.col("surname"))).alias("key"))
    met = doubtful.join(strangers, ["roster_id", "key"]).select("roster_id", "spelling", "form").distinct().mapInArrow(_strangers, "roster_id int, spelling string, form string, stranger_cost double")
    priors = strangers.select("roster_id", "form", "form_prior").distinct()
    best = met.join(priors, ["roster_id", "form"]).groupBy("roster_id", "spelling").agg(F.max(F.col("form_prior") - F.col("stranger_cost")).alias("stranger_score"))
    judged = first.join(best, ["roster_id", "spelling"], "left").where("member_id is not null")
    good = (F.col("member_score") >= F.greatest(F.col("fresh_score"), F.coalesce("stranger_score", F.lit(-NEVER)))) & (F.col("next_cost") - F.col("cost") > 0.4)
    meant = judged.where(good).select("roster_id", "spelling", "member_id")
    return named.join(meant, ["roster_id", "spelling"]).select("source", "record_id", "member_id")


def _bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of both tables with their bodies; where a mapping names none, its meeting's."""
    m = table(spark, sf_dir, "mappings").where("mapping_id is not null").groupBy("mapping_id").agg(F.min("meeting_id").alias("meeting_id"), F.min("roster_id").alias("roster_id"), F.min("speaker_name").alias("name"))
    key = lambda c: F.lower(F.trim(F.col(c)))
    meetings = table(spark, sf_dir, "meetings").groupBy("meeting_id").agg(F.min(key("city")).alias("city"), F.min(key("body")).alias("body"))
    rosters = table(spark, sf_dir, "roster").select(F.col("roster_id").alias("of_meeting"), key("city").alias("city"), key("body").alias("body")).groupBy("city", "body").agg(F.min("of_meeting").alias("of_meeting"))
    named, open_ = m.where("roster_id is not null"), m.where("roster_id is null and name is not null")
    looked = open_.join(meetings, "meeting_id").join(rosters, ["city", "body"]).select("mapping_id", F.col("of_meeting").alias("roster_id"), "name")
    mapped = named.select("mapping_id", "roster_id", "name").unionByName(looked).select(F.lit("mapping").alias("source"), F.col("mapping_id").alias("record_id"), "roster_id", "name")
    p = table(spark, sf_dir, "profiles").where("ord is not null").groupBy("ord").agg(F.min("roster_id").alias("roster_id"), F.min("display_name").alias("name"))
    return mapped.unionByName(p.select(F.lit("profile").alias("source"), F.col("ord").cast("bigint").alias("record_id"), "roster_id", "name"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attribute(_bodies(spark, sf_dir), table(spark, sf_dir, "roster"))
