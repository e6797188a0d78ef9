"""Problem 7: items over a size limit, cut into pieces at natural boundaries, with overlap.

Method: bounded-quantifier regex extraction. One pattern, whose alternatives stand in order of
boundary strength (blank line, line break, sentence end, clause end, white space, any character),
consumes as much as the limit allows at each step; the pieces' offsets are running sums over the
extracted array, and each piece is lengthened to the left by a look-back into its predecessor of
at most the overlap, moved to the next word start. All of it is SQL array functions in the JVM.

Sizes are Unicode code points. A piece is at most `limit` long with its overlap; without the
overlaps the pieces are the text, character by character. Defined cases: null and empty texts and
texts within the limit give no pieces from split_long (they need none); white space counts as
text; a text without any boundary is cut between characters; repeated rows of a key count once;
other columns are kept aside, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from podium.sources.tables import table

LIMIT = 1000
OVERLAP = 100


def pattern(limit: int = LIMIT, overlap: int = OVERLAP) -> str:
    """Stronger boundaries must leave a piece at least a third full; weaker ones half of it."""
    most = limit - overlap
    third, half = max(1, most // 3), max(1, most // 2)
    def up_to(least: int, boundary: str, width: int) -> str:
        return rf".{{{least},{max(least, most - width)}}}{boundary}"

    return "(?s)" + "|".join([
        up_to(third, r"\n[ \t\r]{0,2}\n", 4),
        up_to(third, r"\n", 1),
        up_to(third, r"(?:[.!?…।؟][\"'”’»)\]]{0,2}\s|[。！？][」』”’）]{0,2})", 4),
        up_to(half, r"[,;:，；：、،—–]\s?", 2),
        up_to(half, r"\s", 1),
        rf".{{1,{most}}}",
    ])


def shared_tail(before: Column, overlap: int) -> Column:
    """The end of the piece before, at most the overlap long, from its first word start if it has one."""
    tail = F.substring(before, F.greatest(F.lit(1), F.char_length(before) - overlap + 1), F.lit(overlap))
    whole = F.char_length(before) <= overlap
    return F.when(~whole & tail.rlike(r"(?s)\s\S"), F.regexp_replace(tail, r"(?s)^\S*\s+(?=\S)", "")).otherwise(tail)


def split_long(df: DataFrame, keys: list[str], text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """(keys, piece_no, start, core, piece) of every item longer than the limit, repeats of a key once.

    core is the offset at which the piece's own text begins, start that of its overlap.
    """
    long = df.select(*keys, F.col(text).alias("_text")).where(F.char_length("_text") > limit)
    once = long.groupBy(*keys).agg(F.min("_text").alias("_text"))
    cores = once.select(*keys, F.regexp_extract_all("_text", F.lit(pattern(limit, overlap)), F.lit(0)).alias("_cores"))
    pairs = F.transform("_cores", lambda c, i: F.struct(c.alias("own"), F.coalesce(F.get("_cores", i - 1), F.lit("")).alias("before")))
    rows = cores.select(*keys, F.posexplode(pairs).alias("piece_no", "_p")).select(*keys, "piece_no", "_p.own", shared_tail(F.col("_p.before"), overlap).alias("_shared"))
    # The running sum of one item's pieces; the rows already lie together by key.
    w = Window.partitionBy(*keys).orderBy("piece_no").rowsBetween(Window.unboundedPreceding, -1)
    core = F.coalesce(F.sum(F.char_length("own")).over(w), F.lit(0)).cast("int")
    return rows.withColumn("core", core).select(*keys, "piece_no", (F.col("core") - F.char_length("_shared")).alias("start"), "core", F.concat("_shared", "own").alias("piece"))


def p7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = split_long(table(spark, sf_dir, "segments"), ["meeting_id", "segment_id"], "text")
    sections = split_long(table(spark, sf_dir, "sections"), ["meeting_id", "pos"], "content")
    a = segments.withColumnRenamed("segment_id", "item_no").withColumn("source", F.lit("segment"))
    b = sections.withColumnRenamed("pos", "item_no").withColumn("source", F.lit("section"))
    return a.unionByName(b).select("source", "meeting_id", "item_no", "piece_no", "start", "core", "piece")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items that the operator cut: each has a second piece."""
    return p7_pieces(spark, sf_dir).where("piece_no = 1").select("source", "meeting_id", "item_no")


P7_SQL = """
SELECT DISTINCT 'segment' AS source, meeting_id, segment_id AS item_no FROM segments WHERE length(text) > 1000
UNION ALL
SELECT DISTINCT 'section', meeting_id, pos FROM sections WHERE length(content) > 1000
"""


def _pieces_sql() -> str:
    quoted = pattern().replace("'", "''")
    return f"""
WITH t AS (SELECT 'segment' AS source, meeting_id, segment_id AS item_no, min(text) AS text FROM segments WHERE length(text) > {LIMIT} GROUP BY ALL
  UNION ALL SELECT 'section', meeting_id, pos, min(content) FROM sections WHERE length(content) > {LIMIT} GROUP BY ALL),
c AS (SELECT source, meeting_id, item_no, regexp_extract_all(text, '{quoted}', 0) AS cores FROM t),
x AS (SELECT source, meeting_id, item_no, CAST(unnest(range(len(cores))) AS INTEGER) AS piece_no, unnest(cores) AS own, unnest(list_prepend('', cores[1:len(cores) - 1])) AS before FROM c),
s AS (SELECT *, substr(before, greatest(1, length(before) - {OVERLAP - 1}), {OVERLAP}) AS tail, CAST(coalesce(sum(length(own)) OVER (PARTITION BY source, meeting_id, item_no ORDER BY piece_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS core FROM x),
v AS (SELECT *, CASE WHEN length(before) > {OVERLAP} AND regexp_matches(tail, '(?s)\\s\\S') THEN regexp_replace(tail, '(?s)^\\S*\\s+', '') ELSE tail END AS shared FROM s)
SELECT source, meeting_id, item_no, piece_no, core - CAST(length(shared) AS INTEGER) AS start, core, shared || own AS piece FROM v
"""


P7_PIECES_SQL = _pieces_sql()
