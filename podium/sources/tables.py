"""Readers of the Parquet tables, with the keys under which re-delivered rows count once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = {
    "meetings": ["meeting_id"],
    "segments": ["meeting_id", "segment_id"],
    "cues": ["meeting_id", "pos"],
    "mappings": ["mapping_id"],
    "sections": ["meeting_id", "pos"],
    "profiles": ["ord"],
    "documents": ["doc_id"],
    "roster": ["roster_id"],
    "eval_items": ["item_id"],
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def once(df: DataFrame, keys: list[str], **columns: Column) -> DataFrame:
    """One row for each key, with the least non-null value of each named column.

    Repeats of a key normally agree, so any choice gives the same row; where they do not,
    the least value of every column is the defined result. Fixed-width columns keep this a
    hash aggregate with map-side combine. Rows without a full key are left out.
    """
    present = [F.col(k).isNotNull() for k in keys]
    kept = df
    for p in present:
        kept = kept.where(p)
    kept = kept.select(*keys, *[c.alias(n) for n, c in columns.items()])
    return kept.groupBy(*keys).agg(*[F.min(n).alias(n) for n in columns])


#: From 2^53 milliseconds on (285,000 years) a double no longer holds whole milliseconds.
_INEXACT = 2.0**53 / 1000


def millis(seconds: Column | str) -> Column:
    """Seconds to whole milliseconds; null for NaN, infinities and what a double cannot hold to the millisecond."""
    s = F.col(seconds) if isinstance(seconds, str) else seconds
    return F.when(F.abs(s) < _INEXACT, F.round(s * 1000).cast("bigint"))


def longest(df: DataFrame, *times: tuple[str, str]) -> int:
    """The most milliseconds from a start to its end, by one pass over the two columns, without a shuffle."""
    spans = [F.max(millis(t) - millis(s)).alias(f"m{i}") for i, (s, t) in enumerate(times)]
    return max((x for x in df.agg(*spans).first() if x is not None), default=0)
