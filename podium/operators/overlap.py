"""Joins of intervals that overlap, within groups of any size.

Both sides are cut into time buckets; rows meet in a bucket by equality, and a pair is kept in the
first bucket that both touch, so it comes once. A plain inequality join would compare all pairs.
A row touches at most REACH + 1 buckets; where there are longer intervals, what they overlap is
found in buckets REACH times as wide, and so on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKET_MS, REACH = 60_000, 120


def _in_buckets(a: DataFrame, b: DataFrame, group: str, bucket: int) -> DataFrame:
    low = lambda c: F.floor(F.col(c) / bucket)
    high = lambda c: F.floor((F.col(c) - 1) / bucket)
    a = a.withColumn("_b", F.explode(F.sequence(low("l_start"), high("l_end"))))
    b = b.withColumn("_b", F.explode(F.sequence(low("r_start"), high("r_end"))))
    both = a.join(b, [group, "_b"]).where("l_start < r_end and r_start < l_end")
    return both.where(F.col("_b") == F.greatest(low("l_start"), low("r_start"))).drop("_b")


def overlapping(left: DataFrame, right: DataFrame, group: str, bucket: int = BUCKET_MS, longest: int | None = None) -> DataFrame:
    """All columns of left rows (l_start, l_end) and right rows (r_start, r_end) of one group that share time.

    longest is a bound of the intervals' lengths; without it they are measured, by a pass over each side.
    """
    a, b = left.where("l_end > l_start"), right.where("r_end > r_start")
    if longest is None:
        longest = max(a.agg(F.max(F.col("l_end") - F.col("l_start"))).first()[0] or 0, b.agg(F.max(F.col("r_end") - F.col("r_start"))).first()[0] or 0)
    if longest <= REACH * bucket:
        return _in_buckets(a, b, group, bucket)
    long_a, long_b = F.col("l_end") - F.col("l_start") > REACH * bucket, F.col("r_end") - F.col("r_start") > REACH * bucket
    near = _in_buckets(a.where(~long_a), b.where(~long_b), group, bucket)
    wide = overlapping(a.where(long_a), b, group, REACH * bucket, longest).unionByName(overlapping(a.where(~long_a), b.where(long_b), group, REACH * bucket, longest))
    return near.unionByName(wide)
