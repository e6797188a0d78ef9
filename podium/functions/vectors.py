"""Vector expressions over array<double>, in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; null where a norm is zero, as a comparison with it must fail."""
    return dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0))


def unit(a: Column) -> Column:
    """The vector over its norm; null for a zero vector."""
    return F.transform(a, lambda x: x / F.nullif(norm(a), F.lit(0.0)))


def mean_of(vectors: Column) -> Column:
    """Element-wise mean of an array of equally long vectors; null or empty members do not count."""
    kept = F.filter(vectors, lambda v: v.isNotNull() & (F.size(v) > 0))
    total = F.aggregate(kept, F.lit(None).cast("array<double>"), lambda s, v: F.when(s.isNull(), v).otherwise(F.zip_with(s, v, lambda x, y: x + y)))
    return F.transform(total, lambda x: x / F.size(kept))


def mean_by(df: DataFrame, keys: list[str], vector: str, name: str = "vector") -> DataFrame:
    """The mean vector of each key, summed by place with map-side combine."""
    rows = df.where(F.col(vector).isNotNull()).select(*keys, F.posexplode(vector).alias("_i", "_x"))
    means = rows.groupBy(*keys, "_i").agg(F.avg("_x").alias("_x"))
    ordered = F.array_sort(F.collect_list(F.struct("_i", "_x")))
    return means.groupBy(*keys).agg(F.transform(ordered, lambda s: s["_x"]).alias(name))
