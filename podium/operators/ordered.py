"""Ordered-sequence operators whose groups may be of any size.

A window partitioned by a meeting puts the meeting into one task. Here a sequence is cut into chunks
of its order column; windows run inside (keys, chunk), and what crosses a chunk's border is carried
by a table of one row a chunk, which is small by the chunk width.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WIDTH = 4096


def _chunked(df: DataFrame, order: str, width: int) -> DataFrame:
    return df.withColumn("_chunk", F.floor(F.coalesce(F.col(order), F.lit(-1)) / width))


def _running(df: DataFrame, keys: list[str], order: list[str], value: Column, name: str, fold, both, width: int) -> DataFrame:
    rows = _chunked(df.withColumn("_v", value), order[0], width)
    inner = Window.partitionBy(*keys, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    inside = rows.withColumn("_s", fold("_v").over(inner))
    per = rows.groupBy(*keys, "_chunk").agg(fold("_v").alias("_t"))
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = per.withColumn("_c", fold("_t").over(earlier)).drop("_t")
    return inside.join(carry, [*keys, "_chunk"]).withColumn(name, both(F.col("_s"), F.col("_c"))).drop("_v", "_s", "_c", "_chunk")


def running_sum(df: DataFrame, keys: list[str], order: list[str], value: Column, name: str, width: int = WIDTH) -> DataFrame:
    """Adds the sum of value over the rows of the keys up to and with this one, by order[0], then the rest."""
    return _running(df, keys, order, value, name, F.sum, lambda s, c: s + F.coalesce(c, F.lit(0)), width)


def running_max(df: DataFrame, keys: list[str], order: list[str], value: Column, name: str, width: int = WIDTH) -> DataFrame:
    """Adds the greatest value of the rows of the keys up to and with this one."""
    return _running(df, keys, order, value, name, F.max, F.greatest, width)


def dense_index(df: DataFrame, keys: list[str], order: str, name: str, tie: str, width: int = WIDTH) -> DataFrame:
    """Adds the row's place among its keys, from 0."""
    out = running_sum(df, keys, [order, tie], F.lit(1).cast("bigint"), name, width)
    return out.withColumn(name, F.col(name) - 1)


def with_previous(df: DataFrame, keys: list[str], index: str, columns: list[str], width: int = WIDTH) -> DataFrame:
    """Adds prev_<column> of the row before, by a dense index from 0."""
    rows = _chunked(df, index, width)
    w = Window.partitionBy(*keys, "_chunk").orderBy(index)
    inside = rows.withColumns({f"prev_{c}": F.lag(c).over(w) for c in columns})
    last = rows.where(F.col(index) % width == width - 1).select(*keys, (F.col("_chunk") + 1).alias("_chunk"), *[F.col(c).alias(f"_l_{c}") for c in columns])
    joined = inside.join(last, [*keys, "_chunk"], "left")
    first = F.col(index) % width == 0
    return joined.withColumns({f"prev_{c}": F.when(first, F.col(f"_l_{c}")).otherwise(F.col(f"prev_{c}")) for c in columns}).drop("_chunk", *[f"_l_{c}" for c in columns])


def with_next(df: DataFrame, keys: list[str], index: str, columns: list[str], reach: int, name: str = "following", width: int = WIDTH) -> DataFrame:
    """Adds an array of the next `reach` rows' columns, by a dense index: rows near a chunk's start are copied into the one before."""
    rows = _chunked(df, index, width).withColumn("_own", F.lit(True))
    halo = rows.where(F.col(index) % width < reach).withColumns({"_chunk": F.col("_chunk") - 1, "_own": F.lit(False)})
    w = Window.partitionBy(*keys, "_chunk").orderBy(index).rowsBetween(1, reach)
    out = rows.unionByName(halo).withColumn(name, F.collect_list(F.struct(index, *columns)).over(w))
    return out.where("_own").drop("_own", "_chunk")


def islands(df: DataFrame, keys: list[str], index: str, starts: Column, name: str = "island", width: int = WIDTH) -> DataFrame:
    """Numbers the stretches of rows that begin where `starts` is true (or null)."""
    return running_sum(df, keys, [index], F.coalesce(starts, F.lit(True)).cast("bigint"), name, width)
