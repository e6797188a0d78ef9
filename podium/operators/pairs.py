"""Pairs of vectors above a cosine within groups of any size, block against block.

A group is cut into blocks by a hash; each pair of blocks is one task's work, a matrix product of
bounded size, and only pairs above the threshold leave it. Exact; zero vectors and vectors of
another length than the group's first take no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 1024


def similar_pairs(df: DataFrame, group: str, key: str, vector: str, least: float, block: int = BLOCK) -> DataFrame:
    """(g, a, b) with a < b: pairs of one group whose cosine is at least `least`; keys of any kind that can be ordered."""
    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(group).cast("string").alias("g"), F.col(key).alias("id"), F.col(vector).alias("v")).where("g is not null and id is not null and v is not null")
    rows = rows.where(F.exists("v", lambda x: x != 0))
    sizes = rows.groupBy("g").agg(F.ceil(F.count(F.lit(1)) / block).alias("n"))
    placed = rows.join(sizes, "g").withColumn("own", F.pmod(F.xxhash64("id"), F.col("n")))
    cells = placed.withColumn("with", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)))
    cells = cells.select("g", "id", "v", "own", F.least("own", "with").alias("row"), F.greatest("own", "with").alias("col"))

    def compare(t: pa.Table) -> pa.Table:
        vs = t.column("v").to_pylist()
        ids, own = np.array(t.column("id").to_pylist(), object), np.array(t.column("own"))
        ok = np.array([len(v) == len(vs[0]) and None not in v for v in vs])
        x = np.array([v for v, k in zip(vs, ok, strict=True) if k], float).reshape(ok.sum(), -1)
        ids, own = ids[ok], own[ok]
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        row, col = t.column("row")[0].as_py(), t.column("col")[0].as_py()
        left, right = np.flatnonzero(own == row), np.flatnonzero(own == col)
        i, j = np.nonzero(x[left] @ x[right].T >= least)
        a, b = ids[left[i]], ids[right[j]]
        keep = a < b if row == col else np.ones(len(a), bool)
        a, b = np.minimum(a, b)[keep], np.maximum(a, b)[keep]
        typed = t.column("id").type
        return pa.table({"g": pa.array([t.column("g")[0].as_py()] * len(a), pa.string()), "a": pa.array(a.tolist(), typed), "b": pa.array(b.tolist(), typed)})

    return cells.groupBy("g", "row", "col").applyInArrow(compare, f"g string, a {kind}, b {kind}")


def query_scores(queries: DataFrame, base: DataFrame, least: float, best_only: bool = False, block: int = BLOCK, width: int = 16 * BLOCK) -> DataFrame:
    """(label, ord, score): the cosines of a stated query set (label, v) against all rows (ord, v), in blocks.

    Only scores of at least `least` leave a cell; with best_only only each query's best of the cell,
    the least ord of equals. Vectors of one length; zero vectors must have been left out.
    """
    spark = queries.sparkSession
    nq, nb = queries.count(), base.count()
    if not nq or not nb:
        return spark.createDataFrame([], "label string, ord bigint, score double")
    rows, cols = -(-nq // block), -(-nb // width)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    q = queries.select("label", F.lit(None).cast("bigint").alias("ord"), "v", F.pmod(F.xxhash64("label"), F.lit(rows)).cast("int").alias("row")).withColumn("col", every(cols))
    b = base.select(F.lit(None).cast("string").alias("label"), F.col("ord").cast("bigint").alias("ord"), "v", F.pmod(F.xxhash64("ord"), F.lit(cols)).cast("int").alias("col")).withColumn("row", every(rows))
    schema = pa.schema([("label", pa.string()), ("ord", pa.int64()), ("score", pa.float64())])

    def compare(t: pa.Table) -> pa.Table:
        t = t.sort_by("ord")
        x = np.asarray(t.column("v").combine_chunks().flatten()).reshape(t.num_rows, -1)
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        labels = t.column("label").to_pylist()
        left = np.array([i for i, k in enumerate(labels) if k is not None], int)
        right = np.array([i for i, k in enumerate(labels) if k is None], int)
        if not len(left) or not len(right):
            return schema.empty_table()
        s = x[left] @ x[right].T
        i, j = (np.arange(len(left)), s.argmax(1)) if best_only else np.nonzero(s >= least)
        good = s[i, j] >= least
        i, j = i[good], j[good]
        ords = t.column("ord").to_pylist()
        return pa.table({"label": pa.array([labels[left[k]] for k in i], pa.string()), "ord": pa.array([ords[right[k]] for k in j], pa.int64()), "score": pa.array(s[i, j], pa.float64())})

    return q.unionByName(b).groupBy("row", "col").applyInArrow(compare, "label string, ord bigint, score double")
