"""Problem 5: the k most similar vectors of every vector, by a permutation index.

Method: a bounded sample of the vectors are pivots, one for every DENSITY vectors. A vector is
represented by its LENGTH nearest pivots in order and posted in the inverted files of the FILES
nearest ones. In a file the candidates of a vector are ranked by the footrule distance of their
orders, the best `ranked` are reranked by cosine, and the best k leave the file. As pivots grow with the
vectors, a file holds a fixed number of them on average, so the pairs a vector meets stay flat. Among many pivots
the nearest are searched in the groups of the nearest leaders. A long file is cut into blocks
that are compared block by block, on as many tasks.

The footrule cannot order many vectors that are alike but not equal, and files may part them: a
vector that meets more than `ranked` others of a cosine of ALIKE or more is compared with every vector by
exact cosine, block by block.

Exact copies are one class: only its representative is posted. The members' own neighbours within
a class are its least ids, so a class of any size costs a fixed number of rows a member.

Bounds: at most MAX_PIVOTS pivots, sent out in single precision (16 MB at most); the pivots are the
documented sample, every row is indexed. A vector travels to its files in single precision, and cosines are
of that precision, rounded to seven places; a block of the exact way holds EXACT vectors of either side.

Defined cases: a vector that is null, empty, not of the dimension asked for, or holds a null or NaN
takes no part, nor do zero vectors; equal cosines go to the lesser id; repeated rows of an id count
once (the vector of the least hash); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from podium.functions.vectors import mean_of
from podium.operators.stream import map_groups, numbers
from podium.session import cut_lineage
from podium.sources.tables import table

MAX_PIVOTS, DENSITY = 65536, 4
FILES, LENGTH = 12, 24
#: Candidates that are reranked for each vector in a file, at least; and the cosine from which on others are alike.
RANKED, ALIKE = 64, 0.6
#: Pivots from which on they are searched through leaders, and the leaders whose groups are searched.
GROUPED, SEARCHED = 4096, 32
BLOCK = 2048
EXACT = 16384
_PAIR_BUDGET = 2_000_000


def voice(centroid: str = "centroid", embeddings: str = "embeddings") -> Column:
    """The centroid, or where it is null the mean of the embeddings."""
    return F.coalesce(F.col(centroid), mean_of(F.col(embeddings)))


def _unit(column: pa.Array, rows: int) -> np.ndarray:
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _valid(df: DataFrame, key: str, vector: Column, dim: int) -> DataFrame:
    """(id, v, h1, h2): the vectors that take part, with two hashes that stand for the vector."""
    ok = (F.size("v") == dim) & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = df.select(F.col(key).cast("bigint").alias("id"), vector.alias("v")).where("id is not null and v is not null").where(ok)
    return rows.select("id", "v", F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(17), "v").alias("h2"))


def _classes(rows: DataFrame, most: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Classes of equal vectors (rep, h1, h2); ids with their rep; and (rep, heads), its `most` least ids."""
    ids = cut_lineage(rows.groupBy("id").agg(F.min("h1").alias("h1"), F.min_by("h2", "h1").alias("h2")))
    classes = ids.groupBy("h1", "h2").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n"))
    single = classes.where("n = 1").select(F.col("rep").alias("id"), "rep")
    # Classes of several: salted, so that one with a third of all rows is spread over tasks.
    salts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(63).cast("bigint"))).alias("salt")
    several = classes.where("n > 1").select("h1", "h2", "rep", salts)
    part = ids.withColumn("salt", F.pmod("id", F.lit(64))).join(several, ["h1", "h2", "salt"]).select("id", "rep", "salt")
    firsts = part.withColumn("r", F.row_number().over(Window.partitionBy("rep", "salt").orderBy("id"))).where(F.col("r") <= most)
    firsts = firsts.withColumn("rn", F.row_number().over(Window.partitionBy("rep").orderBy("id"))).where(F.col("rn") <= most)
    heads = firsts.groupBy("rep").agg(F.array_sort(F.collect_list("id")).alias("heads"))
    members = single.unionByName(part.select("id", "rep"))
    return classes.select("rep", "h1", "h2"), members, single.select("rep", F.array("rep").alias("heads")).unionByName(heads)


class _Pivots:
    """The nearest pivots in order; among many, those of the groups of the nearest leaders."""

    def __init__(self, x: np.ndarray):
        self.x, self.groups = x.astype(np.float32), []
        if len(x) > GROUPED:
            self.leaders = self.x[: math.isqrt(len(x))]
            home = np.concatenate([(self.x[i : i + 4096] @ self.leaders.T).argmax(1) for i in range(0, len(x), 4096)])
            self.groups = [np.flatnonzero(home == g) for g in range(len(self.leaders))]

    def nearest(self, x: np.ndarray, m: int) -> np.ndarray:
        if not self.groups:
            return self._first(x @ self.x.T, None, m)
        led = x @ self.leaders.T
        searched = min(SEARCHED, len(self.leaders))
        some = np.argpartition(-led, searched - 1, axis=1)[:, :searched]
        near, names = np.full((len(x), searched, m), -2, np.float32), np.zeros((len(x), searched, m), np.int64)
        owner, group = np.repeat(np.arange(len(x)), searched), some.ravel()
        order = np.argsort(group, kind="stable")
        cuts = np.searchsorted(group[order], np.arange(len(self.groups) + 1))
        for g, members in enumerate(self.groups):
            at = order[cuts[g] : cuts[g + 1]]
            if len(at) and len(members):
                sims = x[owner[at]] @ self.x[members].T
                best = np.argpartition(-sims, min(m, len(members)) - 1, axis=1)[:, :m]
                near[owner[at], at % searched, : best.shape[1]] = np.take_along_axis(sims, best, 1)
                names[owner[at], at % searched, : best.shape[1]] = members[best]
        return self._first(near.reshape(len(x), -1), names.reshape(len(x), -1), m)

    @staticmethod
    def _first(sims: np.ndarray, names: np.ndarray | None, m: int) -> np.ndarray:
        some = np.argpartition(-sims, m - 1, axis=1)[:, :m] if sims.shape[1] > m else np.tile(np.arange(sims.shape[1]), (len(sims), 1))
        some = np.take_along_axis(some, np.argsort(-np.take_along_axis(sims, some, 1), axis=1, kind="stable"), 1)
        return some if names is None else np.take_along_axis(names, some, 1)


def _code(pivots, files: int, m: int):
    """Maps batches of (rep, v) to (rep, files, body): the nearest pivots, and the order of pivots with the vector as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                part = batch.slice(lo, 2048)
                x = _unit(part.column(1), part.num_rows).astype(np.float32)
                near = pivots.value.nearest(x, m)
                body = np.concatenate([near.astype(np.uint16).view(np.uint8).reshape(len(x), -1), x.view(np.uint8).reshape(len(x), -1)], axis=1)
                ends = pa.py_buffer(np.arange(0, body.size + 1, body.shape[1], dtype=np.int32))
                coded = pa.Array.from_buffers(pa.binary(), len(body), [None, ends, pa.py_buffer(body.tobytes())])
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(x) * files + 1, files), pa.int32()), pa.array(near[:, :files].astype(np.int32).ravel()))
                yield pa.RecordBatch.from_arrays([part.column(0), lists, coded], names=["rep", "files", "body"])

    return run


_FOUND = pa.schema([("q", pa.int64()), ("c", pa.int64()), ("near", pa.float64()), ("alike", pa.int64())])


def footrule(perm: np.ndarray) -> np.ndarray:
    """For orders of m pivots each, m(m+1) less their footrule distances, halved: the sum over pivots in both of the lesser weight m - place."""
    m = perm.shape[1]
    _, local = np.unique(perm, return_inverse=True)
    local = local.reshape(perm.shape)
    weight = np.zeros((local.max() + 1, len(perm)), np.int8)
    weight[local, np.arange(len(perm))[:, None]] = np.arange(m, 0, -1, dtype=np.int8)
    score = np.zeros((len(perm), len(perm)), np.int16)
    for i in range(m):
        score += np.minimum(weight[local[:, i]], np.int8(m - i))
    return score


def _meet(files: int, m: int, k: int, ranked: int, floor: float):
    """In each inverted file, for every vector the best k by cosine of the best `ranked` by footrule (c, near), and how many alike it meets.

    A pair that meets in several files is counted as alike in that of its least shared pivot.
    """

    def fn(t: pa.Table, begins: np.ndarray) -> pa.Table:
        rep, block, file, row, col = (numbers(t, n) for n in ("rep", "block", "file", "row", "col"))
        data = np.frombuffer(b"".join(t.column("body").to_pylist()), np.uint8).reshape(len(rep), -1)
        perm, x = np.ascontiguousarray(data[:, : 2 * m]).view(np.uint16).astype(np.int64), np.ascontiguousarray(data[:, 2 * m :]).view(np.float32)
        starts = np.append(np.flatnonzero(begins), len(rep))
        out, met = [], []
        for lo, hi in zip(starts[:-1], starts[1:], strict=True):
            n = hi - lo
            if n < 2:
                continue
            score, near = footrule(perm[lo:hi]), x[lo:hi] @ x[lo:hi].T
            own = np.eye(n, dtype=bool) if row[lo] == col[lo] else block[lo:hi, None] == block[None, lo:hi]  # two blocks meet across only
            score[own] = -1
            near[own] = -2
            least = np.partition(score, max(0, n - ranked), axis=1)[:, max(0, n - ranked)]
            a, b = np.nonzero((score >= np.maximum(least, 0)[:, None]) & (near >= floor - 1e-6))
            s = np.round(near[a, b].astype(np.float64), 7)
            order = np.lexsort((rep[lo + b], -s, a))
            a, b, s = a[order], b[order], s[order]
            keep = (np.arange(len(a)) - np.searchsorted(a, a) < k) & (s >= floor)
            out.append((lo + a[keep], lo + b[keep], s[keep]))
            a, b = np.nonzero(near >= ALIKE)
            mine, other = perm[lo + a, :files], perm[lo + b, :files]
            shared = np.where((mine[:, :, None] == other[:, None, :]).any(2), mine, np.iinfo(np.int64).max).min(1) == file[lo]
            met.append(lo + a[shared])
        if not out:
            return _FOUND.empty_table()
        a, b, s = (np.concatenate(v) for v in zip(*out, strict=True))
        alike = np.bincount(np.concatenate(met), minlength=len(rep))
        some = np.flatnonzero(alike)
        pairs = pa.table({"q": rep[a], "c": rep[b], "near": s, "alike": np.zeros(len(a), np.int64)})
        counts = pa.table({"q": rep[some], "c": pa.nulls(len(some), pa.int64()), "near": pa.nulls(len(some), pa.float64()), "alike": alike[some]})
        return pa.concat_tables([pairs.cast(_FOUND), counts.cast(_FOUND)])

    return fn


def _nearest(k: int, floor: float):
    """The k nearest of a block of vectors (role 1) to each of a block of queries (role 0), by exact cosine."""

    def fn(t: pa.Table, begins: np.ndarray) -> pa.Table:
        rep, role = numbers(t, "rep"), numbers(t, "role")
        x = _unit(t.column("v").combine_chunks(), len(rep))
        starts = np.flatnonzero(begins)
        out = []
        for lo, hi in zip(starts, np.append(starts[1:], len(rep)), strict=True):
            mid = lo + int((role[lo:hi] == 0).sum())
            if not lo < mid < hi:
                continue
            ids, step = rep[mid:hi], max(1, _PAIR_BUDGET // (hi - mid))
            for at in range(lo, mid, step):
                own = rep[at : min(at + step, mid)]
                s = np.round(x[at : at + len(own)] @ x[mid:hi].T, 7)
                s[own[:, None] == ids] = -2.0
                least = np.partition(s, len(ids) - min(k, len(ids)), axis=1)[:, len(ids) - min(k, len(ids))]
                a, b = np.nonzero((s >= least[:, None]) & (s >= max(floor, -1.5)))
                order = np.lexsort((b, -s[a, b], a))  # the ids of a block are in order
                a, b = a[order], b[order]
                keep = np.arange(len(a)) - np.searchsorted(a, a) < k
                a, b = a[keep], b[keep]
                out.append((own[a], ids[b], s[a, b]))
        q, c, s = (np.concatenate(v) for v in zip(*out, strict=True)) if out else ([], [], [])
        return pa.table({"q": pa.array(q, pa.int64()), "c": pa.array(c, pa.int64()), "near": pa.array(s, pa.float64())})

    return fn


def _exact(reps: DataFrame, n: int, some: DataFrame, n_some: int, k: int, floor: float) -> DataFrame:
    """(q, c, near): the k nearest of all reps to every q of some, each block of the one against each of the other."""
    rows, cols = math.ceil(n_some / EXACT), math.ceil(n / EXACT)
    block = lambda blocks: F.pmod(F.xxhash64("rep"), F.lit(blocks))
    each = lambda blocks: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint")))
    asked = reps.join(some.select(F.col("q").alias("rep")), "rep").select("rep", "v", F.lit(0).alias("role"), block(rows).alias("row"), each(cols).alias("col"))
    given = reps.select("rep", "v", F.lit(1).alias("role"), block(cols).alias("col"), each(rows).alias("row"))
    return map_groups(asked.unionByName(given), ["row", "col"], ["role", "rep"], _nearest(k, floor), "q bigint, c bigint, near double")


def most_similar(df: DataFrame, key: str, vector: Column, k: int = 5, dim: int = 64, floor: float = -1.0) -> DataFrame:
    """(id, other, cosine): the k most similar others of every id, those with a cosine >= floor."""
    spark, ranked = df.sparkSession, max(RANKED, 4 * k)
    rows = _valid(df, key, vector, dim)
    classes, members, heads = _classes(rows, k + 1)
    reps = rows.withColumnRenamed("id", "rep").join(classes, ["rep", "h1", "h2"]).groupBy("rep").agg(F.first("v").alias("v"))
    n = classes.count()
    if n == 0:
        return spark.createDataFrame([], "id bigint, other bigint, cosine double")
    wanted = min(n, MAX_PIVOTS, max(64, n // DENSITY))
    # The sample: those whose hash is low, with room for chance; equal at every partitioning.
    low = F.pmod(F.xxhash64(F.lit(5), "rep"), F.lit(1 << 30)) < math.ceil((wanted + 4 * math.sqrt(wanted) + 4) / n * (1 << 30))
    sample = rows.select(F.col("id").alias("rep"), "h1", "h2", "v").where(low).join(classes, ["rep", "h1", "h2"]).groupBy("rep").agg(F.first("v").alias("v"))
    chosen = sorted(sample.select("rep", F.xxhash64(F.lit(5), "rep").alias("h"), "v").collect(), key=lambda r: (r.h, r.rep))[:wanted]
    x = np.array([r.v for r in chosen])
    pivots = spark.sparkContext.broadcast(_Pivots(x / np.linalg.norm(x, axis=1, keepdims=True)))
    m, files = min(LENGTH, len(chosen)), min(FILES, len(chosen))
    coded = cut_lineage(reps.select("rep", "v").mapInArrow(_code(pivots, files, m), "rep bigint, files array<int>, body binary"))
    posted = coded.select("rep", "body", F.explode("files").alias("file"))
    # Files longer than a block: their rows go to one cell for each pair of blocks.
    lengths = coded.select(F.explode("files").alias("file")).groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    long = [(r.file, -(-r.n // BLOCK)) for r in lengths.where(F.col("n") > BLOCK).collect()]  # at most one row a pivot
    cut = posted.withColumn("blocks", F.lit(1))
    if long:
        cut = posted.join(F.broadcast(spark.createDataFrame(long, "file int, blocks int")), "file", "left").fillna({"blocks": 1})
    cut = cut.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")))
    cells = cut.withColumn("with", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks").cast("bigint") - 1)))
    cells = cells.select("rep", "body", "file", "block", F.least("block", "with").alias("row"), F.greatest("block", "with").alias("col"))
    met = cut_lineage(map_groups(cells, ["file", "row", "col"], ["rep"], _meet(files, m, k, ranked, floor), "q bigint, c bigint, near double, alike bigint"))
    found = met.where("c is not null").groupBy("q", "c").agg(F.max("near").alias("near"))
    # Vectors that meet more alike than are ranked: all that there are, by exact cosine.
    dense = met.where("c is null").groupBy("q").agg(F.sum("alike").alias("alike")).where(F.col("alike") > ranked).select("q")
    n_dense = dense.count()
    if n_dense:
        found = found.join(dense, "q", "left_anti").unionByName(_exact(reps, n, dense, n_dense, k, floor))
    near = found.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("near"), "c"))).where(F.col("r") <= k).select(F.col("q").alias("a"), F.col("c").alias("b"), F.col("near").alias("cosine"))
    # Members: first their own class, by least id, then the members of the classes near.
    held = members.join(heads, "rep")
    outer = held.where(F.size("heads") <= k).select("id", F.col("rep").alias("a")).join(near, "a").join(heads.withColumnRenamed("rep", "b"), "b").select("id", F.explode("heads").alias("other"), "cosine")
    inner = held.where(F.size("heads") > 1).select("id", F.explode("heads").alias("other"), F.lit(1.0).alias("cosine")).where("id <> other")
    own = Window.partitionBy("id").orderBy(F.desc("cosine"), "other")
    return inner.unionByName(outer).withColumn("r", F.row_number().over(own)).where(F.col("r") <= k).drop("r").where(F.col("cosine") >= floor)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = most_similar(table(spark, sf_dir, "profiles"), "ord", voice(), k=5, floor=0.80)
    return near.select(F.least("id", "other").cast("int").alias("ord_a"), F.greatest("id", "other").cast("int").alias("ord_b")).distinct()
