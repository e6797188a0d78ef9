"""Continuous periods and gaps of overlapping intervals, by compressed run bitmaps.

Time is discretised into whole units (milliseconds). The set of busy units of an entity in a
time shard is a bitmap in run form, held as a run container: the ascending, disjoint runs as bytes
(offset in the shard, length, count of intervals that begin in it). Containers are
built where the rows lie, before the shuffle, so what travels is one container an entity and shard
of each batch; the containers of a shard are united, and
set runs (periods) and clear runs (gaps) between them are read off. Runs at the two ends of a
shard's container may go on in a neighbouring shard: only those, at most two an entity and
shard, are united once more over the whole entity. No task holds more than one shard of a group,
so one group may have a third of all rows.

An interval is cut into the shards it touches, at most REACH + 1 of them. Where there are longer
ones, they and the periods of the rest are united once more in shards REACH times as wide, and so on.

Defined cases: null keys, null bounds and end <= start take no part; repeated intervals
count as often as they are given (callers drop re-delivered rows first); touching runs unite;
an empty input gives an empty result; other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podium.operators.stream import changes, map_groups, numbers

SHARD_MS, REACH = 3_600_000, 24
#: Rows whose containers are built together.
_ROWS = 200_000
_PERIOD, _GAP, _EDGE = 0, 1, 2
_SCHEMA = "g string, e int, kind int, s bigint, t bigint, n bigint, joined boolean, shard bigint"
_ARROW = pa.schema([("g", pa.string()), ("e", pa.int32()), ("kind", pa.int32()), ("s", pa.int64()), ("t", pa.int64()), ("n", pa.int64()), ("joined", pa.bool_()), ("shard", pa.int64())])


def _merge(first: np.ndarray, s: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the merged runs of each entity begin, and how far the intervals reach up to each row; rows by entity and start."""
    entity = np.cumsum(first) - 1
    # A running maximum of ends that never crosses an entity: ends are ranked within entities.
    rank = np.lexsort((t, entity))
    place = np.empty(len(t), dtype=np.int64)
    place[rank] = np.arange(len(t))
    reach = t[rank[np.maximum.accumulate(place)]]
    opens = first.copy()
    opens[1:] |= s[1:] > reach[:-1]  # a bit is clear between them
    return opens, reach


def encode(s: np.ndarray, t: np.ndarray, n: np.ndarray, cuts: np.ndarray, base: np.ndarray) -> pa.Array:
    """Run containers of the runs between cuts: offsets, lengths and counts of each, little-endian."""
    runs = np.stack([s - np.repeat(base, np.diff(cuts)), t - s, n], axis=1).astype("<i8")
    ends = pa.py_buffer((cuts * runs.itemsize * 3).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, ends, pa.py_buffer(runs.tobytes())])


def decode(containers: list[bytes], base: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The container of each run, its start, end and count."""
    runs = np.frombuffer(b"".join(containers), "<i8").reshape(-1, 3)
    owner = np.repeat(np.arange(len(containers)), [len(c) // 24 for c in containers])
    s = runs[:, 0] + base[owner]
    return owner, s, s + runs[:, 1], runs[:, 2]


def _contain(shard: int):
    """Batches of intervals (g, e, s, t, n) to the run containers (g, e, shard, runs) of each entity and shard."""

    def build(table: pa.Table) -> pa.RecordBatch:
        g = table.column("g").combine_chunks().dictionary_encode()
        g = g.combine_chunks() if isinstance(g, pa.ChunkedArray) else g
        code, e = g.indices.to_numpy(zero_copy_only=False), numbers(table, "e")
        s, t, n = numbers(table, "s"), numbers(table, "t"), numbers(table, "n")
        low, high = s // shard, (t - 1) // shard
        row = np.repeat(np.arange(len(s)), high - low + 1)
        k = np.arange(len(row)) - np.repeat(np.cumsum(high - low + 1) - (high - low + 1), high - low + 1)
        home = low[row] + k
        s, t, n = np.maximum(s[row], home * shard), np.minimum(t[row], (home + 1) * shard), np.where(k == 0, n[row], 0)
        code, e = code[row], e[row]
        order = np.lexsort((s, e, home, code))
        code, e, home, s, t, n = (x[order] for x in (code, e, home, s, t, n))
        first = np.ones(len(s), bool)
        first[1:] = (code[1:] != code[:-1]) | (e[1:] != e[:-1]) | (home[1:] != home[:-1])
        opens, reach = _merge(first, s, t)
        at = np.flatnonzero(opens)
        last = np.append(at[1:], len(s)) - 1
        heads = np.flatnonzero(first[at])
        runs = encode(s[at], reach[last], np.add.reduceat(n, at), np.append(heads, len(at)), home[at[heads]] * shard)
        own = at[heads]
        return pa.RecordBatch.from_arrays([g.dictionary.take(pa.array(code[own])), pa.array(e[own], pa.int32()), pa.array(home[own]), runs], names=["g", "e", "shard", "runs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                rows += batch.num_rows
            if rows >= _ROWS:
                yield build(pa.Table.from_batches(held))
                held, rows = [], 0
        if held:
            yield build(pa.Table.from_batches(held))

    return run


def _unite(final: bool, shard: int):
    """Unites what lies in each (group, shard, entity): run containers, or at last the runs at the shards' ends."""

    def fn(work: pa.Table, begins: np.ndarray) -> pa.Table:
        first = changes(work, ["g", "shard", "e"])
        if final:
            s, t, n = numbers(work, "s"), numbers(work, "t"), numbers(work, "n")
            joined = work.column("joined").to_numpy(zero_copy_only=False).astype(bool)
        else:
            owner, s, t, n = decode(work.column("runs").to_pylist(), numbers(work, "shard") * shard)
            entity = (np.cumsum(first) - 1)[owner]
            order = np.lexsort((s, entity))
            owner, s, t, n, entity = (x[order] for x in (owner, s, t, n, entity))
            work = work.select(["g", "e", "shard"]).take(pa.array(owner))
            first = np.append(True, entity[1:] != entity[:-1])
            joined = np.zeros(len(s), bool)
        opens, reach = _merge(first, s, t)
        at = np.flatnonzero(opens)
        last = np.append(at[1:], len(s)) - 1
        rs, rt, rn = s[at], reach[last], np.add.reduceat(n, at)
        rj, re = joined[at], first[at]
        ends = np.append(re[1:], True)
        # Clear runs between two set runs; where a run's gap was read off in its shard, not again.
        gap = np.flatnonzero(~re & ~rj)
        keep = work.select(["g", "e", "shard"]).take(pa.array(at))
        edge = np.zeros(len(at), dtype=bool) if final else (re | ends)
        out_kind = np.where(edge, _EDGE, _PERIOD)
        # The last run of a container knows that the clear run before it has been read off.
        out_joined = np.where(edge & ~re, True, rj)
        runs = pa.table({"g": keep["g"], "e": keep["e"], "kind": pa.array(out_kind, pa.int32()), "s": rs, "t": rt, "n": rn, "joined": out_joined, "shard": keep["shard"]})
        holes = keep.take(pa.array(gap))
        clear = pa.table({"g": holes["g"], "e": holes["e"], "kind": pa.array(np.full(len(gap), _GAP), pa.int32()), "s": rt[gap - 1], "t": rs[gap], "n": np.zeros(len(gap), np.int64), "joined": np.zeros(len(gap), bool), "shard": holes["shard"]})
        return pa.concat_tables([runs.cast(_ARROW), clear.cast(_ARROW)])

    return fn


def _level(timed: DataFrame, shard: int) -> DataFrame:
    contained = timed.mapInArrow(_contain(shard), "g string, e int, shard bigint, runs binary")
    local = map_groups(contained, ["g", "shard"], ["e"], _unite(False, shard), _SCHEMA)
    # Only edges are shuffled on, to meet by group; the rows that are done pass them by.
    edges = local.where(F.col("kind") == _EDGE).withColumn("shard", F.lit(-1).cast("bigint"))
    met = map_groups(edges, ["g", "shard"], ["e", "s"], _unite(True, shard), _SCHEMA)
    return local.where(F.col("kind") != _EDGE).unionByName(met).select("g", "e", "kind", "s", "t", "n")


def periods_and_gaps(df: DataFrame, group: Column, entity: Column, start: Column, end: Column, shard: int = SHARD_MS, longest: int | None = None) -> DataFrame:
    """Rows (g, e, kind, s, t, n): kind 0 a period of n intervals from s to t, kind 1 a gap.

    group is a string (a meeting), entity an int within it (a speaker); start and end are whole units.
    longest is a bound of the intervals' lengths; without it they are measured, by one pass over df.
    """
    timed = df.select(group.alias("g"), entity.cast("int").alias("e"), start.cast("bigint").alias("s"), end.cast("bigint").alias("t"), F.lit(1).cast("bigint").alias("n")).where("g is not null and e is not null and t > s")
    if longest is None:
        longest = timed.agg(F.max(F.col("t") - F.col("s"))).first()[0] or 0
    while longest > REACH * shard:
        long = F.col("t") - F.col("s") > REACH * shard
        done = _level(timed.where(~long), shard).where(F.col("kind") == _PERIOD).select("g", "e", "s", "t", "n")
        timed, shard = timed.where(long).unionByName(done), REACH * shard
    return _level(timed, shard)
