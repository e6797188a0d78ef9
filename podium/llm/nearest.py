"""Problem 3: pairing records of two tables by nearest time within a tolerance.

Method: x-fast tries. In each (entity, time shard) the right side's points in time are the leaves
of a trie over their bits; every prefix of every leaf is in one hash table, keyed by the prefix
with a leading one bit, with the lowest and the highest leaf below it. A query finds the longest
prefix of its own bits in the table by binary search over the prefix length; there the leaf list
gives its predecessor and successor, of which the nearer within the tolerance is taken. Probing is
vectorised over all queries of a batch, five or six table look-ups each.

Right rows within the tolerance of a shard's border are copied to the neighbouring shard too, so
shards are independent, and no task holds more than one of an entity.

Defined cases: rows with a null entity, id or point take no part; of equal distances the smaller
right id wins; rows at the same point collapse to the smallest id; a left row without a partner
within the tolerance (which is inclusive) gives no row; empty inputs give an empty result; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.operators.stream import map_groups, numbers
from podium.sources.tables import millis, once, table

_SCHEMA = "g string, left_id int, right_id int"
_ARROW = pa.schema([("g", pa.string()), ("left_id", pa.int32()), ("right_id", pa.int32())])
_MIX = np.uint64(0x9E3779B97F4A7C15)


class XFastTrie:
    """Predecessor and successor search among distinct non-negative keys, ascending."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys.astype(np.uint64)
        self.bits = max(1, int(self.keys[-1]).bit_length() + 1) if len(keys) else 1
        nodes, low, high = [], [], []
        for length in range(self.bits + 1):
            prefix = self.keys >> np.uint64(self.bits - length)
            at = np.flatnonzero(np.append(True, prefix[1:] != prefix[:-1]))
            nodes.append(prefix[at] | np.uint64(1 << length))
            low.append(at)
            high.append(np.append(at[1:], len(keys)) - 1)
        nodes, low, high = np.concatenate(nodes), np.concatenate(low), np.concatenate(high)
        self.shift = np.uint64(64 - int(2 * len(nodes)).bit_length())
        size = 1 << (64 - int(self.shift))
        self.table, self.low, self.high = np.zeros(size, np.uint64), np.zeros(size, np.int64), np.zeros(size, np.int64)
        self.mask, left, slot = size - 1, np.arange(len(nodes)), self._slot(nodes)
        while len(left):  # open addressing: of those that want a free slot, one gets it; the rest step on
            free = self.table[slot[left]] == 0
            self.table[slot[left[free]]] = nodes[left[free]]
            won = self.table[slot[left]] == nodes[left]
            self.low[slot[left[won]]], self.high[slot[left[won]]] = low[left[won]], high[left[won]]
            left = left[~won]
            slot[left] = (slot[left] + 1) & self.mask

    def _slot(self, nodes: np.ndarray) -> np.ndarray:
        return ((nodes * _MIX) >> self.shift).astype(np.int64)

    def _find(self, nodes: np.ndarray) -> np.ndarray:
        """The slot of each node, or -1."""
        slot, found = self._slot(nodes), np.full(len(nodes), -1, np.int64)
        left = np.arange(len(nodes))
        while len(left):
            there = self.table[slot[left]]
            hit = there == nodes[left]
            found[left[hit]] = slot[left[hit]]
            left = left[~hit & (there != 0)]
            slot[left] = (slot[left] + 1) & self.mask
        return found

    def around(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indices of the last key <= and the first key >= each query; -1 and len(keys) where none."""
        q = np.clip(queries, 0, (1 << self.bits) - 1).astype(np.uint64)
        below, above = queries < 0, queries > (1 << self.bits) - 1
        good, bad = np.zeros(len(q), np.int64), np.full(len(q), self.bits + 1, np.int64)
        node = self._find(np.ones(len(q), np.uint64))
        while (open_ := bad - good > 1).any():
            middle = (good + bad) // 2
            length = middle[open_].astype(np.uint64)
            slot = self._find((q[open_] >> (np.uint64(self.bits) - length)) | (np.uint64(1) << length))
            at = np.flatnonzero(open_)
            good[at[slot >= 0]], node[at[slot >= 0]] = middle[at[slot >= 0]], slot[slot >= 0]
            bad[at[slot < 0]] = middle[at[slot < 0]]
        exact = good == self.bits
        # At the node the query's next bit leads nowhere: all leaves below lie on one side of it.
        step = np.where(exact, 0, self.bits - 1 - good).astype(np.uint64)
        right = (q >> step) & np.uint64(1) == 1
        before = np.where(right | exact, self.high[node], self.low[node] - 1)
        after = np.where(exact, before, before + 1)
        return np.where(below, -1, np.where(above, len(self.keys) - 1, before)), np.where(below, 0, np.where(above, len(self.keys), after))


def _match(tolerance: int):
    def fn(table: pa.Table, begins: np.ndarray) -> pa.Table:
        group = np.cumsum(begins) - 1
        side, point, ident = numbers(table, "side"), numbers(table, "point"), numbers(table, "id")
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        if not len(left) or not len(right):
            return _ARROW.empty_table()
        # One trie for all groups of the batch: each group's points are laid out far from the others'.
        low = np.minimum.reduceat(point, np.flatnonzero(begins))
        span = np.maximum.reduceat(point, np.flatnonzero(begins)) - low + 2 * tolerance + 2
        base = np.append(0, np.cumsum(span)[:-1]) + tolerance - low
        x = point + base[group]
        order = right[np.lexsort((ident[right], x[right]))]
        keys, first = np.unique(x[order], return_index=True)
        ids = ident[order[first]]
        trie = XFastTrie(keys)
        before, after = trie.around(x[left])
        big = np.iinfo(np.int64).max
        b, a = np.maximum(before, 0), np.minimum(after, len(keys) - 1)
        down = np.where(before >= 0, x[left] - keys[b], big)
        up = np.where(after < len(keys), keys[a] - x[left], big)
        pick = np.where((down < up) | ((down == up) & (ids[b] < ids[a])), b, a)
        near = np.minimum(down, up) <= tolerance
        out = table.select(["g"]).take(pa.array(left[near]))
        return pa.table({"g": out["g"], "left_id": ident[left[near]], "right_id": ids[pick[near]]}).cast(_ARROW)

    return fn


def nearest(left: DataFrame, right: DataFrame, tolerance: int, shard: int = 3_600_000) -> DataFrame:
    """(g, left_id, right_id) for (g, id, point) rows of either side; points and tolerance are whole units."""
    have = "g is not null and id is not null and point is not null"
    a = left.select("g", F.col("id").cast("int").alias("id"), "point").where(have).withColumns({"side": F.lit(0), "shard": F.floor(F.col("point") / shard)})
    b = right.select("g", F.col("id").cast("int").alias("id"), "point").where(have)
    reach = F.sequence(*[F.floor((F.col("point") + d) / shard) for d in (-tolerance, tolerance)])
    b = b.withColumns({"side": F.lit(1), "shard": F.explode(reach)})
    return map_groups(a.unionByName(b), ["g", "shard"], ["point"], _match(tolerance), _SCHEMA)


def _points(df: DataFrame, ident: str, start: str, end: str) -> DataFrame:
    """Twice the midpoint in milliseconds, which is whole, of timed rows."""
    rows = once(df, ["meeting_id", ident], s=millis(start), t=millis(end)).where("t > s")
    return rows.select(F.col("meeting_id").alias("g"), F.col(ident).alias("id"), (F.col("s") + F.col("t")).alias("point"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    cues = _points(table(spark, sf_dir, "cues"), "pos", "start", "end")
    segments = _points(table(spark, sf_dir, "segments"), "segment_id", "start_time", "end_time")
    return nearest(cues, segments, tolerance=3000, shard=7_200_000).select(F.col("g").alias("meeting_id"), F.col("left_id").alias("cue_pos"), F.col("right_id").alias("segment_id"))


P3_SQL = """
WITH s AS (SELECT meeting_id, segment_id, min(CAST(round(start_time * 1000) AS BIGINT)) AS a, min(CAST(round(end_time * 1000) AS BIGINT)) AS b FROM segments GROUP BY 1, 2),
c AS (SELECT meeting_id, pos, min(CAST(round("start" * 1000) AS BIGINT)) AS a, min(CAST(round("end" * 1000) AS BIGINT)) AS b FROM cues GROUP BY 1, 2),
s2 AS (SELECT meeting_id, segment_id, a + b AS m, (a + b) // 3000 AS k FROM s WHERE b > a),
s3 AS (SELECT meeting_id, segment_id, m, k + unnest([-1, 0, 1]) AS k FROM s2),
p AS (SELECT c.meeting_id, c.pos, s3.segment_id, row_number() OVER (PARTITION BY c.meeting_id, c.pos ORDER BY abs(c.a + c.b - s3.m), s3.segment_id) AS rn
      FROM c JOIN s3 ON c.meeting_id = s3.meeting_id AND (c.a + c.b) // 3000 = s3.k
      WHERE c.b > c.a AND abs(c.a + c.b - s3.m) <= 3000)
SELECT meeting_id, pos AS cue_pos, segment_id FROM p WHERE rn = 1
"""
