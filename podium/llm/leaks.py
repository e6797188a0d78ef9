"""Problem 9: evaluation passages that leaked into training texts.

Method: latent semantic retrieval. Items are cut into overlapping passages; passages are TF-IDF
vectors over the items' vocabulary, with document frequencies counted over the whole corpus; a
distributed randomised SVD (power iterations with partial products summed in Spark) gives the
latent space. Every document is cut into passages that overlap by half, so that any run of 12 words
lies whole in one; a passage is projected, and items with a passage of enough cosine are candidates.
So is, whatever the cosine, an item that holds RUN or more successive words of the passage.
Candidates are verified by longest common subsequence, then by the longest common run, and for
paraphrases by the share of the item's rarest words (its answer) that stand in or around the passage.

The corpus is only ever mapped over: no shuffle but that of the counts of the items' words and of
the rows found. The items are a stated set, of fixed size; beyond BLOCK of them they are taken in
blocks, each with its own space and its own pass, so what is sent to the executors stays bounded.

Defined cases: words are runs of letters and digits without case and accents; null, empty and short
texts hold nothing; an item of fewer words than the least run is never found; texts of any length
are read whole; repeated rows give one row; extra columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.sources.tables import table

RUN = 12
RANK = 256
BLOCK = 2000
#: Least share of a passage's norm in the latent space, and least cosine with an item's passage there.
ENERGY, COSINE = 0.3, 0.2

_WORD = re.compile(r"[^\W_]+")


#: Whether a code point is a combining mark, which words are compared without; none stands beyond the range looked at.
_COMBINING = np.zeros(0x110000, bool)
_COMBINING[[c for c in range(0x1F000) if unicodedata.combining(chr(c))]] = True


def without_marks(text: str) -> str:
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    marked = _COMBINING[codes]
    return codes[~marked].tobytes().decode("utf-32-le") if marked.any() else text


def words(text: str) -> list[str]:
    if not text.isascii():
        return _WORD.findall(without_marks(unicodedata.normalize("NFKD", text)).casefold())
    return _WORD.findall(text.lower())


def starts(n: int, width: int) -> np.ndarray:
    """Starts of windows of `width` words that overlap by half: any half lies whole in one."""
    half = width // 2
    return np.arange(0, max(1, n - half + 1), half)


def _partial(vocabulary: dict[str, int], weight: np.ndarray, q: np.ndarray, width: int):
    """The sums over a partition's passages of a (a q), by word: one step of the power iteration."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros_like(q)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                ids = np.array([vocabulary[w] for w in words(text)], np.int64)
                for at in starts(len(ids), width):
                    part = ids[at : at + width]
                    a = weight[part, None]
                    np.add.at(total, part, a * (a * q[part]).sum(0))
        used = np.flatnonzero(np.abs(total).sum(1))
        rows = pa.FixedSizeListArray.from_arrays(pa.array(total[used].ravel()), q.shape[1]).cast(pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(used), rows], names=["word", "sums"])

    return run


def _add(t: pa.Table) -> pa.Table:
    ids = t.column("word").to_numpy()
    x = np.asarray(t.column("sums").combine_chunks().flatten()).reshape(len(ids), -1)
    distinct, place = np.unique(ids, return_inverse=True)
    out = np.zeros((len(distinct), x.shape[1]))
    np.add.at(out, place, x)
    return pa.table({"word": distinct, "sums": pa.FixedSizeListArray.from_arrays(pa.array(out.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))})


def latent_space(items: DataFrame, vocabulary: dict[str, int], weight: np.ndarray, rank: int, width: int, iterations: int = 2) -> np.ndarray:
    """An orthonormal basis (words x rank) of the main directions of the items' passages."""
    rank = min(rank, len(vocabulary))
    q = np.linalg.qr(np.random.default_rng(7).standard_normal((len(vocabulary), rank)))[0]
    for _ in range(iterations + 1):
        parts = items.mapInArrow(_partial(vocabulary, weight, q, width), "word bigint, sums array<double>")
        sums = parts.groupBy(F.pmod("word", F.lit(16))).applyInArrow(lambda t: _add(t.select(["word", "sums"])), "word bigint, sums array<double>")
        y = np.zeros_like(q)
        for r in sums.collect():  # as many rows as the items have words
            y[r.word] = r.sums
        q = np.linalg.qr(y)[0]
    return q


def _frequencies(vocabulary: dict[str, int]):
    """A partition's counts of documents by word of the vocabulary; word -1 counts the documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        n, known = 0, vocabulary.keys()
        for batch in batches:
            n += batch.num_rows
            for text in batch.column(0).to_pylist():
                if text:
                    seen.update(known & set(words(text)))
        yield pa.RecordBatch.from_arrays([pa.array([-1, *[vocabulary[w] for w in seen]], pa.int64()), pa.array([n, *seen.values()], pa.int64())], names=["word", "n"])

    return run


def common_subsequence(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, bit-parallel over a."""
    masks: dict[str, int] = {}
    for i, w in enumerate(a):
        masks[w] = masks.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for w in b:
        if m := masks.get(w, 0):
            u = v & m
            v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def common_run(a: list[str], b: list[str]) -> int:
    """Length of the longest run of words that both hold."""
    best, row = 0, {}
    at: dict[str, list[int]] = {}
    for j, w in enumerate(b):
        at.setdefault(w, []).append(j)
    for w in a:
        row = {j: row.get(j - 1, 0) + 1 for j in at.get(w, ())}
        best = max(best, max(row.values(), default=0))
    return best


class _Model:
    """What a worker needs of one block of items."""

    def __init__(self, items: list[tuple[int, str]], vocabulary: dict[str, int], weight: np.ndarray, other: float, q: np.ndarray, width: int):
        self.vocabulary, self.weight, self.other, self.q, self.width = vocabulary, weight.astype(np.float32), other, (weight[:, None] * q).astype(np.float32), width
        self.ids = [i for i, _ in items]
        self.words = [words(t) for _, t in items]
        self.sets = [frozenset(w) for w in self.words]
        owner, rows = [], []
        for k, ws in enumerate(self.words):
            ids = np.array([vocabulary[w] for w in ws], np.int64)
            for at in starts(len(ids), width):
                owner.append(k)
                rows.append(self.q[ids[at : at + width]].sum(0))
        z = np.array(rows, np.float32).reshape(len(rows), q.shape[1])
        self.z, self.owner = z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9), np.array(owner)
        self.first = np.searchsorted(self.owner, np.arange(len(self.ids)))
        self.holds = np.zeros((len(vocabulary), len(self.ids)), np.uint8)
        for k, ws in enumerate(self.sets):
            self.holds[[vocabulary[w] for w in ws], k] = 1
        rare = np.argsort(-weight, kind="stable")
        order = np.empty(len(rare), np.int64)
        order[rare] = np.arange(len(rare))
        self.answers = [frozenset(sorted(s, key=lambda w: (order[vocabulary[w]], w))[:6]) for s in self.sets]

    def candidates(self, found: list[list[str]], least_run: int) -> Iterator[tuple[int, int, int]]:
        """(document, start, item) of passages near an item in the latent space, or with RUN words in a row that it holds.

        Left out are those of which it is sure that their common subsequence with the item is
        shorter than RUN, or their common run shorter than least_run.
        """
        ids = np.array(list(map(self.vocabulary.get, chain.from_iterable(found), repeat(-1))), np.int64)
        if not len(ids):
            return
        w2 = np.where(ids >= 0, self.weight[ids] ** 2, self.other**2)
        inside = np.append(0, np.cumsum(np.where(ids >= 0, w2, 0)))
        norm = np.append(0, np.cumsum(w2))
        base = np.append(0, np.cumsum([len(ws) for ws in found]))
        doc, start = [], []
        for d, ws in enumerate(found):
            if len(ws):
                at = starts(len(ws), self.width)
                doc.append(np.full(len(at), d))
                start.append(at + base[d])
        doc, start = np.concatenate(doc), np.concatenate(start)
        end = np.minimum(start + self.width, base[doc + 1])
        size = np.maximum(norm[end] - norm[start], 1e-9)
        # The share of the norm in the items' words bounds that in the latent space.
        # RUN words in a row of the vocabulary are verified whatever they weigh.
        at = np.arange(len(ids))
        gap = np.maximum.accumulate(np.where((ids < 0) | np.isin(at, base), at - (ids >= 0), -1))  # the last place before the row
        ends = np.append(0, np.cumsum(at - gap >= RUN))
        inner = np.minimum(start + RUN - 1, end)
        runs = ends[end] - ends[inner] > 0
        may = np.flatnonzero(((inside[end] - inside[start]) / size >= ENERGY**2) | runs)
        for lo in range(0, len(may), 2048):
            some = may[lo : lo + 2048]
            y = np.zeros((len(some), self.q.shape[1]), np.float32)
            for k in range(self.width):
                p = start[some] + k
                ok = p < end[some]
                i = np.where(ok, ids[np.minimum(p, len(ids) - 1)], -1)
                y[i >= 0] += self.q[i[i >= 0]]
            near = np.flatnonzero((np.linalg.norm(y, axis=1) >= ENERGY * np.sqrt(size[some])) | runs[some])
            if not len(near):
                continue
            cosine = np.maximum.reduceat((y[near] / np.sqrt(size[some[near]])[:, None]) @ self.z.T, self.first, axis=1)
            # Words of the passage that the item holds: no common subsequence is longer.
            held = np.zeros((len(near), len(self.ids)), np.uint8)
            row, longest = held.copy(), held.copy()
            for k in range(self.width):
                p = start[some[near]] + k
                i = np.where(p < end[some[near]], ids[np.minimum(p, len(ids) - 1)], -1)
                has = np.where((i >= 0)[:, None], self.holds[i], 0)
                held += has
                row = (row + 1) * has
                np.maximum(longest, row, out=longest)
            for n, item in zip(*np.nonzero(((cosine >= COSINE) & (held >= RUN) & (longest >= least_run)) | (longest >= max(RUN, least_run))), strict=True):
                at = some[near[n]]
                d = int(doc[at])
                yield d, int(start[at] - base[d]), int(item)


_LEAKS = "doc_id bigint, item_id bigint, run int, shared double, answer double"


def _retrieve(model: _Model, least_run: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                keys, found = part.column(0).to_pylist(), [words(t) if t else [] for t in part.column(1).to_pylist()]
                best: dict[tuple[int, int], list[float]] = {}
                for d, at, item in model.candidates(found, least_run):
                    passage = found[d][at : at + model.width]
                    lcs = common_subsequence(passage, model.words[item])
                    if lcs < RUN:
                        continue
                    run = common_run(passage, model.words[item])
                    # The answer may stand anywhere in what is retold: as far around the passage as the item is long.
                    reach = len(model.words[item])
                    answer = len(model.answers[item].intersection(found[d][max(0, at - reach) : at + model.width + reach])) / max(1, len(model.answers[item]))
                    seen = best.setdefault((d, item), [0, 0.0, 0.0])
                    seen[0], seen[1], seen[2] = max(seen[0], run), max(seen[1], lcs / model.width), max(seen[2], answer)
                rows = [(keys[d], model.ids[i], int(v[0]), v[1], v[2]) for (d, i), v in best.items() if keys[d] is not None]
                columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "item_id", "run", "shared", "answer"])

    return run


def leaks(documents: DataFrame, items: DataFrame, rank: int = RANK, width: int = 2 * RUN, block: int = BLOCK, least_run: int = 0) -> DataFrame:
    """(doc_id, item_id, run, shared, answer): what is near in the latent space and shares words in order.

    With least_run only pairs that may share so many successive words are verified.
    """
    spark = documents.sparkSession
    once = items.where("item_id is not null and text is not null").groupBy("item_id").agg(F.min("text").alias("text"))
    texts = documents.select("text")
    parts = []
    ids = [r.item_id for r in once.select("item_id").orderBy("item_id").collect()]  # the stated set
    for lo in range(0, len(ids), block):
        some = once.where(F.col("item_id").between(ids[lo], ids[min(lo + block, len(ids)) - 1]))
        held = [(r.item_id, r.text) for r in some.orderBy("item_id").collect() if len(words(r.text)) >= RUN]
        if not held:
            continue
        vocabulary = {w: i for i, w in enumerate(sorted({w for _, t in held for w in words(t)}))}
        counts = texts.mapInArrow(_frequencies(vocabulary), "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
        frequency = {r.word: r.n for r in counts.collect()}  # a row for each of the items' words
        n = frequency.pop(-1, 0)
        df = np.array([frequency.get(i, 0) for i in range(len(vocabulary))])
        # The root of the inverse frequency: rare names must not outweigh all the rest of a passage.
        weight = np.sqrt(np.log((n + 2) / (df + 1)))
        passages = spark.createDataFrame(held, "item_id bigint, text string").select("text")
        q = latent_space(passages, vocabulary, weight, rank, width)
        model = _Model(held, vocabulary, weight, float(np.sqrt(np.log(n + 2) / 2)), q, width)
        parts.append(documents.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(_retrieve(model, least_run), _LEAKS))
    if not parts:
        return spark.createDataFrame([], _LEAKS)
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    return found.groupBy("doc_id", "item_id").agg(F.max("run").alias("run"), F.max("shared").alias("shared"), F.max("answer").alias("answer"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"), least_run=RUN)
    return found.where(F.col("run") >= RUN).select("doc_id", "item_id")


def kinds(found: DataFrame) -> DataFrame:
    """Adds what a leak is: copied, or paraphrased, that is half a passage in the item's order with a third of the item's rare words; others are left out."""
    kind = F.when(F.col("run") >= RUN, "copied").when((F.col("shared") >= 0.5) & (F.col("answer") > 0.33), "paraphrased")
    return found.withColumn("kind", kind).where("kind is not null")


def p9_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Also paraphrases."""
    return kinds(leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items")))


P9_SQL = """
WITH w AS (SELECT doc_id, regexp_extract_all(strip_accents(lower(text)), '[\\p{L}\\p{N}]+') AS w FROM documents WHERE text IS NOT NULL),
i AS (SELECT DISTINCT item_id, regexp_extract_all(strip_accents(lower(text)), '[\\p{L}\\p{N}]+') AS w FROM eval_items WHERE text IS NOT NULL),
g AS (SELECT DISTINCT item_id, array_to_string(w[k:k + 11], ' ') AS gram FROM (SELECT item_id, w, unnest(range(1, len(w) - 10)) AS k FROM i)),
h AS (SELECT doc_id, array_to_string(w[k:k + 11], ' ') AS gram FROM (SELECT doc_id, w, unnest(range(1, len(w) - 10)) AS k FROM w))
SELECT DISTINCT doc_id, item_id FROM h JOIN g USING (gram)
"""
