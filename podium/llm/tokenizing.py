"""Problem 8: the whole corpus as ids of a public byte-level BPE tokenizer.

Method: the vocabulary's byte strings, mapped to Latin-1 characters, form the trie of an Aho-Corasick
automaton, whose longest-prefix walk (without failure links) bounds the longest token at each place. A piece of text is
encoded by taking the longest token and backtracking to shorter ones where two neighbours could
not both come out of the merges; whether two tokens may stand side by side depends on those two
alone and is memoised. The only encoding of which all neighbours are compatible is the one the
merge rules give, and it is found in linear time, without applying a merge.

Text is first cut by the tokenizer's pre-token pattern, so a token never spans two pieces; the
ids of a piece of up to LONG letters are remembered within a worker, up to MEMORY pieces, after which
the memory starts anew.

Defined cases: null and empty texts give an empty list; strings that look like special tokens are
ordinary text; lone surrogates cannot occur in Parquet strings; any length of text works in time
linear in it; equal doc_ids are encoded as often as they are given; other columns are ignored.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from podium.sources.tables import table

#: Where the vocabulary files lie; a parameter everywhere below.
TOKENIZERS = "/opt/tokenizers"
#: The pre-token pattern that belongs to the vocabulary (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
MEMORY = 500_000
LONG = 64


class BacktrackingEncoder:
    """Exact byte-pair encoding by longest matches and backtracking."""

    def __init__(self, path: str, pattern: str = PATTERN):
        import ahocorasick
        import regex

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a).decode("latin-1"): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.ranks = ranks
        self.strings = {i: s for s, i in ranks.items()}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for s, i in ranks.items():
            self.automaton.add_word(s, i)
        self.most = max(map(len, ranks))  # no token is longer
        self.shorter: dict[int, int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self.beside: dict[tuple[int, int], bool] = {}
        self.find = regex.compile(pattern).findall
        self.pieces: dict[str, tuple[int, ...]] = {}

    def next_shorter(self, token: int) -> int:
        """The longest token that is a proper prefix of this one; -1 where there is none."""
        known = self.shorter.get(token)
        if known is None:
            s, known = self.strings[token][:-1], -1
            while s:
                if s in self.ranks:
                    known = self.ranks[s]
                    break
                s = s[:-1]
            self.shorter[token] = known
        return known

    def split(self, token: int) -> tuple[int, int]:
        """The two tokens whose merge makes this one: those of the last merge inside its bytes."""
        known = self.halves.get(token)
        if known is None:
            s = self.strings[token]
            parts = list(s)
            known = (token, token)
            while len(parts) > 1:
                best, at = None, -1
                for i in range(len(parts) - 1):
                    r = self.ranks.get(parts[i] + parts[i + 1])
                    if r is not None and (best is None or r < best):
                        best, at = r, i
                if best is None:
                    break
                if len(parts) == 2:
                    known = (self.ranks[parts[0]], self.ranks[parts[1]])
                    break
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            self.halves[token] = known
        return known

    def compatible(self, a: int, b: int) -> bool:
        """Whether the merges leave a and b side by side: no merge across them would come first."""
        key = (a, b)
        known = self.beside.get(key)
        if known is None:
            if len(self.beside) > MEMORY:
                self.beside.clear()
            known = self.beside[key] = self._compatible(a, b)
        return known

    def _compatible(self, a: int, b: int) -> bool:
        limit, left, right = 1 << 62, a, b
        ranks, strings = self.ranks, self.strings
        while True:
            across = ranks.get(strings[left] + strings[right])
            if across is not None and across < limit:
                return False
            # Undo the later of the two tokens' last merges and look at the border again.
            if left > right:
                limit = left
                inner = self.split(left)[1]
                if inner == left:
                    limit, inner = right + 1, self.split(right)[0]
                    if inner == right:
                        return True
                    right = inner
                else:
                    left = inner
            else:
                limit = right + 1
                inner = self.split(right)[0]
                if inner == right:
                    limit, inner = left, self.split(left)[1]
                    if inner == left:
                        return True
                    left = inner
                else:
                    right = inner

    def encode_piece(self, text: str) -> tuple[int, ...]:
        s = text.encode("utf-8").decode("latin-1")
        if len(s) == 1:
            return (self.ranks[s],)
        longest, ranks, strings = self.automaton.longest_prefix, self.ranks, self.strings
        dead: set[int] = set()  # places from which no encoding of the rest is compatible
        out: list[int] = []
        at, size = 0, len(s)
        token = self._longest(s, 0)
        while True:
            end = at + len(strings[token])
            if end not in dead and (not out or self.compatible(out[-1], token)):
                out.append(token)
                at = end
                if at == size:
                    return tuple(out)
                token = self._longest(s, at)
                continue
            token = self.next_shorter(token)
            while token < 0:
                dead.add(at)
                token = out.pop()
                at -= len(strings[token])
                token = self.next_shorter(token)

    def _longest(self, s: str, at: int) -> int:
        # The automaton says how far some token goes on; the longest whole token lies within that.
        n = self.automaton.longest_prefix(s[at : at + self.most])
        ranks = self.ranks
        while n > 1:
            r = ranks.get(s[at : at + n])
            if r is not None:
                return r
            n -= 1
        return ranks[s[at]]

    def __call__(self, text: str) -> list[int]:
        pieces, found = self.pieces, self.find(text)
        if len(pieces) > MEMORY:
            pieces.clear()
        try:
            return list(chain.from_iterable([pieces[p] for p in found]))
        except KeyError:
            own: dict[str, tuple[int, ...]] = {}  # long pieces are not remembered beyond their text
            for p in found:
                if p not in pieces and p not in own:
                    (pieces if len(p) <= LONG else own)[p] = self.encode_piece(p)
            return list(chain.from_iterable([pieces.get(p) or own[p] for p in found]))


_ENCODERS: dict[str, BacktrackingEncoder] = {}


def encoder(path: str) -> BacktrackingEncoder:
    """One encoder for each worker process and vocabulary."""
    if path not in _ENCODERS:
        _ENCODERS[path] = BacktrackingEncoder(path)
    return _ENCODERS[path]


def encode_corpus(df: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = f"{TOKENIZERS}/byte_bpe_50k.tiktoken") -> DataFrame:
    """(key, ids): a map over the scan, without a shuffle."""
    kind = df.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                ids = pa.array([encode(t) if t else [] for t in part.column(1).to_pylist()], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), ids], names=[key, "ids"])

    return df.select(key, text).mapInArrow(run, f"{key} {kind.simpleString()}, ids array<int>")


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = os.environ.get("PODIUM_TOKENIZERS", TOKENIZERS)
    return encode_corpus(table(spark, sf_dir, "documents"), vocabulary=f"{folder}/byte_bpe_50k.tiktoken")
