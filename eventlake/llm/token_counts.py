"""Token counts of every prefix of a text, by dynamic programming over prefixes.

The encoding of a prefix by byte-pair merges is the encoding of a shorter prefix and one token more.
Which token that is follows from the vocabulary pieces that end there: exactly one of them stands
beside the last token of the shorter prefix without merging with it. So one pass over the characters
gives the last token and the count of tokens at every prefix, and any later question of truncation or
budget is a lookup. Chunks between which nothing can merge are computed once per worker and kept.

Defined results: null and empty texts have 0 tokens and 0 bytes; null or repeated doc_ids are counted
like any others; a character outside the vocabulary counts one token per byte of it, all at the
character's end. Only `doc_id` and `text` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from eventlake.llm.common import WordPool, gather_runs, small_batches
from eventlake.llm.pieces import Pieces, load


NEVER = 1 << 40


class PrefixCounter:
    """Counts of tokens at every prefix of chunks, kept per worker."""

    def __init__(self, pieces: Pieces, pairs: int = 1_000_000):
        self.pieces, self.pairs = pieces, pairs
        self.rank = {p: int(pieces.rank[i]) for p, i in pieces.ids.items()}
        self.piece = {r: p for p, r in self.rank.items()}
        # every beginning of a piece: its rank, or -1 where it is none itself
        self.begun = {p[:n]: -1 for p in self.rank for n in range(1, len(p))} | self.rank
        self.whole: dict[int, bool] = {}  # by rank: merges make this very piece of its characters
        self.made: dict[int, tuple[int, int, int]] = {}  # when a piece is merged (-1: never), and of which two
        self.beside: dict[int, bool] = {}  # by two ranks: the pieces stay apart as neighbours
        self.pool = WordPool(self._learn, np.uint32)

    def _is_token(self, piece: int) -> bool:
        """Whether merges make this piece; notes when, and of which two pieces."""
        parts, last = list(self.piece[piece]), None
        while len(parts) > 1:
            ranks = [self.rank.get(a + b, NEVER) for a, b in zip(parts, parts[1:])]
            best = min(ranks)
            if best == NEVER:
                break
            at = ranks.index(best)
            last = parts[at], parts[at + 1]
            parts[at : at + 2] = ["".join(last)]
        found = self.whole[piece] = len(parts) == 1
        if found:
            self.made[piece] = (piece, self.rank[last[0]], self.rank[last[1]]) if last else (-1, -1, -1)
        return found

    def _stand(self, a: int, b: int) -> bool:
        """Whether two tokens stay apart as neighbours.

        Goes back in time: undoes the later of the two tokens' merges (of equal ones the right, which
        came second) and asks whether the pieces then at the border would have merged before it.
        """
        if len(self.beside) >= self.pairs:
            self.beside.clear()
        key, limit = a << 32 | b, NEVER
        while True:
            joined = self.rank.get(self.piece[a] + self.piece[b], NEVER)
            if joined < limit:
                found = False
                break
            for piece in (a, b):
                if piece not in self.made:
                    self._is_token(piece)
            (time_a, _, right), (time_b, left, _) = self.made[a], self.made[b]
            if time_a > time_b:
                limit, a = time_a, right
            elif time_b >= 0:
                limit, b = time_b + 1, left
            else:
                found = True
                break
        self.beside[key] = found
        return found

    def prefix_counts(self, chunk: str) -> list[int]:
        """Tokens of the first 1, 2, ... characters of the chunk."""
        begun, beside, whole = self.begun, self.beside, self.whole
        size = len(chunk)
        last: list[int | None] = [None] * (size + 1)
        last[0] = -1  # -1: nothing before, or a character that never merges
        counts = [0] * (size + 1)
        for start in range(size):
            before = last[start]
            if chunk[start] not in begun:
                last[start + 1] = -1
                counts[start + 1] = counts[start] + len(chunk[start].encode())
                continue
            for end in range(start + 1, size + 1):
                token = begun.get(chunk[start:end])
                if token is None:
                    break
                if token < 0 or last[end] is not None:
                    continue
                real = whole.get(token)
                if not (self._is_token(token) if real is None else real):
                    continue
                if before >= 0:
                    stand = beside.get(before << 32 | token)
                    if not (self._stand(before, token) if stand is None else stand):
                        continue
                last[end] = token
                counts[end] = counts[start] + 1
        return counts[1:]

    def _learn(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [self.prefix_counts(c) for c in chunks]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((n for counts in found for n in counts), np.uint32, int(lengths.sum())), lengths

    def total(self, text: str) -> int:
        """Tokens of the whole text: the counts at the last prefix of each chunk."""
        rows = self.pool.rows(self.pieces.chunks(text))
        return int(self.pool.values[self.pool.starts[rows] + self.pool.lengths[rows] - 1].sum(dtype=np.int64))

    def counts(self, text: str) -> np.ndarray:
        """Tokens of the text's first 0, 1, 2, ... characters."""
        rows = self.pool.rows(self.pieces.chunks(text))
        lengths = self.pool.lengths[rows]
        inside = self.pool.values[gather_runs(self.pool.starts[rows], lengths)].astype(np.int64)
        if not len(inside):
            return np.zeros(1, np.int64)
        totals = inside[np.cumsum(lengths) - 1]
        found = inside + np.repeat(np.cumsum(totals) - totals, lengths)
        found[0] = 0  # the mark in front alone: no text, no token
        return found

    def longest_within(self, text: str, budget: int) -> int:
        """Characters of the longest prefix of at most `budget` tokens."""
        return int(np.flatnonzero(self.counts(text) <= budget)[-1])


_counters: dict[str, PrefixCounter] = {}


def counter_for(path: str) -> PrefixCounter:
    if path not in _counters:
        _counters[path] = PrefixCounter(load(path))
    return _counters[path]


def token_counts(documents: DataFrame, path: str, budget: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, and the characters that fit into the budget."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_for(path)
        for batch in small_batches(batches, "text"):
            sizes, tokens, fit = [], [], []
            for text in batch.column("text").to_pylist():
                text = text or ""
                n = counter.total(text)
                sizes.append(len(text.encode()))
                tokens.append(n)
                fit.append(len(text) if n <= budget else counter.longest_within(text, budget))
            arrays = [pa.array(c, pa.int64()) for c in (sizes, tokens, fit)]
            over = pa.array(np.array(tokens) > budget)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), arrays[0], arrays[1], over, arrays[2]],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars"],
            )

    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fit_chars long"
    return documents.select("doc_id", "text").mapInArrow(run, schema)
