"""Stretches of a text that repeat themselves: runs of words with a period, found online.

Words are appended to a sequence. Every power-of-two block of it, once complete, gets a catcher. A catcher of
2**k words waits for its block to come again between 2**(k+1) - 1 and 2**(k+2) - 2 words later; after that it
is dropped, so each appended word meets two live catchers per power. What a catcher meets is the suffix that
the word completes, compared by name: names of 2**k words are hashes of two names of half as many. A square
of period q has in its first half a complete block of the power that belongs to q, so none is missed. Each
match is widened to the left and to the right as far as the period holds; matches that widen to the same
stretch are one run, and a run that reaches the last word so far stays open and grows with the next words.

All comparisons of a batch of words are done as numpy arrays, and many texts go through one sequence, parted
by symbols that occur once. Names are 64 bits; each run found is compared with the words themselves.

Defined results: null and blank texts have no words and no run; the words of a run are kept as a text writes
them; rows with equal or null ids are treated on their own; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from eventlake.llm.common import small_batches

SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every element."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class SquareCatchers:
    """Runs of a sequence that grows: maximal stretches with smallest period q and `exponent` * q words at least.

    `longest` bounds the length of a run, where it is known (texts of a batch), and so the powers needed.
    """

    def __init__(self, least: int = 2, exponent: int = 2, longest: int | None = None):
        if exponent < 2:
            raise ValueError("a square is the least that is caught")
        self.least, self.exponent, self.longest = least, exponent, longest
        self.words = np.zeros(0, np.int64)
        self.names: list[np.ndarray] = []  # names[k][i]: the 2**k words from i on
        self._open = np.zeros((0, 3), np.int64)  # start, end, period; the end is the last word so far
        self._closed: list[np.ndarray] = []

    def append(self, words: np.ndarray) -> None:
        if not len(words):
            return
        before = [len(names) for names in self.names]
        self.words = np.concatenate([self.words, np.asarray(words, np.int64)])
        self._name()
        caught = [self._grown(self._open)]
        for k, names in enumerate(self.names):
            starts, again = self._met(k, names, before[k] if k < len(before) else 0)
            starts, again = self._unexplained(caught, starts, again, 1 << k)
            caught.append(self._widened(starts, again, 1 << k))
        self._settle(np.concatenate(caught))

    def runs(self) -> np.ndarray:
        """start, length, period of all runs so far, by start and period."""
        found = self._kept(np.concatenate([*self._closed, self._open]))
        return np.stack([found[:, 0], found[:, 1] - found[:, 0], found[:, 2]], axis=1)

    def _name(self) -> None:
        """Names of all stretches that the new words complete."""
        n, k = len(self.words), 0
        limit = n if self.longest is None else min(n, self.longest)
        while k == 0 or self.exponent * (2 * (1 << k) - 1) <= limit:
            if k == len(self.names):
                self.names.append(np.zeros(0, np.uint64))
            have, count = len(self.names[k]), n - (1 << k) + 1
            if count > have:
                if k == 0:
                    new = mixed(self.words[have:] * np.int64(2) + 1)
                else:
                    below, half = self.names[k - 1], 1 << (k - 1)
                    new = mixed(below[have:count] * np.uint64(0x9E3779B97F4A7C15) + below[have + half : count + half] + np.uint64(k))
                self.names[k] = np.concatenate([self.names[k], new]) if have else new
            k += 1

    @staticmethod
    def _met(k: int, names: np.ndarray, old: int) -> tuple[np.ndarray, np.ndarray]:
        """Blocks and the places where their words come again, among the stretches named since `old`."""
        size = 1 << k
        starts, again = [], []
        for nearest in (2 * size - 1, 3 * size - 1):  # the two catchers alive at each place
            first = max(old, nearest) - nearest
            count = len(names) - nearest
            if count <= first:
                continue
            block = first // size
            waiting = np.repeat(names[block * size : count : size], size)[first - block * size : count - block * size]
            hits = np.flatnonzero(names[nearest + first : nearest + count] == waiting) + first
            starts.append(hits - hits % size)
            again.append(hits + nearest)
        if not starts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(starts), np.concatenate(again)

    @staticmethod
    def _unexplained(caught: list[np.ndarray], starts: np.ndarray, again: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Leave out matches inside a run of a period that divides theirs: they are that run."""
        runs = np.concatenate(caught)
        runs = runs[runs[:, 1] - runs[:, 0] >= 2 * runs[:, 2]]
        if not len(runs) or not len(starts):
            return starts, again
        runs = runs[np.argsort(runs[:, 0], kind="stable")]
        # of the runs that begin before the match the one that reaches furthest
        reach = np.maximum.accumulate(runs[:, 1])
        best = np.maximum.accumulate(np.where(runs[:, 1] == reach, np.arange(len(runs)), 0))
        at = np.searchsorted(runs[:, 0], starts, "right") - 1
        run = runs[best[np.maximum(at, 0)]]
        inside = (at >= 0) & (run[:, 1] >= again + size) & ((again - starts) % run[:, 2] == 0)
        return starts[~inside], again[~inside]

    def _widened(self, starts: np.ndarray, again: np.ndarray, size: int) -> np.ndarray:
        """start, end, period of the stretches around matches; equal stretches once."""
        if not len(starts):
            return np.zeros((0, 3), np.int64)
        period = again - starts
        left = starts - self._alike(starts, again, -1)
        right = again + size + self._alike(starts + size, again + size, 1)
        return np.unique(np.stack([left, right, period], axis=1), axis=0)

    def _alike(self, a: np.ndarray, b: np.ndarray, way: int) -> np.ndarray:
        """How many words from a and b on (way 1), or before a and b (way -1), are the same."""
        a, b = a.copy(), b.copy()
        total = np.zeros(len(a), np.int64)
        k = len(self.names) - 1
        active = np.arange(len(a))
        while k >= 0:
            names, step = self.names[k], 1 << k
            x, y = a[active], b[active]
            if way < 0:
                x, y = x - step, y - step
            fits = (x >= 0) & (y < len(names))
            same = np.zeros(len(active), bool)
            same[fits] = names[x[fits]] == names[y[fits]]
            going = active[same]
            a[going] += way * step
            b[going] += way * step
            total[going] += step
            # the longest step is taken as often as it fits, each shorter one once
            if k == len(self.names) - 1 and len(going):
                active = going
                continue
            if k == len(self.names) - 1:
                active = np.arange(len(a))
            k -= 1
        return total

    def _grown(self, runs: np.ndarray) -> np.ndarray:
        if not len(runs):
            return runs
        out = runs.copy()
        out[:, 1] += self._alike(runs[:, 1] - runs[:, 2], runs[:, 1], 1)
        return out

    def _settle(self, found: np.ndarray) -> None:
        """Runs that reach the last word stay open, the others are closed if they are long enough."""
        found = np.unique(found, axis=0)
        at_end = found[:, 1] == len(self.words)
        self._open = found[at_end]
        closed = self._kept(found[~at_end])
        if len(closed):
            self._closed.append(closed)

    def _kept(self, found: np.ndarray) -> np.ndarray:
        """Long enough runs, each by its smallest period, once."""
        length = found[:, 1] - found[:, 0]
        found = found[(length >= self.least) & (length >= self.exponent * found[:, 2])]
        found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
        first = np.ones(len(found), bool)
        first[1:] = (np.diff(found[:, 0]) != 0) | (np.diff(found[:, 1]) != 0)
        found = found[first]
        for start, end, period in found:
            if not np.array_equal(self.words[start : end - period], self.words[start + period : end]):
                raise RuntimeError("two stretches of words have the same name")
        return found[np.lexsort((found[:, 2], found[:, 0]))]


def runs_of(texts: list[list], least: int, exponent: int, piece: int = 1 << 18) -> list[np.ndarray]:
    """Runs of each list of words. Texts of like length share one sequence, appended piece by piece."""
    number: dict = {}
    symbols = [np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words)) for words in texts]
    out = [np.zeros((0, 3), np.int64) for _ in texts]
    classes: dict[int, list[int]] = {}
    for at, words in enumerate(texts):
        if len(words) >= max(least, exponent):
            classes.setdefault(len(words).bit_length(), []).append(at)
    for members in classes.values():
        lengths = np.array([len(symbols[m]) for m in members])
        ends = np.cumsum(lengths + 1)
        stream = np.concatenate([part for i, m in enumerate(members) for part in (symbols[m], np.array([-1 - i]))])
        catchers = SquareCatchers(least, exponent, int(lengths.max()))
        for start in range(0, len(stream), piece):
            catchers.append(stream[start : start + piece])
        found = catchers.runs()
        owner = np.searchsorted(ends, found[:, 0], "right")
        found[:, 0] -= ends[owner] - lengths[owner] - 1
        cuts = np.searchsorted(owner, np.arange(len(members) + 1))
        for i, m in enumerate(members):
            out[m] = found[cuts[i] : cuts[i + 1]]
    return out


def kept_words(words: list, runs: np.ndarray) -> list:
    """The words without what runs repeat: of each run the first period stays."""
    if not len(runs):
        return words
    steps = np.zeros(len(words) + 1, np.int64)
    np.add.at(steps, runs[:, 0] + runs[:, 2], 1)
    np.add.at(steps, runs[:, 0] + runs[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(steps[:-1]) == 0)]


def periodic_runs(documents: DataFrame, least: int = 24, exponent: int = 3) -> DataFrame:
    """doc_id, n_words, runs (start, length, period) by start and period, and the text without repeats.

    A run is a maximal stretch of at least `least` words and `exponent` periods. Words are what ASCII white
    space parts, numbered from 0. Nothing is shuffled; a task holds one batch of texts, or one long text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", 2 << 20):
            texts = [(t or "").encode().split() for t in batch.column("text").to_pylist()]
            found = runs_of(texts, least, exponent)
            flat = np.concatenate(found)
            offsets = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
            listed = pa.ListArray.from_arrays(
                offsets, pa.StructArray.from_arrays([pa.array(flat[:, j]) for j in range(3)], ["start", "length", "period"])
            )
            collapsed = [b" ".join(kept_words(words, r)).decode() for words, r in zip(texts, found)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(list(map(len, texts)), pa.int64()), listed, pa.array(collapsed, pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )

    return documents.select("doc_id", "text").mapInArrow(run, SCHEMA)
