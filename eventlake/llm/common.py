"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.config import scratch_path


LETTERS = re.compile(r"[^\W\d_]+")


def letter_words(text: str | None) -> list[str]:
    """Lower-case runs of letters; none for a null text."""
    return LETTERS.findall((text or "").lower())


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the shared folder: lineage is cut, lost executors cost nothing."""
    return written_at(df, label)[0]


def written_at(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """The same, and its path, for tables that are removed when the next one has taken their place."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def fold_is(key: str, modulus: int, remainder: int) -> Column:
    """crc32 of the key as text falls on the remainder; false for a null key."""
    digest = F.crc32(F.col(key).cast("string").cast("binary"))
    return F.coalesce(digest % modulus == remainder, F.lit(False))


def drawn(df: DataFrame, key: str, wanted: int, total: int) -> DataFrame:
    """At most `wanted` of `total` rows with a key, those of lowest key hash.

    Most rows are left out before the sort, so the tasks together send about as many as are wanted.
    """
    share = F.pmod(F.xxhash64(key), F.lit(1 << 40)) / float(1 << 40)
    few = df.where(F.col(key).isNotNull() & (share <= min(1.0, 1.5 * wanted / max(total, 1))))
    return few.orderBy(share, key).limit(wanted)


def columns(batch: pa.RecordBatch, *names: str) -> list[list]:
    return [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names]


def small_batches(batches: Iterable[pa.RecordBatch], text: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the text column of each holds about `limit` bytes (or one row)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes.astype(np.int64)) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for start, stop in zip(cuts, cuts[1:]):
            if stop > start:
                yield batch.slice(start, stop - start)


_SPACE = re.compile(rb"[ \t\n\r\x0b\x0c]")


def blocks(data: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """The text in blocks of about this size that begin and end between words."""
    start = 0
    while len(data) - start > size:
        found = _SPACE.search(data, start + size)
        if not found:
            break
        yield data[start : found.start()]
        start = found.start()
    yield data[start:]


class _Rows(dict):
    """Word -> row; a new word gets the next row and is noted in `fresh`."""

    def __init__(self):
        super().__init__()
        self.fresh: list = []

    def __missing__(self, word) -> int:
        row = self[word] = len(self)
        self.fresh.append(word)
        return row


class WordPool:
    """A worker's memory of what each word stands for: a run of numbers.

    `compute` gives the runs of a list of new words, one behind the other, and their lengths. When over
    `limit` words or `most_bytes` are held, the half of the words that were asked for most is kept and the
    rest is forgotten, to be computed again when it comes again.
    """

    ENTRY = 150  # bytes of a word's object and its place in the dictionary, besides its letters

    def __init__(self, compute, dtype, limit: int = 1_000_000, most_bytes: int = 1 << 40):
        self.compute, self.dtype, self.limit, self.most_bytes = compute, dtype, limit, most_bytes
        self.clear()

    def clear(self) -> None:
        self._rows = _Rows()
        self.values = np.zeros(1 << 16, self.dtype)
        self.starts, self.lengths, self.asked = (np.zeros(1 << 14, np.int32) for _ in range(3))
        self.used = self.held = 0

    @staticmethod
    def _grown(array: np.ndarray, least: int) -> np.ndarray:
        """Room for `least` elements and a quarter more."""
        out = np.zeros(least + least // 4, array.dtype)
        out[: len(array)] = array
        return out

    def _forget(self) -> None:
        count = len(self._rows)
        kept = np.sort(np.argsort(-self.asked[:count], kind="stable")[: count // 2])
        lengths, asked = self.lengths[kept], self.asked[kept] // 2
        values = self.values[gather_runs(self.starts[kept], lengths)]
        words = list(self._rows)
        self.clear()
        self._add([words[i] for i in kept.tolist()], values, lengths)
        self.asked[: len(kept)] = asked

    def _add(self, words: list, flat: np.ndarray, lengths: np.ndarray) -> None:
        """Runs of words that are last in the dictionary, or not yet in it."""
        for word in words:
            self._rows[word]
        self._rows.fresh = []
        first, last = len(self._rows) - len(words), len(self._rows)
        if self.used + len(flat) > len(self.values):
            self.values = self._grown(self.values, self.used + len(flat))
        if last > len(self.starts):
            self.starts, self.lengths, self.asked = (self._grown(x, last) for x in (self.starts, self.lengths, self.asked))
        self.values[self.used : self.used + len(flat)] = flat
        self.starts[first:last] = self.used + np.cumsum(lengths) - lengths
        self.lengths[first:last] = lengths
        self.used += len(flat)
        self.held += sum(map(len, words)) + self.ENTRY * len(words)

    def rows(self, words: list) -> np.ndarray:
        """The row of every word, good until the next call."""
        if len(self._rows) > self.limit or self.held > self.most_bytes:
            self._forget()
        rows = np.fromiter(map(self._rows.__getitem__, words), np.int64, len(words))
        fresh, self._rows.fresh = self._rows.fresh, []
        if fresh:
            self._add(fresh, *self.compute(fresh))
        np.add.at(self.asked, rows, 1)  # touches the words asked for only, not all that are held
        return rows

    def runs(self, words: list) -> np.ndarray:
        """The numbers of all words, one run behind the other."""
        rows = self.rows(words)
        return self.values[gather_runs(self.starts[rows], self.lengths[rows])]


def gather_runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of all elements of the runs (start, length), run after run."""
    total = int(lengths.sum())
    own = np.zeros(len(lengths), np.int64)
    np.cumsum(lengths[:-1], out=own[1:], dtype=np.int64)
    return np.arange(total) + np.repeat(starts - own, lengths)


def free_names(taken: list[str], *wanted: str) -> list[str]:
    """Column names like the wanted ones that no column has, upper and lower case alike."""
    used = {t.lower() for t in taken}
    found = []
    for name in wanted:
        found.append(next(n for n in (name, *(f"{name}_{i}" for i in range(len(used) + 1))) if n.lower() not in used))
        used.add(found[-1].lower())
    return found


def usable_vector(name: str) -> Column:
    """Neither null, nor zero, nor holding a null or non-finite component."""
    v = F.col(name)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array | list) -> np.ndarray:
    """Vectors of one length as rows of doubles."""
    if isinstance(column, pa.Array):
        flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)
    return np.array([np.asarray(v, np.float64) for v in column])
