"""Packing of tokenised documents into fixed windows by the sum-of-squares rule.

Documents arrive one after another and are placed at once. A document of at least a window's length
fills whole windows first. The rest goes to that fill level, an empty window among them, after which
the sum over all levels of (partly filled windows at that level) squared is smallest; ties go to the
fuller window. The counts are held in one array with an entry per level, so a placement is one pass
over that array. When a partition ends, the emptiest windows are cut up to fill the gaps of the
fullest ones, which leaves at most one window with padding per partition.

Every input partition is packed by itself, so nothing is shuffled and one source or group of copies
may hold any share of the rows. What a task holds is bounded by the windows that are open: one
window's tokens for each level at which it keeps windows. Window numbers carry the partition number.

Defined results: a null or empty text is the end id alone; null or repeated doc_ids are packed like
any others; an empty table gives no piece. Only `doc_id` and `text` are read.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain
from unicodedata import normalize

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from eventlake.llm.common import WordPool, blocks, gather_runs, small_batches

WINDOW = 4096
END_ID = 2
PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class WordEncoder:
    """Ids of texts by a lower-casing tokenizer that drops white space and never crosses it.

    A text is the run of its words' ids. The distinct words of a batch are looked up once each. The
    tokenizer also never merges letters with other characters, so the letters of a word and the
    punctuation behind them are looked up apart; what is found is kept per worker, up to a number of parts.
    """

    TAIL = ".,!?;:|*%$#&"

    def __init__(self, path: str, limit: int = 250_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.parts = WordPool(self._encode_parts, np.uint32, limit)

    def _split(self, words: pa.Array) -> tuple[pa.Array, np.ndarray, pa.Array]:
        """Lower-cased words without the punctuation that ends them, where it can be cut off; where; and that."""
        # A-Z only, which commutes with the tokenizer's own folding; a special token is matched as it stands
        words = pc.if_else(pc.match_substring(words, "<|"), words, pc.ascii_lower(words))
        cores = pc.ascii_rtrim(words, characters=self.TAIL)
        size = pc.binary_length(cores)
        at = np.flatnonzero(pc.less(size, pc.binary_length(words)).to_numpy(zero_copy_only=False))
        last = pc.utf8_slice_codeunits(cores.take(pa.array(at)), -1).dictionary_encode()
        letter = np.fromiter(map(str.isalpha, last.dictionary.to_pylist()), bool, len(last.dictionary))
        at = at[letter[last.indices.to_numpy()]]
        at = at[~pc.match_substring(words.take(pa.array(at)), "<|").to_numpy(zero_copy_only=False)]
        cut = np.zeros(len(words), bool)
        cut[at] = True
        tails = [w[n:] for w, n in zip(words.take(pa.array(at)).cast(pa.binary()).to_pylist(), size.take(pa.array(at)).to_pylist())]
        return pc.if_else(pa.array(cut), cores, words), at, pa.array(tails, pa.binary()).cast(pa.string())

    @staticmethod
    def _is_letters(part: bytes) -> bool:
        return part.isalpha() or normalize("NFC", part.decode()).lower().isalpha()

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_parts(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of parts. Words of letters are encoded many at once: each ends with an end-of-word id."""
        letters = np.fromiter(map(self._is_letters, parts), bool, len(parts))
        plain = [p.decode() for p, yes in zip(parts, letters) if yes]
        joined = self._ids([" ".join(plain[i : i + 500]) for i in range(0, len(plain), 500)])
        flat = np.fromiter(chain.from_iterable(joined), np.uint32)
        stops = np.flatnonzero(self.ends[flat]) + 1
        assert len(stops) == len(plain), "the tokenizer does not end every word"
        other = self._ids([p.decode() for p, yes in zip(parts, letters) if not yes])
        lengths = np.empty(len(parts), np.int64)
        lengths[letters] = np.diff(stops, prepend=0)
        lengths[~letters] = [len(ids) for ids in other]
        out = np.empty(int(lengths.sum()), np.uint32)
        of_letters = np.repeat(letters, lengths)
        out[of_letters] = flat
        out[~of_letters] = np.fromiter(chain.from_iterable(other), np.uint32)
        return out, lengths

    def _encode_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, one behind the other, and how many each has."""
        cores, at, tails = self._split(words)
        parts = pa.concat_arrays([cores, tails]).dictionary_encode()  # many words share a core, and most a tail
        found = self.parts.rows(parts.dictionary.cast(pa.binary()).to_pylist())
        rows = found[parts.indices.to_numpy()]
        starts, sizes = np.zeros((2, len(words), 2), np.int64)
        for column, where, part in ((0, slice(None), rows[: len(words)]), (1, at, rows[len(words) :])):
            starts[where, column], sizes[where, column] = self.parts.starts[part], self.parts.lengths[part]
        return self.parts.values[gather_runs(starts.ravel(), sizes.ravel())], sizes.sum(axis=1)

    def encode(self, text: str) -> np.ndarray:
        """Ids of one text of any length."""
        return np.concatenate([self._encode_column(pa.array([b.decode()]))[0] for b in blocks(text.encode())])

    def encode_all(self, texts: list[str] | pa.Array) -> list[np.ndarray]:
        """Ids of each text; the distinct words of all of them are encoded together."""
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        if (pc.sum(pc.binary_length(column)).as_py() or 0) > 4 << 20:
            return [self.encode(t) for t in column.to_pylist()]
        return self._encode_column(column)

    def _encode_column(self, texts: pa.Array) -> list[np.ndarray]:
        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        flat, lengths = self._encode_words(coded.dictionary)
        starts = np.cumsum(lengths) - lengths
        of_word = coded.indices.to_numpy()
        sizes = lengths[of_word]
        ids = flat[gather_runs(starts[of_word], sizes)]
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(split.value_lengths().to_numpy())])]
        return [ids[i:j] for i, j in zip(ends, ends[1:])]


_encoders: dict[str, WordEncoder] = {}


def encoder_for(path: str) -> WordEncoder:
    """The encoder that this worker process keeps for the tokenizer file."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


@dataclass
class Piece:
    doc: object
    start: int
    ids: np.ndarray
    tokens: int


@dataclass
class Packer:
    """Online packing of one partition. `place` and `finish` give windows: lists of pieces."""

    window: int = WINDOW
    open: dict[int, list[list[Piece]]] = field(default_factory=dict)

    def __post_init__(self):
        self.levels = np.zeros(self.window + 1, np.int64)

    def level_for(self, size: int) -> int:
        """The fill level (0: an empty window) that a piece of this size goes to."""
        top = self.window - size
        after, before = self.levels[size : self.window + 1], self.levels[: top + 1]
        change = 2 * (after - before) + 2
        change[0] = 2 * self.levels[size] + 1  # a window is opened
        if top:
            change[top] = 1 - 2 * self.levels[top]  # a window is closed
        usable = before > 0
        usable[0] = True
        change = np.where(usable, change, np.iinfo(np.int64).max)
        return top - int(change[::-1].argmin())

    def place(self, doc, ids: np.ndarray) -> Iterator[list[Piece]]:
        whole = len(ids) - len(ids) % self.window
        for start in range(0, whole, self.window):
            yield [Piece(doc, start, ids[start : start + self.window], len(ids))]
        size = len(ids) - whole
        if not size:
            return
        level = self.level_for(size)
        pieces = []
        if level:
            pieces = self.open[level].pop()
            self.levels[level] -= 1
        pieces.append(Piece(doc, whole, ids[whole:], len(ids)))
        if level + size == self.window:
            yield pieces
        else:
            self.levels[level + size] += 1
            self.open.setdefault(level + size, []).append(pieces)

    def finish(self) -> Iterator[list[Piece]]:
        """All open windows; the emptiest are cut to fill the others, one may stay unfilled."""
        left = [(level, pieces) for level in sorted(self.open) for pieces in self.open[level]]
        self.open, self.levels[:] = {}, 0
        low, high = 0, len(left) - 1
        while low < high:
            (have, source), (level, target) = left[low], left[high]
            gap = self.window - level
            if gap == 0:
                yield target
                high -= 1
                continue
            piece = source.pop()
            if len(piece.ids) > gap:
                # the end of the piece fills the gap, its beginning stays
                keep = len(piece.ids) - gap
                source.append(Piece(piece.doc, piece.start, piece.ids[:keep], piece.tokens))
                piece = Piece(piece.doc, piece.start + keep, piece.ids[keep:], piece.tokens)
            target.append(piece)
            left[high] = (level + len(piece.ids), target)
            left[low] = (have - len(piece.ids), source)
            if not source:
                low += 1
        if low == high:
            yield left[low][1]


def pack(documents: DataFrame, path: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents with their ids (little-endian unsigned 32-bit) and place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = encoder_for(path), Packer(window)
        number = TaskContext.get().partitionId() << 33
        rows: list[tuple] = []

        def note(pieces: list[Piece]) -> None:
            nonlocal number
            offset = 0
            for p in pieces:
                rows.append((p.doc, p.start, len(p.ids), p.ids.astype("<u4").tobytes(), p.tokens, number, offset))
                offset += len(p.ids)
            number += 1

        def batch_of() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
            made = pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 7, kinds)],
                names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )
            rows.clear()
            return made

        for batch in small_batches(batches, "text", 2 << 20):
            encoded = encoder.encode_all(pc.fill_null(batch.column("text"), ""))
            for doc, ids in zip(batch.column("doc_id").to_pylist(), encoded):
                for pieces in packer.place(doc, np.append(ids, np.uint32(end_id))):
                    note(pieces)
            yield batch_of()
        for pieces in packer.finish():
            note(pieces)
        yield batch_of()

    return documents.select("doc_id", "text").mapInArrow(run, PIECES)
