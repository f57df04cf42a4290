"""Encoding into pieces, and decoding, by vectorised merge rounds.

The symbols of many chunks lie one behind the other in flat numpy arrays. In each round every chunk
finds its best ranked pair of neighbours with one segmented minimum, and all chunks merge at once:
the leftmost place of that pair, or all its places from left to right where no pair with the merged
piece in it can rank before it, so that the order of merges is that of one merge at a time. Symbols
that went are compacted away, chunks without a pair leave, and the rounds end when none is left.

Chunks, between which nothing can merge, are encoded once per worker and kept.

Defined results: null and empty texts give no ids and decode to the empty text; null or repeated
doc_ids are encoded like any others; characters outside the vocabulary become their bytes. Only
`doc_id` and `text` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from eventlake.llm.common import WordPool, gather_runs, small_batches
from eventlake.llm.pieces import Pieces, load

NONE = np.iinfo(np.int64).max


class PieceCodec:
    """Encodes and decodes texts; remembers chunks."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.of_char = np.full(0x110000, -1, np.int32)
        for piece, i in pieces.ids.items():
            if len(piece) == 1:
                self.of_char[ord(piece)] = i
        pairs = sorted(
            ((pieces.ids[p[:n]] << 32) | pieces.ids[p[n:]], i)
            for p, i in pieces.ids.items() for n in range(1, len(p)) if p[:n] in pieces.ids and p[n:] in pieces.ids
        )
        self.keys = np.array([k for k, _ in pairs], np.int64)
        self.made = np.array([i for _, i in pairs], np.int64)
        self.ranks = pieces.rank[self.made]
        # pieces of which every larger piece ranks behind: their merges can be done all at once
        self.safe = np.ones(len(pieces.rank), bool)
        for part in (self.keys >> 32, self.keys & 0xFFFFFFFF):
            self.safe[part[self.ranks < pieces.rank[part]]] = False
        lengths = np.fromiter(map(len, pieces.surfaces), np.int64, len(pieces.surfaces))
        self.surface = np.frombuffer(b"".join(pieces.surfaces), np.uint8)
        self.surface_starts, self.surface_lengths = np.cumsum(lengths) - lengths, lengths
        self.pool = WordPool(self._learn, np.int32)

    def _pair_at(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Index of each pair of ids among the pairs that merge, -1 for none."""
        keys = (left.astype(np.int64) << 32) | np.maximum(right, 0)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where((self.keys[at] == keys) & (left >= 0) & (right >= 0), at, -1)

    def merge(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge the symbols of consecutive chunks (all with symbols); ids and their new lengths."""
        chunk = np.repeat(np.arange(len(lengths)), lengths)
        pair = np.full(len(symbols), -1, np.int64)  # with the next symbol, in the same chunk
        inside = np.flatnonzero(chunk[1:] == chunk[:-1])
        pair[inside] = self._pair_at(symbols[inside], symbols[inside + 1])
        done_symbols, done_chunks = [], []
        while len(symbols):
            starts = np.flatnonzero(np.concatenate([[True], chunk[1:] != chunk[:-1]]))
            size = np.diff(np.append(starts, len(symbols)))
            rank = np.where(pair >= 0, self.ranks[pair], NONE)
            best = np.minimum.reduceat(rank, starts)
            live = best < NONE
            if not live.all():
                keep = np.repeat(live, size)
                done_symbols.append(symbols[~keep])
                done_chunks.append(chunk[~keep])
                symbols, chunk, pair, rank = symbols[keep], chunk[keep], pair[keep], rank[keep]
                best, size = best[live], size[live]
                starts = np.cumsum(size) - size
                if not len(symbols):
                    break
            at = np.flatnonzero(rank == np.repeat(best, size))
            owner = chunk[at]
            first = np.concatenate([[True], owner[1:] != owner[:-1]])
            # of overlapping places every other one counts, from the left of each run of neighbours
            breaks = np.concatenate([[True], (at[1:] != at[:-1] + 1) | first[1:]])
            run = at[np.maximum.accumulate(np.where(breaks, np.arange(len(at)), 0))]
            at = at[first | (self.safe[self.made[pair[at]]] & ((at - run) % 2 == 0))]
            symbols[at] = self.made[pair[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            new_at = at - np.arange(len(at))
            symbols, chunk, pair = symbols[keep], chunk[keep], pair[keep]
            for changed in (new_at, new_at[new_at > 0] - 1):
                last = np.append(chunk[1:] != chunk[:-1], True)[changed]
                following = np.minimum(changed + 1, len(symbols) - 1)
                pair[changed] = np.where(last, -1, self._pair_at(symbols[changed], symbols[following]))
        flat, owners = np.concatenate(done_symbols), np.concatenate(done_chunks)
        order = np.argsort(owners, kind="stable")
        return flat[order], np.bincount(owners, minlength=len(lengths))

    def _learn(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.fromiter(map(len, chunks), np.int64, len(chunks))
        points = np.frombuffer("".join(chunks).encode("utf-32-le"), np.uint32).astype(np.int64)
        known = self.of_char[points].astype(np.int64)
        symbols = np.where(known >= 0, known, -1 - points)  # below 0: a character without a piece
        found, sizes = self.merge(symbols, lengths)
        odd = np.flatnonzero(found < 0)
        if not len(odd):
            return found, sizes
        spelt = [self.pieces.byte_ids[list(chr(-1 - int(found[i])).encode())] for i in odd]
        grown = np.ones(len(found), np.int64)
        grown[odd] = [len(s) for s in spelt]
        owners = np.repeat(np.arange(len(sizes)), sizes)
        out = np.repeat(found, grown)
        out[np.repeat(found, grown) < 0] = np.concatenate(spelt)
        return out, np.bincount(np.repeat(owners, grown), minlength=len(sizes))

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one behind the other, and how many each has."""
        chunks = [self.pieces.chunks(t) for t in texts]
        rows = self.pool.rows(list(chain.from_iterable(chunks)))
        lengths = self.pool.lengths[rows]
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.cumsum([0, *map(len, chunks)])]
        return self.pool.values[gather_runs(self.pool.starts[rows], lengths)], np.diff(ends)

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]

    def decode_bytes(self, ids: np.ndarray) -> np.ndarray:
        """UTF-8 of the ids' text: surfaces in a row, without the mark put in front."""
        found = self.surface[gather_runs(self.surface_starts[ids], self.surface_lengths[ids])]
        return found[1:] if len(ids) and self.pieces.surfaces[ids[0]][:1] == b" " else found

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_bytes(ids).tobytes().decode(errors="replace")


_codecs: dict[str, PieceCodec] = {}


def codec_for(path: str) -> PieceCodec:
    if path not in _codecs:
        _codecs[path] = PieceCodec(load(path))
    return _codecs[path]


def round_trip(documents: DataFrame, path: str) -> DataFrame:
    """doc_id, ids and the text decoded from them, for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_for(path)
        for batch in small_batches(batches, "text", 2 << 20):
            flat, lengths = codec.encode_all([t or "" for t in batch.column("text").to_pylist()])
            offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            texts = pa.array([codec.decode(flat[a:b]) for a, b in zip(offsets, offsets[1:])], pa.string())
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids, texts], names=["doc_id", "ids", "decoded"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>, decoded string")
