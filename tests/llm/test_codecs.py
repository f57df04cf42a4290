"""Packing, piece codec and token counts against the tokenizers' own libraries."""

from __future__ import annotations

import random
import sys
import tracemalloc
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from cases import ODD_TEXTS, no_documents, odd_documents
from tokenizers import Tokenizer

from eventlake.llm import packing, piece_codec, token_counts
from eventlake.llm.common import WordPool

WORD = public_tokenizers.path("word_bpe_49k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")
HARD = [
    "", " ", "a  b", "   a", "a \n b\r\n", "▁x ▁▁y", "aaaaaaaaaaaaa", "mississippi" * 40, "é ﬁ Ａ", "x" * 700, " " * 50,
    "don't WE'LL 's", "İstanbul Σίσυφος ΣΑΣ", "é Å", "１２ 12三", "<|startoftext|>a<|ENDOFTEXT|>", "​x\x85y", "a\x1cb",
]


def some_texts(seed: int) -> list[str]:
    rng = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyzéäßAZ 0123456789.,_-=()<>\n日"
    return ["".join(rng.choices(letters, k=rng.randint(0, 80))) for _ in range(300)]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECE)


def test_word_ids_are_the_tokenizers():
    own, theirs = packing.WordEncoder(WORD, limit=200), Tokenizer.from_file(WORD)
    texts = HARD + some_texts(1)
    expected = [theirs.encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in own.encode_all(texts)] == expected
    assert [own.encode(t).tolist() for t in texts] == expected


def test_words_are_cut_by_column_not_one_by_one():
    encoder = packing.WordEncoder(WORD)
    texts = [" ".join(f"{kind}{'abcdefghij'[i % 10] * (i // 10 + 1)}{tail}" for i in range(200) for kind in ("W", "é", "") for tail in ("", ",", ".|", "!?")) for _ in range(3)]
    expected = [Tokenizer.from_file(WORD).encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in encoder.encode_all(texts)] == expected  # all parts are known from here on
    calls = 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    sys.setprofile(count)
    again = encoder.encode_all(texts)
    sys.setprofile(None)
    assert [x.tolist() for x in again] == expected
    assert calls < 1000  # of 2,400 distinct words


def test_pieces_and_decoding_are_the_library_s(library):
    codec = piece_codec.codec_for(PIECE)
    for text in HARD + some_texts(2):
        ids = codec.encode(text)
        assert ids.tolist() == library.encode(text), text
        assert codec.decode(ids) == library.decode(ids.tolist())


def test_merges_that_may_not_run_at_once(library):
    codec = piece_codec.codec_for(PIECE)
    assert (~codec.safe).any() and codec.safe.any()
    rng = random.Random(3)
    for _ in range(200):
        text = "".join(rng.choices(["in", "ing", "n", "g", "er", "e", "r", "the", "he", "t"], k=40))
        assert codec.encode(text).tolist() == library.encode(text)


def test_counts_at_every_prefix(library):
    counter = token_counts.counter_for(PIECE)
    for text in HARD + some_texts(4)[:60]:
        counts = counter.counts(text)
        assert counts.tolist() == [len(library.encode(text[:n])) for n in range(len(text) + 1)]
        assert counter.total(text) == counts[-1]
    text = "the quick brown fox jumps over the lazy dog " * 20
    fit = counter.longest_within(text, 17)
    assert len(library.encode(text[:fit])) <= 17 and all(len(library.encode(text[:n])) > 17 for n in range(fit + 1, len(text)))


def test_operators_on_odd_rows(spark, library):
    rows = {(r["doc_id"], r["n_tokens"], r["n_bytes"], r["over_limit"]) for r in token_counts.token_counts(odd_documents(spark), PIECE).collect()}
    texts = [(i, t or "") for i, t in ODD_TEXTS]
    assert rows == {(i, len(library.encode(t)), len(t.encode()), len(library.encode(t)) > 4096) for i, t in texts}
    found = piece_codec.round_trip(odd_documents(spark), PIECE).collect()
    assert Counter((r["doc_id"], tuple(r["ids"]), r["decoded"]) for r in found) == Counter(
        (i, tuple(library.encode(t)), library.decode(library.encode(t))) for i, t in texts
    )
    assert token_counts.token_counts(no_documents(spark), PIECE).count() == 0
    assert piece_codec.round_trip(no_documents(spark), PIECE).count() == 0


def test_packing_keeps_every_id_once(spark):
    theirs = Tokenizer.from_file(WORD)
    pieces = packing.pack(odd_documents(spark), WORD).collect()
    expected = Counter()
    for i, t in ODD_TEXTS:
        expected[(i, tuple(theirs.encode(t or "", add_special_tokens=False).ids + [2]))] += 1
    windows: dict[int, list] = {}
    for p in pieces:
        assert len(p["ids"]) == 4 * p["length"] and p["length"] > 0
        windows.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for places in windows.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= packing.WINDOW
    # documents put together again; the two copies and the two rows without an id share a key
    ids = Counter()
    for p in pieces:
        for k, n in enumerate(np.frombuffer(p["ids"], "<u4").tolist()):
            ids[(p["doc_id"], p["start"] + k, n)] += 1
    again = Counter()
    for (i, tokens), times in expected.items():
        for k, n in enumerate(tokens):
            again[(i, k, n)] += times
    assert ids == again
    assert packing.pack(no_documents(spark), WORD).count() == 0


def brute_level(levels: np.ndarray, size: int, window: int) -> int:
    """The level of least sum of squares, the fuller one of equals, by trying all."""
    best = None
    for level in range(window - size, -1, -1):
        if level and not levels[level]:
            continue
        after = levels.astype(object).copy()
        if level:
            after[level] -= 1
        if level + size < window:
            after[level + size] += 1
        squares = sum(int(n) ** 2 for n in after[1:window])
        if best is None or squares < best[0]:
            best = (squares, level)
    return best[1]


def test_placement_is_least_sum_of_squares():
    rng = np.random.default_rng(5)
    packer = packing.Packer(window=24)
    full = []
    for n in range(400):
        ids = np.arange(int(rng.integers(1, 60)), dtype=np.uint32)
        rest = len(ids) % 24
        if rest:
            assert packer.level_for(rest) == brute_level(packer.levels, rest, 24)
        full += list(packer.place(n, ids))
    assert all(sum(len(p.ids) for p in w) == 24 for w in full)
    rest = list(packer.finish())
    assert sum(sum(len(p.ids) for p in w) < 24 for w in rest) <= 1


def test_a_lookup_does_not_touch_all_words_held():
    pool = WordPool(lambda words: (np.ones(len(words), np.int32), np.ones(len(words), np.int64)), np.int32)
    words = [f"w{i}" for i in range(100_000)]
    pool.rows(words)
    tracemalloc.start()
    pool.rows(words[:10] + words[:5])
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 100_000
    assert pool.asked[:12].tolist() == [3] * 5 + [2] * 5 + [1] * 2
