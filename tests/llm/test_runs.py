"""Repeated stretches of words against a plain search over all periods."""

from __future__ import annotations

import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from cases import documents, no_documents, odd_documents

from conftest import SAMPLE_DIR
from eventlake.llm import queries, runs


def plain_runs(words, least, exponent):
    """Every maximal stretch of every period, smallest periods first."""
    found, n = {}, len(words)
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(least, exponent * q):
                found.setdefault((i, length), q)
            i = j
    return sorted((start, length, q) for (start, length), q in found.items())


def texts(rng):
    """Sequences over few words, with stretches that repeat, also inside each other."""
    for size in (0, 1, 2, 3, 5, 24, 60, 130, 257):
        yield list(rng.integers(0, 2, size))
        yield list(rng.integers(0, 4, size))
        yield [7] * size
        part = list(rng.integers(0, 9, max(1, size // 9)))
        yield (list(rng.integers(0, 9, size // 5)) + part * 9 + list(rng.integers(0, 9, 3)))[: size + 9]
        inner = [1, 2] * 7 + list(rng.integers(3, 6, 5))
        yield inner * 4 + inner[: size % len(inner)]


@pytest.mark.parametrize(("least", "exponent"), [(2, 2), (4, 3), (24, 3)])
def test_all_runs_are_found(least, exponent):
    rng = np.random.default_rng(5)
    several = [t for _ in range(12) for t in texts(rng)]
    for words, found in zip(several, runs.runs_of(several, least, exponent)):
        assert [tuple(r) for r in found.tolist()] == plain_runs(words, least, exponent)


@pytest.mark.parametrize("piece", [1, 2, 7, 64])
def test_pieces_appended_do_not_matter(piece):
    rng = np.random.default_rng(piece)
    for words in texts(rng):
        catchers = runs.SquareCatchers(2, 2)
        for start in range(0, len(words), piece):
            catchers.append(np.array(words[start : start + piece]))
            known = words[: start + piece]
            if piece > 1 or start % 16 == 0:
                assert [tuple(r) for r in catchers.runs().tolist()] == plain_runs(known, 2, 2)
        assert [tuple(r) for r in catchers.runs().tolist()] == plain_runs(words, 2, 2)


def test_words_after_the_first_period_are_dropped(spark):
    phrase = "one two three four five six seven eight"
    df = documents(spark, [(1, f"start {phrase}  {phrase}\n{phrase} end"), (2, "la " * 30), (3, f"{phrase} {phrase}")])
    got = {r["doc_id"]: r for r in runs.periodic_runs(df).collect()}
    assert [tuple(x) for x in got[1]["runs"]] == [(1, 24, 8)] and got[1]["collapsed"] == f"start {phrase} end"
    assert [tuple(x) for x in got[2]["runs"]] == [(0, 30, 1)] and got[2]["collapsed"] == "la"
    assert got[3]["runs"] == [] and got[3]["collapsed"] == f"{phrase} {phrase}" and got[3]["n_words"] == 16


def test_odd_and_empty_tables(spark):
    got = runs.periodic_runs(odd_documents(spark)).collect()
    assert len(got) == odd_documents(spark).count()
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert [tuple(x) for x in by_id[9]["runs"]] == [(0, 30_000, 1)] and by_id[9]["collapsed"] == "word"
    assert by_id[3]["n_words"] == by_id[4]["n_words"] == by_id[5]["n_words"] == 0 and by_id[3]["collapsed"] == ""
    assert by_id[13]["n_words"] == 3  # \x1c parts no words here
    assert runs.periodic_runs(no_documents(spark)).count() == 0


def test_query_against_a_plain_search(spark, tmp_path):
    docs = spark.read.parquet(f"{SAMPLE_DIR}/documents.parquet").where("length(text) < 4000")
    docs = docs.unionByName(documents(spark, [(i, "a b c d e " * 40, "en") for i in range(10_000, 10_030)] + [(None, None), (10_031, " "), (None, "x " * 40)]))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, queries.op11_runs(spark, str(tmp_path)).collect()), key=repr)
    expected = []
    for r in docs.select("doc_id", "text").collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")
        n = len(words)
        h = zlib.crc32(str(r["doc_id"]).encode()) if r["doc_id"] is not None else 1
        if h % 10 == 0 and n:
            g = h // 10
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        found = plain_runs(words, 24, 3)
        best = min(found, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None)
        dropped = {i for s, length, q in found for i in range(s + q, s + length)}
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
        kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)]
        expected.append((r["doc_id"], len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, *sha))
    assert got == sorted(expected, key=repr)
    assert any(r[1] for r in got)
