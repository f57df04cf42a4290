"""SimHash groups, vector links, components and the pipeline's choice against brute force."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from cases import ODD_TEXTS, documents, no_documents, odd_documents, same_as_sql
from pyspark.sql import functions as F

from eventlake.llm import simhash, vector_links
from eventlake.llm.components import components


def roots(nodes, pairs):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def plain_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints():
    rng = random.Random(1)
    texts = [t for _, t in ODD_TEXTS if not t or len(t) < 9000]
    texts += [" ".join(rng.choices("ab cd\n ef GH é".split(" "), k=rng.randint(0, 40))) for _ in range(50)]
    for text in texts:
        assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_spark_hash_is_the_same(spark):
    row = spark.range(1).select(F.xxhash64(F.lit("the cat sät")).alias("h")).first()
    assert row["h"] & (1 << 64) - 1 == xxhash.xxh64_intdigest("the cat sät".encode(), 42)


@pytest.mark.parametrize("crowd, segments", [(512, 2), (3, 2), (512, 4)])
def test_groups_equal_all_pairs(spark, crowd, segments):
    rng = random.Random(2)
    prints = []
    for _ in range(40):
        base = rng.getrandbits(64)
        prints += [base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(rng.randint(1, 12))]
    crowded = rng.getrandbits(64)
    prints += [crowded ^ rng.getrandbits(5) for _ in range(60)] + [0, 0, 1]
    rows = [(i, int(np.uint64(p).astype(np.int64))) for i, p in enumerate(prints)]
    df = spark.createDataFrame(rows, "doc_id LONG, fp LONG")
    found = {r["doc_id"]: r["component_id"] for r in df.join(simhash.groups(df, segments=segments, crowd=crowd), "fp").collect()}
    pairs = [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3]
    assert found == roots(range(len(prints)), pairs)


def test_odd_rows_and_one_of_each_group(spark):
    df = odd_documents(spark)
    found = simhash.near_duplicates(df).collect()
    assert len(found) == len(ODD_TEXTS)
    by_text = {}
    for r in found:
        by_text.setdefault(r["doc_id"], set()).add((r["fp"], r["component_id"]))
    assert by_text[2] == by_text[1] and {c for _, c in by_text[2]} == {1}
    assert {c for i in (3, 4, 5) for _, c in by_text[i]} == {3} and (0, 3) in by_text[None]
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    left = [r["doc_id"] for r in kept.collect()]
    groups = {r["component_id"] for r in found if r["component_id"] is not None}
    assert sorted(i for i in left if i is not None) == sorted(groups)
    assert left.count(None) == 1  # the only text of its group has no id
    assert simhash.near_duplicates(no_documents(spark)).count() == 0
    assert simhash.keep_one(no_documents(spark)).count() == 0


def test_components(spark):
    rng = random.Random(4)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(500, n) for n in range(501, 700)] + [(rng.randint(1000, 1200), rng.randint(1000, 1200)) for _ in range(150)]
    df = spark.createDataFrame(pairs, "a LONG, b LONG")
    nodes = {n for p in pairs for n in p if p[0] != p[1]}
    expected = roots(nodes, [p for p in pairs if p[0] != p[1]])
    assert {r["node"]: r["root"] for r in components(df).collect()} == expected
    assert components(df.limit(0)).count() == 0


@pytest.mark.parametrize("settings", [
    vector_links.Settings(), vector_links.Settings(rows_per_pivot=10, copies=50.0), vector_links.Settings(rows_per_pivot=20, block_rows=16, chunk=7),
])
def test_links_equal_all_pairs(spark, settings):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(12, 8)) * 3
    vectors = [centres[i % 12] + rng.normal(size=8) * (0.15 if i % 3 else 0.4) for i in range(260)]
    vectors += [vectors[5]] * 6 + [vectors[5] * 3.0]
    rows = [(i, [float(np.float32(x)) for x in v], i % 2) for i, v in enumerate(vectors)]
    rows += [(900, None, 1), (901, [0.0] * 8, 1), (902, [1.0, None] + [0.0] * 6, 1), (903, [float("nan")] * 8, 1), (904, [1.0] * 8, None), (905, [1.0] * 3, 1)]
    df = spark.createDataFrame(rows, "vec_id LONG, embedding ARRAY<FLOAT>, label INT").withColumns({c: F.lit(1) for c in ("v", "rep", "links", "root", "same")})
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v, _ in rows[:-6]}
    links = [(i, j) for i in unit for j in unit if j < i and i % 2 == j % 2 and unit[i] @ unit[j] >= 0.98]
    assert len(links) > 300
    counts = defaultdict(int)
    for i, j in links:
        counts[i] += 1
        counts[j] += 1
    expected = roots([r[0] for r in rows], links)
    found = vector_links.linked(df, settings=settings).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in found} == {i: (counts[i], c, i == c) for i, c in expected.items()}
    assert len(found) == len(rows)


def test_no_vectors(spark):
    schema = "vec_id LONG, embedding ARRAY<FLOAT>, label INT"
    assert vector_links.linked(spark.createDataFrame([], schema)).count() == 0
    only = spark.createDataFrame([(None, [1.0, 0.0], 1), (3, [1.0, 0.0], None)], schema)
    assert {tuple(r) for r in vector_links.linked(only).collect()} == {(None, 0, None, False), (3, 0, 3, True)}


def test_repeated_rows_keep_one(spark):
    rows = [(4, "some words that are here twice"), (4, "some words that are here twice"), (2, "Some words that are here twice"), (7, "another text")]
    assert sorted(r["doc_id"] for r in simhash.keep_one(documents(spark, rows)).collect()) == [2, 7]


def test_every_group_keeps_one(spark):
    """Groups without an id, and groups that share their smallest id, keep a row each."""
    first, second, third, fourth = ("a text about the sea and its ships", "bread is baked from flour and water", "seven birds sat on an old wire", "the road to the north was closed")
    rows = [(None, first), (None, first), (None, second), (5, third), (5, fourth), (9, fourth.upper())]
    found = sorted((r["doc_id"] or 0, r["text"]) for r in simhash.keep_one(documents(spark, rows)).collect())
    assert found == sorted([(0, first), (0, second), (5, third), (5, fourth)])


def test_pivots_of_clustered_vectors_leave_few_pairs():
    """Two hundred clear clusters: under a twentieth of all pairs is compared, at any size of the table."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(200, 64))
    x = vector_links._directions(centres[rng.integers(0, 200, 3000)] + rng.normal(size=(3000, 64)) * 0.05)
    reach = float(np.sqrt(2 - 2 * 0.98)) + 1e-7
    pivots = vector_links._pivots(x, 256, reach, 3.0)
    far = np.sqrt(np.maximum(2 - 2 * x @ pivots.T, 0))
    member = far <= far.min(axis=1, keepdims=True) + 2 * reach
    home = np.bincount(far.argmin(axis=1), minlength=len(pivots))
    assert (home * member.sum(axis=0)).sum() < 0.05 * len(x) ** 2 and member.sum(axis=1).mean() <= 3
    # directions without clusters have no pivots that save anything
    assert len(vector_links._pivots(vector_links._directions(rng.normal(size=(2000, 64))), 256, reach, 3.0)) == 1


def test_vector_links_equal_their_sql_twin(spark):
    same_as_sql(spark, "op1_vector_links")
