"""Nearest neighbours and shards against brute force, and the pipeline as a whole."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from cases import ODD_TEXTS, no_documents, odd_documents
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SAMPLE_DIR
from eventlake.llm import neighbours, queries, sharding

VECTOR = "vec_id LONG, embedding ARRAY<FLOAT>, label INT"


def true_neighbours(vectors, query, k):
    scores = [(-float(np.dot(np.array(v, np.float64), vectors[query])), i) for i, v in vectors.items() if i != query]
    return [i for _, i in sorted(scores)[:k]]


@pytest.mark.parametrize("settings", [
    neighbours.Settings(), neighbours.Settings(list_rows=20, cell_rows=64, query_rows=16, trial_queries=40),
])
def test_recall_and_exact_scores(spark, settings):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(20, 24))
    found = np.float32(centres[rng.integers(0, 20, 900)] + rng.normal(size=(900, 24)) * 0.5)
    found[200:330] = found[200]  # one vector that many rows repeat
    rows = [(i, [float(x) for x in v], 0) for i, v in enumerate(found)]
    odd = [(2000, None, 0), (2020, [0.0] * 24, 0), (2040, [float("inf")] * 24, 0), (2060, [None] * 24, 0), (2080, [1.0] * 5, 0), (None, [1.0] * 24, 0)]
    df = spark.createDataFrame(rows + odd, VECTOR).withColumns({c: F.lit(1) for c in ("list", "cell", "portion", "v", "rank")}).repartition(4)
    got = defaultdict(list)
    for r in neighbours.search(df, df.where("vec_id % 20 = 0"), k=10, settings=settings).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    vectors = {i: np.array(v, np.float64) for i, v, _ in rows}
    assert set(got) == {i for i in vectors if i % 20 == 0}
    hits = 0
    for query, places in got.items():
        places.sort()
        assert [p[0] for p in places] == list(range(1, 11))
        order = [(-p[2], p[1]) for p in places]
        assert order == sorted(order) and query not in {p[1] for p in places}
        assert np.allclose([p[2] for p in places], [vectors[query] @ vectors[p[1]] for p in places], rtol=1e-12)
        hits += len({p[1] for p in places} & set(true_neighbours(vectors, query, 10)))
    assert hits / (10 * len(got)) >= 0.9


def test_recall_on_the_whole_table(spark):
    """The registered query with its own parameters, against brute force over all its queries."""
    folder = SAMPLE_DIR.replace("sf0.001", "sf0.1")
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()
    vectors = {r["vec_id"]: np.array(r["embedding"], np.float64) for r in rows if r["embedding"] is not None}
    ids, matrix = np.array(list(vectors)), np.array(list(vectors.values()))
    got = defaultdict(set)
    for r in queries.op5_neighbours(spark, folder).collect():
        got[r["query_id"]].add(r["vec_id"])
    assert set(got) == {i for i in vectors if i % 20 == 0}
    hits = 0
    for query, found in got.items():
        score = matrix @ vectors[query]
        order = np.lexsort((ids, -score))
        hits += len(found & set([i for i in ids[order].tolist() if i != query][:20]))
    assert hits / (20 * len(got)) >= 0.9


def test_rows_are_copied_to_the_portions_that_probe_them_only(spark, monkeypatch):
    """Twice the rows and queries: about twice the rows that meet in cells, not four times."""
    met = []
    scan = neighbours.written

    def noted(df, label):
        out = scan(df, label)
        if label == "portions":
            met.append(out.agg(F.sum("portions")).first()[0])
        return out

    monkeypatch.setattr(neighbours, "written", noted)
    rng = np.random.default_rng(4)
    settings = neighbours.Settings(list_rows=50, cell_rows=100, query_rows=8, trial_queries=20)
    for n in (1000, 2000):
        centres = rng.normal(size=(n // 50, 16)) * 4
        found = np.float32(centres[rng.integers(0, len(centres), n)] + rng.normal(size=(n, 16)) * 0.1)
        df = spark.createDataFrame([(i, [float(x) for x in v], 0) for i, v in enumerate(found)], VECTOR)
        neighbours.search(df, df.where("vec_id % 20 = 0"), k=5, settings=settings).count()
    assert met[1] <= 3 * met[0]


def test_ties_and_repeated_ids(spark):
    rows = [(0, [1.0, 0.0], 0)] + [(i, [0.5, 0.0], 0) for i in (9, 3, 7, 5)] + [(7, [0.5, 0.0], 0), (20, [0.5, 1.0], 0), (20, [0.5, 1.0], 0)]
    df = spark.createDataFrame(rows, VECTOR)
    got = [tuple(r) for r in neighbours.search(df, df.where("vec_id = 0"), k=3).collect()]
    assert sorted(got) == [(0, 1, 3, 0.5), (0, 2, 5, 0.5), (0, 3, 7, 0.5)]


def test_few_or_no_candidates(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0], 0), (20, [0.0, 2.0], 0), (7, [1.0, 1.0], 0)], VECTOR)
    rows = neighbours.search(df, df.where("vec_id % 20 = 0")).collect()
    assert {tuple(r) for r in rows} == {(0, 1, 7, 1.0), (0, 2, 20, 0.0), (20, 1, 7, 2.0), (20, 2, 0, 0.0)}
    assert neighbours.search(df.limit(0), df.limit(0)).count() == 0
    assert neighbours.search(df, df.limit(0)).count() == 0
    one = df.where("vec_id = 0")
    assert neighbours.search(one, one).count() == 0


def check_shards(rows, shards):
    slots = defaultdict(list)
    for r in rows:
        assert 0 <= r["shard"] < shards
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_are_near_equal_and_keep_copies_together(spark):
    rng = np.random.default_rng(2)
    texts = [(i, "é" * int(rng.integers(0, 3)) + "word " * int(rng.integers(0, 300))) for i in range(3000)]
    texts += [(10_000 + i, "the same text " * 20) for i in range(1500)]  # a third of all rows
    texts += [(20_000 + i, f"pair {i // 2} " * 30) for i in range(60)]
    df = spark.createDataFrame(texts, "doc_id LONG, text STRING").repartition(5)
    rows = sharding.shard(df, shards=7, slot_rows=50).collect()
    check_shards(rows, 7)
    sizes = {i: len(t.encode()) + 8 for i, t in texts}
    assert {(r["doc_id"], r["size"], r["text_crc32"]) for r in rows} == {(i, sizes[i], zlib.crc32(t.encode())) for i, t in texts}
    held = Counter()
    for r in rows:
        held[r["shard"]] += r["size"]
    mean = sum(held.values()) / 7
    assert len(held) == 7 and max(held.values()) < 1.03 * mean and min(held.values()) > 0.97 * mean
    of = {r["doc_id"]: r["shard"] for r in rows}
    assert sum(of[20_000 + i] == of[20_001 + i] for i in range(0, 60, 2)) >= 29


def test_rows_equal_in_everything_are_cut(spark):
    """A third of all rows have the same id and text, others no id and the same text."""
    rows = [(5, "again " * 20)] * 2000 + [(None, "none " * 10)] * 1000 + [(10 + i, "x" * (i % 200)) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING").repartition(4)
    found = sharding.shard(df, shards=24, slot_rows=100).collect()
    check_shards(found, 24)
    held = Counter()
    for r in found:
        held[r["shard"]] += r["size"]
    mean = sum(held.values()) / 24
    assert len(found) == 6000 and len(held) == 24 and max(held.values()) < 1.03 * mean and min(held.values()) > 0.97 * mean


def test_shards_of_odd_rows(spark):
    rows = sharding.shard(odd_documents(spark), shards=24).collect()
    check_shards(rows, 24)
    assert Counter((r["doc_id"], r["size"]) for r in rows) == Counter((i, len((t or "").encode()) + 8) for i, t in ODD_TEXTS)
    assert sharding.shard(no_documents(spark), shards=24).count() == 0


def test_shard_query_columns(spark):
    df = queries.op8_sharding(spark, SAMPLE_DIR)
    assert dict(df.dtypes) == {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"}
    assert df.count() == spark.read.parquet(f"{SAMPLE_DIR}/documents.parquet").count()


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SAMPLE_DIR}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, stage(spark, kept, SAMPLE_DIR)
        assert kept.columns == docs.columns, name
        assert kept.count() > 0.6 * before.count(), name
        assert {tuple(r) for r in kept.collect()} <= {tuple(r) for r in before.collect()}, name
    packed = corpus_pipeline.run(spark, SAMPLE_DIR)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == {r["doc_id"] for r in kept.select("doc_id").collect()}


def test_pipeline_on_odd_and_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id LONG, quality INT, toxic INT").write.parquet(f"{tmp_path}/labels.parquet")
    for make in (odd_documents, no_documents):
        docs = make(spark)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, str(tmp_path))
        docs.count()
