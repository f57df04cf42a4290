"""The manifest against a tree built by plain loops."""

from __future__ import annotations

import hashlib
import re
import zlib

import pytest
from cases import documents, no_documents, odd_documents, same_as_sql
from pyspark.sql import functions as F

from eventlake.llm import merkle, queries


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row, lower=False):
    out = ""
    for name in ("doc_id", "source", "lang", "n_chars", "text"):
        value = row[name]
        if value is None:
            out += "-"
            continue
        value = str(value)
        if lower and name == "text":
            value = re.sub("[A-Z]", lambda m: m.group().lower(), value)
        out += f"{len(value.encode())}:{value}"
    return H(out)


def plain_tree(hashes):
    """The node of the hashes, and for each the runs beside its path."""
    paths = [[] for _ in hashes]
    places, level = list(range(len(hashes))), list(hashes)
    while len(level) > 1:
        for i, at in enumerate(places):
            first = at // 16 * 16
            paths[i].append(("".join(level[first:at]), "".join(level[at + 1 : first + 16])))
        level = [H(*level[i : i + 16]) for i in range(0, len(level), 16)]
        places = [at // 16 for at in places]
    return level[0], paths


def plain_manifest(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append((r["doc_id"] is not None, r["doc_id"], plain_leaf(r), r))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_tree([x[2] for x in sorted(groups[s], key=lambda x: (x[0], x[1] or 0, x[2]))]) for s in names}
    root, tops = plain_tree([trees[s][0] for s in names])
    out = []
    for s, top in zip(names, tops):
        subroot, paths = trees[s]
        for (_, doc_id, leaf, row), path in zip(sorted(groups[s], key=lambda x: (x[0], x[1] or 0, x[2])), paths):
            whole = path + top
            start = plain_leaf(row, True) if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0 else leaf
            for left, right in whole:
                start = H(left, start, right)
            out.append((doc_id, leaf, subroot, root, H(*(a + b for a, b in whole)), start, start == root))
    return sorted(out, key=repr)


def query_rows(spark, df, folder):
    df.write.parquet(f"{folder}/documents.parquet")
    return sorted(map(tuple, queries.op13_manifest(spark, str(folder)).collect()), key=repr)


@pytest.fixture
def mixed(spark):
    """Sources of one row, of a run and of runs; a third of the rows is one row again and again."""
    def doc(i, source):
        return (i, f"Text {i} Of Some Length" if i % 7 else None, "en" if i % 3 else None, source, i if i % 4 else None)

    rows = [doc(1, "one"), doc(2, ""), doc(None or 3, None), doc(4, "-"), doc(5, "+"), doc(6, "Ünï"), doc(7, "\U0001f44d")]
    rows += [doc(100 + i, "run") for i in range(16)] + [doc(200 + i, "more") for i in range(17)]
    rows += [doc(1000 + i, "many") for i in range(300)] + [doc(9000 + i, f"s{i}") for i in range(20)]
    rows += [(77, "Again And Again", "en", "hot", 1)] * 180 + [(None, f"No {i % 3}", None, "hot", None) for i in range(9)]
    return spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG").repartition(5)


def test_equal_to_a_plain_tree(spark, mixed, tmp_path):
    got = query_rows(spark, mixed, tmp_path)
    assert got == plain_manifest(mixed.collect())
    assert {r[6] for r in got} == {True, False}


def test_groups_of_several_tiers(spark, mixed, tmp_path, monkeypatch):
    """With blocks of 16 rows, groups of 300 need three tiers."""
    monkeypatch.setattr(merkle, "DEPTH", 1)
    monkeypatch.setattr(merkle, "BLOCK", 16)
    assert query_rows(spark, mixed, tmp_path) == plain_manifest(mixed.collect())


def test_counts_joined_by_a_shuffle(spark, mixed):
    few = merkle.manifest(mixed, settings=merkle.Settings(broadcast_rows=0))
    got = {(r["doc_id"], r["leaf"], r["root"]) for r in few.collect()}
    assert got == {r[:2] + (r[3],) for r in plain_manifest(mixed.collect())}


def test_a_changed_document_changes_the_root(spark, mixed):
    before = merkle.manifest(mixed).first()["root"]
    changed = mixed.withColumn("lang", F.when(F.col("doc_id") == 1000, "fr").otherwise(F.col("lang")))
    assert merkle.manifest(changed).first()["root"] != before
    assert merkle.manifest(mixed.repartition(2)).first()["root"] == before


def test_odd_and_empty_tables(spark, tmp_path):
    odd = odd_documents(spark).withColumns({c: F.lit("x") for c in ("group", "rank", "hash", "total", "load", "path", "dealt", "at")})
    assert query_rows(spark, odd, tmp_path) == plain_manifest(odd.collect())
    assert merkle.manifest(no_documents(spark)).count() == 0
    one = merkle.manifest(documents(spark, [(1, "a")])).collect()
    assert len(one) == 1 and one[0]["leaf"] == one[0]["subroot"] == one[0]["root"] and one[0]["path"] == []


def test_equal_to_its_sql_twin(spark):
    same_as_sql(spark, "op13_manifest")
