"""Approximate nearest neighbours by inner product with an adaptive dimension scan.

Vectors get one component more, so that all have the same length and the largest inner product is the
smallest distance, and are turned by a random rotation, so that every few components stand for the
whole. They are kept in lists around centroids (fitted on a bounded sample; every row is indexed). A
query scans the lists it probes in blocks of columns: after each block a candidate whose partial
distance, scaled up, exceeds the query's present k-th distance by more than chance allows is given
up. The number of lists probed is set at run time so that a sample of queries, compared with all
rows, finds the wanted share of its true neighbours.

Lists are grouped into cells of about `cell_rows` rows, and a list larger than that is cut into
several, so a vector that a third of all rows repeat fills many cells, not one. Queries are dealt into
portions likewise. Each task returns its best k per query.

Defined results: vectors that are null, zero, of another length than most, or hold null or non-finite
components, and rows without an id, take no part; with k or fewer candidates all are returned; rows
that repeat an id are all candidates, are searched for once, and are never each other's neighbours;
ties go to the smaller id. Only the id and the vector are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.common import drawn, matrix, usable_vector, written


@dataclass(frozen=True)
class Settings:
    """Production parameters: `fit_rows` and `trial_queries` bound the samples."""

    list_rows: int = 200
    most_lists: int = 4096
    fit_rows: int = 16_384
    trial_queries: int = 128
    recall: float = 0.97
    cell_rows: int = 8192
    query_rows: int = 4096
    broadcast_cells: int = 1_000_000
    block: int = 16
    doubt: float = 2.1
    rounds: int = 8
    seed: int = 3


@dataclass
class Index:
    rotation: np.ndarray  # of vectors with the added component
    reach: float  # largest squared length
    centroids: np.ndarray
    probes: int = 0
    cell_of: np.ndarray | None = None  # per list: first cell
    parts: np.ndarray | None = None  # per list: cells it fills

    def lifted(self, x: np.ndarray, query: bool) -> np.ndarray:
        """Rotated vectors with the component that makes the lengths of stored rows equal."""
        if query:
            more = np.zeros(len(x))
        else:
            more = np.sqrt(np.maximum(self.reach - np.einsum("ij,ij->i", x, x), 0))
        return (np.column_stack([x, more]) @ self.rotation).astype(np.float32)

    def nearest_lists(self, lifted: np.ndarray, n: int) -> np.ndarray:
        """The n nearest lists of each row, nearest first."""
        far = (self.centroids**2).sum(axis=1) - 2 * lifted @ self.centroids.T
        n = min(n, far.shape[1])
        if n == 1:
            return far.argmin(axis=1)[:, None]
        return np.argsort(far, axis=1, kind="stable")[:, :n]


def _fit(sample: np.ndarray, reach: float, lists: int, s: Settings) -> Index:
    """Rotation and centroids by Lloyd's rounds."""
    rng = np.random.default_rng(s.seed)
    rotation, _ = np.linalg.qr(rng.normal(size=(sample.shape[1] + 1,) * 2))
    index = Index(rotation, reach, np.zeros((0, 0), np.float32))
    x = index.lifted(sample, query=False)
    index.centroids = x[rng.permutation(len(x))[: min(lists, len(x))]].copy()
    for _ in range(s.rounds):
        own = index.nearest_lists(x, 1)[:, 0]
        sums = np.zeros_like(index.centroids)
        np.add.at(sums, own, x)
        n = np.bincount(own, minlength=len(sums))
        index.centroids[n > 0] = sums[n > 0] / n[n > 0, None]
    return index


def _best(query: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of each query's k best, by score, then id."""
    order = np.lexsort((ids, -score, query))
    q = query[order]
    first = np.concatenate([[True], q[1:] != q[:-1]]) if len(q) else np.zeros(0, bool)
    began = np.maximum.accumulate(np.where(first, np.arange(len(q)), 0))
    return order[np.arange(len(q)) - began < k]


def scan(index: Index, queries: np.ndarray, query_ids: np.ndarray, probed: np.ndarray, rows: np.ndarray, ids: np.ndarray, lists: np.ndarray, k: int, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best k rows of each query among the rows of the lists it probes: positions and exact scores.

    `probed` tells for every query and distinct list (in the order of np.unique(lists)) whether it is
    scanned.
    """
    q, x = index.lifted(queries, True), index.lifted(rows, False)
    names, place = np.unique(lists, return_inverse=True)
    size = q.shape[1]
    lengths = np.einsum("ij,ij->i", queries, queries) + index.reach
    some = np.random.default_rng(s.seed).permutation(len(rows))[: 8 * k]
    found = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]

    def keep(qi, ri):
        other = query_ids[qi] != ids[ri]
        qi, ri = qi[other], ri[other]
        score = np.einsum("ij,ij->i", queries[qi], rows[ri])
        joined = [np.concatenate(pair) for pair in zip(found, (qi, ri, score))]
        best = _best(joined[0], joined[2], ids[joined[1]], k)
        found[:] = [c[best] for c in joined]

    def limits():
        n = np.bincount(found[0], minlength=len(q))
        worst = np.full(len(q), np.inf)
        np.minimum.at(worst, found[0], found[2])
        # a little slack for single precision
        return np.where(n >= k, (lengths - 2 * worst) * (1 + 1e-5) + 1e-6, np.inf)

    # a first bound from a few rows of lists that the query probes anyway
    qi, at = np.nonzero(probed[:, place[some]])
    keep(qi, some[at])
    held = np.zeros(len(rows), bool)
    held[some] = True
    for number in range(len(names)):
        members = np.flatnonzero((place == number) & ~held)
        asking = np.flatnonzero(probed[:, number])
        if not len(members) or not len(asking):
            continue
        limit = limits()[asking].astype(np.float32)
        part = np.zeros((len(asking), len(members)), np.float32)
        alive = np.ones_like(part, bool)
        pairs = None
        for start in range(0, size, s.block):
            stop = min(start + s.block, size)
            bound = limit * np.float32(stop / size * (1 + (s.doubt / stop**0.5 if stop < size else 0)) ** 2)
            if pairs is None:
                a, b = q[asking, start:stop], x[members, start:stop]
                part += (a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1) - 2 * a @ b.T
                alive &= part <= bound[:, None]
                if alive.sum() < 0.25 * alive.size or stop == size:
                    pairs = np.nonzero(alive)
                    sums = part[pairs]
            else:
                gap = q[asking[pairs[0]], start:stop] - x[members[pairs[1]], start:stop]
                sums = sums + np.einsum("ij,ij->i", gap, gap)
                near = sums <= bound[pairs[0]]
                pairs, sums = (pairs[0][near], pairs[1][near]), sums[near]
        keep(asking[pairs[0]], members[pairs[1]])
    return found[0], found[1], found[2]


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, vector: str = "embedding", key: str = "vec_id", settings: Settings = Settings()) -> DataFrame:
    """query_id, rank, vec_id and score: the k nearest found of each query among `vectors`."""
    s, spark = settings, vectors.sparkSession
    plain = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("v")).where(usable_vector("v") & F.col("vec_id").isNotNull())
    shape = plain.groupBy(F.size("v").alias("size")).agg(
        F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))).alias("reach")
    ).orderBy(F.desc("n"), "size").first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if shape is None:
        return empty
    plain = plain.where(F.size("v") == shape["size"])
    asked = (
        queries.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("v"))
        .where(usable_vector("v") & F.col("vec_id").isNotNull() & (F.size("v") == shape["size"])).dropDuplicates(["vec_id"])
    )
    sample = matrix([r["v"] for r in drawn(plain, "vec_id", s.fit_rows, shape["n"]).collect()])
    lists = int(min(s.most_lists, max(1, shape["n"] // s.list_rows)))
    index = _fit(sample, shape["reach"], lists, s)
    listed = written(_listed(plain, index), "lists")
    asked = written(asked, "asked")
    index.probes = _probes(listed, asked, index, k, s)
    sizes = {r["list"]: r["count"] for r in listed.groupBy("list").count().collect()}  # a row per list
    _lay_cells(index, sizes, s)
    shared = spark.sparkContext.broadcast(index)  # bounded by `most_lists` centroids

    def deal_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = shared.value
        for b in batches:
            own, ids = b.column("list").to_numpy(), b.column("vec_id").to_numpy()
            cell = ix.cell_of[own] + ids % ix.parts[own]
            yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), *(b.column(n) for n in ("list", "vec_id", "v"))], names=["cell", "list", "vec_id", "v"])

    def deal_queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = shared.value
        for b in batches:
            if not b.num_rows:
                continue
            near = ix.nearest_lists(ix.lifted(matrix(b.column("v")), True), ix.probes)
            at, cell = [], []
            for row, names in enumerate(near):
                met = np.unique(np.concatenate([np.arange(ix.cell_of[n], ix.cell_of[n] + ix.parts[n]) for n in names]))
                at.append(np.full(len(met), row))
                cell.append(met)
            at, cell = np.concatenate(at), np.concatenate(cell).astype(np.int32)
            taken = b.select(["vec_id", "v"]).take(pa.array(at))
            yield pa.RecordBatch.from_arrays([pa.array(cell), *taken.columns], names=["cell", "vec_id", "v"])

    kind = dict(plain.dtypes)["v"]
    probing = written(asked.mapInArrow(deal_queries, f"cell int, vec_id long, v {kind}"), "probing")
    # a cell is dealt into as many portions as the queries that probe it fill, so its rows are copied for no others
    portions = written(probing.groupBy("cell").agg(F.ceil(F.count("*") / s.query_rows).cast("int").alias("portions")), "portions")
    if portions.count() <= s.broadcast_cells:
        portions = F.broadcast(portions)
    left = listed.mapInArrow(deal_rows, f"cell int, list int, vec_id long, v {kind}").join(portions, "cell").select(
        "cell", F.explode(F.sequence(F.lit(0), F.col("portions") - 1)).alias("portion"), "list", "vec_id", "v"
    )
    right = probing.join(portions, "cell").select(
        "cell", F.pmod(F.xxhash64("vec_id"), F.col("portions")).cast("int").alias("portion"), "vec_id", "v"
    )

    def compare(rows: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(wanted):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        ix = shared.value
        qs, xs, own = matrix(wanted["v"].tolist()), matrix(rows["v"].tolist()), rows["list"].to_numpy()
        names = np.unique(own)
        near = ix.nearest_lists(ix.lifted(qs, True), ix.probes)
        probed = np.zeros((len(qs), len(ix.centroids)), bool)
        np.put_along_axis(probed, near, True, axis=1)
        qi, ri, score = scan(ix, qs, wanted["vec_id"].to_numpy(), probed[:, names], xs, rows["vec_id"].to_numpy(), own, k, s)
        return pd.DataFrame({"query_id": wanted["vec_id"].to_numpy()[qi], "vec_id": rows["vec_id"].to_numpy()[ri], "score": score})

    near = left.groupBy("cell", "portion").cogroup(right.groupBy("cell", "portion")).applyInPandas(compare, "query_id long, vec_id long, score double")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return near.withColumn("rank", place.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _listed(plain: DataFrame, index: Index) -> DataFrame:
    shared = plain.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = shared.value.nearest_lists(shared.value.lifted(matrix(b.column("v")), False), 1)[:, 0] if b.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), b.column("vec_id"), b.column("v")], names=["list", "vec_id", "v"])

    return plain.mapInArrow(run, f"list int, vec_id long, v {dict(plain.dtypes)['v']}")


def _probes(listed: DataFrame, asked: DataFrame, index: Index, k: int, s: Settings) -> int:
    """Lists to probe so that the wanted share of a sample's true neighbours lies in them."""
    trial = drawn(asked, "vec_id", s.trial_queries, asked.count()).collect()
    if not trial:
        return 1
    ids, vectors = np.array([r["vec_id"] for r in trial]), matrix([r["v"] for r in trial])

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64)]
        for b in batches:
            if not b.num_rows:
                continue
            own = b.column("vec_id").to_numpy()
            score = vectors @ matrix(b.column("v")).T
            score[ids[:, None] == own] = -np.inf
            top = np.argpartition(-score, min(k, score.shape[1]) - 1, axis=1)[:, :k]
            q = np.repeat(np.arange(len(ids)), top.shape[1])
            flat = top.ravel()
            new = (q, score[q, flat], own[flat], b.column("list").to_numpy()[flat].astype(np.int64))
            held = [np.concatenate(p) for p in zip(held, new)]
            kept = _best(held[0], held[1], held[2], k)
            held = [h[kept] for h in held]
        kinds = (pa.int64(), pa.float64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(h, t) for h, t in zip(held, kinds)], names=["q", "score", "vec_id", "list"])

    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))
    rows = (
        listed.mapInArrow(best, "q long, score double, vec_id long, list long").where(f"score > {float(np.finfo(np.float64).min)}")
        .withColumn("at", place).where(F.col("at") <= k).select("q", "list").collect()  # k rows per trial query
    )
    if not rows:
        return 1
    order = index.nearest_lists(index.lifted(vectors, True), len(index.centroids))
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(order.shape[1])[None], axis=1)
    need = np.sort([rank[r["q"], r["list"]] for r in rows])
    return int(need[min(len(need) - 1, int(np.ceil(s.recall * len(need))))]) + 1


def _lay_cells(index: Index, sizes: dict[int, int], s: Settings) -> None:
    """Lists in a row until a cell is full; a larger list gets cells of its own."""
    n = len(index.centroids)
    index.cell_of, index.parts = np.zeros(n, np.int64), np.ones(n, np.int64)
    cell, held = 0, 0
    for i in range(n):
        size = sizes.get(i, 0)
        if size > s.cell_rows:
            cell += held > 0
            index.parts[i] = -(-size // s.cell_rows)
            index.cell_of[i] = cell
            cell, held = cell + int(index.parts[i]), 0
            continue
        if held + size > s.cell_rows:
            cell, held = cell + 1, 0
        index.cell_of[i] = cell
        held += size
