"""Near-duplicate vectors: an exact metric range join through pivots.

Cosine of at least c between vectors is a distance of at most sqrt(2 - 2c) between their directions.
Every vector belongs to the cell of its nearest pivot. By the triangle inequality, a vector can have
a partner in another cell only if its distance to that cell's pivot is at most twice the range above
the distance to its own, so it is copied to those cells and to no others. Then a cell holds all
partners of its own vectors and is joined alone. Links are counted at the cell that owns a vector,
once for each partner.

Pivots are as many as leave the fewest pairs to compare, by a bounded sample, with the copies per vector
below a limit; data without clusters get one cell per label. Equal vectors meet as one row with a count. A cell of more
than `block_rows` rows is dealt into blocks that meet two by two, each pair in its own task, so one
label, cell or crowd of near copies can hold any share of the rows. Tasks emit counts and a spanning
forest of their links, never all pairs.

Defined results: vectors without a label, and vectors that are null, zero, or hold null or non-finite
components, link with nothing; nor do vectors of different lengths. A row without an id links with
nothing and is not kept. Rows that repeat an id are one node: what any of their vectors links with
counts for all of them, but they are no partners of each other unless their vectors are equal. Only
the id, the vector and the label are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import drawn, matrix, usable_vector, written
from eventlake.llm.components import components


@dataclass(frozen=True)
class Settings:
    """Production parameters; `sample_rows` bounds the vectors that pivots are chosen from."""

    sample_rows: int = 4096
    most_pivots: int = 256
    rows_per_pivot: int = 32
    copies: float = 3.0
    block_rows: int = 4096
    chunk: int = 512


def _pivots(sample: np.ndarray, wanted: int, reach: float, copies: float) -> np.ndarray:
    """Farthest-first directions, as many as leave the smallest share of all pairs to be compared.

    That share is estimated on the sample: a cell compares its own vectors with all that are copied to it.
    Counts that copy a vector more than `copies` times on average are left out, and where the best count
    saves less than a fifth, one pivot is kept.
    """
    chosen = [0]
    gaps = np.linalg.norm(sample - sample[0], axis=1)
    while len(chosen) < min(wanted, len(sample)) and gaps.max() > reach:
        chosen.append(int(gaps.argmax()))
        gaps = np.minimum(gaps, np.linalg.norm(sample - sample[chosen[-1]], axis=1))
    far = np.sqrt(np.maximum(2 - 2 * sample @ sample[chosen].T, 0))
    best, count = 0.8, 1
    n = 2
    while n <= len(chosen):
        own = far[:, :n]
        member = own <= own.min(axis=1, keepdims=True) + 2 * reach
        home = np.bincount(own.argmin(axis=1), minlength=n)
        share = float((home * member.sum(axis=0)).sum()) / len(sample) ** 2
        if member.sum(axis=1).mean() <= copies and share < best:
            best, count = share, n
        n = len(chosen) if n < len(chosen) < 2 * n else 2 * n
    return sample[chosen[:count]]


def _directions(x: np.ndarray) -> np.ndarray:
    # scaled first, so that squares neither overflow nor vanish
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def linked(vectors: DataFrame, least: float = 0.98, vector: str = "embedding", key: str = "vec_id", label: str = "label", settings: Settings = Settings()) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row."""
    s = settings
    plain = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("v"), F.col(label).alias("label"))
    ready = usable_vector("v") & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    classes = written(
        plain.where(ready).groupBy("label", "v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("same"))
        .withColumn("size", F.size("v")),
        "classes",
    )
    found = _join(classes, least, s)
    counts = found.where("other IS NULL").groupBy("rep").agg(F.sum("links").alias("links"))
    roots = components(found.where("other IS NOT NULL").select(F.col("rep").alias("a"), F.col("other").alias("b")))
    named = (
        classes.select("label", "v", "rep", "same").join(counts, "rep", "left")
        .join(roots.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            "label", "v", (F.col("same") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("root", "rep").alias("component_id"),
        )
    )
    alone = plain.where(~ready).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    joined = plain.where(ready).join(named, ["label", "v"]).select("vec_id", "n_links", "component_id")
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    return joined.unionByName(alone).select("vec_id", "n_links", "component_id", kept.alias("kept"))


def _join(classes: DataFrame, least: float, s: Settings) -> DataFrame:
    """Rows (rep, other, links): partners counted for rep, or with `other` a link of a forest."""
    spark = classes.sparkSession
    reach = float(np.sqrt(max(2 - 2 * least, 0))) + 1e-7
    total = classes.count()
    pivots: dict[int, np.ndarray] = {}
    for row in classes.groupBy("size").count().orderBy(F.desc("count")).limit(16).collect():
        sample = drawn(classes.where(F.col("size") == row["size"]), "rep", s.sample_rows, row["count"])
        x = _directions(matrix([r["v"] for r in sample.select("v").collect()]))
        pivots[row["size"]] = _pivots(x, min(s.most_pivots, max(1, total // s.rows_per_pivot)), reach, s.copies)
    shared = spark.sparkContext.broadcast(pivots)  # bounded by `most_pivots`
    kind, label = dict(classes.dtypes)["v"], dict(classes.dtypes)["label"]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes = b.column("size").to_numpy()
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                part = b.take(pa.array(rows))
                own = shared.value.get(int(size))
                if own is None or len(own) == 1:
                    at, cell, home = np.arange(len(rows)), np.zeros(len(rows), np.int32), np.ones(len(rows), bool)
                else:
                    far = np.sqrt(np.maximum(2 - 2 * _directions(matrix(part.column("v"))) @ own.T, 0))
                    nearest = far.argmin(axis=1)
                    at, cell = np.nonzero(far <= far.min(axis=1, keepdims=True) + 2 * reach)
                    home = cell == nearest[at]
                taken = part.take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [*(taken.column(n) for n in ("label", "size")), pa.array(cell.astype(np.int32)), pa.array(home), *(taken.column(n) for n in ("rep", "same", "v"))],
                    names=["label", "size", "cell", "home", "rep", "same", "v"],
                )

    schema = f"label {label}, size int, cell int, home boolean, rep long, same long, v {kind}"
    dealt = written(classes.select("label", "size", "rep", "same", "v").mapInArrow(deal, schema), "cells")
    place = ["label", "size", "cell"]
    blocks = dealt.groupBy(*place).agg(F.ceil(F.count("*") / s.block_rows).cast("int").alias("blocks"))
    spread = dealt.join(blocks, place).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    # every row waits in its block for the vectors owned by the cell, which go to all blocks
    waiting = spread.select(*place, F.lit(False).alias("asks"), F.explode(every).alias("i"), F.col("block").alias("j"), "rep", "same", "v")
    asking = spread.where("home").select(*place, F.lit(True).alias("asks"), F.col("block").alias("i"), F.explode(every).alias("j"), "rep", "same", "v")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        asks = group["asks"].to_numpy()
        a, b = group[asks], group[~asks]
        return _block(a, b, least, s.chunk) if len(a) and len(b) else _rows([], [], [])

    return written(
        waiting.unionByName(asking).groupBy(*place, "i", "j").applyInPandas(compare, "rep long, other long, links long"), "found"
    )


def _rows(rep, other, links) -> pd.DataFrame:
    return pd.DataFrame({"rep": pd.array(rep, "Int64"), "other": pd.array(other, "Int64"), "links": pd.array(links, "Int64")})


def _block(asking: pd.DataFrame, waiting: pd.DataFrame, least: float, chunk: int) -> pd.DataFrame:
    """Counts for the asking vectors, and links that connect all that are linked here."""
    x, y = _directions(matrix(asking["v"].tolist())), _directions(matrix(waiting["v"].tolist()))
    ids, others, same = asking["rep"].to_numpy(), waiting["rep"].to_numpy(), waiting["same"].to_numpy()
    names, at = np.unique(np.concatenate([ids, others]), return_inverse=True)
    group = np.arange(len(names))
    counts = np.zeros(len(ids), np.int64)
    links: list[tuple[int, int]] = []
    for start in range(0, len(x), chunk):
        near = (x[start : start + chunk] @ y.T >= least) & (ids[start : start + chunk, None] != others[None])
        counts[start : start + chunk] = near @ same
        for i in np.flatnonzero(near.any(axis=1)):
            here = at[len(ids) :][near[i]]
            met, first = np.unique(group[here], return_index=True)
            new = met != group[at[start + i]]
            if new.any():
                links.extend((int(ids[start + i]), int(names[j])) for j in here[first[new]])
                group[np.isin(group, met)] = group[at[start + i]]
    has = counts > 0
    return pd.concat([
        _rows(ids[has], [None] * int(has.sum()), counts[has]),
        _rows([a for a, _ in links], [b for _, b in links], [None] * len(links)),
    ])
