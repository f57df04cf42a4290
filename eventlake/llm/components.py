"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.config import remove
from eventlake.llm.common import written_at


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """node and root, the smallest node reachable, for every node that has a link (columns a, b).

    Large-star and small-star steps in turn: every node tells its neighbours the smallest node it
    knows, until each node points at its root only. The minimum is pre-aggregated before the shuffle
    and joined back, so a node with very many links is never gathered. Each round is written to the
    shared folder. The number of rounds grows with the logarithm of the longest path.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, path = written_at(edges, "links")
    state = _state(edges)
    for _ in range(rounds):
        edges, after = written_at(_small_star(_large_star(edges)), "links")
        remove(links.sparkSession, path)  # nothing reads the round before any more
        path = after
        before, state = state, _state(edges)
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    told = edges.join(least, "u")
    return told.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
        least.select("u", F.col("m").alias("v"))
    ).where("u <> v").distinct()
