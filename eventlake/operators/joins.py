"""Enrichment of facts with a dimension table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.functions.rows import row_hash

# Catalyst takes the size of the files, and compressed columns grow several times
# in memory: the limit leaves room for that.
BROADCAST_LIMIT = 32 * 1024 * 1024
HOT_ROWS = 5_000_000


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's estimate of the size of a result, None where it is not to be had."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except AttributeError:
        return None


def join_dimension(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    how: str = "left",
    broadcast_limit: int = BROADCAST_LIMIT,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Add the dimension's columns to the facts.

    A dimension estimated below the limit is broadcast. A larger one is joined
    by shuffle, with the keys that too many facts share spread over several
    partitions. `hot_rows=None` says that no key has many facts, as after an
    aggregation by key, and saves the search for such keys.
    """
    size = estimated_bytes(dimension)
    if size is not None and size <= broadcast_limit:
        return facts.join(F.broadcast(dimension), key, how)
    if hot_rows is None or facts.isStreaming:
        return facts.join(dimension, key, how)
    return salted_join(facts, dimension, key, how, hot_rows)


def bucketed_join(facts: DataFrame, dimension: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join two tables that were written in equal buckets by the key, bucket by bucket."""
    return facts.join(dimension.hint("merge"), key, how)


def salted_join(
    facts: DataFrame, dimension: DataFrame, key: str, how: str = "left", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Shuffle join in which no key brings more than about `hot_rows` facts to a task.

    A hot key gets one salt per `hot_rows` facts, and its dimension row one copy
    per salt. There are at most (facts / hot_rows) hot keys, which keeps the
    broadcast list of them short by construction.
    """
    if how not in ("left", "inner"):
        raise ValueError("facts may only be joined left or inner")
    hot = (
        facts.groupBy(key).agg(F.count("*").alias("_facts"))
        .filter((F.col("_facts") > hot_rows) & F.col(key).isNotNull())
        .select(key, F.ceil(F.col("_facts") / hot_rows).cast("int").alias("_salts"))
    )
    spread = row_hash(facts)
    salts = F.when(F.col(key).isNull(), F.lit(1 << 20)).otherwise(F.coalesce("_salts", F.lit(1)))
    left = (
        facts.join(F.broadcast(hot), key, "left")
        .withColumn("_salt", F.pmod(spread, salts).cast("int"))
        .drop("_salts")
    )
    right = (
        dimension.join(F.broadcast(hot), key, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)))
        .drop("_salts")
    )
    return left.join(right, [key, "_salt"], how).drop("_salt")
