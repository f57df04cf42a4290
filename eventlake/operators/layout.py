"""Comparison of data layouts: the same rows, written in different orders."""

from __future__ import annotations

import math
import time
from collections.abc import Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.config import TIME_STATISTICS
from eventlake.functions.rows import row_hash


@dataclass(frozen=True)
class Layout:
    name: str
    sort_keys: tuple[str, ...] = ()


# The three layouts and the four queries that are compared.
LAYOUTS = (
    Layout("events_unsorted"),
    Layout("events_sorted_time", ("event_timestamp",)),
    Layout("events_sorted_product", ("product_id", "event_timestamp")),
)
QUERIES = {
    "time_range": """
        SELECT count(*) AS n, sum(price) AS total FROM {table}
        WHERE event_timestamp BETWEEN :day_from AND :day_to
    """,
    "product_lookup": """
        SELECT count(*) AS n, sum(price) AS total FROM {table}
        WHERE product_id = :product
    """,
    "product_time_range": """
        SELECT count(*) AS n, sum(price) AS total FROM {table}
        WHERE product_id = :product AND event_timestamp BETWEEN :month_from AND :month_to
    """,
    "aggregation": """
        SELECT category, count(*) AS n, sum(price) AS total FROM {table} GROUP BY category
    """,
}
UNSORTED_PARTITIONS = 200  # default of spark.shuffle.sort.bypassMergeThreshold
START_SECONDS = 1_609_459_200  # 2021-01-01T00:00:00Z


def synthetic_events(spark: SparkSession, n: int, seed: int = 42, step_seconds: int = 1) -> DataFrame:
    """n events, one per step from 2021 on, in an order unrelated to time or product."""
    i = F.col("id")
    rows = spark.range(n).select(
        i.cast("string").alias("event_id"),
        (i % 4).cast("string").alias("event_type"),
        (i % 100_000).cast("string").alias("user_id"),
        (i % 10_000).cast("string").alias("product_id"),
        (i % 5).cast("string").alias("category"),
        (F.rand(seed) * 1_000_000).cast("int").alias("price"),
        F.timestamp_seconds(i * step_seconds + START_SECONDS).alias("event_timestamp"),
    )
    mixed = rows.withColumn("_order", F.xxhash64("event_id"))
    shuffled = mixed.repartition("_order").sortWithinPartitions("_order").drop("_order")
    return shuffled.withColumn("event_date", F.to_date("event_timestamp"))


@contextmanager
def _time_statistics(spark: SparkSession) -> Iterator[None]:
    key, value = TIME_STATISTICS
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def write_layouts(
    df: DataFrame, path: str, layouts: Iterable[Layout] = LAYOUTS, files: int | None = None,
    file_rows: int = 500_000, most_rows: int = 1_500_000,
) -> dict[str, float]:
    """Write each layout under the path; returns the seconds each took.

    Sorted layouts are range partitioned first, so every file covers a narrow
    key range of its own and a filter on the keys skips the others. Rows with
    equal keys are told apart by a hash, so that a key with a large share of all
    rows is cut into several files too. Without `files`, a file holds about
    `file_rows` rows whatever the session's number of partitions is, so that a
    task sorts in its memory. Up to UNSORTED_PARTITIONS the writing side of the
    shuffle sorts nothing; larger tables have larger files first, of `most_rows`
    rows at most, and only then more of them.
    """
    seconds, layouts = {}, list(layouts)
    ranges = files
    if not ranges and any(layout.sort_keys for layout in layouts):
        rows = df.count()
        ranges = max(1, min(math.ceil(rows / file_rows), UNSORTED_PARTITIONS), math.ceil(rows / most_rows))
    for layout in layouts:
        out = df
        if layout.sort_keys:
            # two bytes cut a key finely enough, and no more than these are carried through the shuffle
            spread = df.withColumn("_spread", F.shiftright(row_hash(df), 48).cast("smallint"))
            out = spread.repartitionByRange(ranges, *layout.sort_keys, "_spread").sortWithinPartitions(*layout.sort_keys).drop("_spread")
        elif files:
            out = df.repartition(files)
        started = time.perf_counter()
        with _time_statistics(df.sparkSession):
            out.write.mode("overwrite").parquet(f"{path}/{layout.name}")
        seconds[layout.name] = time.perf_counter() - started
    return seconds


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None) -> None:
    """Keep the rows as a table of buckets by the key, sorted by it.

    Tables with the same key and number of buckets are joined and aggregated by it without an exchange: the
    shuffle is paid once, when the table is written. Rows are brought to their bucket before the write, so
    that a bucket is one sorted file. A key with a large share of the
    rows makes a large bucket; such facts are joined by `joins.join_dimension` instead.
    """
    sorted_rows = df.repartition(buckets, key).sortWithinPartitions(key)
    writer = sorted_rows.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
    if path:
        writer = writer.option("path", path)
    with _time_statistics(df.sparkSession):
        writer.saveAsTable(table)


def layout_query(spark: SparkSession, name: str, table: DataFrame, parameters: Mapping[str, object]) -> DataFrame:
    text = QUERIES[name]
    used = {k: v for k, v in parameters.items() if f":{k}" in text}
    return spark.sql(text, args=used or None, table=table)


def time_layouts(
    spark: SparkSession,
    path: str,
    parameters: Mapping[str, object],
    layouts: Sequence[Layout] = LAYOUTS,
    queries: Sequence[str] = tuple(QUERIES),
    load_seconds: Mapping[str, float] | None = None,
    runs: int = 3,
) -> DataFrame:
    """Mean seconds of each query on each layout, after one warm-up."""
    measured = []
    for query in queries:
        for layout in layouts:
            table = spark.read.parquet(f"{path}/{layout.name}")
            layout_query(spark, query, table, parameters).collect()
            started = time.perf_counter()
            for _ in range(runs):
                layout_query(spark, query, table, parameters).collect()
            seconds = (time.perf_counter() - started) / runs
            measured.append((query, layout.name, seconds, (load_seconds or {}).get(layout.name)))
    rows = spark.createDataFrame(
        measured,
        "query_name STRING, table_name STRING, execution_time_seconds DOUBLE, load_time_seconds DOUBLE",
    )
    return rows.select(F.current_timestamp().alias("run_timestamp"), "*")


def layout_report(timings: DataFrame, layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """Seconds per layout side by side, the best sorted layout and its gain in percent."""
    names = [layout.name for layout in layouts]
    base, *sorted_names = names
    wide = timings.groupBy("query_name").pivot("table_name", names).agg(F.first("execution_time_seconds"))
    best = F.array_min(F.array(*[F.struct(F.col(c).alias("s"), F.lit(c).alias("name")) for c in sorted_names]))
    return wide.withColumns({
        "best_layout": best["name"],
        "improvement_pct": F.round(F.try_divide((F.col(base) - best["s"]) * 100, F.col(base)), 1),
    })


def _meets(column: str, low: Column, high: Column) -> Column:
    """Whether the value range of a file meets a range, as an aggregate over its rows.

    Its minimum is at most `high` if any value is, and its maximum at least `low` likewise. Counts are aggregated by
    hash, whereas a minimum of strings would have every row sorted by its file.
    """
    return (F.count_if(F.col(column) <= high) > 0) & (F.count_if(F.col(column) >= low) > 0)


def rows_met(table: DataFrame, column: str, low: Column, high: Column) -> DataFrame:
    """All rows, and the rows within the range among the files whose value range meets it."""
    per_file = table.groupBy("_metadata.file_path").agg(
        _meets(column, low, high).alias("touched"), F.count("*").alias("n"),
        F.count_if(F.col(column).between(low, high)).alias("meets"),
    )
    return per_file.agg(F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("touched"), F.col("meets"))), F.lit(0)).alias("meets"))


def files_touched(table: DataFrame, column: str, low: object, high: object) -> DataFrame:
    """Files and bytes whose value range meets the filter range, against all of them."""
    per_file = table.groupBy("_metadata.file_path", "_metadata.file_size").agg(
        _meets(column, F.lit(low), F.lit(high)).alias("touched")
    )
    return per_file.agg(
        F.count("*").alias("files"),
        F.count_if("touched").alias("files_touched"),
        F.sum("file_size").alias("bytes"),
        F.coalesce(F.sum(F.when(F.col("touched"), F.col("file_size"))), F.lit(0)).alias("bytes_touched"),
    )


def layout_files(spark: SparkSession, path: str, filters: Mapping[str, tuple], layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """Files and bytes that each filter (query name -> column, low, high) touches on each layout, as stored with the timings."""
    found = [
        files_touched(spark.read.parquet(f"{path}/{layout.name}"), *bounds).select(
            F.current_timestamp().alias("run_timestamp"), F.lit(query).alias("query_name"), F.lit(layout.name).alias("table_name"), "*"
        )
        for query, bounds in filters.items() for layout in layouts
    ]
    return reduce(DataFrame.unionByName, found)
