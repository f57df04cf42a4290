"""Stream outputs: append to a table, or hand each micro-batch to several sinks."""

from __future__ import annotations

import logging
from collections import Counter
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventlake.functions.rows import row_hash
from eventlake.schemas import TABLES
from eventlake.sources.tables import TableStore, write_jdbc

log = logging.getLogger(__name__)

BatchSink = Callable[[DataFrame, int], None]


def _start(writer, trigger: str | None):
    """`once` reads all there is and stops; an interval polls; None runs back to back."""
    if trigger == "once":
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger) if trigger else writer


def append_to_path(
    df: DataFrame, path: str, checkpoint: str, partitions: Sequence[str] = (), trigger: str | None = None
) -> StreamingQuery:
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partitions:
        writer = writer.partitionBy(*partitions)
    return _start(writer, trigger).start(path)


def few_files(df: DataFrame, partitions: Sequence[str], files: int) -> DataFrame:
    """Bring the rows of a partition together in at most `files` tasks.

    Otherwise every task of a micro-batch writes a file of its own into every
    partition it has rows for. Rows are spread by a hash, so a partition with
    most of the rows is still written by several tasks.
    """
    spread = F.pmod(row_hash(df), F.lit(files))
    keyed = df.withColumn("_file", spread)
    return keyed.repartition(*partitions, "_file").drop("_file")


def append_to_table(
    df: DataFrame,
    store: TableStore,
    name: str,
    checkpoint: str,
    trigger: str | None = None,
    files: int | None = None,
) -> StreamingQuery:
    """Append rows to a lake table; the columns follow the table's own order.

    Without `files` there is no shuffle before the write; with it each micro-batch
    adds at most that many files to a partition.
    """
    rows = df.select(*store.columns(name))
    if files:
        rows = few_files(rows, TABLES[name].partitions, files)
    writer = (
        rows.writeStream
        .format(store.settings.provider)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    if store.settings.provider == "iceberg":
        writer = writer.option("fanout-enabled", "true")
    else:
        writer = writer.partitionBy(*TABLES[name].partitions)
    return _start(writer, trigger).toTable(store.full_name(name))


def checkpoint_key(checkpoint: str) -> Callable[[SparkSession], str]:
    """The id that Spark gave the query of this checkpoint, known from its first batch on."""
    return lambda spark: spark.read.json(f"{checkpoint.rstrip('/')}/metadata").first()["id"]


def table_sink(store: TableStore, name: str, key: Callable[[SparkSession], str], time: str) -> BatchSink:
    """Append a micro-batch to a table by day of its `time` column; a replayed batch is not added twice.

    Rows carry the id of their query and batch. A new checkpoint is a new query, so its batches start
    at 0 without touching earlier rows; a batch without rows writes nothing.
    """
    found: dict[str, str] = {}
    day = TABLES[name].partitions[0]

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if not found:
            found["id"] = key(spark)
        marked = batch.withColumns({
            "query_id": F.lit(found["id"]), "batch_id": F.lit(batch_id).cast("long"), day: F.to_date(time),
        })
        days = marked.agg(F.min(day).alias("first"), F.max(day).alias("last")).first()
        if days["first"] is None:
            return
        spark.catalog.refreshTable(store.full_name(name))
        there = spark.read.table(store.full_name(name)).filter(
            F.col(day).between(F.lit(days["first"]), F.lit(days["last"]))
            & (F.col("query_id") == found["id"]) & (F.col("batch_id") == batch_id)
        )
        if there.isEmpty():
            store.append(marked, name)

    return write


def path_sink(path: str) -> BatchSink:
    """A folder per micro-batch that has rows; a replayed batch replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def jdbc_sink(url: str, table: str, properties: dict[str, str], mode: str = "append") -> BatchSink:
    def write(batch: DataFrame, batch_id: int) -> None:
        write_jdbc(batch.withColumn("batch_id", F.lit(batch_id)), url, table, properties, mode)

    return write


def multi_sink(primary: BatchSink, *secondary: BatchSink) -> BatchSink:
    """The primary sink must succeed; a failing secondary one is logged, counted and passed over.

    The batch is kept while it is written, so that its aggregation runs once. The function that is
    returned has `failures`: failed writes by the place of the secondary sink.
    """
    failures: Counter[int] = Counter()

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            primary(batch, batch_id)
            for place, sink in enumerate(secondary):
                try:
                    sink(batch, batch_id)
                except Exception:
                    failures[place] += 1
                    log.exception("secondary sink failed for batch %s", batch_id)
        finally:
            batch.unpersist()

    write.failures = failures
    return write


def for_each_batch(
    df: DataFrame, sink: BatchSink, checkpoint: str, trigger: str | None = None
) -> StreamingQuery:
    writer = (
        df.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(sink)
    )
    return _start(writer, trigger).start()
