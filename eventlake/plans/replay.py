"""Run a streaming query over a table that is already there, and read back what it wrote."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from eventlake.config import scratch_path
from eventlake.sources.streams import Source, read_stream
from eventlake.streaming import sinks


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as a stream. A stream takes folders or globs, and the table may be one file."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    return read_stream(spark, Source("parquet", path=f"{sf_dir}/{name}.parque[t]", schema=schema.toDDL()))


def finish(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def replay(df: DataFrame, label: str, partitions: Sequence[str] = ()) -> DataFrame:
    """Append the stream's rows to a fresh table until the source is used up."""
    run = scratch_path(df.sparkSession, label)
    finish(sinks.append_to_path(df, f"{run}/rows", f"{run}/checkpoint", partitions, trigger="once"))
    return df.sparkSession.read.schema(df.schema).parquet(f"{run}/rows")


def replay_batches(
    df: DataFrame, label: str, sink: Callable[[str], sinks.BatchSink], schema: str
) -> DataFrame:
    """The same through foreachBatch; the sink is made for the path it writes to."""
    run = scratch_path(df.sparkSession, label)
    # batches without rows write nothing, and all of them may be so
    df.sparkSession.createDataFrame([], schema).write.parquet(f"{run}/rows/batch_id=-1")
    finish(sinks.for_each_batch(df, sink(run), f"{run}/checkpoint", trigger="once"))
    return df.sparkSession.read.schema(schema).parquet(f"{run}/rows").drop("batch_id")
