"""Message sources. Every one yields a `value` column with one JSON message per row."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Source:
    """What to read: kafka in production, folders of JSON lines for replays."""

    format: str
    options: Mapping[str, str] = field(default_factory=dict)
    path: str | None = None
    schema: str | None = None


def kafka_source(
    servers: str, topic: str, starting: str = "latest", fail_on_data_loss: bool = False,
    most_offsets: int | None = None, least_partitions: int | None = None,
) -> Source:
    """A topic. `most_offsets` bounds a micro-batch, so that a start from earliest is not one batch."""
    rates = {"maxOffsetsPerTrigger": most_offsets, "minPartitions": least_partitions}
    return Source("kafka", {
        **{k: str(v) for k, v in rates.items() if v is not None},
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    })


def json_lines_source(path: str, files_per_batch: int | None = None) -> Source:
    """A folder of text files. Kept as text, so that a malformed line reaches the parser."""
    options = {"maxFilesPerTrigger": str(files_per_batch)} if files_per_batch else {}
    return Source("text", options, path)


def heartbeat_source(rows_per_second: int = 1) -> Source:
    """The current time, again and again. After a stop the missed seconds come first."""
    return Source("rate", {"rowsPerSecond": str(rows_per_second)})


def read_heartbeats(spark: SparkSession, source: Source) -> DataFrame:
    return read_stream(spark, source).select(F.col("timestamp").alias("event_timestamp"))


def read_stream(spark: SparkSession, source: Source) -> DataFrame:
    reader = spark.readStream.format(source.format).options(**source.options)
    if source.schema:
        reader = reader.schema(source.schema)
    return reader.load(source.path) if source.path else reader.load()


def read_batch(spark: SparkSession, source: Source) -> DataFrame:
    """The same messages as a bounded table, for backfills."""
    rates = ("maxFilesPerTrigger", "maxOffsetsPerTrigger")
    options = {k: v for k, v in source.options.items() if k not in rates}
    if options.get("startingOffsets") == "latest":
        options["startingOffsets"] = "earliest"
    reader = spark.read.format(source.format).options(**options)
    if source.schema:
        reader = reader.schema(source.schema)
    return reader.load(source.path) if source.path else reader.load()
