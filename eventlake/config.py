"""Session, settings and scratch locations shared by every job."""

from __future__ import annotations

import os
import tempfile
import uuid
from dataclasses import dataclass, field

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class EventRoles:
    """Which event_type value plays which part in the reports."""

    search: str = "search"
    view: str = "view"
    cart: str = "add_cart"
    purchase: str = "purchase"

    @property
    def valid(self) -> tuple[str, ...]:
        return (self.search, self.view, self.cart, self.purchase)


@dataclass(frozen=True)
class Thresholds:
    """Fixed limits of the one-minute volume detector."""

    high: int = 500
    low: int = 10
    mean: float = 250.0
    stddev: float = 50.0


@dataclass(frozen=True)
class Settings:
    """Where the jobs read and write; one place, so that no two jobs disagree."""

    database: str = "commerce"
    provider: str = "parquet"
    # Folder for tables that outlive a session without a metastore; None leaves
    # the location to the catalog.
    lake_path: str | None = None
    kafka_servers: str = field(
        default_factory=lambda: os.getenv("KAFKA_BOOTSTRAP_SERVERS", "kafka:9092")
    )
    checkpoint_base: str | None = field(default_factory=lambda: os.getenv("CHECKPOINT_BASE"))
    roles: EventRoles = EventRoles()
    thresholds: Thresholds = Thresholds()


# The topics the producers write to.
TOPICS = {
    "events": "shopping-events",
    "reviews": "reviews",
    "sessions": "session-events",
    "searches": "search-queries",
}

# Without this, Spark writes timestamps as INT96, for which Parquet keeps no
# minimum and maximum: filters on time could not skip anything.
TIME_STATISTICS = ("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")

# AQE splits skewed join partitions and merges small shuffle partitions; the
# partition count itself is left to the cluster's own defaults.
SESSION_CONF = {
    TIME_STATISTICS[0]: TIME_STATISTICS[1],
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def iceberg_conf(warehouse: str, catalog: str = "iceberg") -> dict[str, str]:
    """Session settings for tables of provider iceberg; its jar must be on the classpath."""
    return {
        "spark.sql.extensions": "org.apache.iceberg.spark.extensions.IcebergSparkSessionExtensions",
        f"spark.sql.catalog.{catalog}": "org.apache.iceberg.spark.SparkCatalog",
        f"spark.sql.catalog.{catalog}.type": "hadoop",
        f"spark.sql.catalog.{catalog}.warehouse": warehouse,
    }


def s3_conf(endpoint: str, access_key: str, secret_key: str) -> dict[str, str]:
    """Session settings for an S3 compatible object store."""
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.path.style.access": "true",
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
    }


def get_spark(app: str, conf: dict[str, str] | None = None, master: str | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the session.

    Only a local session without the setting gets a folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    base = tempfile.mkdtemp(prefix="eventlake-")
    spark.conf.set("spark.checkpoint.dir", base)
    return base


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for one run's intermediate table or checkpoint."""
    return f"{shared_dir(spark)}/eventlake/{label}-{uuid.uuid4().hex}"


def _folder(spark: SparkSession, path: str):
    """The path as Hadoop's file systems know it, wherever it lies."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, files = _folder(spark, path)
    return files.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of this library's own making."""
    place, files = _folder(spark, path)
    files.delete(place, True)


def folders_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if it is not there."""
    place, files = _folder(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(place)) if files.exists(place) else []


def checkpoint_path(base: str, job: str) -> str:
    """The lasting checkpoint folder of a streaming job."""
    return f"{base.rstrip('/')}/{job}"
