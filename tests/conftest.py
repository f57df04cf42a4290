from __future__ import annotations

import uuid
from datetime import date, datetime

import pytest
from pyspark.sql import SparkSession

from eventlake.config import Settings, get_spark
from eventlake.sources.tables import TableStore

SAMPLE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    base = tmp_path_factory.mktemp("lake")
    session = get_spark(
        "tests",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(base / "warehouse"),
            "spark.checkpoint.dir": str(base / "shared"),
        },
        master="local[8]",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def store(spark) -> TableStore:
    return TableStore(spark, Settings(database=f"lake_{uuid.uuid4().hex[:8]}"))


EVENT_SCHEMA = """
    event_id STRING, event_type STRING, user_id STRING, product_id STRING, product_name STRING,
    category STRING, price INT, event_timestamp TIMESTAMP, total_amount INT, event_date DATE,
    event_hour INT
"""


@pytest.fixture
def make_events(spark):
    """Rows of the events table from short tuples (id, type, user, product, time, amount)."""

    def make(rows):
        full = []
        for event_id, kind, user, product, when, amount in rows:
            t = datetime.fromisoformat(when) if when else None
            full.append((
                event_id, kind, user, product, f"name {product}", "home", 100, t, amount,
                t.date() if t else None, t.hour if t else None,
            ))
        return spark.createDataFrame(full, EVENT_SCHEMA)

    return make


def rows_of(df, *columns):
    """Rows as sorted tuples, for comparison by value."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)


def day(text: str) -> date:
    return date.fromisoformat(text)
