"""Small awkward tables for the tests of the training-data operators."""

from __future__ import annotations

import duckdb
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conftest import SAMPLE_DIR
from eventlake.llm import oracle, queries

DOCUMENT = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG"
CLASHES = ("fp", "known", "number", "score", "row", "token", "shard", "part", "size", "ids", "toxicity", "c", "links")

ODD_TEXTS = [
    (1, "The cat sat on the mat and the dog"), (2, "the CAT sat on the mat and the dog"), (3, None), (4, ""),
    (5, " \t\n "), (6, "one"), (7, "one two"), (8, "Ünïcödé Wörter  mit   Lücken\n\nund Zeilen"), (None, "no id here at all"),
    (None, None), (9, "word " * 30_000), (10, "x" * 5_000), (11, "日本語のテキスト 👍 ▁▁ <|endoftext|> </s>"),
    (12, "12 34 !!! ..."), (1, "The cat sat on the mat and the dog"), (13, "a\x00b \x1c c"),
]


def odd_documents(spark: SparkSession) -> DataFrame:
    """Nulls, empty and very long texts, copies, repeated ids, and columns with clashing names."""
    rows = [(i, t, "en" if i and i % 2 else None, None, None) for i, t in ODD_TEXTS]
    df = spark.createDataFrame(rows, DOCUMENT).repartition(3)
    return df.withColumns({name: F.lit("clash") for name in CLASHES})


def no_documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DOCUMENT)


def documents(spark: SparkSession, texts: list[tuple], partitions: int = 3) -> DataFrame:
    rows = [(t[0], t[1], t[2] if len(t) > 2 else None, None, None) for t in texts]
    return spark.createDataFrame(rows, DOCUMENT).repartition(partitions)


def same_as_sql(spark: SparkSession, name: str, folder: str = SAMPLE_DIR) -> None:
    """The query's rows are those of its SQL twin, run over the same tables."""
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "labels"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    found = connection.execute(oracle.all_sql()[name])
    columns = [d[0] for d in found.description]
    expected = found.fetchall()
    df = queries.all_queries()[name](spark, folder)
    assert expected and sorted(columns) == sorted(df.columns)
    got = [tuple(r[c] for c in columns) for r in df.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, expected))
