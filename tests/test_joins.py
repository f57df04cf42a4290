from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from eventlake.operators import joins


@pytest.fixture
def facts(spark):
    """A third of all facts share one key; some are equal in every column; some have none."""
    hot = [(1, "same")] * 400
    others = [(k, f"v{i}") for i, k in enumerate([None, 2, 3, 4, 5, 99] * 130)]
    return spark.createDataFrame(hot + others, "k INT, v STRING").repartition(5)


@pytest.fixture
def dimension(spark):
    return spark.createDataFrame([(k, f"name {k}") for k in range(1, 6)] + [(None, "none")], "k INT, name STRING")


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("hot_rows", [1, 37, 10_000])
def test_salted_join_equals_plain_join(facts, dimension, how, hot_rows):
    salted = joins.salted_join(facts, dimension, "k", how, hot_rows)
    plain = facts.join(dimension, "k", how)
    assert rows_of(salted, "k", "v", "name") == rows_of(plain, "k", "v", "name")


def test_copies_of_a_hot_row_are_spread(facts, dimension, monkeypatch):
    salted = joins.salted_join(facts, dimension, "k", hot_rows=50)
    plan = salted._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan
    spread = facts.filter("k = 1").withColumn(
        "s", F.pmod(F.xxhash64("k", "v", F.spark_partition_id()), F.lit(8))
    )
    assert spread.select("s").distinct().count() > 1


def test_small_dimension_is_broadcast_and_large_is_not(facts, dimension):
    assert joins.estimated_bytes(dimension) is not None
    small = joins.join_dimension(facts, dimension, "k")
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    large = joins.join_dimension(facts, dimension, "k", broadcast_limit=0)
    assert "_salt" in large._jdf.queryExecution().optimizedPlan().toString()
    counted = joins.join_dimension(facts, dimension, "k", broadcast_limit=0, hot_rows=None)
    assert "_salt" not in counted._jdf.queryExecution().optimizedPlan().toString()
    assert rows_of(small, "k", "v", "name") == rows_of(large, "k", "v", "name")


def test_only_joins_that_keep_facts_whole(facts, dimension):
    with pytest.raises(ValueError):
        joins.salted_join(facts, dimension, "k", "right")
