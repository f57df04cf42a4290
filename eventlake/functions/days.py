"""Comparison of a day with the calendar day before it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def with_previous_day(per_day: DataFrame, date: str, columns: Sequence[str]) -> DataFrame:
    """Add `previous_<column>`, NULL where the day before has no row.

    Each row is sent to its own date and to the next one, where the two meet in
    an aggregate: the input is computed once, where a self join would do so
    twice, and no task sees all days.
    """
    homes = F.array(
        F.struct(F.col(date).alias("date"), F.lit(True).alias("own")),
        F.struct(F.date_add(date, 1).alias("date"), F.lit(False).alias("own")),
    )
    kept = [c for c in per_day.columns if c != date]
    own = F.col("_home.own")
    met = per_day.select(F.explode(homes).alias("_home"), *kept).groupBy(F.col("_home.date").alias(date)).agg(
        F.count_if(own).alias("_own"),
        *[F.max(F.when(own, F.col(c))).alias(c) for c in kept],
        *[F.max(F.when(~own, F.col(c))).alias(f"previous_{c}") for c in columns],
    )
    return met.filter(F.col("_own") > 0).drop("_own")


def with_missing_days(per_day: DataFrame, date: str) -> DataFrame:
    """Add a row for each calendar day missing between two rows, all else NULL.

    The window has no partitions: there is one row per day, so it is as short as
    the calendar however many events lie behind it.
    """
    upcoming = F.coalesce(F.lead(date).over(W.orderBy(date)), F.date_add(date, 1))
    spread = per_day.withColumn("_days", F.sequence(F.col(date), F.date_sub(upcoming, 1)))
    each = spread.select("*", F.explode("_days").alias("_day"))
    real = F.col("_day") == F.col(date)
    kept = [F.when(real, F.col(c)).alias(c) for c in per_day.columns if c != date]
    return each.select(F.col("_day").alias(date), *kept)
