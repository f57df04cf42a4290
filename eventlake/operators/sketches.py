"""Distinct counts that add up: sketches stored with each window, merged for longer spans.

A count of distinct users can't be summed over windows, a sketch of them can be merged. The finest windows are
aggregated from events once; hours, days and weeks are made from the stored sketches alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Registers of a sketch, as a power of two. The standard error of HyperLogLog is 1.04 / sqrt(registers), that of
# a theta sketch 1 / sqrt(entries).
REGISTERS_LOG2 = 12
ENTRIES_LOG2 = 12
RELATIVE_ERROR = 1.04 / 2 ** (REGISTERS_LOG2 / 2)


def window_sketches(
    events: DataFrame, column: str = "user_id", size: str = "5 minutes", watermark: str | None = None
) -> DataFrame:
    """Per window the number of events and two sketches of the column's values; batch and stream alike."""
    timed = events.withWatermark("event_timestamp", watermark) if watermark else events
    value = F.col(column)
    found = timed.groupBy(F.window("event_timestamp", size)).agg(
        F.count("*").alias("event_count"),
        F.hll_sketch_agg(value, F.lit(REGISTERS_LOG2)).alias("distinct_sketch"),
        F.theta_sketch_agg(value, F.lit(ENTRIES_LOG2)).alias("set_sketch"),
    )
    return found.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "event_count", "distinct_sketch", "set_sketch")


def merged(sketched: DataFrame, span: Column, name: str) -> DataFrame:
    """Sketches of the span (an expression of window_start) that each row falls in."""
    return sketched.groupBy(span.alias(name)).agg(
        F.sum("event_count").alias("event_count"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.theta_union_agg("set_sketch", F.lit(ENTRIES_LOG2)).alias("set_sketch"),
    )


def estimated(sketched: DataFrame, name: str = "unique_users") -> DataFrame:
    """The distinct counts of the sketches, in place of them."""
    return sketched.withColumn(name, F.hll_sketch_estimate("distinct_sketch")).drop("distinct_sketch", "set_sketch")


def kept_from_week_to_week(weekly: DataFrame, week: str = "week") -> DataFrame:
    """Of each week and the next one: values in both, and their share of the first week's values.

    Sets are intersected by their sketches, so no user is looked at again. `weekly` is `merged` by week.
    """
    following = weekly.select(F.date_sub(week, 7).alias(week), F.col("set_sketch").alias("next_sketch"))
    both = weekly.join(following, week)
    estimate = F.theta_sketch_estimate
    common = estimate(F.theta_intersection("set_sketch", "next_sketch"))
    return both.select(
        week, estimate("set_sketch").alias("users"), estimate("next_sketch").alias("next_users"), common.alias("users_in_both"),
    ).withColumn("kept_rate", F.try_divide(F.col("users_in_both"), F.col("users")))
