"""Weekly retention of users by the week of their first activity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventlake.config import EventRoles


def _active(events: DataFrame, roles: EventRoles, as_of: str | None) -> DataFrame:
    active = events.filter(
        F.col("event_type").isin(roles.view, roles.purchase)
        & F.col("user_id").isNotNull() & F.col("event_date").isNotNull()
    )
    return active.filter(F.col("event_date") <= F.lit(as_of).cast("date")) if as_of else active


def user_weeks(events: DataFrame, roles: EventRoles = EventRoles(), as_of: str | None = None) -> DataFrame:
    """One row per user and active week, with the first active day of that week."""
    week = F.date_trunc("week", "event_date").cast("date")
    return (
        _active(events, roles, as_of)
        .groupBy("user_id", week.alias("activity_week"))
        .agg(F.min("event_date").alias("first_day"))
    )


def first_visits(weeks: DataFrame) -> DataFrame:
    return weeks.groupBy("user_id").agg(
        F.min("first_day").alias("first_visit_date"), F.min("activity_week").alias("cohort_week")
    )


def cohort_activity(weeks: DataFrame) -> DataFrame:
    """Each user-week with the user's cohort week.

    Same rows as joining the activity with the first visits on user_id, at half
    the shuffles: after `user_weeks` a user has at most one row per week, so the
    window holds few rows however busy the user is.
    """
    cohort = F.min("activity_week").over(W.partitionBy("user_id"))
    joined = weeks.withColumn("cohort_week", cohort)
    period = F.floor(F.datediff("activity_week", "cohort_week") / 7).cast("int")
    return joined.withColumn("period_week", period).filter(F.col("period_week") >= 0)


def cohort_sizes(weeks: DataFrame) -> DataFrame:
    return first_visits(weeks).groupBy("cohort_week").agg(F.count("user_id").alias("cohort_size"))


def retention(weeks: DataFrame) -> DataFrame:
    """Distinct users of each cohort active in each later week, and their share.

    All users of a cohort are active in its week 0, so that row is the cohort
    size and needs no second pass or join.
    """
    kept = cohort_activity(weeks).groupBy("cohort_week", "period_week").agg(F.count("*").alias("retained_users"))
    week_zero = F.max(F.when(F.col("period_week") == 0, F.col("retained_users")))
    sized = kept.withColumn("cohort_size", week_zero.over(W.partitionBy("cohort_week")))
    return sized.select(
        "cohort_week", "cohort_size", "period_week", "retained_users",
        (F.col("retained_users").cast("double") / F.col("cohort_size")).alias("retention_rate"),
    )


def cohort_retention(
    events: DataFrame, roles: EventRoles = EventRoles(), as_of: str | None = None
) -> DataFrame:
    return retention(user_weeks(events, roles, as_of))


def retention_matrix(cohorts: DataFrame, periods: Sequence[int] | None = None) -> DataFrame:
    """Cohorts down, weeks since the first visit across.

    The periods are those of the data, without gaps; periods that are given must hold all of them.
    """
    last = cohorts.agg(F.max("period_week")).first()[0]
    if periods is None:
        periods = range((last or 0) + 1)
    elif last is not None and last > max(periods):
        raise ValueError(f"period {last} would be lost")
    wide = cohorts.groupBy("cohort_week").pivot("period_week", list(periods)).agg(F.first("retention_rate"))
    return wide.select("cohort_week", *[F.col(str(p)).alias(f"week_{p}") for p in periods])
