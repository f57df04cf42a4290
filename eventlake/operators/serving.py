"""Queries behind the dashboards, over the metric and report tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.config import EventRoles
from eventlake.functions.days import with_previous_day
from eventlake.functions.numbers import amount_where

# Fixed value: the line drawn on the events-per-minute panel.
PER_MINUTE_LINE = 300


def current_window(metrics: DataFrame) -> DataFrame:
    """Events, revenue, users and orders of the newest window."""
    return metrics.orderBy(F.desc("window_start")).limit(1).select(
        "window_start", "total_events", "total_revenue", "unique_users", "purchase_count"
    )


def recent_events(events: DataFrame, minutes: int = 5, until: Column | None = None) -> DataFrame:
    """Events of the last minutes before a moment, by default the newest event.

    The days are bounded as well, so only their partitions are read. A tile passes the end of the
    newest closed window as `until`: one small read instead of one of the events, and an event with a
    time in the future does not empty it.
    """
    span = F.make_dt_interval(mins=F.lit(minutes))
    when = F.col("event_timestamp")
    if until is None:
        newest_day = events.agg(F.max("event_date")).scalar()
        until = events.filter(F.col("event_date") == newest_day).agg(F.max("event_timestamp")).scalar()
    days = F.col("event_date").between(F.to_date(until - span), F.to_date(until))
    return events.filter(days & (when > until - span) & (when <= until))


def recent_totals(
    events: DataFrame, minutes: int = 5, roles: EventRoles = EventRoles(), until: Column | None = None
) -> DataFrame:
    """The number panels: events, revenue, users and orders of the last minutes."""
    bought = F.col("event_type") == roles.purchase
    return recent_events(events, minutes, until).agg(
        F.count("*").alias("total_events"),
        amount_where(bought, "total_amount").alias("total_revenue"),
        F.count_distinct("user_id").alias("unique_users"),
        F.count_if(bought).alias("orders"),
    )


def recent_by_type(events: DataFrame, minutes: int = 5, until: Column | None = None) -> DataFrame:
    return recent_events(events, minutes, until).groupBy("event_type").agg(F.count("*").alias("event_count"))


def events_per_minute(counts: DataFrame, line: int = PER_MINUTE_LINE) -> DataFrame:
    return counts.select(
        "window_start", "event_count", F.lit(line).alias("threshold"),
        (F.col("event_count") > line).alias("above_threshold"),
    )


def revenue_over_time(metrics: DataFrame) -> DataFrame:
    return metrics.select("window_start", "total_revenue", "avg_order_value").orderBy("window_start")


def events_by_type(type_counts: DataFrame) -> DataFrame:
    return type_counts.groupBy("event_type").agg(F.sum("event_count").alias("event_count"))


def revenue_by_category(category_metrics: DataFrame) -> DataFrame:
    return category_metrics.groupBy("category").agg(F.sum("revenue").alias("revenue"))


def alert_counts(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("anomaly_type").agg(F.count("*").alias("alerts"))


def latest_alerts(alerts: DataFrame, n: int = 100) -> DataFrame:
    return alerts.orderBy(F.desc("detection_time"), F.desc("window_start")).limit(n)


def latest_cohorts(retention: DataFrame) -> DataFrame:
    return retention.orderBy(F.desc("cohort_week"), "period_week")


def kpi_cards(daily: DataFrame) -> DataFrame:
    """Users, orders and conversion of each day with the change from the day before."""
    kept = ("unique_users", "total_orders", "conversion_rate")
    paired = with_previous_day(daily, "report_date", kept)
    users, orders, conversion = (F.col(c) - F.col(f"previous_{c}") for c in kept)
    return paired.select(
        "report_date",
        F.col("unique_users").alias("active_users"),
        F.col("total_orders").alias("orders"),
        "conversion_rate",
        users.alias("active_users_change"),
        orders.alias("orders_change"),
        conversion.alias("conversion_change"),
    )
