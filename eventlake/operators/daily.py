"""Daily reports over the events table, one row set per event_date.

Each takes any span of days; a caller that wants one day filters first, which
prunes partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventlake.config import EventRoles
from eventlake.functions.days import with_previous_day
from eventlake.functions.numbers import amount_where, percent, ratio
from eventlake.operators.joins import join_dimension

PRODUCT_KEYS = ("product_id", "product_name", "category")


def _is(kind: str) -> Column:
    return F.col("event_type") == kind


def _report_date() -> Column:
    return F.col("event_date").alias("report_date")


def on_day(df: DataFrame, column: str, day: str) -> DataFrame:
    return df.filter(F.col(column) == F.lit(day).cast("date"))


def daily_summary(events: DataFrame, roles: EventRoles = EventRoles()) -> DataFrame:
    bought = _is(roles.purchase)
    totals = events.groupBy(_report_date()).agg(
        F.count("*").alias("total_events"),
        F.count_distinct("user_id").alias("unique_users"),
        amount_where(bought, "total_amount").alias("total_revenue"),
        F.count_if(bought).alias("total_orders"),
        F.count_if(_is(roles.view)).alias("views"),
        F.count_if(_is(roles.cart)).alias("cart_adds"),
    )
    orders = F.col("total_orders")
    return totals.withColumns({
        "avg_order_value": F.coalesce(ratio(F.col("total_revenue"), orders), F.lit(0.0)),
        "conversion_rate": F.coalesce(ratio(orders, F.col("unique_users")), F.lit(0.0)),
    })


def hourly_metrics(events: DataFrame, roles: EventRoles = EventRoles()) -> DataFrame:
    bought = _is(roles.purchase)
    return events.groupBy(_report_date(), F.col("event_hour").alias("hour")).agg(
        F.count("*").alias("events"),
        amount_where(bought, "total_amount").alias("revenue"),
        F.count_if(bought).alias("orders"),
        F.count_distinct("user_id").alias("unique_users"),
    )


def product_days(
    events: DataFrame,
    roles: EventRoles = EventRoles(),
    keys: Sequence[str] = PRODUCT_KEYS,
) -> DataFrame:
    """Counts per day and product: the shared first step of the two reports below."""
    bought = _is(roles.purchase)
    return events.groupBy(_report_date(), *keys).agg(
        F.count("*").alias("events"),
        F.count_if(_is(roles.view)).alias("views"),
        F.count_if(_is(roles.cart)).alias("cart_adds"),
        F.count_if(bought).alias("purchases"),
        amount_where(bought, "total_amount").alias("revenue"),
    )


def product_metrics(days: DataFrame) -> DataFrame:
    """Products that were viewed that day, with purchases per hundred views."""
    return days.filter(F.col("views") > 0).select(
        "report_date", *PRODUCT_KEYS, "views", "cart_adds", "purchases", "revenue",
        percent(F.col("purchases"), F.col("views"), 2).cast("double").alias("conversion_rate"),
    )


def category_metrics(days: DataFrame) -> DataFrame:
    """Category totals; the top product has most revenue, then most events, then the lowest id."""
    per_product = days.groupBy("report_date", "category", "product_id").agg(
        F.sum("events").alias("events"),
        F.sum("revenue").alias("revenue"),
        F.sum("purchases").alias("purchases"),
    )
    rank = F.when(
        F.col("product_id").isNotNull(),
        F.struct(-F.col("revenue"), -F.col("events"), F.col("product_id")),
    )
    return per_product.groupBy("report_date", "category").agg(
        F.sum("events").alias("events"),
        F.sum("revenue").alias("revenue"),
        F.sum("purchases").alias("orders"),
        F.count("product_id").alias("unique_products"),
        F.min_by("product_id", rank).alias("top_product_id"),
    )


def repurchase_rate(events: DataFrame, roles: EventRoles = EventRoles()) -> DataFrame:
    """Share of buyers who bought on two days or more.

    First and last purchase day tell that without a list of days per user.
    """
    buyers = (
        events.filter(_is(roles.purchase) & F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(F.min("event_date").alias("first_day"), F.max("event_date").alias("last_day"))
    )
    counted = buyers.agg(
        F.count("*").alias("purchasers"),
        F.count_if(F.col("first_day") < F.col("last_day")).alias("repeat_purchasers"),
    )
    return counted.withColumn("repurchase_rate", ratio(F.col("repeat_purchasers"), F.col("purchasers")))


def volume_change(events: DataFrame) -> DataFrame:
    """Events per day against the calendar day before, in percent."""
    counts = events.groupBy(_report_date()).agg(F.count("*").alias("events"))
    known = counts.filter(F.col("report_date").isNotNull())
    change = F.col("events") - F.col("previous_events")
    return with_previous_day(known, "report_date", ["events"]).withColumn(
        "change_pct", percent(change, F.col("previous_events"), 1).cast("double")
    )


def hourly_moving_average(events: DataFrame, products: DataFrame | None = None, hours: int = 3) -> DataFrame:
    """Events per category and hour of time, with the mean of the last hours, empty ones included.

    With `products` the events have no category of their own: they are counted per product and hour
    and joined after. Each hour's count is sent to the hours whose mean it is part of and added up there, so no task
    holds the hours of a category. Hours before the first count as empty.
    """
    hour = F.date_trunc("hour", "event_timestamp").alias("hour_start")
    if products is None:
        per_hour = events.groupBy("category", hour).agg(F.count("*").alias("events"))
    else:
        counted = events.groupBy("product_id", hour).agg(F.count("*").alias("n"))
        named = join_dimension(counted, products.select("product_id", "category"), "product_id", hot_rows=None)
        per_hour = named.groupBy("category", "hour_start").agg(F.sum("n").alias("events"))
    sent = per_hour.withColumn("later", F.explode(F.sequence(F.lit(0), F.lit(hours - 1))))
    own = F.col("later") == 0
    summed = sent.groupBy(
        "category", (F.col("hour_start") + F.make_dt_interval(hours=F.col("later"))).alias("hour_start")
    ).agg(F.max(F.when(own, F.col("events"))).alias("events"), F.sum("events").alias("total"))
    return summed.filter(F.col("events").isNotNull()).select(
        "category", "hour_start", "events", (F.col("total") / hours).alias("moving_avg")
    )


def revenue_rollup(products: DataFrame, dimensions: Sequence[str] = ("category", "brand"), cube: bool = False) -> DataFrame:
    """Events, purchases and revenue by all dimensions, by the leading ones, and in total.

    `level` is the grouping id: a bit is set for each dimension that is summed over, which tells a subtotal
    from a dimension that is null. The input is counted per product, so the copies that grouping sets make
    of their rows are copies of a few counts and not of events. `cube` gives every combination instead.
    """
    grouped = products.cube(*dimensions) if cube else products.rollup(*dimensions)
    return grouped.agg(
        F.grouping_id().alias("level"), F.sum("events").alias("events"), F.sum("purchases").alias("purchases"),
        F.sum("revenue").alias("revenue"),
    )
