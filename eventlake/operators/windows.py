"""Tumbling-window metrics. One definition serves batch and stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventlake.config import EventRoles
from eventlake.functions.numbers import ratio
from eventlake.operators.joins import join_dimension


def _watermarked(events: DataFrame, watermark: str | None) -> DataFrame:
    return events.withWatermark("event_timestamp", watermark) if watermark else events


def _distinct(events: DataFrame, column: str, exact: bool) -> Column:
    """A sketch has a fixed size, which a stream needs and which spares a batch
    the shuffle of all values; only a batch can be exact."""
    if exact and not events.isStreaming:
        return F.count_distinct(column)
    return F.approx_count_distinct(column)


def _with_bounds(windowed: DataFrame) -> DataFrame:
    names = [c for c in windowed.columns if c != "window"]
    return windowed.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *names
    )


def window_metrics(
    events: DataFrame,
    size: str = "5 minutes",
    roles: EventRoles = EventRoles(),
    watermark: str | None = None,
    exact: bool = False,
) -> DataFrame:
    kind = F.col("event_type")
    bought = kind == roles.purchase
    metrics = _watermarked(events, watermark).groupBy(F.window("event_timestamp", size)).agg(
        F.count("*").alias("total_events"),
        _distinct(events, "user_id", exact).alias("unique_users"),
        F.sum(F.when(bought, F.col("total_amount"))).alias("total_revenue"),
        F.count_if(bought).alias("purchase_count"),
        F.count_if(kind == roles.view).alias("view_count"),
        F.count_if(kind == roles.cart).alias("cart_count"),
        F.count_if(kind == roles.search).alias("search_count"),
    )
    return _with_bounds(metrics).withColumn(
        "avg_order_value", ratio(F.col("total_revenue"), F.col("purchase_count"))
    )


def window_category_metrics(
    events: DataFrame,
    size: str = "5 minutes",
    roles: EventRoles = EventRoles(),
    watermark: str | None = None,
    exact: bool = False,
) -> DataFrame:
    bought = F.col("event_type") == roles.purchase
    metrics = _watermarked(events, watermark).groupBy(F.window("event_timestamp", size), "category").agg(
        F.count("*").alias("event_count"),
        F.sum(F.when(bought, F.col("total_amount"))).alias("revenue"),
        _distinct(events, "product_id", exact).alias("unique_products"),
    )
    return _with_bounds(metrics)


def window_category_metrics_of(
    events: DataFrame, products: DataFrame, size: str = "5 minutes", roles: EventRoles = EventRoles()
) -> DataFrame:
    """The same in batch for events without a category: counted per product first and joined after.

    The facts are never joined or shuffled whole, and the distinct products of a category are its rows.
    """
    bought = F.col("event_type") == roles.purchase
    counted = events.groupBy(F.window("event_timestamp", size), "product_id").agg(
        F.count("*").alias("event_count"),
        F.sum(F.when(bought, F.col("total_amount"))).alias("revenue"),
    )
    named = join_dimension(counted, products.select("product_id", "category"), "product_id", hot_rows=None)
    return _with_bounds(named.groupBy("window", "category").agg(
        F.sum("event_count").alias("event_count"),
        F.sum("revenue").alias("revenue"),
        F.count("product_id").alias("unique_products"),
    ))


def window_counts(events: DataFrame, size: str = "1 minute", watermark: str | None = None) -> DataFrame:
    counted = _watermarked(events, watermark).groupBy(F.window("event_timestamp", size)).agg(
        F.count("*").alias("event_count")
    )
    return _with_bounds(counted)


def beating_counts(
    events: DataFrame, beats: DataFrame, size: str = "1 minute", watermark: str | None = None, grace: str = "2 minutes"
) -> DataFrame:
    """Window counts that close in silence too: heartbeats move the watermark and count as no event.

    A heartbeat carries the current time, and is set back by the `grace` that events may be on their way. A
    window that holds heartbeats only has a count of 0.
    """
    back = F.col("event_timestamp") - F.expr(f"INTERVAL {grace}")
    both = events.select("event_timestamp", F.lit(True).alias("is_event")).unionByName(
        beats.select(back.alias("event_timestamp"), F.lit(False).alias("is_event"))
    )
    counted = _watermarked(both, watermark).groupBy(F.window("event_timestamp", size)).agg(
        F.count_if("is_event").alias("event_count")
    )
    return _with_bounds(counted)


def window_type_counts(events: DataFrame, size: str = "5 minutes", watermark: str | None = None) -> DataFrame:
    counted = _watermarked(events, watermark).groupBy(F.window("event_timestamp", size), "event_type").agg(
        F.count("*").alias("event_count")
    )
    return _with_bounds(counted)


def window_product_counts(events: DataFrame, size: str = "5 minutes", watermark: str | None = None) -> DataFrame:
    counted = (
        _watermarked(events.filter(F.col("product_id").isNotNull()), watermark)
        .groupBy(F.window("event_timestamp", size), "product_id")
        .agg(F.count("*").alias("event_count"))
    )
    return _with_bounds(counted)


def top_products(product_counts: DataFrame, k: int = 10) -> DataFrame:
    """The k busiest products of each window; Spark trims to k before it shuffles."""
    busiest = W.partitionBy("window_start").orderBy(F.desc("event_count"), "product_id")
    return product_counts.withColumn("rank", F.row_number().over(busiest)).filter(F.col("rank") <= k)


def _visit_figures(roles: EventRoles) -> dict[str, Column]:
    kind = F.col("event_type")
    return {
        "event_count": F.count("*"),
        "view_count": F.count_if(kind == roles.view),
        "cart_count": F.count_if(kind == roles.cart),
        "purchase_count": F.count_if(kind == roles.purchase),
        "revenue": F.sum(F.when(kind == roles.purchase, F.col("total_amount"))),
    }


def session_windows(
    events: DataFrame, gap_seconds: int = 1800, key: str = "user_id", roles: EventRoles = EventRoles(),
    watermark: str | None = None,
) -> DataFrame:
    """Visits: events of a user with less than the gap between them; a visit ends a gap after its last event.

    A stream merges visits in its state and emits each once the watermark has passed its end. A batch first
    counts events per user and stretch of a gap, as all events of such a stretch belong together; what is
    put in order per user is at most one row per stretch, however many events there are. Rows without a
    user or a time belong to no visit.
    """
    figures = _visit_figures(roles)
    kept = events.filter(F.col(key).isNotNull() & F.col("event_timestamp").isNotNull())
    if events.isStreaming:
        span = F.session_window("event_timestamp", f"{gap_seconds} seconds")
        found = _watermarked(kept, watermark).groupBy(span, key).agg(*[c.alias(n) for n, c in figures.items()])
        return found.select(
            key, F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"), *figures
        )
    stretch = F.floor(F.unix_seconds("event_timestamp") / gap_seconds)
    parts = kept.groupBy(key, stretch.alias("_stretch")).agg(
        F.min("event_timestamp").alias("_first"), F.max("event_timestamp").alias("_last"),
        *[c.alias(n) for n, c in figures.items()],
    )
    in_order = W.partitionBy(key).orderBy("_stretch")
    gap = F.expr(f"INTERVAL {gap_seconds} SECONDS")
    before = F.lag("_last").over(in_order)
    numbered = parts.withColumn("_starts", F.when(F.col("_first") < before + gap, 0).otherwise(1)).withColumn(
        "_visit", F.sum("_starts").over(in_order)
    )
    return numbered.groupBy(key, "_visit").agg(
        F.min("_first").alias("session_start"), (F.max("_last") + gap).alias("session_end"),
        *[F.sum(n).alias(n) for n in figures],
    ).drop("_visit")


def with_audit(metrics: DataFrame) -> DataFrame:
    """Add the write time and the day that the table is partitioned by."""
    return metrics.withColumns({
        "updated_at": F.current_timestamp(),
        "window_date": F.to_date("window_start"),
    })
