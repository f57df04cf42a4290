"""Session summaries, from the event array of a message or from exploded events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.config import EventRoles

SUMMARY = (
    "total_events", "unique_products_viewed", "searches_count", "views_count",
    "add_cart_count", "purchase_count", "converted", "bounce",
)


def summarize_sessions(
    parsed: DataFrame, roles: EventRoles = EventRoles(), keep: Sequence[str] = ("session_id",)
) -> DataFrame:
    """Recompute the summary of each session message from its own event array.

    Plain array functions instead of lambdas, which would leave generated code.
    """
    kinds = F.coalesce("events.event_type", F.array().cast("array<string>"))
    products = F.coalesce("events.product.product_id", F.array().cast("array<string>"))

    def of_type(kind: str) -> Column:
        return F.size(kinds) - F.size(F.array_remove(kinds, kind))

    seen = F.array_except(products, F.array(F.lit(None).cast("string")))
    counted = parsed.select(
        *keep,
        F.size(kinds).alias("total_events"),
        F.size(seen).alias("unique_products_viewed"),
        of_type(roles.search).alias("searches_count"),
        of_type(roles.view).alias("views_count"),
        of_type(roles.cart).alias("add_cart_count"),
        of_type(roles.purchase).alias("purchase_count"),
    )
    return counted.withColumns({
        "converted": F.col("purchase_count") > 0,
        "bounce": F.col("total_events") == 1,
    })


def summarize_session_events(session_events: DataFrame, roles: EventRoles = EventRoles()) -> DataFrame:
    """The same summary by aggregation over exploded events.

    A session is never collected into one array, so its size does not matter.
    """
    kind = F.col("event_type")
    counted = session_events.groupBy("session_id").agg(
        F.count("*").alias("total_events"),
        F.count_distinct("product_id").alias("unique_products_viewed"),
        F.count_if(kind == roles.search).alias("searches_count"),
        F.count_if(kind == roles.view).alias("views_count"),
        F.count_if(kind == roles.cart).alias("add_cart_count"),
        F.count_if(kind == roles.purchase).alias("purchase_count"),
    )
    return counted.withColumns({
        "converted": F.col("purchase_count") > 0,
        "bounce": F.col("total_events") == 1,
    })


def summary_mismatches(parsed: DataFrame, roles: EventRoles = EventRoles()) -> DataFrame:
    """How many session messages carry a summary that differs from their events, by field."""
    recomputed = summarize_sessions(parsed.withColumnRenamed("summary", "given"), roles, keep=("given",))
    differs = {c: ~F.col(c).eqNullSafe(F.col(f"given.{c}")) for c in SUMMARY}
    counted = recomputed.agg(
        F.count("*").alias("sessions"), *[F.count_if(differs[c]).alias(c) for c in SUMMARY]
    )
    fields = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("mismatched")) for c in SUMMARY])
    return counted.select("sessions", F.inline(fields))
