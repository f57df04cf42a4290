"""From JSON messages to the flat rows of the lake. Works on batch and stream alike."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.functions import search as search_text
from eventlake.functions import text as review_text
from eventlake.functions.text import REVIEW_LEXICON, Lexicon


def parse_json(messages: DataFrame, schema: str, key: str) -> DataFrame:
    """Type the `value` column and drop messages whose key field is missing.

    Malformed JSON parses to all NULLs, so the key test drops it as well. The
    struct is expanded by a generator: filters are not pushed below it, so each
    message is parsed once and not once more per filter.
    """
    typed = F.from_json(F.col("value").cast("string"), schema)
    return messages.select(F.inline(F.array(typed))).filter(F.col(key).isNotNull())


def rejected(messages: DataFrame, schema: str, key: str, time: str) -> DataFrame:
    """Messages that give no row (`malformed`, `no key`) or one that no day's report reads (`no time`).

    All columns of the messages stay, and the reason is added.
    """
    typed = F.from_json(
        F.col("value").cast("string"), f"{schema}, _corrupt STRING", {"columnNameOfCorruptRecord": "_corrupt"}
    )
    read = messages.withColumn("_typed", typed)
    reason = (
        F.when(F.col(f"_typed.{key}").isNull() & F.col("_typed._corrupt").isNotNull(), "malformed")
        .when(F.col(f"_typed.{key}").isNull(), "no key")
        .when(F.try_to_timestamp(f"_typed.{time}").isNull(), "no time")
    )
    return read.withColumn("reason", reason).filter(F.col("reason").isNotNull()).drop("_typed")


def _time(name: str) -> Column:
    return F.try_to_timestamp(F.col(name))


def timed_events(parsed: DataFrame) -> DataFrame:
    """Events with their time, for aggregation; the schema has chosen the columns."""
    return parsed.withColumn("event_timestamp", _time("timestamp")).drop("timestamp")


def flatten_events(parsed: DataFrame) -> DataFrame:
    timed = parsed.withColumn("event_timestamp", _time("timestamp"))
    return timed.select(
        "event_id", "event_type", "user_id", "product_id", "product_name", "category",
        "brand", "price", "event_timestamp", "session_id",
        F.col("device.type").alias("device_type"),
        F.col("device.os").alias("device_os"),
        F.col("device.app_version").alias("device_app_version"),
        F.col("context.referrer").alias("referrer"),
        F.col("context.campaign.id").alias("campaign_id"),
        F.col("context.campaign.name").alias("campaign_name"),
        "quantity", "total_amount", "payment_method",
        F.to_date("event_timestamp").alias("event_date"),
        F.hour("event_timestamp").alias("event_hour"),
    )


def flatten_sessions(parsed: DataFrame) -> DataFrame:
    return parsed.select(
        "session_id", "user_id",
        _time("started_at").alias("started_at"),
        _time("ended_at").alias("ended_at"),
        "duration_seconds", "event_count",
        F.col("device.type").alias("device_type"),
        F.col("device.os").alias("device_os"),
        F.col("device.model").alias("device_model"),
        F.col("context.referrer").alias("referrer"),
        F.col("context.utm.source").alias("utm_source"),
        F.col("context.utm.medium").alias("utm_medium"),
        F.col("context.location.region").alias("region"),
        F.col("context.location.city").alias("city"),
        F.col("context.is_first_visit").alias("is_first_visit"),
        "summary.*",
        F.to_date(_time("started_at")).alias("session_date"),
    )


def explode_session_events(parsed: DataFrame) -> DataFrame:
    """One row per event of each session message."""
    each = parsed.select("session_id", "user_id", F.inline("events"))
    return each.select(
        "session_id", "user_id", "event_index", "event_type",
        _time("timestamp").alias("event_timestamp"),
        "page", "duration_on_page",
        F.col("product.product_id").alias("product_id"),
        F.col("product.category").alias("product_category"),
        F.col("product.price").alias("product_price"),
        F.col("search.query").alias("search_query"),
        F.col("search.result_count").alias("search_result_count"),
        F.col("transaction.transaction_id").alias("transaction_id"),
        F.col("transaction.total_amount").alias("transaction_amount"),
        F.to_date(_time("timestamp")).alias("event_date"),
    )


def flatten_reviews(parsed: DataFrame, lexicon: Lexicon = REVIEW_LEXICON) -> DataFrame:
    """Review rows with their keywords, so that reports need not search the text again."""
    created = _time("created_at")
    images = F.coalesce(F.size("images"), F.lit(0))
    return parsed.select(
        "review_id", "product_id", "user_id", "rating",
        F.col("text").alias("review_text"),
        F.length("text").alias("text_length"),
        images.alias("image_count"),
        (images > 0).alias("has_images"),
        "helpful_count", "verified_purchase",
        created.alias("created_at"),
        F.to_date(created).alias("created_date"),
        review_text.keywords(F.col("text"), lexicon).alias("sentiment_keywords"),
    )


def flatten_searches(
    parsed: DataFrame,
    patterns: Sequence[tuple[str, str]] = search_text.SEARCH_PATTERNS,
    vocabulary: Sequence[str] = search_text.SEARCH_VOCABULARY,
) -> DataFrame:
    searched = _time("timestamp")
    repaired = parsed.withColumn("query_norm", search_text.repair_query(F.col("query"), vocabulary))
    return repaired.select(
        "search_id", "user_id", "query", "query_norm",
        search_text.query_pattern(F.col("query_norm"), patterns).alias("pattern"),
        "pattern_type",
        searched.alias("searched_at"),
        "result_count", "clicked", "clicked_position", "session_id",
        F.coalesce(F.size("filters_applied"), F.lit(0)).alias("filter_count"),
        F.to_date(searched).alias("search_date"),
    )
