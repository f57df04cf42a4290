"""Every registered query: name -> function of (spark, folder of benchmark tables)."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta
from functools import cache, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from eventlake import schemas
from eventlake.config import Settings, Thresholds, scratch_path
from eventlake.functions import text
from eventlake.operators import (
    anomalies, cohort, daily, joins, layout, messages, quality, reviews, searches, serving, sessions,
    sketches, spelling, timejoins, windows,
)
from eventlake.plans import daily as nightly
from eventlake.plans.replay import finish, replay, replay_batches, table_stream
from eventlake.sources import samples
from eventlake.sources.streams import json_lines_source, read_stream
from eventlake.sources.tables import TableStore
from eventlake.streaming import jobs, sinks

Query = Callable[[SparkSession, str], DataFrame]

HOUR = 3600
LIMITS = Thresholds(high=25, low=6, mean=14.0, stddev=4.0)
ROLLING = {"lookback_seconds": 24 * HOUR, "min_history": 10, "sigmas": 2.0}
LAYOUT_PARAMETERS = {
    "day_from": "1996-03-01", "day_to": "1996-03-31", "product": "42",
    "month_from": "1996-01-01", "month_to": "1997-06-30",
}

_registry: dict[str, Query] = {}


def register(query: Query) -> Query:
    def plain(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Decimals as doubles, so that any engine prints them alike."""
        df = query(spark, sf_dir)
        exact = [f.name for f in df.schema if isinstance(f.dataType, DecimalType)]
        return df.withColumns({c: F.col(c).cast("double") for c in exact}) if exact else df

    _registry[query.__name__] = plain
    return query


def all_queries() -> dict[str, Query]:
    return dict(_registry)


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return samples.events(samples.table(spark, sf, "events"))


def _products(spark: SparkSession, sf: str) -> DataFrame:
    return samples.products(samples.table(spark, sf, "part"))


def _enriched(spark: SparkSession, sf: str) -> DataFrame:
    return samples.enriched_events(samples.table(spark, sf, "events"), samples.table(spark, sf, "part"))


def _product_days(spark: SparkSession, sf: str) -> DataFrame:
    """Counted per product first and joined after, so that facts never meet the dimension."""
    counted = daily.product_days(_events(spark, sf), samples.ROLES, keys=("product_id",))
    return joins.join_dimension(counted, _products(spark, sf), "product_id", hot_rows=None)


def _tagged(spark: SparkSession, sf: str) -> DataFrame:
    rows = samples.reviews(samples.table(spark, sf, "documents"))
    return reviews.tag_reviews(rows, samples.LEXICON, samples.ASPECTS)


def _hourly_counts(spark: SparkSession, sf: str) -> DataFrame:
    return windows.window_counts(_events(spark, sf), "1 hour")


def _searches(spark: SparkSession, sf: str) -> DataFrame:
    return _search_rows(samples.search_messages(
        samples.table(spark, sf, "events"), samples.table(spark, sf, "part")
    ))


def _search_rows(raw: DataFrame) -> DataFrame:
    parsed = messages.parse_json(raw, schemas.SEARCH, "search_id")
    return messages.flatten_searches(parsed, samples.PATTERNS, samples.VOCABULARY)


def _review_rows(raw: DataFrame) -> DataFrame:
    parsed = messages.parse_json(raw, schemas.REVIEW, "review_id")
    rows = messages.flatten_reviews(parsed, samples.LEXICON)
    return rows.withColumn("sentiment_keywords", F.array_join("sentiment_keywords", ","))


# --- ingest: messages to rows -------------------------------------------------


@register
def ingest_events(spark, sf):
    return jobs.parsed_events(samples.event_messages(samples.table(spark, sf, "events")))


@register
def ingest_rejected(spark, sf):
    """Messages that give no usable row, by reason."""
    sent = samples.faulty_event_messages(samples.table(spark, sf, "events"))
    found = messages.rejected(sent, schemas.EVENT, "event_id", "timestamp")
    return found.groupBy("reason").agg(F.count("*").alias("n"), F.min("number").alias("first_event"))


@register
def ingest_sessions(spark, sf):
    return jobs.parsed_sessions(samples.session_messages(samples.table(spark, sf, "orders")))


@register
def ingest_session_events(spark, sf):
    return jobs.parsed_session_events(samples.session_messages(samples.table(spark, sf, "orders")))


@register
def ingest_reviews(spark, sf):
    return _review_rows(samples.review_messages(samples.table(spark, sf, "documents")))


@register
def ingest_searches(spark, sf):
    return _searches(spark, sf)


# --- daily reports -----------------------------------------------------------


@register
def daily_summary(spark, sf):
    return daily.daily_summary(_events(spark, sf), samples.ROLES)


@register
def hourly_metrics(spark, sf):
    return daily.hourly_metrics(_events(spark, sf), samples.ROLES)


@register
def category_daily(spark, sf):
    return daily.category_metrics(_product_days(spark, sf))


@register
def product_daily(spark, sf):
    return daily.product_metrics(_product_days(spark, sf))


@register
def repurchase_rate(spark, sf):
    return daily.repurchase_rate(_events(spark, sf), samples.ROLES)


@register
def volume_change(spark, sf):
    return daily.volume_change(_events(spark, sf))


@register
def hourly_moving_average(spark, sf):
    return daily.hourly_moving_average(_events(spark, sf), _products(spark, sf), hours=3)


@register
def event_product_join(spark, sf):
    return _enriched(spark, sf)


@register
def event_product_join_salted(spark, sf):
    """The way taken when the dimension is too large to broadcast, with hot keys split."""
    return joins.salted_join(_events(spark, sf), _products(spark, sf), "product_id", hot_rows=50)


@register
def event_product_join_bucketed(spark, sf):
    """Both tables are kept in buckets by the product; the join of the buckets has no exchange."""
    return joins.bucketed_join(*_bucketed(spark, sf), "product_id")


@cache
def _bucketed(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Written once per session."""
    place = scratch_path(spark, "buckets")
    name = place[-32:]
    for table, rows in (("events", _events(spark, sf)), ("products", _products(spark, sf))):
        layout.write_bucketed(rows, f"{table}_{name}", "product_id", 8, f"{place}/{table}")
    return spark.read.table(f"events_{name}"), spark.read.table(f"products_{name}")


@register
def revenue_rollup(spark, sf):
    """By category and brand, by category, and in total."""
    counted = daily.product_days(_events(spark, sf), samples.ROLES, keys=("product_id",))
    products = samples.branded_products(samples.table(spark, sf, "part"))
    named = joins.join_dimension(counted, products.select("product_id", "category", "brand"), "product_id", hot_rows=None)
    return daily.revenue_rollup(named)


# --- joins over time -----------------------------------------------------------

WEEK_SECONDS = 7 * 24 * HOUR


def _of_kind(events: DataFrame, kind: str) -> DataFrame:
    return events.filter(F.col("event_type") == kind)


@register
def view_to_purchase(spark, sf):
    """Views of a product that its user bought within a week."""
    events = _events(spark, sf)
    views, bought = (_of_kind(events, kind) for kind in (samples.ROLES.view, samples.ROLES.purchase))
    return timejoins.followed_within(views, bought, ("user_id", "product_id"), WEEK_SECONDS)


@register
def purchase_last_view(spark, sf):
    """Each purchase with what its user viewed last before it."""
    events = _events(spark, sf)
    bought = _of_kind(events, samples.ROLES.purchase).select("event_id", "user_id", "product_id", "event_timestamp")
    views = _of_kind(events, samples.ROLES.view).select("event_id", "user_id", "product_id", "event_timestamp")
    found = timejoins.last_before(bought, views, "user_id", 24 * HOUR)
    return found.select(
        "event_id", "user_id", "product_id", "event_timestamp", F.col("mark.event_id").alias("view_id"),
        F.col("mark.product_id").alias("viewed_product_id"), F.col("mark.event_timestamp").alias("viewed_at"),
    )


@register
def event_campaigns(spark, sf):
    """Events of a campaign's segment while it ran, counted per campaign."""
    events = _events(spark, sf).withColumn("segment", F.col("product_id") % 4)
    bought, amount = F.col("event_type") == samples.ROLES.purchase, F.col("total_amount")
    counted = timejoins.totals_in_intervals(
        events, samples.campaigns(samples.table(spark, sf, "part")), "starts_at", "ends_at", ("segment",),
        {"events": F.lit(1), "purchases": bought.cast("int"), "revenue": amount, "amounts": amount.isNotNull().cast("int")},
    )
    return counted.filter("events > 0").withColumn("revenue", F.when(F.col("amounts") > 0, F.col("revenue"))).drop("amounts")


# --- distinct counts that add up -----------------------------------------------


@cache
def _stored_sketches(spark: SparkSession, sf: str) -> DataFrame:
    """Five-minute windows with their sketches, written once per session; all else is made from them."""
    path = scratch_path(spark, "sketches")
    sketches.window_sketches(_events(spark, sf)).write.parquet(path)
    return spark.read.parquet(path)


def _near(estimate, exact):
    """Within three standard errors, or one for counts so small that this is less than one."""
    return F.abs(F.col(estimate) - F.col(exact)) <= F.greatest(F.lit(1.0), 3 * sketches.RELATIVE_ERROR * F.col(exact))


@register
def sketched_users_daily(spark, sf):
    """Users per day from stored windows, held against the exact count."""
    by_day = sketches.merged(_stored_sketches(spark, sf), F.to_date("window_start"), "day")
    exact = _events(spark, sf).groupBy(F.col("event_date").alias("day")).agg(F.count_distinct("user_id").alias("exact_users"))
    found = sketches.estimated(by_day).join(exact, "day")
    return found.select("day", "event_count", "exact_users", _near("unique_users", "exact_users").alias("within_error"))


@register
def sketched_users_kept(spark, sf):
    """Users seen in a week and in the next, from stored windows, held against the exact figures."""
    week = F.date_trunc("week", "window_start").cast("date")
    found = sketches.kept_from_week_to_week(sketches.merged(_stored_sketches(spark, sf), week, "week"))
    seen = _events(spark, sf).select(F.date_trunc("week", "event_timestamp").cast("date").alias("week"), "user_id").distinct()
    both = seen.join(seen.select(F.date_sub("week", 7).alias("week"), "user_id"), ["week", "user_id"])
    exact = both.groupBy("week").agg(F.count("*").alias("exact_in_both"))
    return found.join(exact, "week").select(
        "week", "exact_in_both", _near("users_in_both", "exact_in_both").alias("within_error"),
    )


# --- windows and alerts ------------------------------------------------------


@register
def metrics_5min(spark, sf):
    return windows.window_metrics(_events(spark, sf), "5 minutes", samples.ROLES, exact=True)


@register
def metrics_category_5min(spark, sf):
    return windows.window_category_metrics_of(_events(spark, sf), _products(spark, sf), "5 minutes", samples.ROLES)


@register
def type_counts_5min(spark, sf):
    return windows.window_type_counts(_events(spark, sf))


@register
def top_products_5min(spark, sf):
    return windows.top_products(windows.window_product_counts(_events(spark, sf)))


@register
def top_products_daily(spark, sf):
    return windows.top_products(windows.window_product_counts(_events(spark, sf), "1 day"))


@register
def threshold_alerts(spark, sf):
    return anomalies.threshold_alerts(_hourly_counts(spark, sf), LIMITS)


@register
def outage_alerts(spark, sf):
    """Five-minute windows without any event count as a drop too."""
    counts = windows.window_counts(_events(spark, sf), "5 minutes")
    filled = anomalies.fill_empty_windows(counts, 300)
    return anomalies.threshold_alerts(filled, Thresholds(high=4, low=1, mean=1.0, stddev=1.0))


@register
def session_windows(spark, sf):
    """Visits of users, parted by twelve hours without an event."""
    return windows.session_windows(_events(spark, sf), 12 * HOUR, roles=samples.ROLES)


@register
def rolling_alerts(spark, sf):
    return anomalies.rolling_alerts(_hourly_counts(spark, sf), **ROLLING)


@register
def rolling_stats(spark, sf):
    return anomalies.rolling_stats(_hourly_counts(spark, sf), ROLLING["lookback_seconds"])


# --- cohorts -----------------------------------------------------------------


@register
def cohort_first_visits(spark, sf):
    return cohort.first_visits(cohort.user_weeks(_events(spark, sf), samples.ROLES))


@register
def cohort_sizes(spark, sf):
    return cohort.cohort_sizes(cohort.user_weeks(_events(spark, sf), samples.ROLES))


@register
def cohort_activity(spark, sf):
    return cohort.cohort_activity(cohort.user_weeks(_events(spark, sf), samples.ROLES))


@register
def cohort_retention(spark, sf):
    return cohort.cohort_retention(_events(spark, sf), samples.ROLES)


@register
def cohort_incremental(spark, sf):
    """Three nightly runs: a week of days, then a rerun of an old day after a gap and a late day, then the rest.

    Every run brings up to date what has changed, so the last leaves the retention of all events.
    """
    place = scratch_path(spark, "cohorts")
    settings = Settings(database=f"cohorts_{place[-32:]}", lake_path=place, roles=samples.ROLES)
    store = TableStore(spark, settings)
    store.create("events")
    rows = _events(spark, sf).withColumns({
        "event_id": F.col("event_id").cast("string"), "user_id": F.col("user_id").cast("string"),
        "product_id": F.col("product_id").cast("string"), "total_amount": F.col("total_amount").cast("int"),
    })
    rows = rows.withColumns({c: F.lit(None) for c in store.columns("events") if c not in rows.columns})
    first = rows.agg(F.min("event_date")).first()[0]
    number = F.datediff("event_date", F.lit(first))
    late = number == 4
    nights = (
        ((number <= 9) & ~late, 9),  # day 4 is late
        ((number > 9) & (number <= 24) | late, 4),  # two weeks without a run, then a rerun for day 4
        ((number > 24), None),
    )
    last = rows.agg(F.max("event_date")).first()[0]
    for came, day in nights:
        store.append(rows.filter(came), "events")
        nightly.run_cohorts(store, (last if day is None else first + timedelta(days=day)).isoformat())
    return cohort.retention(store.read("user_weeks"))


@register
def retention_matrix(spark, sf):
    retention = cohort.cohort_retention(_events(spark, sf), samples.ROLES)
    return cohort.retention_matrix(retention)


@register
def order_cohort_retention(spark, sf):
    """Retention of customers over years of orders: many cohorts and periods."""
    orders = samples.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("user_id"),
        F.lit("purchase").alias("event_type"),
        F.to_date("o_orderdate").alias("event_date"),
    )
    return cohort.cohort_retention(orders)


# --- reviews -----------------------------------------------------------------


@register
def review_tags(spark, sf):
    return _tagged(spark, sf).select(
        "review_id", F.array_join("keywords", ",").alias("keywords"),
        F.array_join("aspects", ",").alias("aspects"),
        F.round(F.col("sentiment").cast("double"), 4).alias("sentiment"),
    )


@register
def review_first_keyword(spark, sf):
    documents = samples.table(spark, sf, "documents")
    return documents.select("doc_id", text.first_keyword(F.col("text"), samples.LEXICON).alias("first_keyword"))


@register
def review_summary(spark, sf):
    return reviews.review_summary(_tagged(spark, sf))


@register
def review_keywords(spark, sf):
    return reviews.keyword_frequency(_tagged(spark, sf), samples.LEXICON)


@register
def review_aspects(spark, sf):
    found = reviews.aspect_sentiment(_tagged(spark, sf))
    return found.withColumn("sentiment_score", F.round("sentiment_score", 4))


@register
def product_reviews(spark, sf):
    return reviews.product_reviews(_tagged(spark, sf), samples.LEXICON)


# --- quality -----------------------------------------------------------------


def _checked(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_checks(_enriched(spark, sf), roles=samples.ROLES)


@register
def quality_profile(spark, sf):
    return quality.quality_profile(_enriched(spark, sf), samples.ROLES)


@register
def quality_checks(spark, sf):
    return _checked(spark, sf)


@register
def quality_checks_faulty(spark, sf):
    """Rows that carry faults: every check finds something."""
    return quality.quality_checks(
        samples.faulty_events(_enriched(spark, sf)), roles=samples.ROLES, arrival="arrival_date",
        products=samples.branded_products(samples.table(spark, sf, "part")),
    )


@register
def quality_report(spark, sf):
    return quality.quality_report(_checked(spark, sf))


# --- sessions and searches ---------------------------------------------------


def _sessions(spark: SparkSession, sf: str) -> DataFrame:
    raw = samples.session_messages(samples.table(spark, sf, "orders"))
    return messages.parse_json(raw, schemas.SESSION_KINDS, "session_id")


@register
def session_summary(spark, sf):
    return sessions.summarize_sessions(_sessions(spark, sf))


@register
def session_summary_check(spark, sf):
    return sessions.summary_mismatches(_sessions(spark, sf))


@register
def session_summary_exploded(spark, sf):
    turns = samples.turn_events(samples.table(spark, sf, "conversations"))
    return sessions.summarize_session_events(turns, samples.TURN_ROLES)


@register
def search_metrics(spark, sf):
    return searches.search_metrics(_searches(spark, sf))


@register
def search_pattern_agreement(spark, sf):
    return searches.pattern_agreement(_searches(spark, sf))


@register
def popular_searches(spark, sf):
    return searches.popular_searches(_searches(spark, sf))


def _vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    return spelling.vocabulary(samples.table(spark, sf, "part"), "p_name")


@register
def search_repairs(spark, sf):
    """Distinct words of the searches that a word of the product names is near to."""
    asked = _searches(spark, sf).select(F.explode(F.split(F.lower("query"), r"\s+")).alias("word"))
    return spelling.repaired_words(asked, spelling.deletion_index(_vocabulary(spark, sf)))


@register
def popular_searches_repaired(spark, sf):
    """The most frequent searches; distinct queries are repaired once, by the words of all product names."""
    counted = _searches(spark, sf).groupBy("query").agg(F.count("*").alias("searches"))
    known = spelling.repaired_queries(counted, spelling.deletion_index(_vocabulary(spark, sf)))
    found = counted.join(known, "query").groupBy("query_norm").agg(F.sum("searches").alias("searches"))
    return found.orderBy(F.desc("searches"), "query_norm").limit(20)


# --- serving -----------------------------------------------------------------


@register
def serving_current_window(spark, sf):
    return serving.current_window(windows.window_metrics(_events(spark, sf), "5 minutes", samples.ROLES, exact=True))


@register
def serving_recent_totals(spark, sf):
    return serving.recent_totals(_events(spark, sf), 24 * 60, samples.ROLES)


@register
def serving_recent_by_type(spark, sf):
    return serving.recent_by_type(_events(spark, sf), 24 * 60)


@register
def serving_events_per_minute(spark, sf):
    return serving.events_per_minute(windows.window_counts(_events(spark, sf), "1 minute"), line=1)


@register
def serving_revenue_over_time(spark, sf):
    metrics = windows.window_metrics(_events(spark, sf), "1 hour", samples.ROLES)
    return serving.revenue_over_time(metrics)


@register
def serving_events_by_type(spark, sf):
    return serving.events_by_type(windows.window_type_counts(_events(spark, sf)))


@register
def serving_revenue_by_category(spark, sf):
    metrics = windows.window_category_metrics_of(_events(spark, sf), _products(spark, sf), "5 minutes", samples.ROLES)
    return serving.revenue_by_category(metrics)


@register
def serving_alert_counts(spark, sf):
    return serving.alert_counts(anomalies.threshold_alerts(_hourly_counts(spark, sf), LIMITS))


@register
def serving_latest_alerts(spark, sf):
    return serving.latest_alerts(anomalies.threshold_alerts(_hourly_counts(spark, sf), LIMITS))


@register
def serving_latest_cohorts(spark, sf):
    return serving.latest_cohorts(cohort.cohort_retention(_events(spark, sf), samples.ROLES))


@register
def serving_kpi_cards(spark, sf):
    return serving.kpi_cards(daily.daily_summary(_events(spark, sf), samples.ROLES))


# --- layouts -----------------------------------------------------------------


@cache
def _written_layouts(spark: SparkSession, sf: str) -> str:
    """Written once per session; the queries then read the same three tables."""
    path = scratch_path(spark, "layouts")
    layout.write_layouts(samples.layout_rows(samples.table(spark, sf, "lineitem")), path)
    return path


def _on_all_layouts(spark: SparkSession, sf: str, name: str) -> DataFrame:
    path = _written_layouts(spark, sf)
    results = [
        layout.layout_query(spark, name, spark.read.parquet(f"{path}/{kind.name}"), LAYOUT_PARAMETERS)
        .withColumn("table_name", F.lit(kind.name))
        for kind in layout.LAYOUTS
    ]
    return results[0].unionByName(results[1]).unionByName(results[2])


@register
def layout_time_range(spark, sf):
    return _on_all_layouts(spark, sf, "time_range")


@register
def layout_product_lookup(spark, sf):
    return _on_all_layouts(spark, sf, "product_lookup")


@register
def layout_product_time_range(spark, sf):
    return _on_all_layouts(spark, sf, "product_time_range")


@register
def layout_aggregation(spark, sf):
    return _on_all_layouts(spark, sf, "aggregation")


@register
def layout_rows_met(spark, sf):
    """Rows of each layout, and how many of them a filter meets, from the files whose range meets it.

    The files left out by their ranges must hold no such row, or the figures differ between layouts.
    """
    path = _written_layouts(spark, sf)
    march = (F.lit("1996-03-01").cast("timestamp"), F.lit("1996-03-31").cast("timestamp"))
    filters = {"time_range": ("event_timestamp", *march), "product_lookup": ("product_id", F.lit("42"), F.lit("42"))}
    found = [
        layout.rows_met(spark.read.parquet(f"{path}/{kind.name}"), *bounds)
        .select(F.lit(kind.name).alias("table_name"), F.lit(name).alias("query_name"), "n", "meets")
        for kind in layout.LAYOUTS for name, bounds in filters.items()
    ]
    return reduce(DataFrame.unionByName, found)


# --- streams -----------------------------------------------------------------


def _event_messages(spark: SparkSession, sf: str) -> DataFrame:
    return samples.event_messages(table_stream(spark, sf, "events"))


def _metric_stream(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.metric_events(_event_messages(spark, sf))


@register
def stream_ingest_events(spark, sf):
    return replay(jobs.parsed_events(_event_messages(spark, sf)), "events", ["event_date", "event_type"])


@register
def stream_ingest_sessions(spark, sf):
    raw = samples.session_messages(table_stream(spark, sf, "orders"))
    return replay(jobs.parsed_sessions(raw), "sessions")


@register
def stream_ingest_session_events(spark, sf):
    raw = samples.session_messages(table_stream(spark, sf, "orders"))
    return replay(jobs.parsed_session_events(raw), "session-events")


@register
def stream_ingest_reviews(spark, sf):
    raw = samples.review_messages(table_stream(spark, sf, "documents"))
    return replay(_review_rows(raw), "reviews")


@register
def stream_ingest_searches(spark, sf):
    raw = samples.search_messages(table_stream(spark, sf, "events"), samples.table(spark, sf, "part"))
    return replay(_search_rows(raw), "searches")


@register
def stream_metrics_5min(spark, sf):
    """Without the sketched user count, which the batch query has exactly."""
    metrics = windows.window_metrics(
        _metric_stream(spark, sf), "5 minutes", samples.ROLES, jobs.METRICS_WATERMARK
    )
    return replay(metrics.drop("unique_users"), "metrics")


@register
def stream_metrics_category_5min(spark, sf):
    metrics = windows.window_category_metrics(
        _metric_stream(spark, sf), "5 minutes", samples.ROLES, jobs.METRICS_WATERMARK
    )
    return replay(metrics.drop("unique_products"), "category-metrics")


@register
def stream_type_counts_5min(spark, sf):
    counts = windows.window_type_counts(_metric_stream(spark, sf), "5 minutes", jobs.METRICS_WATERMARK)
    return replay(counts, "type-counts")


def _stream_hours(spark: SparkSession, sf: str) -> DataFrame:
    return windows.window_counts(jobs.event_times(_event_messages(spark, sf)), "1 hour", jobs.ALERT_WATERMARK)


ALERT_SCHEMA = """
    window_start TIMESTAMP, window_end TIMESTAMP, event_count LONG, avg_count DOUBLE,
    stddev_count DOUBLE, z_score DOUBLE, anomaly_type STRING, severity STRING, detection_time TIMESTAMP
"""


@register
def stream_threshold_alerts(spark, sf):
    alerts = anomalies.threshold_alerts(_stream_hours(spark, sf), LIMITS)
    return replay_batches(
        alerts, "alerts", lambda run: sinks.multi_sink(sinks.path_sink(f"{run}/rows")), ALERT_SCHEMA
    )


@register
def stream_outage_alerts(spark, sf):
    """Closed windows, and the empty ones between them; the last open window is left out as in any append."""
    counts = windows.window_counts(jobs.event_times(_event_messages(spark, sf)), "5 minutes", jobs.ALERT_WATERMARK)
    limits = Thresholds(high=4, low=1, mean=1.0, stddev=1.0)
    return replay_batches(
        counts, "outage-alerts",
        lambda run: jobs.threshold_alert_sink(f"{run}/state", sinks.path_sink(f"{run}/rows"), limits, 300), ALERT_SCHEMA,
    )


@register
def stream_purchase_outages(spark, sf):
    """Five minutes without a purchase while other events go on: these are the heartbeat."""
    times = jobs.metric_events(_event_messages(spark, sf))
    beats = jobs.event_times(_event_messages(spark, sf))
    counts = windows.beating_counts(
        _of_kind(times, samples.ROLES.purchase), beats, "5 minutes", jobs.ALERT_WATERMARK, "0 minutes"
    )
    return replay_batches(
        counts, "purchase-outages",
        lambda run: sinks.multi_sink(lambda batch, i: sinks.path_sink(f"{run}/rows")(
            anomalies.threshold_alerts(batch, Thresholds(high=10, low=1, mean=1.0, stddev=1.0)), i)), ALERT_SCHEMA,
    )


@register
def stream_view_to_purchase(spark, sf):
    times = jobs.metric_events(_event_messages(spark, sf)).select("event_id", "event_type", "user_id", "product_id", "event_timestamp")
    again = jobs.metric_events(_event_messages(spark, sf)).select("event_id", "event_type", "user_id", "product_id", "event_timestamp")
    views, bought = _of_kind(times, samples.ROLES.view), _of_kind(again, samples.ROLES.purchase)
    found = timejoins.followed_within(views, bought, ("user_id", "product_id"), WEEK_SECONDS, jobs.METRICS_WATERMARK)
    return replay(found, "view-to-purchase")


@register
def stream_session_windows(spark, sf):
    found = windows.session_windows(_metric_stream(spark, sf), 12 * HOUR, roles=samples.ROLES, watermark=jobs.METRICS_WATERMARK)
    return replay(found, "session-windows")


@register
def stream_ingest_distinct(spark, sf):
    """Messages sent twice: within a batch, in a later one, and after a restart from the checkpoint."""
    run = scratch_path(spark, "distinct")
    sent = samples.event_messages(samples.table(spark, sf, "events"), "event_id AS number")
    source = json_lines_source(f"{run}/topic", files_per_batch=2)
    parts = ("number % 3 = 0 OR number % 5 = 0", "number % 3 <> 0 OR number % 7 = 0")
    for which in parts:
        # a third of the messages stand twice in one file
        twice = sent.filter(which).withColumn("copy", F.explode(F.sequence(F.lit(0), (F.col("number") % 3 == 0).cast("int"))))
        twice.repartition(4, "number").select("value").write.mode("append").text(f"{run}/topic")
        rows = jobs.distinct_events(jobs.parsed_events(read_stream(spark, source)), "60 days")
        finish(sinks.append_to_path(rows, f"{run}/rows", f"{run}/checkpoint", trigger="once"))
    return spark.read.schema(rows.schema).parquet(f"{run}/rows")


@register
def stream_rolling_alerts(spark, sf):
    return replay_batches(
        _stream_hours(spark, sf), "rolling-alerts",
        lambda run: jobs.rolling_alert_sink(f"{run}/history", sinks.path_sink(f"{run}/rows"), **ROLLING), ALERT_SCHEMA,
    )


@register
def stream_top_products_daily(spark, sf):
    counts = windows.window_product_counts(_metric_stream(spark, sf), "1 day", jobs.METRICS_WATERMARK)
    return replay_batches(
        counts, "top-products", lambda run: jobs.top_product_sink(sinks.path_sink(f"{run}/rows")),
        "window_start TIMESTAMP, window_end TIMESTAMP, product_id STRING, event_count LONG, rank INT",
    )
