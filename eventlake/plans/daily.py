"""The nightly run of one day: checks first, then the reports."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.config import Settings
from eventlake.functions.text import REVIEW_ASPECTS, REVIEW_LEXICON
from eventlake.operators import cohort, daily, quality, reviews, searches
from eventlake.sources.tables import TableStore


# Days over which a second purchase counts.
REPURCHASE_DAYS = 30


def run_quality(store: TableStore, day: str) -> DataFrame:
    """Write the day's checks and return them as stored."""
    store.create("events", "data_quality")
    checks = quality.quality_checks(
        store.read("events"), day, roles=store.settings.roles, table_name=store.full_name("events"),
        arrival="arrival_date",
    )
    store.overwrite_day(checks.withColumn("checked_at", F.current_timestamp()), "data_quality", "check_date", day)
    return daily.on_day(store.read("data_quality"), "check_date", day)


def _write_all(store: TableStore, day: str, reports: dict[str, DataFrame]) -> None:
    """Independent reports run side by side, so that one's last tasks do not idle the cluster."""
    store.create(*reports)
    with ThreadPoolExecutor(len(reports)) as pool:
        runs = [
            pool.submit(store.overwrite_day, report, table, "report_date", day)
            for table, report in reports.items()
        ]
    for run in runs:
        run.result()


def run_aggregation(store: TableStore, day: str) -> None:
    store.create("events")
    roles = store.settings.roles
    events = daily.on_day(store.read("events"), "event_date", day)
    target = F.lit(day).cast("date")
    two_days = store.read("events").filter(F.col("event_date").between(F.date_sub(target, 1), target))
    buying = store.read("events").filter(F.col("event_date").between(F.date_sub(target, REPURCHASE_DAYS - 1), target))
    # one row per product and day, read by two reports
    products = daily.product_days(events, roles).persist()
    try:
        _write_all(store, day, {
            "daily_summary": daily.daily_summary(events, roles).withColumn("created_at", F.current_timestamp()),
            "hourly_metrics": daily.hourly_metrics(events, roles),
            "daily_category": daily.category_metrics(products),
            "daily_product": daily.product_metrics(products),
            "volume_change": daily.volume_change(two_days).filter(F.col("report_date") == target),
            "repurchase": daily.repurchase_rate(buying, roles).withColumns({
                "report_date": target, "days": F.lit(REPURCHASE_DAYS),
            }),
        })
    finally:
        products.unpersist()


def run_reviews(store: TableStore, day: str) -> None:
    store.create("reviews")
    rows = daily.on_day(store.read("reviews"), "created_date", day)
    # the texts are searched once; four reports read the words found
    tagged = reviews.tag_reviews(rows, REVIEW_LEXICON, REVIEW_ASPECTS, stored=True).persist()
    try:
        _write_all(store, day, {
            "review_daily_summary": reviews.review_summary(tagged),
            "review_keywords": reviews.keyword_frequency(tagged),
            "review_aspects": reviews.aspect_sentiment(tagged),
            "product_review_summary": reviews.product_reviews(tagged),
        })
    finally:
        tagged.unpersist()


def _days_of(events: DataFrame) -> DataFrame:
    """Rows and newest file per day. No column of the rows is read where the day is a partition."""
    changed = F.max("_metadata.file_modification_time")
    return events.filter(F.col("event_date").isNotNull()).groupBy("event_date").agg(
        F.count("*").alias("n"), changed.cast("timestamp").alias("changed")
    )


def run_searches(store: TableStore, day: str) -> None:
    store.create("search_queries")
    rows = daily.on_day(store.read("search_queries"), "search_date", day)
    _write_all(store, day, {
        "search_metrics": searches.search_metrics(rows).withColumnRenamed("search_date", "report_date"),
        "popular_searches": searches.popular_searches(rows).withColumn("report_date", F.lit(day).cast("date")),
    })


def _bring_up_to_date(store: TableStore, weeks: list[date]) -> None:
    """The user-weeks of these weeks anew: one job reads and writes them all, other weeks are not read."""
    parts = store.by_partition()
    in_weeks = F.col("event_date").isin([week + timedelta(days=i) for week in weeks for i in range(7)])
    seen = cohort.user_weeks(parts.read("events").filter(in_weeks), store.settings.roles).persist()
    try:
        parts.overwrite_partitions(seen, "user_weeks")
        there = {row["activity_week"] for row in seen.select("activity_week").distinct().collect()}
        for week in sorted(set(weeks) - there):  # no row is left
            parts.overwrite_partition(seen.limit(0), "user_weeks", "activity_week", week.isoformat())
    finally:
        seen.unpersist()
    store.spark.catalog.refreshTable(store.full_name("user_weeks"))


def run_cohorts(store: TableStore, day: str, rebuild: bool = False) -> DataFrame:
    """Retention as of the day.

    The user-weeks of a week are kept whole, whatever day the run is for, with the state of the days
    they were made from. A run brings up to date every week that has a day which is new, has changed
    or has gone since, however long ago it lies, and reads no other week; `rebuild` reads all events.
    Only the report is cut at the day.
    """
    store.create("events", "user_weeks", "cohort_days", "cohort_retention")
    roles = store.settings.roles
    events = store.read("events")
    target = F.lit(day).cast("date")
    # one row per day; taken before the events are read, so that rows that come meanwhile count as new
    days = store.spark.createDataFrame(_days_of(events).collect(), "event_date DATE, n LONG, changed TIMESTAMP")
    known = store.read("cohort_days")
    if rebuild or known.isEmpty():
        store.overwrite(cohort.user_weeks(events, roles), "user_weeks")
    else:
        either = days.alias("a").join(known.alias("b"), "event_date", "full")
        same = F.col("a.n").eqNullSafe(F.col("b.n")) & F.col("a.changed").eqNullSafe(F.col("b.changed"))
        week = F.date_trunc("week", "event_date").cast("date").alias("week")
        weeks = [row["week"] for row in either.filter(~same).select(week).distinct().collect()]
        if weeks:
            _bring_up_to_date(store, weeks)
    store.overwrite(days, "cohort_days")
    active = store.read("user_weeks").filter(F.col("first_day") <= target)
    store.overwrite(
        cohort.retention(active).withColumn("calculation_date", target), "cohort_retention"
    )
    return store.read("cohort_retention")


def run_daily(
    spark: SparkSession,
    day: str,
    settings: Settings = Settings(),
    with_cohorts: bool = False,
    gate: Callable[[DataFrame], None] = quality.quality_gate,
) -> None:
    """Checks, then reports side by side; a failed check stops the run before any report is written."""
    store = TableStore(spark, settings)
    gate(run_quality(store, day))
    jobs = [run_aggregation, run_reviews, run_searches, *([run_cohorts] if with_cohorts else [])]
    with ThreadPoolExecutor(len(jobs)) as pool:
        runs = [pool.submit(job, store, day) for job in jobs]
    for run in runs:
        run.result()
