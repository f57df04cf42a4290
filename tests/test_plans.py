from __future__ import annotations

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from conftest import day, rows_of
from eventlake.config import Settings, checkpoint_path, scratch_path, shared_dir
from eventlake.operators import cohort, layout, quality, serving
from eventlake.plans import daily
from eventlake.sources.tables import TableStore

DAY = "2024-01-02"


@pytest.fixture
def filled(store, make_events, spark):
    store.create("events", "reviews")
    rows = [
        ("1", "view", "a", "p1", "2024-01-01T10:00:00", None), ("2", "view", "b", "p1", f"{DAY}T10:00:00", None),
        ("3", "purchase", "b", "p1", f"{DAY}T11:00:00", 70), ("4", "add_cart", "a", "p2", f"{DAY}T12:00:00", None),
        ("5", "view", "a", "p1", "2024-01-09T10:00:00", None),
    ]
    missing = [c for c in store.columns("events") if c not in make_events(rows).columns]
    store.append(make_events(rows).withColumns({c: F.lit(None) for c in missing}), "events")
    reviews = spark.createDataFrame(
        [("r1", "p1", 5, "배송 빠르고 좋아요", DAY), ("r2", "p1", 1, "별로", DAY), ("r3", "p2", 3, "보통", "2024-01-01")],
        "review_id STRING, product_id STRING, rating INT, review_text STRING, d STRING",
    ).withColumn("created_date", F.col("d").cast("date"))
    reviews = reviews.withColumns({"text_length": F.length("review_text"), "has_images": F.lit(False)})
    missing = [c for c in store.columns("reviews") if c not in reviews.columns]
    store.append(reviews.withColumns({c: F.lit(None) for c in missing}), "reviews")
    return store


REPORTS = (
    "daily_summary", "hourly_metrics", "daily_category", "daily_product", "review_daily_summary",
    "review_keywords", "review_aspects", "product_review_summary", "data_quality",
)


def snapshot(store):
    found = {}
    for name in REPORTS:
        df = store.read(name)
        found[name] = rows_of(df.drop("created_at", "checked_at"))
    return found


def test_run_and_rerun_leave_the_same_tables(filled, spark):
    daily.run_daily(spark, DAY, filled.settings)
    once = snapshot(filled)
    assert all(once.values())
    daily.run_daily(spark, DAY, filled.settings)
    assert snapshot(filled) == once
    daily.run_aggregation(filled, "2024-01-01")
    after = snapshot(filled)
    assert len(after["daily_summary"]) == 2
    assert set(once["daily_summary"]) < set(after["daily_summary"])
    row = filled.read("daily_summary").filter(F.col("report_date") == DAY).first()
    assert (row["total_events"], row["total_revenue"], row["conversion_rate"]) == (3, 70, 0.5)
    words = rows_of(filled.read("product_review_summary"), "product_id", "top_positive_keywords", "top_negative_keywords")
    assert words == [("p1", "빠르,좋아,좋아요", "별로")]


def test_planned_metrics_are_stored(filled, spark):
    daily.run_aggregation(filled, DAY)
    assert rows_of(filled.read("repurchase"), "days", "purchasers", "repeat_purchasers") == [(30, 1, 0)]
    assert rows_of(filled.read("volume_change"), "events", "previous_events", "change_pct") == [(3, 1, 200.0)]
    filled.create("search_queries")
    rows = spark.createDataFrame(
        [("s1", "bag", True, 3), ("s2", "bag", False, 0), ("s3", "hat", False, 2)],
        "search_id STRING, query_norm STRING, clicked BOOLEAN, result_count INT",
    ).withColumn("search_date", F.lit(DAY).cast("date"))
    missing = [c for c in filled.columns("search_queries") if c not in rows.columns]
    filled.append(rows.withColumns({c: F.lit(None) for c in missing}), "search_queries")
    for _ in range(2):
        daily.run_searches(filled, DAY)
    assert rows_of(filled.read("search_metrics"), "searches", "clicks", "empty_searches") == [(3, 1, 1)]
    assert rows_of(filled.read("popular_searches"), "query_norm", "searches") == [("bag", 2), ("hat", 1)]


def test_failed_check_stops_before_the_reports(filled, spark):
    with pytest.raises(quality.QualityGateError):
        daily.run_daily(spark, "2024-01-05", filled.settings)
    assert filled.read("data_quality").count() > 0
    assert not spark.catalog.tableExists(filled.full_name("daily_summary"))


def test_day_that_became_empty_is_cleared(filled, spark):
    daily.run_aggregation(filled, DAY)
    empty = spark.createDataFrame([], filled.read("events").schema)
    filled.overwrite_day(empty, "events", "event_date", DAY)
    assert filled.read("events").count() == 2
    daily.run_aggregation(filled, DAY)
    assert filled.read("daily_summary").count() == 0
    assert filled.read("hourly_metrics").count() == 0


def test_day_filter_prunes_partitions(filled):
    events = daily.daily.on_day(filled.read("events"), "event_date", DAY)
    plan = events._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_cohorts_by_week_equal_a_rebuild(filled):
    columns = ("cohort_week", "period_week", "cohort_size", "retained_users")
    daily.run_cohorts(filled, "2024-01-03")
    weekly = rows_of(daily.run_cohorts(filled, "2024-01-09"), *columns)
    rebuilt = rows_of(daily.run_cohorts(filled, "2024-01-09", rebuild=True), *columns)
    direct = rows_of(cohort.cohort_retention(filled.read("events"), as_of="2024-01-09"), *columns)
    assert weekly == rebuilt == direct == [(day("2024-01-01"), 0, 2, 2), (day("2024-01-01"), 1, 2, 1)]
    rate = filled.read("cohort_retention").filter("period_week = 1").first()
    assert (rate["retention_rate"], rate["calculation_date"]) == (0.5, day("2024-01-09"))


def test_cohorts_after_a_gap_a_late_day_and_a_backdated_rerun(store, make_events, spark):
    store.create("events")
    columns = ("cohort_week", "period_week", "cohort_size", "retained_users")

    def add(*rows):
        events = make_events([(str(i), "view", user, "p", f"{when}T10:00:00", None) for i, (user, when) in enumerate(rows)])
        missing = [c for c in store.columns("events") if c not in events.columns]
        store.append(events.withColumns({c: F.lit(None) for c in missing}), "events")

    def direct(as_of):
        return rows_of(cohort.cohort_retention(store.read("events"), as_of=as_of), *columns)

    add(("a", "2024-01-02"), ("b", "2024-01-03"))
    assert rows_of(daily.run_cohorts(store, "2024-01-03"), *columns) == direct("2024-01-03")
    add(("a", "2024-01-09"), ("c", "2024-01-10"), ("c", "2024-01-24"), ("b", "2024-01-25"))
    assert rows_of(daily.run_cohorts(store, "2024-01-24"), *columns) == direct("2024-01-24")
    add(("c", "2024-01-04"))  # weeks late
    assert rows_of(daily.run_cohorts(store, "2024-01-03"), *columns) == direct("2024-01-03")
    assert rows_of(daily.run_cohorts(store, "2024-01-25"), *columns) == direct("2024-01-25")
    store.overwrite_day(spark.createDataFrame([], store.read("events").schema), "events", "event_date", "2024-01-10")
    assert rows_of(daily.run_cohorts(store, "2024-01-25"), *columns) == direct("2024-01-25")


def test_matrix_keeps_all_periods(spark):
    rows = spark.createDataFrame([(day("2024-01-01"), 0, 1.0), (day("2024-01-01"), 7, 0.5)], "cohort_week DATE, period_week INT, retention_rate DOUBLE")
    wide = cohort.retention_matrix(rows).first()
    assert (wide["week_0"], wide["week_3"], wide["week_7"]) == (1.0, None, 0.5)
    with pytest.raises(ValueError, match="period 7"):
        cohort.retention_matrix(rows, range(5))


def test_recent_events_read_their_days_only(filled):
    until = F.lit(f"{DAY} 12:00:00").cast("timestamp")
    recent = serving.recent_events(filled.read("events"), 60, until)
    assert sorted(r["event_id"] for r in recent.collect()) == ["4"]
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and plan.count("FileScan") == 1


def test_whole_table_overwrite_drops_old_partitions(filled, spark):
    daily.run_cohorts(filled, "2024-01-09")
    filled.overwrite(filled.spark.createDataFrame(
        [(day("2025-01-06"), 1, 0, 1, 1.0, day("2025-01-06"))],
        "cohort_week DATE, cohort_size LONG, period_week INT, retained_users LONG, retention_rate FLOAT, calculation_date DATE",
    ), "cohort_retention")
    assert rows_of(filled.read("cohort_retention"), "cohort_week") == [(day("2025-01-06"),)]


def test_tables_at_a_path_are_found_again_without_a_metastore(spark, make_events, tmp_path):
    settings = Settings(database="first_session", lake_path=str(tmp_path / "lake"))
    first = TableStore(spark, settings)
    first.create("daily_product", "data_quality", "benchmark_results")
    events = make_events([("1", "view", "a", "p1", f"{DAY}T10:00:00", None)])
    report = daily.daily.product_metrics(daily.daily.product_days(events))
    first.overwrite_day(report, "daily_product", "report_date", DAY)
    later = TableStore(spark, Settings(database="later_session", lake_path=str(tmp_path / "lake")))
    later.create("daily_product")
    assert rows_of(later.read("daily_product"), "product_id", "views") == [("p1", 1)]
    later.overwrite_day(report.limit(0), "daily_product", "report_date", DAY)
    assert later.read("daily_product").count() == 0


def test_scratch_follows_the_session(spark):
    assert scratch_path(spark, "x").startswith(f"{shared_dir(spark)}/eventlake/x-")
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert checkpoint_path("s3a://b/cp/", "events") == "s3a://b/cp/events"


def test_layouts(spark, tmp_path):
    df = layout.synthetic_events(spark, 20_000, step_seconds=600)
    assert df.count() == 20_000
    first = df.select("event_timestamp").limit(50).collect()
    assert first != sorted(first)
    load = layout.write_layouts(df, str(tmp_path), files=4)
    assert set(load) == {kind.name for kind in layout.LAYOUTS}
    span = ("event_timestamp", F.lit("2021-01-05").cast("timestamp"), F.lit("2021-01-06").cast("timestamp"))
    touched = {
        kind.name: layout.files_touched(spark.read.parquet(f"{tmp_path}/{kind.name}"), *span).first()
        for kind in layout.LAYOUTS
    }
    assert touched["events_sorted_time"]["files_touched"] == 1
    assert touched["events_unsorted"]["files_touched"] == touched["events_unsorted"]["files"] == 4
    assert touched["events_sorted_time"]["bytes_touched"] < touched["events_sorted_time"]["bytes"]
    timings = layout.time_layouts(spark, str(tmp_path), {
        "day_from": "2021-01-01", "day_to": "2021-01-02", "product": "1234",
        "month_from": "2021-01-01", "month_to": "2021-06-01",
    }, load_seconds=load, runs=1)
    assert timings.count() == 12
    report = layout.layout_report(timings)
    assert report.count() == 4
    assert report.filter("best_layout IS NULL").count() == 0


def test_layouts_by_string_are_not_sorted_by_file(spark, tmp_path):
    df = layout.synthetic_events(spark, 4_000)
    layout.write_layouts(df, str(tmp_path), files=4)
    for kind in layout.LAYOUTS:
        table = spark.read.parquet(f"{tmp_path}/{kind.name}")
        met = layout.rows_met(table, "product_id", F.lit("42"), F.lit("42"))
        for found in (met, layout.files_touched(table, "product_id", "42", "42")):
            assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()
        assert tuple(met.first()) == (4_000, df.filter("product_id = '42'").count())
        per_file = table.groupBy("_metadata.file_path").agg(F.min("product_id").alias("low"), F.max("product_id").alias("high"))
        for low, high in (("42", "42"), ("", "0"), ("zz", "zzz"), ("3", "30")):
            touched = layout.files_touched(table, "product_id", low, high).first()
            assert touched["files_touched"] == per_file.filter(f"low <= '{high}' AND high >= '{low}'").count()


@pytest.mark.parametrize("column", ["product_id", "event_timestamp"])
def test_sorted_files_keep_their_size(spark, tmp_path, column):
    """As many files as the rows ask for, also of one key, whatever the number of partitions of the session."""
    hot = layout.synthetic_events(spark, 20_000).withColumn(column, F.min(column).over(W.partitionBy()))
    kinds = [layout.Layout("by_it", (column,))]
    layout.write_layouts(hot, str(tmp_path), kinds, file_rows=1_000)
    per_file = spark.read.parquet(f"{tmp_path}/by_it").groupBy("_metadata.file_path").count()
    assert per_file.count() == 20
    assert per_file.agg(F.max("count")).first()[0] < 3_000
    layout.write_layouts(hot.limit(0), str(tmp_path), kinds)
    assert spark.read.parquet(f"{tmp_path}/by_it").count() == 0
