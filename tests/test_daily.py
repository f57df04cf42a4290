from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import day, rows_of
from eventlake.operators import cohort, daily, serving, sessions
from eventlake.config import EventRoles


@pytest.fixture
def events(make_events):
    return make_events([
        ("1", "view", "a", "p1", "2024-01-01T10:00:00", None),
        ("2", "purchase", "a", "p1", "2024-01-01T10:05:00", 300),
        ("3", "purchase", "b", "p2", "2024-01-01T11:00:00", None),
        ("4", "add_cart", "b", "p2", "2024-01-01T11:00:00", None),
        ("5", "view", None, None, "2024-01-02T00:00:00", None),
        ("6", "search", "c", None, "2024-01-04T00:00:00", None),
    ])


def test_summary(events):
    found = {r["report_date"]: r for r in daily.daily_summary(events).collect()}
    first = found[day("2024-01-01")]
    assert (first["total_events"], first["unique_users"], first["total_orders"]) == (4, 2, 2)
    assert (first["total_revenue"], first["avg_order_value"], first["conversion_rate"]) == (300, 150.0, 1.0)
    quiet = found[day("2024-01-02")]
    assert (quiet["unique_users"], quiet["total_revenue"]) == (0, 0)
    assert (quiet["avg_order_value"], quiet["conversion_rate"]) == (0.0, 0.0)


def test_products_without_views_are_left_out(events):
    found = daily.product_metrics(daily.product_days(events))
    picked = rows_of(found, "product_id", "views", "purchases", "revenue", "conversion_rate")
    assert picked == [("p1", 1, 1, 300, 100.0), (None, 1, 0, 0, 0.0)]


def test_top_product_by_revenue_then_events_then_id(make_events):
    rows = [(str(i), "view", "u", p, "2024-01-01T00:00:00", None) for i, p in enumerate("zzyx")]
    days = daily.product_days(make_events(rows))
    assert daily.category_metrics(days).first()["top_product_id"] == "z"
    sold = [*rows, ("9", "purchase", "u", "y", "2024-01-01T00:00:00", 5), ("8", "purchase", "u", "x", "2024-01-01T00:00:00", 5)]
    top = daily.category_metrics(daily.product_days(make_events(sold))).first()
    assert (top["top_product_id"], top["unique_products"], top["orders"]) == ("x", 3, 2)


def test_volume_change_needs_the_day_before(events):
    found = rows_of(daily.volume_change(events), "report_date", "events", "previous_events", "change_pct")
    assert found == [
        (day("2024-01-01"), 4, None, None), (day("2024-01-02"), 1, 4, -75.0), (day("2024-01-04"), 1, None, None),
    ]


def test_kpi_changes(events):
    found = {r["report_date"]: r for r in serving.kpi_cards(daily.daily_summary(events)).collect()}
    assert found[day("2024-01-02")]["active_users_change"] == -2
    assert found[day("2024-01-04")]["orders_change"] is None


def test_recent_totals(events):
    last = serving.recent_totals(events, 60 * 24 * 2 + 1).first()
    assert (last["total_events"], last["orders"], last["unique_users"]) == (2, 0, 1)
    moment = F.lit("2024-01-01 10:05:00").cast("timestamp")
    then = serving.recent_totals(events, 5, until=moment).first()
    assert (then["total_events"], then["total_revenue"], then["orders"]) == (1, 300, 1)
    assert rows_of(serving.recent_by_type(events, 6, until=moment)) == [("purchase", 1), ("view", 1)]


def test_repurchase(make_events):
    rows = [
        ("1", "purchase", "a", "p", "2024-01-01T00:00:00", 1), ("2", "purchase", "a", "p", "2024-01-03T00:00:00", 1),
        ("3", "purchase", "b", "p", "2024-01-01T00:00:00", 1), ("4", "purchase", "b", "p", "2024-01-01T09:00:00", 1),
        ("5", "view", "b", "p", "2024-01-05T00:00:00", None),
    ]
    row = daily.repurchase_rate(make_events(rows)).first()
    assert (row["purchasers"], row["repeat_purchasers"], row["repurchase_rate"]) == (2, 1, 0.5)


def test_retention(make_events):
    rows = [
        ("1", "view", "a", "p", "2024-01-01T00:00:00", None), ("2", "view", "a", "p", "2024-01-07T00:00:00", None),
        ("3", "view", "a", "p", "2024-01-08T00:00:00", None), ("4", "purchase", "b", "p", "2024-01-03T00:00:00", 1),
        ("5", "view", "c", "p", "2024-01-15T00:00:00", None), ("6", "search", "b", "p", "2024-01-09T00:00:00", None),
    ]
    events = make_events(rows)
    found = rows_of(
        cohort.cohort_retention(events),
        "cohort_week", "period_week", "cohort_size", "retained_users", "retention_rate",
    )
    assert found == [
        (day("2024-01-01"), 0, 2, 2, 1.0), (day("2024-01-01"), 1, 2, 1, 0.5), (day("2024-01-15"), 0, 1, 1, 1.0),
    ]
    assert cohort.cohort_retention(events, as_of="2024-01-07").count() == 1
    matrix = cohort.retention_matrix(cohort.cohort_retention(events), [0, 1])
    assert rows_of(matrix) == [(day("2024-01-01"), 1.0, 0.5), (day("2024-01-15"), 1.0, None)]


def test_session_forms_agree(spark):
    schema = "session_id STRING, events ARRAY<STRUCT<event_type: STRING, product: STRUCT<product_id: STRING>>>"
    rows = [
        ("a", [("view", ("p1",)), ("view", ("p1",)), ("purchase", ("p2",)), (None, None)]),
        ("b", [("search", None)]),
    ]
    parsed = spark.createDataFrame(rows, schema)
    flat = parsed.selectExpr("session_id", "inline(events)").selectExpr(
        "session_id", "event_type", "product.product_id"
    )
    columns = ("session_id", *sessions.SUMMARY)
    by_array = rows_of(sessions.summarize_sessions(parsed), *columns)
    assert by_array == rows_of(sessions.summarize_session_events(flat), *columns)
    assert by_array[0] == ("a", 4, 2, 0, 2, 0, 1, True, False)
    assert by_array[1] == ("b", 1, 0, 1, 0, 0, 0, False, True)
    empty = spark.createDataFrame([("c", None)], schema)
    assert sessions.summarize_sessions(empty).first()["total_events"] == 0


def test_summary_mismatch_is_counted(spark):
    schema = """session_id STRING, events ARRAY<STRUCT<event_type: STRING, product: STRUCT<product_id: STRING>>>,
        summary STRUCT<total_events: INT, unique_products_viewed: INT, searches_count: INT, views_count: INT,
        add_cart_count: INT, purchase_count: INT, converted: BOOLEAN, bounce: BOOLEAN>"""
    events = [("view", ("p",))]
    rows = [("a", events, (1, 1, 0, 1, 0, 0, False, True)), ("b", events, (2, 1, 0, 1, 0, 0, False, None))]
    found = dict(rows_of(
        sessions.summary_mismatches(spark.createDataFrame(rows, schema), EventRoles()), "field", "mismatched"
    ))
    assert found["total_events"] == 1 and found["bounce"] == 1 and found["views_count"] == 0
