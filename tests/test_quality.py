from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import day, rows_of
from eventlake.operators import quality


def day_of(n, when="2024-01-02", **changes):
    """n clean events of one day; `nulls` blanks user ids, `copies` repeats an id."""
    nulls, copies = changes.get("nulls", 0), changes.get("copies", 0)
    return [
        (
            f"{when}-{0 if i < copies + (copies > 0) else i}", "view", None if i < nulls else "u", "p",
            f"{when}T10:00:00", None,
        )
        for i in range(n)
    ]


def status(checks, name):
    return [r["status"] for r in checks.filter(f"check_name = '{name}'").collect()]


@pytest.mark.parametrize("nulls, expected", [(0, "PASS"), (9, "PASS"), (10, "WARN"), (49, "WARN"), (50, "FAIL")])
def test_null_rate_edges(make_events, nulls, expected):
    checks = quality.quality_checks(make_events(day_of(1000, nulls=nulls)), "2024-01-02")
    assert status(checks, "user_id_null_rate") == [expected]


@pytest.mark.parametrize("copies, expected", [(0, "PASS"), (1, "WARN"), (9, "WARN"), (10, "FAIL")])
def test_duplicate_edges(make_events, copies, expected):
    checks = quality.quality_checks(make_events(day_of(1000, copies=copies)), "2024-01-02")
    assert status(checks, "duplicate_events") == [expected]


@pytest.mark.parametrize("today, expected", [(149, "PASS"), (150, "WARN"), (51, "PASS"), (50, "WARN")])
def test_volume_edges(make_events, today, expected):
    events = make_events(day_of(100, "2024-01-01") + day_of(today))
    assert status(quality.quality_checks(events, "2024-01-02"), "volume_change") == [expected]
    assert status(quality.quality_checks(events), "volume_change") == [expected]


def test_day_without_data_fails_and_has_no_other_family(make_events):
    checks = quality.quality_checks(make_events(day_of(10, "2024-01-01")), "2024-01-02")
    assert rows_of(checks, "check_name", "status") == [("has_data", "FAIL"), ("volume_change", "WARN")]


def test_missing_days_are_reported(make_events):
    checks = quality.quality_checks(make_events(day_of(3, "2024-01-01") + day_of(3, "2024-01-05")))
    empty = checks.filter("check_name = 'has_data' AND status = 'FAIL'")
    assert rows_of(empty, "check_date") == [(day("2024-01-02"),), (day("2024-01-03"),), (day("2024-01-04"),)]


def test_values_and_texts(make_events, spark):
    rows = day_of(4) + [
        ("x", "teleport", "u", "p", "2024-01-02T10:00:00", None),
        ("y", "purchase", "u", "p", "2024-01-02T10:00:00", None),
        ("z", "purchase", "u", "p", "2024-01-02T10:00:00", 5),
        ("w", None, "u", "p", "2024-01-02T10:00:00", None),
    ]
    events = make_events(rows).withColumn("price", F.when(F.col("event_id") == "x", -1).otherwise(5))
    events = events.withColumn(
        "event_timestamp",
        F.when(F.col("event_id") == "z", F.lit("2024-01-03").cast("timestamp")).otherwise(F.col("event_timestamp")),
    )
    checks = {r["check_name"]: r for r in quality.quality_checks(events, "2024-01-02").collect()}
    assert (checks["price_positive"]["status"], checks["price_positive"]["actual_value"]) == ("FAIL", "-1")
    assert (checks["valid_event_types"]["status"], checks["valid_event_types"]["actual_value"]) == ("FAIL", "1")
    assert checks["timestamp_in_range"]["status"] == "WARN"
    assert checks["purchase_has_amount"]["details"] == "1/2 purchases missing amount"
    assert checks["event_type_null_rate"]["actual_value"] == "12.50%"
    assert checks["event_type_null_rate"]["details"] == "1 nulls out of 8"
    report = quality.quality_report(quality.quality_checks(events, "2024-01-02")).first()
    assert report["total"] == report["pass"] + report["warn"] + report["fail"] == 11


def test_gate(make_events):
    quality.quality_gate(quality.quality_checks(make_events(day_of(10)), "2024-01-02"))
    with pytest.raises(quality.QualityGateError, match="has_data"):
        quality.quality_gate(quality.quality_checks(make_events(day_of(10)), "2024-02-02"))


def test_gate_counts_every_failure(spark):
    rows = spark.range(25).selectExpr("'events' AS table_name", "concat('check', id) AS check_name", "'FAIL' AS status", "'x' AS details")
    with pytest.raises(quality.QualityGateError, match="25 checks failed.*and 5 more"):
        quality.quality_gate(rows)


def test_rows_without_time_and_late_rows_are_reported_by_arrival(make_events):
    rows = day_of(8) + [("late", "view", "u", "p", "2024-01-01T10:00:00", None), ("never", "view", "u", "p", None, None)]
    events = make_events(rows).withColumn("arrival_date", F.lit("2024-01-02").cast("date"))
    checks = quality.quality_checks(events, "2024-01-02", arrival="arrival_date")
    found = {r["check_name"]: (r["status"], r["actual_value"]) for r in checks.collect()}
    assert found["has_data"] == ("PASS", "9")
    assert found["event_timestamp_null_rate"] == ("FAIL", "11.11%")
    day_before = quality.quality_checks(events, "2024-01-01", arrival="arrival_date")
    assert {r["check_name"]: r["actual_value"] for r in day_before.collect()}["timestamp_in_range"] == "1"
