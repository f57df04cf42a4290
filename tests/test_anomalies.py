from __future__ import annotations

import math
import random
from datetime import datetime, timedelta

import pytest

from conftest import rows_of
from eventlake.config import Thresholds
from eventlake.operators import anomalies, windows

START = datetime(2024, 1, 1)


def counts_of(spark, numbers, minutes=60):
    rows = [
        (START + timedelta(minutes=minutes * i), START + timedelta(minutes=minutes * (i + 1)), n)
        for i, n in numbers
    ]
    return spark.createDataFrame(rows, "window_start TIMESTAMP, window_end TIMESTAMP, event_count LONG")


def test_thresholds(spark):
    numbers = list(enumerate([500, 501, 1000, 1001, 10, 9]))
    found = rows_of(
        anomalies.threshold_alerts(counts_of(spark, numbers)), "event_count", "anomaly_type", "severity", "z_score"
    )
    assert found == [
        (1000, "High Traffic Spike", "WARNING", 15.0), (1001, "High Traffic Spike", "CRITICAL", 15.02),
        (501, "High Traffic Spike", "WARNING", 5.02), (9, "Traffic Drop", "WARNING", -4.82),
    ]


@pytest.mark.parametrize("hours", [1, 5, 24, 50])
def test_rolling_stats_against_brute_force(spark, hours):
    """Windows of history reach over any number of day boundaries."""
    rng = random.Random(hours)
    numbers = [(i, rng.randint(0, 50)) for i in range(24 * 9) if rng.random() < 0.8]
    found = {
        r["window_start"]: r
        for r in anomalies.rolling_stats(counts_of(spark, numbers), hours * 3600).collect()
    }
    assert len(found) == len(numbers)
    for i, _ in numbers:
        before = [n for j, n in numbers if i - hours <= j < i]
        row = found[START + timedelta(hours=i)]
        assert row["history"] == len(before)
        if before:
            mean = sum(before) / len(before)
            assert row["avg_count"] == pytest.approx(mean)
        if len(before) > 1:
            variance = sum((n - mean) ** 2 for n in before) / (len(before) - 1)
            assert row["stddev_count"] == pytest.approx(math.sqrt(variance), abs=1e-6)


def test_rolling_alerts_spike_and_drop(spark):
    numbers = [(i, 100 + i % 3) for i in range(40)] + [(40, 200), (41, 0)]
    found = rows_of(
        anomalies.rolling_alerts(counts_of(spark, numbers), 20 * 3600), "event_count", "anomaly_type"
    )
    assert found == [(0, "Traffic Drop"), (200, "High Traffic Spike")]


@pytest.mark.parametrize("bounds", [(None, None), ("2024-01-01 00:00:00", "2024-01-04 03:00:00")])
def test_empty_windows_are_filled(spark, bounds):
    numbers = [(0, 5), (2, 7), (75, 1)]
    found = anomalies.fill_empty_windows(counts_of(spark, numbers), 3600, *bounds)
    assert rows_of(found.filter("event_count > 0"), "event_count") == [(1,), (5,), (7,)]
    assert found.count() == 76
    assert found.select("window_start").distinct().count() == 76
    limits = Thresholds(high=100, low=1)
    assert anomalies.threshold_alerts(found, limits).count() == 73


def test_approximate_users_are_close(spark):
    from pyspark.sql import functions as F

    events = spark.range(40_000).select(
        F.lit(START).alias("event_timestamp"), (F.col("id") % 10_000).alias("user_id"),
        F.lit("view").alias("event_type"), F.lit(None).cast("int").alias("total_amount"),
    )
    exact = windows.window_metrics(events, exact=True).first()["unique_users"]
    close = windows.window_metrics(events).first()["unique_users"]
    assert exact == 10_000
    assert abs(close - exact) / exact <= 0.15


def test_top_products_break_ties_by_id(make_events):
    rows = [(f"{p}{i}", "view", "u", p, "2024-01-01T00:00:00", None) for p in "cba" for i in range(2)]
    rows.append(("x", "view", "u", "c", "2024-01-01T00:01:00", None))
    rows.append(("y", "view", "u", None, "2024-01-01T00:01:00", None))
    found = windows.top_products(windows.window_product_counts(make_events(rows)), 2)
    assert rows_of(found, "rank", "product_id", "event_count") == [(1, "c", 3), (2, "a", 2)]


def test_windows_without_purchases_have_no_order_value(make_events):
    row = windows.window_metrics(make_events([("1", "view", "u", "p", "2024-01-01T00:00:00", None)])).first()
    assert (row["total_revenue"], row["purchase_count"], row["avg_order_value"]) == (None, 0, None)
