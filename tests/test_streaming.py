from __future__ import annotations

import json
import time
import os
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from eventlake.config import Settings, Thresholds
from eventlake.operators import anomalies, timejoins, windows
from eventlake.sources.streams import Source, json_lines_source, read_stream
from eventlake.sources.tables import TableStore
from eventlake.streaming import jobs, sinks


def message(i, when, kind="view", amount=None, user="u"):
    return json.dumps({
        "event_id": f"ev_{i}", "event_type": kind, "user_id": user, "product_id": f"p{i % 3}",
        "category": "home", "timestamp": f"2024-01-01T{when}", "total_amount": amount,
    })


class Feed:
    """A folder of message files that grows between runs."""

    def __init__(self, path):
        self.path = path
        self.files = 0
        path.mkdir()

    def add(self, *messages):
        self.files += 1
        file = self.path / f"{self.files:03}.json"
        file.write_text("\n".join(messages) + "\n")
        # a file stream reads by age
        os.utime(file, (1_700_000_000 + self.files,) * 2)

    def source(self):
        return json_lines_source(str(self.path), 1)


@pytest.fixture
def feed(tmp_path):
    return Feed(tmp_path / "feed")


@pytest.fixture
def lake(spark, tmp_path):
    name = f"stream_{uuid.uuid4().hex[:8]}"
    return Settings(database=name, checkpoint_base=str(tmp_path / "checkpoints"))


def run(spark, job, settings, feed, *extra):
    query = jobs.start(spark, job, settings, feed.source(), "once", extra)
    query.awaitTermination()
    return query


def test_ingest_continues_from_its_checkpoint(spark, feed, lake):
    feed.add(message(1, "10:00:00"), "{broken", message(2, "10:00:01", "purchase", 5))
    run(spark, "events", lake, feed)
    feed.add(message(3, "10:00:02"))
    run(spark, "events", lake, feed)
    run(spark, "events", lake, feed)
    found = TableStore(spark, lake).read("events")
    assert rows_of(found, "event_id", "event_type", "total_amount") == [
        ("ev_1", "view", None), ("ev_2", "purchase", 5), ("ev_3", "view", None),
    ]


@pytest.mark.parametrize("job, table, key", [
    ("reviews", "reviews", "review_id"), ("sessions", "sessions", "session_id"),
    ("session-events", "session_events", "session_id"), ("searches", "search_queries", "search_id"),
])
def test_other_ingests(spark, feed, lake, job, table, key):
    feed.add(json.dumps({
        key: "x1", "rating": 5, "text": "좋아요", "created_at": "2024-01-01T00:00:00",
        "started_at": "2024-01-01T00:00:00", "device": {"type": "mobile"}, "query": "운동화 추천",
        "timestamp": "2024-01-01T00:00:00",
        "events": [{"event_index": 0, "event_type": "view", "timestamp": "2024-01-01T00:00:00"}],
    }, ensure_ascii=False))
    run(spark, job, lake, feed)
    assert [r[key] for r in TableStore(spark, lake).read(table).collect()] == ["x1"]


def test_window_is_emitted_once_and_late_rows_are_counted(spark, feed, lake):
    feed.add(message(1, "10:00:10", user="a"), message(2, "10:04:59", "purchase", 40, user="b"))
    feed.add(message(3, "10:07:00"))
    feed.add(message(6, "10:07:30"))
    feed.add(message(4, "10:01:00"), message(5, "10:08:00"))
    late = jobs.LateRows()
    spark.streams.addListener(late)
    try:
        query = run(spark, "metrics", lake, feed)
        deadline = time.monotonic() + 20
        while not late.counts.get(str(query.id)) and time.monotonic() < deadline:
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(late)
    found = TableStore(spark, lake).read("metrics_5min")
    picked = rows_of(found, "total_events", "unique_users", "total_revenue", "avg_order_value")
    assert picked == [(2, 2, 40, 40.0)]
    assert late.counts[str(query.id)] == 1


def test_category_metrics(spark, feed, lake):
    feed.add(message(1, "10:00:10"), message(2, "10:04:59", "purchase", 40), message(9, "10:30:00"))
    run(spark, "category-metrics", lake, feed)
    found = TableStore(spark, lake).read("metrics_category_5min")
    assert rows_of(found, "category", "event_count", "revenue", "unique_products") == [("home", 2, 40, 2)]


def test_alerts_reach_all_sinks_and_a_failing_one_is_passed_over(spark, feed, lake, caplog):
    feed.add(*[message(i, f"10:00:{i:02}") for i in range(5)], message(99, "10:10:00"))
    seen = []

    def failing(batch, batch_id):
        raise RuntimeError("database is down")

    def counting(batch, batch_id):
        seen.append(batch.count())

    run(spark, "alerts", lake, feed, failing, counting)
    found = TableStore(spark, lake).read("anomaly_alerts")
    assert rows_of(found, "event_count", "anomaly_type", "z_score") == [(5, "Traffic Drop", -4.9)]
    assert sum(seen) == 1
    assert "secondary sink failed" in caplog.text


def test_a_stop_is_reported_when_events_come_again(spark, feed, lake):
    feed.add(*[message(i, f"10:00:{i % 60:02}") for i in range(300)])
    feed.add(message(900, "10:05:00"), message(901, "10:20:00"))
    feed.add(message(902, "10:40:00"))
    run(spark, "alerts", lake, feed)
    feed.add(message(903, "11:00:00"))
    run(spark, "alerts", lake, feed)
    alerts = TableStore(spark, lake).read("anomaly_alerts").filter("event_count = 0")
    minutes = [r["window_start"].strftime("%H:%M") for r in alerts.orderBy("window_start").collect()]
    there = {"10:00", "10:05", "10:20", "10:40"}
    assert minutes == [m for m in (f"10:{n:02}" for n in range(41)) if m not in there]


def test_replayed_batch_is_kept_once_and_a_new_checkpoint_keeps_old_alerts(spark, store):
    store.create("anomaly_alerts")
    sink = sinks.table_sink(store, "anomaly_alerts", lambda _: "first", "detection_time")
    counts = spark.createDataFrame(
        [(1, 5), (2, 900)], "n INT, event_count LONG"
    ).withColumns({"window_start": F.current_timestamp(), "window_end": F.current_timestamp()})
    alerts = anomalies.threshold_alerts(counts, Thresholds())
    for batch_id in (0, 1, 1, 0):
        sink(alerts, batch_id)
    assert rows_of(store.read("anomaly_alerts").groupBy("batch_id").count()) == [(0, 2), (1, 2)]
    other = sinks.table_sink(store, "anomaly_alerts", lambda _: "second", "detection_time")
    other(alerts.limit(0), 0)
    other(alerts, 0)
    kept = store.read("anomaly_alerts").groupBy("query_id", "batch_id").count()
    assert rows_of(kept) == [("first", 0, 2), ("first", 1, 2), ("second", 0, 2)]
    days = [p.partition for p in spark.sql(f"SHOW PARTITIONS {store.full_name('anomaly_alerts')}").collect()]
    assert all(d.startswith("detection_date=") and "/" not in d for d in days)


def test_failed_secondary_writes_are_counted(spark):
    def failing(batch, batch_id):
        raise RuntimeError("database is down")

    sink = sinks.multi_sink(lambda b, i: None, failing, lambda b, i: None)
    sink(spark.range(1), 0)
    sink(spark.range(1), 1)
    assert sink.failures == {0: 2}


def hour_counts(spark, feed):
    raw = read_stream(spark, feed.source())
    return windows.window_counts(jobs.event_times(raw), "1 minute", "1 minute")


def test_rolling_alerts_over_many_batches_equal_one_batch(spark, feed, tmp_path):
    sizes = [3, 4, 3, 4, 3, 4, 3, 4, 3, 4, 3, 30, 4, 3, 4, 1, 3]
    i = 0
    for minute, size in enumerate(sizes):
        rows = []
        for second in range(size):
            i += 1
            rows.append(message(i, f"10:{minute:02}:{second:02}"))
        feed.add(*rows)
    feed.add(message(10_000, "11:00:00"))
    limits = {"lookback_seconds": 600, "min_history": 5, "sigmas": 2.0}
    out = str(tmp_path / "alerts")
    sink = jobs.rolling_alert_sink(str(tmp_path / "history"), sinks.path_sink(out), **limits)

    def twice(batch, batch_id):
        """Every batch is delivered again, as after a failure."""
        sink(batch, batch_id)
        sink(batch, batch_id)

    query = sinks.for_each_batch(hour_counts(spark, feed), twice, str(tmp_path / "cp"), "once")
    query.awaitTermination()
    streamed = spark.read.parquet(out)
    assert spark.read.parquet(str(tmp_path / "history")).select("batch").distinct().count() > 10
    raw = spark.read.text(str(feed.path))
    closed = windows.window_counts(jobs.event_times(raw), "1 minute").filter("window_start < '2024-01-01 10:59:00'")
    columns = ("window_start", "event_count", "anomaly_type", "severity", "z_score")
    expected = rows_of(anomalies.rolling_alerts(closed, **limits), *columns)
    assert rows_of(streamed, *columns) == expected
    assert [r[1] for r in expected] == [30]


def test_top_products_in_batches(spark, feed, tmp_path):
    feed.add(*[message(i, f"10:00:{i:02}") for i in (0, 3, 6, 1, 4, 2)], message(99, "10:30:00"))
    counts = windows.window_product_counts(jobs.metric_events(read_stream(spark, feed.source())), "5 minutes", "1 minute")
    out = str(tmp_path / "top")
    sinks.for_each_batch(counts, jobs.top_product_sink(sinks.path_sink(out), 2), str(tmp_path / "cp"), "once").awaitTermination()
    assert rows_of(spark.read.parquet(out), "rank", "product_id", "event_count") == [(1, "p0", 3), (2, "p1", 2)]


def test_sketched_users_in_a_stream_are_close(spark, feed, tmp_path):
    feed.add(*[message(i, "10:00:00", user=f"u{i}") for i in range(3000)], message(-1, "10:30:00"))
    metrics = windows.window_metrics(jobs.metric_events(read_stream(spark, feed.source())), watermark="1 minute")
    out = str(tmp_path / "m")
    sinks.append_to_path(metrics, out, str(tmp_path / "cp"), trigger="once").awaitTermination()
    users = spark.read.parquet(out).first()["unique_users"]
    assert abs(users - 3000) / 3000 <= 0.15


def test_rolling_and_top_product_jobs(spark, feed, lake):
    feed.add(*[message(i, f"10:{i // 3:02}:{i % 3:02}") for i in range(60)])
    feed.add(*[message(100 + i, f"10:21:{i:02}") for i in range(40)], message(999, "11:00:00"))
    run(spark, "rolling-alerts", lake, feed)
    run(spark, "top-products", lake, feed)
    run(spark, "type-counts", lake, feed)
    store = TableStore(spark, lake)
    alerts = store.read("rolling_alerts")
    assert rows_of(alerts, "event_count", "anomaly_type") == [(40, "High Traffic Spike")]
    top = store.read("top_products")
    assert top.filter("rank = 1").count() == 5
    assert store.read("type_counts_5min").agg(F.sum("event_count")).first()[0] == 100


def test_files_per_partition_are_bounded(spark, feed, lake):
    for n in range(6):
        feed.add(*[message(100 * n + i, "10:00:00", kind) for i, kind in enumerate(["view"] * 40 + ["search"])])
    source = json_lines_source(str(feed.path))
    jobs.start(spark, "events", lake, source, "once", files=2).awaitTermination()
    found = TableStore(spark, lake).read("events")
    assert found.count() == 6 * 41
    per_type = found.groupBy("event_type").agg(F.count_distinct("_metadata.file_path").alias("files"))
    assert all(r["files"] <= 2 for r in per_type.collect())


def test_rejected_messages_are_kept_with_their_reason(spark, feed, lake):
    feed.add(message(1, "10:00:00"), "{broken", '{"event_type": "view"}', '{"event_id": "e", "timestamp": "soon"}')
    run(spark, "rejected-events", lake, feed)
    run(spark, "events", lake, feed)
    store = TableStore(spark, lake)
    assert [r[0] for r in rows_of(store.read("rejected_messages"), "reason")] == ["malformed", "no key", "no time"]
    assert store.read("events").filter("arrival_date IS NULL").count() == 0


def test_unknown_job(spark, feed, lake):
    with pytest.raises(ValueError, match="unknown job"):
        jobs.start(spark, "nothing", lake, feed.source(), "once")


def test_silence_raises_an_alert_before_any_event_comes(spark, feed, lake):
    """Ten minutes without an event: only the clock goes on."""
    feed.add(*[message(i, f"10:00:{i % 60:02}") for i in range(300)])
    clock = Source("rate-micro-batch", {
        "rowsPerBatch": "6", "startTimestamp": "1704103200000", "advanceMillisPerBatch": "60000",  # 10:00 on that day
    })
    query = jobs.start(spark, "alerts", lake, feed.source(), None, heartbeat=clock, grace="1 minute")
    try:
        deadline = time.monotonic() + 120
        found = []
        while len(found) < 10 and time.monotonic() < deadline:
            time.sleep(1)
            spark.catalog.refreshTable(TableStore(spark, lake).full_name("anomaly_alerts"))
            found = rows_of(TableStore(spark, lake).read("anomaly_alerts").filter("event_count = 0"), "window_start", "anomaly_type")
    finally:
        query.stop()
    assert len(found) >= 10 and {r[1] for r in found} == {"Traffic Drop"}
    # from the minute after the events on, none left out and none judged twice; none from before the start
    minutes = sorted(r[0].minute + 60 * r[0].hour for r in found)
    assert minutes == list(range(601, 601 + len(minutes)))


def test_heartbeat_and_distinct_are_for_their_jobs_only(spark, feed, lake):
    with pytest.raises(ValueError, match="heartbeat"):
        jobs.start(spark, "metrics", lake, feed.source(), "once", heartbeat=feed.source())
    with pytest.raises(ValueError, match="repeats"):
        jobs.start(spark, "metrics", lake, feed.source(), "once", distinct="1 hour")


def test_messages_sent_again_are_kept_once(spark, feed, lake):
    def run_distinct():
        query = jobs.start(spark, "events", lake, feed.source(), "once", distinct="1 hour")
        query.awaitTermination()
        return query

    feed.add(message(1, "10:00:00"), message(1, "10:00:00"), message(2, "10:01:00"))
    feed.add(message(1, "10:00:00"), message(3, "10:10:00"))
    run_distinct()
    feed.add(message(3, "10:10:00"), message(2, "10:01:00"), message(4, "10:20:00"))  # after a restart
    run_distinct()
    found = TableStore(spark, lake).read("events")
    assert rows_of(found, "event_id") == [("ev_1",), ("ev_2",), ("ev_3",), ("ev_4",)]
    # an hour later the keys are forgotten
    feed.add(message(5, "13:00:00"))
    feed.add(message(6, "13:00:01"))
    query = run_distinct()
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 2


def test_state_of_the_interval_join_is_bounded(spark, feed, tmp_path):
    for minute in range(0, 60, 5):
        feed.add(message(minute, f"10:{minute:02}:00", user="u"), message(100 + minute, f"10:{minute:02}:30", "purchase", 5, user="u"))
    events = jobs.metric_events(read_stream(spark, feed.source()))
    again = jobs.metric_events(read_stream(spark, feed.source()))
    found = timejoins.followed_within(
        events.filter("event_type = 'view'"), again.filter("event_type = 'purchase'"), ("user_id",), 60, "1 minute"
    )
    out = str(tmp_path / "pairs")
    query = sinks.append_to_path(found, out, str(tmp_path / "cp"), trigger="once")
    query.awaitTermination()
    assert spark.read.parquet(out).count() == 12
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(held) <= 8  # of 24 events and their copies


def test_visits_in_a_stream_equal_those_of_a_batch(spark, feed, tmp_path):
    for minute in (0, 20, 55, 59):
        feed.add(message(minute, f"10:{minute:02}:00", user="u"), message(100 + minute, f"10:{minute:02}:30", "purchase", 5, user="v"))
    feed.add(message(999, "14:00:00", user="w"))
    events = jobs.metric_events(read_stream(spark, feed.source()))
    out = str(tmp_path / "visits")
    sinks.append_to_path(windows.session_windows(events, 1800, watermark="1 minute"), out, str(tmp_path / "cp"), trigger="once").awaitTermination()
    batch = windows.session_windows(jobs.metric_events(spark.read.text(str(feed.path))), 1800).filter("user_id <> 'w'")
    columns = ("user_id", "session_start", "session_end", "event_count", "revenue")
    assert rows_of(spark.read.parquet(out), *columns) == rows_of(batch, *columns)
    assert batch.count() == 4


def minute_rows(spark, minutes, day=1):
    """Closed windows of one batch from (minute after ten, events)."""
    rows = [(f"2024-01-{day:02}T{10 + m // 60}:{m % 60:02}:00", n) for m, n in minutes]
    start = F.col("at").cast("timestamp")
    return spark.createDataFrame(rows, "at STRING, event_count LONG").select(
        start.alias("window_start"), (start + F.expr("INTERVAL 1 MINUTE")).alias("window_end"), "event_count"
    )


def test_silent_minutes_are_history_and_old_days_are_removed(spark, tmp_path):
    out, history = str(tmp_path / "alerts"), str(tmp_path / "history")
    limits = {"lookback_seconds": 3600, "min_history": 5, "sigmas": 2.0}
    sink = jobs.rolling_alert_sink(history, sinks.path_sink(out), size_seconds=60, **limits)
    batches = [[(m, 50 + m % 2) for m in range(30)], [(90, 50)], [(91, 51)]]  # an hour of silence after the first
    for batch_id, minutes in enumerate(batches):
        for _ in range(2):  # delivered twice
            sink(minute_rows(spark, minutes), batch_id)
    # after an hour of no events, of which the history knows, fifty at once are a spike
    spikes = rows_of(spark.read.parquet(out).filter("window_start >= '2024-01-01 11:30:00'"), "window_start", "anomaly_type")
    assert [(s[0].minute, s[1]) for s in spikes] == [(30, "High Traffic Spike"), (31, "High Traffic Spike")]
    kept = spark.read.parquet(history)
    assert kept.select("window_start").distinct().count() == kept.count() == 92
    for day in (2, 3, 5):
        sink(minute_rows(spark, [(0, 50)], day), 40 + day)
    kept = sorted(p.name for p in (tmp_path / "history").glob("day=*"))
    assert kept[-1] == "day=2024-01-05" and len(kept) <= 3


def test_lost_state_of_the_alert_job_is_none(spark, tmp_path):
    out = str(tmp_path / "alerts")
    sink = jobs.threshold_alert_sink(str(tmp_path / "state"), sinks.path_sink(out), Thresholds(), 60)
    sink(minute_rows(spark, [(7, 1)]), 5)
    assert rows_of(spark.read.parquet(out), "event_count") == [(1,)]
