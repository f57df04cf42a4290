from __future__ import annotations

import json
from datetime import date, datetime

from conftest import rows_of
from eventlake import schemas
from eventlake.operators import messages
from eventlake.sources.streams import json_lines_source, kafka_source, read_batch
from eventlake.streaming import jobs


def raw(spark, *values):
    lines = [v if isinstance(v, str) else json.dumps(v, ensure_ascii=False) for v in values]
    return spark.createDataFrame([(line,) for line in lines], "value STRING")


PURCHASE = {
    "event_id": "ev_1", "event_type": "purchase", "user_id": "u_1", "product_id": "pd_000001",
    "product_name": "운동화", "category": "fashion", "brand": "b", "price": 1000,
    "timestamp": "2024-01-15T10:30:00.123456", "session_id": "s",
    "device": {"type": "mobile", "os": "iOS", "app_version": "1.2.3"},
    "context": {"referrer": "direct", "campaign": {"id": "c1", "name": "n1"}},
    "quantity": 2, "total_amount": 2000, "payment_method": "card", "unknown": {"x": 1},
}


def test_event_is_flattened_in_table_order(spark):
    flat = jobs.parsed_events(raw(spark, PURCHASE))
    assert [*flat.columns, "arrival_date"] == schemas.TABLES["events"].names  # the job adds the day of arrival
    row = flat.first()
    assert row["event_timestamp"] == datetime(2024, 1, 15, 10, 30, 0, 123456)
    assert (row["event_date"], row["event_hour"]) == (date(2024, 1, 15), 10)
    assert (row["device_os"], row["campaign_id"], row["total_amount"]) == ("iOS", "c1", 2000)


def test_bad_messages(spark):
    """Malformed and keyless messages go; a bad field or time only loses itself."""
    found = jobs.parsed_events(raw(
        spark, "{not json", "", "null", {"event_type": "view"},
        {**PURCHASE, "event_id": "bad time", "timestamp": "yesterday"},
        {**PURCHASE, "event_id": "bad price", "price": "cheap"},
        {**PURCHASE, "event_id": "no parts", "device": None, "context": None},
        {**PURCHASE, "event_id": "zulu", "timestamp": "2024-01-15T10:30:00Z"},
    ))
    by_id = {r["event_id"]: r for r in found.collect()}
    assert set(by_id) == {"bad time", "bad price", "no parts", "zulu"}
    assert by_id["bad time"]["event_timestamp"] is None
    assert by_id["bad price"]["price"] is None
    assert by_id["bad price"]["event_type"] == "purchase"
    assert by_id["no parts"]["device_type"] is None
    assert by_id["zulu"]["event_hour"] == 10


def test_messages_are_parsed_once(spark):
    plan = jobs.parsed_session_events(raw(spark, "{}"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


REVIEW = {
    "review_id": "r1", "product_id": "p1", "user_id": "u1", "rating": 5, "text": "정말 좋아요",
    "images": ["a.jpg"], "helpful_count": 3, "created_at": "2024-01-15T10:00:00",
    "verified_purchase": True,
}


def test_review_arrays(spark):
    found = jobs.parsed_reviews(raw(
        spark, REVIEW, {**REVIEW, "review_id": "r2", "images": None, "text": None},
        {**REVIEW, "review_id": "r3", "images": [], "text": ""},
    ))
    assert found.columns == schemas.TABLES["reviews"].names
    picked = rows_of(found, "review_id", "image_count", "has_images", "text_length", "sentiment_keywords")
    assert picked == [
        ("r1", 1, True, 6, ["좋아요", "좋아"]),
        ("r2", 0, False, None, []),
        ("r3", 0, False, 0, []),
    ]


SESSION = {
    "session_id": "s1", "user_id": "u1", "started_at": "2024-01-15T10:00:00",
    "ended_at": "2024-01-15T10:05:00", "duration_seconds": 300, "event_count": 3,
    "device": {"type": "mobile", "os": "iOS", "model": "m", "is_tablet": False, "screen": {"width": 1}},
    "context": {
        "referrer": "direct", "utm": None, "is_first_visit": True,
        "location": {"country": "KR", "region": "서울", "city": "c"},
    },
    "events": [
        {"event_index": 0, "event_type": "search", "timestamp": "2024-01-15T10:00:00",
         "search": {"query": "q", "result_count": 7, "filters": ["price"]}},
        {"event_index": 1, "event_type": "view", "timestamp": "2024-01-15T10:01:00",
         "product": {"product_id": "p1", "category": "home", "price": 10, "quantity": 1}},
        {"event_index": 2, "event_type": "purchase", "timestamp": "2024-01-15T23:59:59",
         "product": {"product_id": "p1", "category": "home", "price": 10, "quantity": 1},
         "transaction": {"transaction_id": "t1", "total_amount": 10}},
    ],
    "summary": {
        "total_events": 3, "unique_products_viewed": 1, "searches_count": 1, "views_count": 1,
        "add_cart_count": 0, "purchase_count": 1, "converted": True, "bounce": False,
    },
    "metadata": {"sdk_version": "1.0"},
}


def test_session_row(spark):
    found = jobs.parsed_sessions(raw(spark, SESSION))
    assert found.columns == schemas.TABLES["sessions"].names
    row = found.first()
    assert (row["region"], row["utm_source"], row["converted"]) == ("서울", None, True)
    assert row["session_date"] == date(2024, 1, 15)


def test_session_events(spark):
    found = jobs.parsed_session_events(raw(
        spark, SESSION, {**SESSION, "session_id": "empty", "events": []},
        {**SESSION, "session_id": "none", "events": None},
    ))
    assert found.columns == schemas.TABLES["session_events"].names
    picked = rows_of(found, "event_index", "product_id", "search_query", "transaction_id")
    assert picked == [(0, None, "q", None), (1, "p1", None, None), (2, "p1", None, "t1")]


def test_json_lines_folder(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(PURCHASE) + "\n{broken\n")
    found = jobs.parsed_events(read_batch(spark, json_lines_source(str(tmp_path), 1)))
    assert found.count() == 1


def test_kafka_options():
    source = kafka_source("host:9092", "reviews")
    assert source.format == "kafka"
    assert source.options == {
        "kafka.bootstrap.servers": "host:9092", "subscribe": "reviews",
        "startingOffsets": "latest", "failOnDataLoss": "false",
    }


def test_table_columns_match_registry(spark, store):
    store.create()
    for name, table in schemas.TABLES.items():
        assert sorted(store.columns(name)) == sorted(table.names)
