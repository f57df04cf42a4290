"""Joins over time, visits, sketches, spelling, buckets: edge cases and plans."""

from __future__ import annotations

import random
import re
import uuid
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import SAMPLE_DIR, rows_of
from eventlake.functions import search
from eventlake.operators import daily, joins, layout, quality, sketches, spelling, timejoins, windows
from eventlake.plans import queries as registry

START = datetime(2024, 1, 1)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def busy(make_events):
    """A third of all rows are of one user and product; some rows lack a user or a time."""
    draw = random.Random(3)
    rows = []
    for i in range(600):
        user = "hot" if i % 3 == 0 else f"u{draw.randrange(5)}"
        at = START + timedelta(seconds=draw.randrange(4 * 86_400))
        rows.append((f"e{i:04}", draw.choice(["view", "purchase"]), user, f"p{i % 2}", at.isoformat(), 10))
    rows += [("x1", "view", None, "p1", "2024-01-01T00:00:00", None), ("x2", "purchase", None, "p1", "2024-01-01T00:00:01", 5)]
    rows += [("x3", "view", "hot", "p1", None, None), ("x4", "purchase", "hot", "p1", None, 5)]
    return make_events(rows)


def sides(events):
    return events.filter("event_type = 'view'"), events.filter("event_type = 'purchase'")


@pytest.mark.parametrize("seconds", [1, 600, 7 * 3600])
def test_followed_within_equals_all_pairs(busy, seconds):
    views, bought = sides(busy)
    got = rows_of(timejoins.followed_within(views, bought, ("user_id", "product_id"), seconds), "first_id", "then_id")
    first, then = views.collect(), bought.collect()
    expected = [
        (a.event_id, b.event_id) for a in first for b in then
        if a.user_id and a.event_timestamp and b.event_timestamp and (a.user_id, a.product_id) == (b.user_id, b.product_id)
        and timedelta(0) <= b.event_timestamp - a.event_timestamp <= timedelta(seconds=seconds)
    ]
    assert got == sorted(expected, key=repr)
    assert len(got) == len(set(got))


@pytest.mark.parametrize("stretch", [60, 3600, 10 * 86_400])
def test_last_before_equals_a_plain_search(busy, stretch):
    views, bought = sides(busy)
    got = {r.event_id: r.mark and r.mark.event_id for r in timejoins.last_before(bought, views, "user_id", stretch).collect()}
    marks = [v for v in views.collect() if v.user_id and v.event_timestamp]
    for b in bought.collect():
        near = [v for v in marks if b.event_timestamp and v.user_id == b.user_id and v.event_timestamp <= b.event_timestamp]
        best = max(near, key=lambda v: (v.event_timestamp, v.event_id), default=None)
        assert got.pop(b.event_id) == (best and best.event_id)
    assert not got


def test_last_before_on_equal_times_and_without_marks(make_events):
    events = make_events([
        ("a", "view", "u", "p", "2024-01-01T10:00:00", None), ("b", "view", "u", "q", "2024-01-01T10:00:00", None),
        ("c", "purchase", "u", "p", "2024-01-01T10:00:00", 1), ("d", "purchase", "v", "p", "2024-01-01T10:00:00", 1),
    ])
    views, bought = sides(events)
    assert rows_of(timejoins.last_before(bought, views, "user_id"), "event_id", "mark.event_id") == [("c", "b"), ("d", None)]
    assert timejoins.last_before(bought.limit(0), views, "user_id").count() == 0
    assert {r.mark for r in timejoins.last_before(bought, views.limit(0), "user_id").collect()} == {None}


def test_no_range_join_and_no_cross_join(spark):
    for name in ("view_to_purchase", "purchase_last_view", "event_campaigns"):
        plan = plan_of(registry.all_queries()[name](spark, SAMPLE_DIR))
        assert "Cartesian" not in plan and "NestedLoop" not in plan, name
        assert re.search("(SortMerge|ShuffledHash|BroadcastHash)Join", plan), name


@pytest.mark.parametrize(("bin_seconds", "fan", "levels"), [(3600, 16, 3), (60, 4, 2), (900, 2, 5), (10**6, 2, 1)])
def test_in_intervals_equals_all_pairs(spark, busy, bin_seconds, fan, levels):
    draw = random.Random(7)
    spans = [(f"c{i}", START + timedelta(seconds=draw.randrange(-86_400, 5 * 86_400)), draw.choice([0, -5, 1, 30, 4000, 90_000, 10**7])) for i in range(40)]
    rows = [(n, a, a + timedelta(seconds=s), f"p{i % 2}") for i, (n, a, s) in enumerate(spans)]
    rows += [("open", None, START, "p0"), ("never", START, None, "p0")]
    intervals = spark.createDataFrame(rows, "name STRING, a TIMESTAMP, b TIMESTAMP, product_id STRING")
    found = timejoins.in_intervals(busy, intervals, "a", "b", ("product_id",), bin_seconds, fan, levels)
    expected = [
        (e.event_id, n) for e in busy.collect() for n, a, b, p in rows
        if e.event_timestamp and a and b and e.product_id == p and a <= e.event_timestamp < b
    ]
    assert rows_of(found, "event_id", "name") == sorted(expected, key=repr)


@pytest.mark.parametrize("stretch", [1, 3600, 10**7])
def test_totals_in_intervals_equal_all_pairs(spark, busy, stretch):
    draw = random.Random(7)
    spans = [(f"c{i}", START + timedelta(seconds=draw.randrange(-86_400, 5 * 86_400)), draw.choice([0, -5, 1, 30, 4000, 90_000, 10**7])) for i in range(40)]
    rows = [(n, a, a + timedelta(seconds=s), f"p{i % 2}") for i, (n, a, s) in enumerate(spans)]
    events = busy.collect()
    at = [e.event_timestamp for e in events if e.event_timestamp and e.product_id == "p0"]
    rows += [("start", at[0], at[0] + timedelta(seconds=1), "p0"), ("end", at[1] - timedelta(hours=5), at[1], "p0"), ("c1", *rows[1][1:])]
    rows += [("open", None, START, "p0"), ("never", START, None, "p0"), ("no key", START, START + timedelta(days=9), None)]
    intervals = spark.createDataFrame(rows, "name STRING, a TIMESTAMP, b TIMESTAMP, product_id STRING")
    sums = {"n": F.lit(1), "paid": F.col("total_amount")}
    found = timejoins.totals_in_intervals(busy, intervals, "a", "b", ("product_id",), sums, stretch)
    expected = {}
    for n, a, b, p in rows:
        met = [e for e in events if a and b and e.event_timestamp and e.product_id == p and a <= e.event_timestamp < b]
        if p and a and b and a < b:
            old = expected.get(n, (0, 0))
            expected[n] = (old[0] + len(met), old[1] + sum(e.total_amount or 0 for e in met))
    assert {r.name: (r.n, r.paid) for r in found.collect()} == expected


def test_campaigns_meet_no_event(spark):
    """Events and campaigns are rows of one line of time: no join of the two, and nothing of either is broadcast."""
    plan = plan_of(registry.all_queries()["event_campaigns"](spark, SAMPLE_DIR))
    assert "Union" in plan and "_piece" not in plan
    pieces = timejoins.in_intervals(
        spark.createDataFrame([(START,)], "event_timestamp TIMESTAMP"), spark.createDataFrame([(START, START + timedelta(days=400))], "a TIMESTAMP, b TIMESTAMP"), "a", "b"
    )
    assert "SortMergeJoin" in plan_of(pieces) and "Broadcast" not in plan_of(pieces)


def test_long_intervals_have_few_pieces(spark):
    span = spark.createDataFrame([(0, 24 * 365 * 3)], "low LONG, high LONG")  # three years of hours
    pieces = span.select(F.explode(timejoins._pieces(F.col("low") + 5, F.col("high"), 16, 3)).alias("p"))
    assert pieces.count() < 16 * 4 + 24 * 365 * 3 / 256 + 2


def test_visits_in_batch(make_events):
    events = make_events([
        ("a", "view", "u", "p", "2024-01-01T10:00:00", None), ("b", "purchase", "u", "p", "2024-01-01T10:29:59", 7),
        ("c", "view", "u", "p", "2024-01-01T10:59:59", None), ("d", "view", "v", "p", "2024-01-01T10:00:00", None),
        ("e", "view", None, "p", "2024-01-01T10:00:00", None), ("f", "view", "u", "p", None, None),
    ])
    found = windows.session_windows(events, 1800)
    assert rows_of(found, "user_id", "event_count", "purchase_count", "revenue") == [
        ("u", 1, 0, None), ("u", 2, 1, 7), ("v", 1, 0, None),
    ]
    ends = {r.session_start: r.session_end for r in found.filter("event_count = 2").collect()}
    assert ends == {START + timedelta(hours=10): START + timedelta(hours=10, minutes=59, seconds=59)}


def test_batch_visits_equal_spark_session_windows(busy):
    kept = busy.filter("user_id IS NOT NULL AND event_timestamp IS NOT NULL")
    for gap in (60, 1800, 20_000):
        native = kept.groupBy(F.session_window("event_timestamp", f"{gap} seconds").alias("w"), "user_id").agg(F.count("*").alias("n"))
        expected = rows_of(native, "user_id", "w.start", "w.end", "n")
        assert rows_of(windows.session_windows(busy, gap), "user_id", "session_start", "session_end", "event_count") == expected


def test_sketches_add_up(spark, make_events):
    rows = [(f"e{i}", "view", f"u{i % 2000}", "p", (START + timedelta(minutes=i)).isoformat(), None) for i in range(12_000)]
    stored = sketches.window_sketches(make_events(rows))
    assert stored.count() == 12_000 / 5
    by_day = sketches.estimated(sketches.merged(stored, F.to_date("window_start"), "day")).collect()
    assert sum(r.event_count for r in by_day) == 12_000
    for r in by_day:
        exact = min(2000, r.event_count)
        assert abs(r.unique_users - exact) <= 3 * sketches.RELATIVE_ERROR * exact
    weekly = sketches.merged(stored, F.date_trunc("week", "window_start").cast("date"), "week")
    kept = sketches.kept_from_week_to_week(weekly).collect()
    assert len(kept) == 1 and abs(kept[0].users_in_both - 1920) < 100 and kept[0].kept_rate > 0.9


def test_repairs_up_to_two_edits(spark):
    terms = spark.createDataFrame([("widget", 5), ("gadget", 9), ("budget", 1), ("rod", 3), ("road", 2)], "term STRING, weight LONG")
    index = spelling.deletion_index(terms)
    words = ["widget", "wdiget", "wigdet", "widgetts", "gidget", "rad", "rood", "ro", "x", "", "zzzzzz", "bodget", None, "roda"]
    found = spelling.repaired_words(spark.createDataFrame([(w,) for w in words], "word STRING"), index)
    assert rows_of(found) == sorted([
        ("widget", "widget", 0), ("wdiget", "widget", 2), ("wigdet", "widget", 2), ("widgetts", "widget", 2),
        ("gidget", "gadget", 1), ("rad", "rod", 1), ("rood", "rod", 1), ("bodget", "budget", 1), ("roda", "rod", 1),
    ], key=repr)


def test_repairs_of_queries_and_a_large_vocabulary(spark):
    """Twenty thousand terms: the plan holds none of them."""
    terms = spark.range(20_000).select(F.concat(F.lit("term"), F.lpad(F.col("id").cast("string"), 6, "0"), F.lit("x")).alias("term"), F.lit(1).alias("weight"))
    index = spelling.deletion_index(terms)
    asked = spark.createDataFrame([("  Term000123x  term00o124x",), ("term000123x term000124x",), (None,), ("",)], "query STRING")
    found = spelling.repaired_queries(asked, index)
    assert rows_of(found) == sorted([
        ("  Term000123x  term00o124x", "term000123x term000124x"), ("term000123x term000124x", "term000123x term000124x"), ("", ""),
    ], key=repr)
    assert "term000123" not in plan_of(found) and len(plan_of(found)) < 200_000


def test_deletions_reach_what_the_literal_repair_reaches(spark):
    # words of which two edits are allowed, as a swap of neighbours needs
    spellings = {w: t for w, t in search.misspellings(search.SEARCH_VOCABULARY).items() if len(w) >= 4}
    terms = spark.createDataFrame([(t, 1) for t in search.SEARCH_VOCABULARY], "term STRING, weight LONG")
    words = spark.createDataFrame([(w,) for w in spellings], "word STRING")
    near = {r.word: r for r in spelling.repaired_words(words, spelling.deletion_index(terms), least_letters=2).collect()}
    for word, term in spellings.items():
        # a swap is two edits: another term may be nearer, none is farther
        assert near[word].distance <= 2


def test_buckets_join_without_an_exchange(spark):
    df = registry.all_queries()["event_product_join_bucketed"](spark, SAMPLE_DIR)
    assert not re.search(r"(Broadcast)?Exchange ", plan_of(df)) and "SortMergeJoin" in plan_of(df)


def test_bucketed_tables_aggregate_without_an_exchange(spark):
    name = f"b_{uuid.uuid4().hex[:8]}"
    layout.write_bucketed(spark.range(1000).select((F.col("id") % 7).alias("k"), "id"), name, "k", 4)
    counted = spark.read.table(name).groupBy("k").count()
    assert "Exchange" not in plan_of(counted) and counted.count() == 7


def test_rollup_tells_subtotals_from_null_brands(spark):
    rows = [("a", "x", 1), ("a", None, 2), (None, None, 4)]
    products = spark.createDataFrame(rows, "category STRING, brand STRING, events LONG").withColumns({"purchases": F.lit(0), "revenue": F.lit(0.0)})
    got = rows_of(daily.revenue_rollup(products), "category", "brand", "level", "events")
    assert got == sorted([
        ("a", "x", 0, 1), ("a", None, 0, 2), (None, None, 0, 4), ("a", None, 1, 3), (None, None, 1, 4), (None, None, 3, 7),
    ], key=repr)
    assert daily.revenue_rollup(products, cube=True).filter("level = 2").count() == 2


def test_orphan_products_are_counted_by_distinct_ids(spark, make_events):
    events = make_events([
        ("a", "view", "u", "p1", "2024-01-01T10:00:00", None), ("b", "view", "u", "gone", "2024-01-01T10:00:00", None),
        ("c", "view", "u", "gone", "2024-01-01T11:00:00", None), ("d", "view", "u", None, "2024-01-01T11:00:00", None),
        ("e", "view", "u", "p1", "2024-01-02T10:00:00", None),
    ])
    products = spark.createDataFrame([("p1",), ("p1",), (None,)], "product_id STRING")
    checks = quality.quality_checks(events, products=products).filter("check_name = 'known_products'")
    assert rows_of(checks, "status", "actual_value", "details") == [
        ("FAIL", "50.00%", "2 events of 1 unknown products"), ("PASS", "0.00%", "0 events of 0 unknown products"),
    ]
    assert quality.quality_checks(events).filter("check_name = 'known_products'").count() == 0


def test_bucketed_join_keeps_facts_without_a_product(spark, make_events):
    events = make_events([("a", "view", "u", "p1", "2024-01-01T10:00:00", None), ("b", "view", "u", "gone", "2024-01-01T10:00:00", None)])
    products = spark.createDataFrame([("p1", 5)], "product_id STRING, rank INT")
    assert rows_of(joins.bucketed_join(events, products, "product_id"), "event_id", "rank") == [("a", 5), ("b", None)]
