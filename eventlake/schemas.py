"""Message schemas on the wire and the tables of the lake."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from eventlake.config import Settings, ensure_database

# Field names and types of the four message streams.
EVENT = """
    event_id STRING, event_type STRING, user_id STRING, product_id STRING,
    product_name STRING, category STRING, brand STRING, price INT,
    timestamp STRING, session_id STRING,
    device STRUCT<type: STRING, os: STRING, app_version: STRING>,
    context STRUCT<referrer: STRING, campaign: STRUCT<id: STRING, name: STRING>>,
    quantity INT, total_amount INT, payment_method STRING
"""

# The parts of an event that the live metrics and the volume alerts read.
EVENT_METRICS = """
    event_id STRING, event_type STRING, user_id STRING, product_id STRING,
    category STRING, timestamp STRING, total_amount INT
"""
EVENT_TIMES = "event_id STRING, timestamp STRING"

REVIEW = """
    review_id STRING, product_id STRING, user_id STRING, rating INT, text STRING,
    images ARRAY<STRING>, helpful_count INT, created_at STRING, verified_purchase BOOLEAN
"""

SESSION = """
    session_id STRING, user_id STRING, started_at STRING, ended_at STRING,
    duration_seconds INT, event_count INT,
    device STRUCT<
        type: STRING, os: STRING, os_version: STRING, app_version: STRING,
        screen: STRUCT<width: INT, height: INT, density: DOUBLE>,
        network: STRUCT<type: STRING, carrier: STRING>,
        manufacturer: STRING, model: STRING, locale: STRING, timezone: STRING>,
    context STRUCT<
        referrer: STRING, landing_page: STRING,
        utm: STRUCT<source: STRING, medium: STRING, campaign: STRING, term: STRING, content: STRING>,
        campaign: STRUCT<id: STRING, name: STRING, discount_rate: DOUBLE>,
        is_first_visit: BOOLEAN, previous_sessions_count: INT, days_since_last_visit: INT,
        location: STRUCT<country: STRING, region: STRING, city: STRING>>,
    user_agent STRING,
    events ARRAY<STRUCT<
        event_index: INT, event_type: STRING, timestamp: STRING, page: STRING,
        duration_on_page: INT,
        product: STRUCT<product_id: STRING, category: STRING, price: INT, quantity: INT>,
        search: STRUCT<query: STRING, result_count: INT, filters: ARRAY<STRING>>,
        transaction: STRUCT<transaction_id: STRING, payment_method: STRING,
            total_amount: INT, discount_amount: INT, coupon_used: BOOLEAN>>>,
    summary STRUCT<
        total_events: INT, unique_products_viewed: INT, searches_count: INT,
        views_count: INT, add_cart_count: INT, purchase_count: INT,
        converted: BOOLEAN, bounce: BOOLEAN>
"""

_SUMMARY = """STRUCT<
    total_events: INT, unique_products_viewed: INT, searches_count: INT,
    views_count: INT, add_cart_count: INT, purchase_count: INT,
    converted: BOOLEAN, bounce: BOOLEAN>"""

# The parts of a session message that its row, its event rows and its recomputed summary read.
SESSION_ROW = f"""
    session_id STRING, user_id STRING, started_at STRING, ended_at STRING,
    duration_seconds INT, event_count INT,
    device STRUCT<type: STRING, os: STRING, model: STRING>,
    context STRUCT<
        referrer: STRING, utm: STRUCT<source: STRING, medium: STRING>,
        is_first_visit: BOOLEAN, location: STRUCT<region: STRING, city: STRING>>,
    summary {_SUMMARY}
"""
SESSION_EVENTS = """
    session_id STRING, user_id STRING,
    events ARRAY<STRUCT<
        event_index: INT, event_type: STRING, timestamp: STRING, page: STRING,
        duration_on_page: INT,
        product: STRUCT<product_id: STRING, category: STRING, price: INT>,
        search: STRUCT<query: STRING, result_count: INT>,
        transaction: STRUCT<transaction_id: STRING, total_amount: INT>>>
"""
SESSION_KINDS = f"""
    session_id STRING,
    events ARRAY<STRUCT<event_type: STRING, product: STRUCT<product_id: STRING>>>,
    summary {_SUMMARY}
"""

SEARCH = """
    search_id STRING, user_id STRING, query STRING, query_length INT,
    pattern_type STRING, timestamp STRING, result_count INT, clicked BOOLEAN,
    clicked_position INT, session_id STRING,
    filters_applied ARRAY<STRUCT<type: STRING, min: DOUBLE, max: DOUBLE, value: STRING>>
"""


@dataclass(frozen=True)
class Table:
    columns: str
    partitions: tuple[str, ...] = ()

    @property
    def names(self) -> list[str]:
        return [part.split()[0] for part in self.columns.split(",") if part.strip()]


# Tables and columns of the lake. A table that is partitioned by
# the day of a timestamp carries that day as its last column.
TABLES = {
    "events": Table(
        """event_id STRING, event_type STRING, user_id STRING, product_id STRING,
        product_name STRING, category STRING, brand STRING, price INT,
        event_timestamp TIMESTAMP, session_id STRING, device_type STRING,
        device_os STRING, device_app_version STRING, referrer STRING,
        campaign_id STRING, campaign_name STRING, quantity INT, total_amount INT,
        payment_method STRING, event_date DATE, event_hour INT, arrival_date DATE""",
        ("event_date", "event_type"),
    ),
    "rejected_messages": Table(
        """value STRING, reason STRING, topic STRING, rejected_at TIMESTAMP, arrival_date DATE""",
        ("arrival_date",),
    ),
    "sessions": Table(
        """session_id STRING, user_id STRING, started_at TIMESTAMP, ended_at TIMESTAMP,
        duration_seconds INT, event_count INT, device_type STRING, device_os STRING,
        device_model STRING, referrer STRING, utm_source STRING, utm_medium STRING,
        region STRING, city STRING, is_first_visit BOOLEAN, total_events INT,
        unique_products_viewed INT, searches_count INT, views_count INT,
        add_cart_count INT, purchase_count INT, converted BOOLEAN, bounce BOOLEAN,
        session_date DATE""",
        ("session_date", "device_type"),
    ),
    "session_events": Table(
        """session_id STRING, user_id STRING, event_index INT, event_type STRING,
        event_timestamp TIMESTAMP, page STRING, duration_on_page INT,
        product_id STRING, product_category STRING, product_price INT,
        search_query STRING, search_result_count INT, transaction_id STRING,
        transaction_amount INT, event_date DATE""",
        ("event_date", "event_type"),
    ),
    "reviews": Table(
        """review_id STRING, product_id STRING, user_id STRING, rating INT,
        review_text STRING, text_length INT, image_count INT, has_images BOOLEAN,
        helpful_count INT, verified_purchase BOOLEAN, created_at TIMESTAMP,
        created_date DATE, sentiment_keywords ARRAY<STRING>""",
        ("created_date", "rating"),
    ),
    "search_queries": Table(
        """search_id STRING, user_id STRING, query STRING, query_norm STRING,
        pattern STRING, pattern_type STRING, searched_at TIMESTAMP,
        result_count INT, clicked BOOLEAN, clicked_position INT, session_id STRING,
        filter_count INT, search_date DATE""",
        ("search_date",),
    ),
    "metrics_5min": Table(
        """window_start TIMESTAMP, window_end TIMESTAMP, total_events LONG,
        unique_users LONG, total_revenue LONG, purchase_count LONG, view_count LONG,
        cart_count LONG, search_count LONG, avg_order_value DOUBLE,
        updated_at TIMESTAMP, window_date DATE""",
        ("window_date",),
    ),
    "metrics_category_5min": Table(
        """window_start TIMESTAMP, window_end TIMESTAMP, category STRING,
        event_count LONG, revenue LONG, unique_products LONG, updated_at TIMESTAMP,
        window_date DATE""",
        ("window_date", "category"),
    ),
    "anomaly_alerts": Table(
        """window_start TIMESTAMP, window_end TIMESTAMP, event_count LONG,
        avg_count DOUBLE, stddev_count DOUBLE, z_score DOUBLE, anomaly_type STRING,
        severity STRING, detection_time TIMESTAMP, query_id STRING, batch_id LONG,
        detection_date DATE""",
        ("detection_date",),
    ),
    "rolling_alerts": Table(
        """window_start TIMESTAMP, window_end TIMESTAMP, event_count LONG,
        avg_count DOUBLE, stddev_count DOUBLE, z_score DOUBLE, anomaly_type STRING,
        severity STRING, detection_time TIMESTAMP, query_id STRING, batch_id LONG,
        detection_date DATE""",
        ("detection_date",),
    ),
    "top_products": Table(
        """window_start TIMESTAMP, window_end TIMESTAMP, product_id STRING,
        event_count LONG, rank INT, query_id STRING, batch_id LONG, window_date DATE""",
        ("window_date",),
    ),
    "type_counts_5min": Table(
        """window_start TIMESTAMP, window_end TIMESTAMP, event_type STRING,
        event_count LONG, window_date DATE""",
        ("window_date",),
    ),
    "daily_summary": Table(
        """report_date DATE, total_events LONG, unique_users LONG, total_revenue LONG,
        total_orders LONG, avg_order_value DOUBLE, conversion_rate DOUBLE, views LONG,
        cart_adds LONG, created_at TIMESTAMP""",
        ("report_date",),
    ),
    "hourly_metrics": Table(
        """report_date DATE, hour INT, events LONG, revenue LONG, orders LONG,
        unique_users LONG""",
        ("report_date",),
    ),
    "daily_category": Table(
        """report_date DATE, category STRING, events LONG, revenue LONG, orders LONG,
        unique_products LONG, top_product_id STRING""",
        ("report_date",),
    ),
    "daily_product": Table(
        """report_date DATE, product_id STRING, product_name STRING, category STRING,
        views LONG, cart_adds LONG, purchases LONG, revenue LONG,
        conversion_rate DOUBLE""",
        ("report_date",),
    ),
    "repurchase": Table(
        """report_date DATE, days INT, purchasers LONG, repeat_purchasers LONG,
        repurchase_rate DOUBLE""",
        ("report_date",),
    ),
    "volume_change": Table(
        "report_date DATE, events LONG, previous_events LONG, change_pct DOUBLE",
        ("report_date",),
    ),
    "search_metrics": Table(
        """report_date DATE, searches LONG, clicks LONG, empty_searches LONG,
        avg_clicked_position DOUBLE, click_through_rate DOUBLE, zero_result_rate DOUBLE""",
        ("report_date",),
    ),
    "popular_searches": Table(
        "report_date DATE, query_norm STRING, searches LONG",
        ("report_date",),
    ),
    "review_daily_summary": Table(
        """report_date DATE, total_reviews LONG, avg_rating DOUBLE, rating_1 LONG,
        rating_2 LONG, rating_3 LONG, rating_4 LONG, rating_5 LONG,
        positive_count LONG, negative_count LONG, with_images_count LONG,
        avg_text_length DOUBLE""",
        ("report_date",),
    ),
    "review_keywords": Table(
        """report_date DATE, keyword STRING, keyword_type STRING, frequency LONG,
        avg_rating_with_keyword DOUBLE""",
        ("report_date",),
    ),
    "product_review_summary": Table(
        """report_date DATE, product_id STRING, review_count LONG, avg_rating DOUBLE,
        positive_ratio DOUBLE, negative_ratio DOUBLE, top_positive_keywords STRING,
        top_negative_keywords STRING""",
        ("report_date",),
    ),
    "review_aspects": Table(
        """report_date DATE, aspect STRING, mention_count LONG, positive_mentions LONG,
        negative_mentions LONG, sentiment_score DOUBLE""",
        ("report_date",),
    ),
    "data_quality": Table(
        """check_date DATE, table_name STRING, check_name STRING, check_type STRING,
        status STRING, expected_value STRING, actual_value STRING, details STRING,
        checked_at TIMESTAMP""",
        ("check_date",),
    ),
    "cohort_retention": Table(
        """cohort_week DATE, cohort_size LONG, period_week INT, retained_users LONG,
        retention_rate FLOAT, calculation_date DATE""",
        ("cohort_week",),
    ),
    "user_weeks": Table(
        "user_id STRING, first_day DATE, activity_week DATE",
        ("activity_week",),
    ),
    "cohort_days": Table("event_date DATE, n LONG, changed TIMESTAMP"),
    "benchmark_results": Table(
        """run_timestamp TIMESTAMP, query_name STRING, table_name STRING,
        execution_time_seconds DOUBLE, load_time_seconds DOUBLE""",
    ),
    "benchmark_files": Table(
        """run_timestamp TIMESTAMP, query_name STRING, table_name STRING,
        files LONG, files_touched LONG, bytes LONG, bytes_touched LONG""",
    ),
}


def _recover_partitions(spark: SparkSession, full_name: str) -> None:
    """A table that a stream has written keeps its own list of files and has none to recover."""
    try:
        spark.sql(f"ALTER TABLE {full_name} RECOVER PARTITIONS")
    except AnalysisException as error:
        if error.getCondition() != "NOT_A_PARTITIONED_TABLE":
            raise


def create_tables(spark: SparkSession, settings: Settings, names: list[str] | None = None) -> None:
    """Create the database and whichever of its tables are missing."""
    ensure_database(spark, settings.database)
    for name in names or TABLES:
        full_name = f"{settings.database}.{name}"
        if spark.catalog.tableExists(full_name):
            continue
        table = TABLES[name]
        layout = f"PARTITIONED BY ({', '.join(table.partitions)})" if table.partitions else ""
        # only Parquet folders are found again by their paths; other formats keep a catalog of their own
        in_folder = settings.lake_path and settings.provider == "parquet"
        path = f"{settings.lake_path}/{name}" if in_folder else None
        if path and table.partitions:
            nothing = spark.createDataFrame([], table.columns)
            nothing.write.mode("append").partitionBy(*table.partitions).parquet(path)
        place = f"LOCATION '{path}'" if path else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {full_name} ({table.columns}) "
            f"USING {settings.provider} {layout} {place}"
        )
        if path and table.partitions:
            # rows that an earlier session left in the folder
            _recover_partitions(spark, full_name)
