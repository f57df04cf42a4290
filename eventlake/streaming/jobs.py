"""The streaming jobs: messages in, lake tables out."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from eventlake import schemas
from eventlake.config import TOPICS, Settings, Thresholds, checkpoint_path, exists, folders_in, remove
from eventlake.operators import anomalies, messages, windows
from eventlake.sources.streams import Source, kafka_source, read_heartbeats, read_stream
from eventlake.sources.tables import TableStore
from eventlake.streaming import sinks
from eventlake.streaming.sinks import BatchSink

METRICS_WATERMARK = "1 minute"
ALERT_WATERMARK = "2 minutes"
ROLLING_LOOKBACK_SECONDS = 3600


def parsed_events(raw: DataFrame) -> DataFrame:
    return messages.flatten_events(messages.parse_json(raw, schemas.EVENT, "event_id"))


def metric_events(raw: DataFrame) -> DataFrame:
    return messages.timed_events(messages.parse_json(raw, schemas.EVENT_METRICS, "event_id"))


def event_times(raw: DataFrame) -> DataFrame:
    return messages.timed_events(messages.parse_json(raw, schemas.EVENT_TIMES, "event_id"))


def parsed_reviews(raw: DataFrame) -> DataFrame:
    return messages.flatten_reviews(messages.parse_json(raw, schemas.REVIEW, "review_id"))


def parsed_sessions(raw: DataFrame) -> DataFrame:
    return messages.flatten_sessions(messages.parse_json(raw, schemas.SESSION_ROW, "session_id"))


def parsed_session_events(raw: DataFrame) -> DataFrame:
    return messages.explode_session_events(messages.parse_json(raw, schemas.SESSION_EVENTS, "session_id"))


def parsed_searches(raw: DataFrame) -> DataFrame:
    return messages.flatten_searches(messages.parse_json(raw, schemas.SEARCH, "search_id"))


def distinct_events(rows: DataFrame, within: str, key: str = "event_id", time: str = "event_timestamp") -> DataFrame:
    """Rows of a stream without repeats of a key whose times lie within the span of the first.

    A key is kept in state until the newest time seen is the span further, then forgotten, so the state holds
    one span of keys however long the stream runs. The span is the watermark too: rows that are older than
    that are left out as late (`LateRows` counts them), so it is chosen as long as messages may be delayed.
    """
    return rows.withWatermark(time, within).dropDuplicatesWithinWatermark([key])


# job: topic, transformation of the raw messages, table
INGESTS = {
    "events": ("events", parsed_events, "events"),
    "reviews": ("reviews", parsed_reviews, "reviews"),
    "sessions": ("sessions", parsed_sessions, "sessions"),
    "session-events": ("sessions", parsed_session_events, "session_events"),
    "searches": ("searches", parsed_searches, "search_queries"),
}


def _metrics(events: DataFrame, settings: Settings) -> DataFrame:
    found = windows.window_metrics(events, "5 minutes", settings.roles, METRICS_WATERMARK)
    return windows.with_audit(found)


def _category_metrics(events: DataFrame, settings: Settings) -> DataFrame:
    found = windows.window_category_metrics(events, "5 minutes", settings.roles, METRICS_WATERMARK)
    return windows.with_audit(found)


def _type_counts(events: DataFrame, settings: Settings) -> DataFrame:
    counts = windows.window_type_counts(events, "5 minutes", METRICS_WATERMARK)
    return counts.withColumn("window_date", F.to_date("window_start"))


METRICS = {
    "metrics": (_metrics, "metrics_5min"),
    "category-metrics": (_category_metrics, "metrics_category_5min"),
    "type-counts": (_type_counts, "type_counts_5min"),
}
ALERT_JOB = "alerts"
ROLLING_ALERT_JOB = "rolling-alerts"
TOP_PRODUCT_JOB = "top-products"
REJECTED_JOB = "rejected-events"
JOBS = (*INGESTS, *METRICS, ALERT_JOB, ROLLING_ALERT_JOB, TOP_PRODUCT_JOB, REJECTED_JOB)


def start(
    spark: SparkSession,
    job: str,
    settings: Settings = Settings(),
    source: Source | None = None,
    trigger: str | None = None,
    extra_sinks: tuple[BatchSink, ...] = (),
    files: int | None = None,
    distinct: str | None = None,
    heartbeat: Source | None = None,
    grace: str = "2 minutes",
) -> StreamingQuery:
    """Start one job; without a source it reads its Kafka topic.

    Checkpoints must outlast the session, so their folder is named by the
    settings or by the session, never made up here.

    `distinct` (a span such as "1 hour") lets an ingest job leave out events sent again within it. A
    `heartbeat` lets the alert jobs judge a minute without events while the silence lasts: minutes close by
    the clock, `grace` after their end. It is for live topics; over old messages the clock would be far ahead
    of them. Both change what a checkpoint holds, so a job with them has a checkpoint of its own, and starts
    anew from the source's starting offset when switched.
    """
    store = TableStore(spark, settings)
    shared = spark.conf.get("spark.checkpoint.dir", None)
    base = settings.checkpoint_base or (f"{shared.rstrip('/')}/checkpoints" if shared else None)
    if base is None:
        raise RuntimeError("set CHECKPOINT_BASE or spark.checkpoint.dir: a restart reads the checkpoint again")
    if distinct and job != "events":
        raise ValueError("only the events job leaves out repeats")
    if heartbeat and job not in (ALERT_JOB, ROLLING_ALERT_JOB):
        raise ValueError("only the alert jobs have a heartbeat")
    checkpoint = checkpoint_path(base, f"{job}{'-distinct' if distinct else ''}{'-heartbeat' if heartbeat else ''}")
    topic = INGESTS[job][0] if job in INGESTS else "events"
    raw = read_stream(spark, source or kafka_source(settings.kafka_servers, TOPICS[topic]))
    if job in INGESTS:
        _, transform, table = INGESTS[job]
        store.create(table)
        rows = transform(raw)
        if distinct:
            rows = distinct_events(rows, distinct)
        if "arrival_date" in store.columns(table):
            rows = rows.withColumn("arrival_date", F.current_date())
        return sinks.append_to_table(rows, store, table, checkpoint, trigger, files)
    if job == REJECTED_JOB:
        store.create("rejected_messages")
        found = messages.rejected(raw.select(F.col("value").cast("string")), schemas.EVENT, "event_id", "timestamp")
        rows = found.withColumns({
            "topic": F.lit(TOPICS[topic]), "rejected_at": F.current_timestamp(), "arrival_date": F.current_date(),
        })
        return sinks.append_to_table(rows, store, "rejected_messages", checkpoint, trigger, files)
    if job in METRICS:
        aggregate, table = METRICS[job]
        store.create(table)
        metrics = aggregate(metric_events(raw), settings)
        return sinks.append_to_table(metrics, store, table, checkpoint, trigger)
    def minute_counts() -> DataFrame:
        if heartbeat:
            return windows.beating_counts(event_times(raw), read_heartbeats(spark, heartbeat), "1 minute", ALERT_WATERMARK, grace)
        return windows.window_counts(event_times(raw), "1 minute", ALERT_WATERMARK)

    if job == ALERT_JOB:
        store.create("anomaly_alerts")
        counts = minute_counts()
        key = sinks.checkpoint_key(f"{checkpoint}/query")
        out = sinks.multi_sink(sinks.table_sink(store, "anomaly_alerts", key, "detection_time"), *extra_sinks)
        sink = threshold_alert_sink(f"{checkpoint}/state", out, settings.thresholds, 60, grace if heartbeat else None)
        return sinks.for_each_batch(counts, sink, f"{checkpoint}/query", trigger)
    if job == ROLLING_ALERT_JOB:
        counts = minute_counts()
        store.create("rolling_alerts")
        key = sinks.checkpoint_key(f"{checkpoint}/query")
        out = sinks.table_sink(store, "rolling_alerts", key, "detection_time")
        sink = rolling_alert_sink(f"{checkpoint}/history", out, ROLLING_LOOKBACK_SECONDS, 60)
        return sinks.for_each_batch(counts, sink, f"{checkpoint}/query", trigger)
    if job == TOP_PRODUCT_JOB:
        counts = windows.window_product_counts(metric_events(raw), "5 minutes", METRICS_WATERMARK)
        store.create("top_products")
        key = sinks.checkpoint_key(f"{checkpoint}/query")
        sink = top_product_sink(sinks.table_sink(store, "top_products", key, "window_start"))
        return sinks.for_each_batch(counts, sink, f"{checkpoint}/query", trigger)
    raise ValueError(f"unknown job {job!r}; one of {', '.join(JOBS)}")


def threshold_alert_sink(
    state_path: str, out: BatchSink, limits: Thresholds, size_seconds: int, unseen: str | None = None
) -> BatchSink:
    """Judge the closed windows of each micro-batch, and the empty windows since the last one before.

    A window without events never closes by itself, so a total stop is seen, minute by minute, as soon
    as events come again. What is kept is the newest window of the last two batches: the state of a
    batch replaces that of the one before the last, so a replayed batch finds what it found at first.

    Heartbeats reach back before the start of the job, to a time whose events it has not read: windows of the
    span `unseen` from the very first window on are not judged.
    """
    when = "yyyy-MM-dd HH:mm:ss"
    kept = "newest STRING, judged_from STRING"

    def judge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = judged_from = None
        # a state that is lost is none: the windows since the last batch are then taken as they come
        if batch_id > 0 and exists(spark, f"{state_path}/{(batch_id - 1) % 2}"):
            before, judged_from = spark.read.schema(kept).json(f"{state_path}/{(batch_id - 1) % 2}").first()
        start = F.min("window_start")
        span = batch.agg(
            F.date_format(start, when).alias("min"), F.date_format(F.max("window_start"), when).alias("max"),
            F.date_format(start + F.expr(f"INTERVAL {unseen}") if unseen else start, when).alias("judged_from"),
        ).first()
        if span["max"] is not None:
            judged_from = judged_from or span["judged_from"]
            filled = anomalies.fill_empty_windows(batch, size_seconds, before or span["min"], span["max"])
            fresh = filled.filter(F.col("window_start") > F.lit(before).cast("timestamp")) if before else filled
            if unseen:
                fresh = fresh.filter(F.col("window_start") > F.lit(judged_from).cast("timestamp"))
            out(anomalies.threshold_alerts(fresh, limits), batch_id)
        newest = spark.createDataFrame([(span["max"] or before, judged_from)], kept)
        newest.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(f"{state_path}/{batch_id % 2}")

    return sinks.multi_sink(judge)


def rolling_alert_sink(
    history_path: str, out: BatchSink, lookback_seconds: int, size_seconds: int | None = None, **limits
) -> BatchSink:
    """Judge each micro-batch of closed windows against the counts kept from before it.

    Windows close in time order, so all that a window is compared with was
    written by its own batch or an earlier one. The history is kept by day and
    batch: a replayed batch replaces its own files, and only the days within the
    lookback are listed and read. Days before them are removed. With the windows' size, windows
    without any event, which no stream emits, count as history with 0 events. They are not judged here:
    a silence is an alert of the fixed limits, or is emitted as windows of 0 events by a heartbeat.
    """

    def newest_before(spark: SparkSession, days: list[str], batch_id: int) -> int | None:
        """Seconds of the newest window that earlier batches have kept."""
        for name in reversed(days):
            rows = spark.read.parquet(f"{history_path}/{name}").filter(F.col("batch") < batch_id)
            found = rows.agg(F.unix_seconds(F.max("window_start")).alias("s")).first()["s"]
            if found is not None:
                return found
        return None

    def judge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        ends = batch.agg(*[F.unix_seconds(f("window_start")).alias(f.__name__) for f in (F.min, F.max)]).first()
        first, last = ends["min"], ends["max"]
        if first is None:
            return
        emitted = batch.select("window_start")
        kept = [name for name in folders_in(spark, history_path) if name.startswith("day=")]
        if size_seconds:
            newest = newest_before(spark, kept, batch_id)
            first = first if newest is None else min(first, newest + size_seconds)
            bounds = (datetime.fromtimestamp(s, timezone.utc).isoformat() for s in (first, last))
            batch = anomalies.fill_empty_windows(batch, size_seconds, *bounds)
        (
            batch.withColumns({"day": F.to_date("window_start"), "batch": F.lit(batch_id)})
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("day", "batch").parquet(history_path)
        )
        zone = ZoneInfo(spark.conf.get("spark.sql.session.timeZone"))
        from_day, to_day = (datetime.fromtimestamp(s, zone).date() for s in (first - lookback_seconds, last))
        dates = [from_day + timedelta(i) for i in range((to_day - from_day).days + 1)]
        days = ",".join(d.isoformat() for d in dates)
        known = spark.read.option("basePath", history_path).parquet(f"{history_path}/day={{{days}}}")
        since = F.timestamp_seconds(F.lit(first - lookback_seconds))
        recent = known.filter((F.col("window_start") >= since) & (F.col("batch") <= batch_id))
        alerts = anomalies.rolling_alerts(
            recent.select("window_start", "window_end", "event_count"), lookback_seconds, **limits
        )
        out(alerts.join(emitted, "window_start", "left_semi").select(*alerts.columns), batch_id)
        # neither the next batch nor a replay of this one reads a day before these
        for name in kept:
            if name < f"day={dates[0].isoformat()}":
                remove(spark, f"{history_path}/{name}")

    return sinks.multi_sink(judge)


def top_product_sink(out: BatchSink, k: int = 10) -> BatchSink:
    """Rank the closed windows of a micro-batch; a window is never split over batches."""

    def write(batch: DataFrame, batch_id: int) -> None:
        out(windows.top_products(batch, k), batch_id)

    return write


class LateRows(StreamingQueryListener):
    """Counts the rows that came after the watermark and were left out of the aggregates, per query.

    A query itself remembers its last hundred micro-batches only; added to `spark.streams` before the
    query starts, this keeps the whole count.
    """

    def __init__(self):
        self.counts: dict[str, int] = {}

    def onQueryStarted(self, event):
        self.counts.setdefault(str(event.id), 0)

    def onQueryProgress(self, event):
        late = sum(operator.numRowsDroppedByWatermark for operator in event.progress.stateOperators)
        key = str(event.progress.id)
        self.counts[key] = self.counts.get(key, 0) + late

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass
