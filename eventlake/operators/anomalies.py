"""Volume alerts over windowed event counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventlake.config import Thresholds
from eventlake.functions.numbers import ratio

# The labels of the alert table.
SPIKE, DROP = "High Traffic Spike", "Traffic Drop"
CRITICAL, WARNING = "CRITICAL", "WARNING"

ALERT_COLUMNS = (
    "window_start", "window_end", "event_count", "avg_count", "stddev_count", "z_score",
    "anomaly_type", "severity", "detection_time",
)
DAY_SECONDS = 86_400


def threshold_alerts(counts: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    """Windows above or below fixed limits; works on a stream of closed windows too."""
    n = F.col("event_count")
    labelled = counts.withColumns({
        "avg_count": F.lit(float(limits.mean)),
        "stddev_count": F.lit(float(limits.stddev)),
        "z_score": ratio(n - F.lit(float(limits.mean)), F.lit(float(limits.stddev))),
        "anomaly_type": F.when(n > limits.high, SPIKE).when(n < limits.low, DROP),
        "severity": F.when(n > 2 * limits.high, CRITICAL).otherwise(WARNING),
        "detection_time": F.col("window_end"),
    })
    return labelled.filter(F.col("anomaly_type").isNotNull()).select(*ALERT_COLUMNS)


def fill_empty_windows(
    counts: DataFrame, size_seconds: int, first: str | None = None, last: str | None = None
) -> DataFrame:
    """Add a zero row for each window between the first and the last that has no events.

    Without bounds the counts are read once more for their first and last
    window. The calendar is built day by day, so that no task holds more than a
    day of it.
    """
    stretch = max(size_seconds, DAY_SECONDS - DAY_SECONDS % size_seconds)
    if first is None or last is None:
        ends = (F.min("window_start"), F.max("window_start"))
        span = counts.agg(*[F.unix_seconds(e).alias(c) for e, c in zip(ends, ("first", "last"))])
    else:
        ends = (F.lit(first).cast("timestamp"), F.lit(last).cast("timestamp"))
        one = counts.sparkSession.range(1)
        span = one.select(*[F.unix_seconds(e).alias(c) for e, c in zip(ends, ("first", "last"))])
    days = span.filter(F.col("first").isNotNull()).select(
        "last", F.explode(F.sequence("first", "last", F.lit(stretch).cast("long"))).alias("from")
    )
    until = F.least(F.col("last"), F.col("from") + stretch - size_seconds)
    calendar = days.repartition("from").select(
        F.explode(F.sequence("from", until, F.lit(size_seconds).cast("long"))).alias("s")
    )
    return (
        calendar.select(
            F.timestamp_seconds("s").alias("window_start"),
            F.timestamp_seconds(F.col("s") + size_seconds).alias("window_end"),
        )
        .join(counts.drop("window_end"), "window_start", "left")
        .withColumn("event_count", F.coalesce("event_count", F.lit(0)).cast("long"))
    )


def rolling_stats(counts: DataFrame, lookback_seconds: int) -> DataFrame:
    """Mean and deviation of the counts in the time before each window.

    Time is cut into stretches that are at least as long as the lookback. A row
    near the end of its stretch is also sent to the next one as history, so each
    stretch is complete by itself and no task sorts the whole series.
    """
    stretch = max(lookback_seconds, DAY_SECONDS)
    t = F.col("t")
    own = F.floor(t / F.lit(stretch)).cast("long")
    keyed = counts.withColumn("t", F.unix_seconds("window_start")).withColumn("own", own)
    is_history = t >= (F.col("own") + 1) * stretch - lookback_seconds
    homes = F.array_compact(F.array(F.col("own"), F.when(is_history, F.col("own") + 1)))
    before = W.partitionBy("stretch").orderBy("t").rangeBetween(-lookback_seconds, -1)
    x = F.col("event_count").cast("decimal(19,0)")
    seen = (
        keyed.withColumn("stretch", F.explode(homes))
        .withColumns({
            "history": F.count("event_count").over(before),
            "total": F.sum(x).over(before),
            "squares": F.sum(x * x).over(before),
        })
        .filter(F.col("stretch") == F.col("own"))
    )
    # whole-number sums: the same result in whatever order rows arrive
    n = F.col("history").cast("double")
    total = F.col("total").cast("double")
    spread = n * F.col("squares").cast("double") - total * total
    return seen.withColumns({
        "avg_count": F.try_divide(total, n),
        "stddev_count": F.sqrt(F.try_divide(spread, n * (n - 1))),
    }).drop("t", "own", "stretch", "total", "squares")


def rolling_alerts(
    counts: DataFrame,
    lookback_seconds: int = 3600,
    min_history: int = 10,
    sigmas: float = 3.0,
) -> DataFrame:
    """Windows more than some deviations away from the mean of the time before them."""
    n = F.col("event_count")
    mean, sd = F.col("avg_count"), F.col("stddev_count")
    judged = rolling_stats(counts, lookback_seconds).filter(F.col("history") >= min_history)
    labelled = judged.withColumns({
        "z_score": F.try_divide(n - mean, sd),
        "anomaly_type": F.when(n > mean + sigmas * sd, SPIKE).when(n < mean - sigmas * sd, DROP),
        "severity": F.when(F.abs(n - mean) > 2 * sigmas * sd, CRITICAL).otherwise(WARNING),
        "detection_time": F.col("window_end"),
    })
    return labelled.filter(F.col("anomaly_type").isNotNull()).select(*ALERT_COLUMNS)
