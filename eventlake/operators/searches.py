"""Search reports over flattened search rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.functions.numbers import ratio


def search_metrics(searches: DataFrame) -> DataFrame:
    """Per day: searches, click-through rate, share without results, mean clicked position."""
    counted = searches.groupBy("search_date").agg(
        F.count("*").alias("searches"),
        F.count_if("clicked").alias("clicks"),
        F.count_if(F.col("result_count") == 0).alias("empty_searches"),
        F.avg("clicked_position").alias("avg_clicked_position"),
    )
    total = F.col("searches")
    return counted.withColumns({
        "click_through_rate": ratio(F.col("clicks"), total),
        "zero_result_rate": ratio(F.col("empty_searches"), total),
    })


def pattern_agreement(searches: DataFrame) -> DataFrame:
    """Detected pattern against the pattern the message was labelled with."""
    return searches.groupBy("pattern_type", "pattern").agg(F.count("*").alias("searches"))


def popular_searches(searches: DataFrame, k: int = 20) -> DataFrame:
    counted = searches.groupBy("query_norm").agg(F.count("*").alias("searches"))
    return counted.orderBy(F.desc("searches"), "query_norm").limit(k)
