"""Review reports per created_date, over reviews tagged once with their words."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.functions import text
from eventlake.functions.numbers import ratio
from eventlake.functions.text import REVIEW_ASPECTS, REVIEW_LEXICON, Lexicon


def tag_reviews(
    reviews: DataFrame,
    lexicon: Lexicon = REVIEW_LEXICON,
    aspects: Mapping[str, Sequence[str]] = REVIEW_ASPECTS,
    stored: bool = False,
) -> DataFrame:
    """Replace the text by its keywords, aspects and sentiment: what the reports read.

    `stored` says that `sentiment_keywords` holds the words of this lexicon already, as rows do that
    were taken in with it; a row without them has its text searched.
    """
    body = F.col("review_text")
    searched = text.keywords(body, lexicon)
    found = reviews.withColumns({
        "keywords": F.coalesce("sentiment_keywords", searched) if stored else searched,
        "aspects": text.aspects(body, aspects),
    }).drop("review_text", "sentiment_keywords")
    return found.withColumn("sentiment", text.keyword_sentiment(F.col("keywords"), lexicon))


def _report_date() -> Column:
    return F.col("created_date").alias("report_date")


def _one_row_per(tagged: DataFrame, array: str, name: str, *kept: str) -> DataFrame:
    """Explode without the empty arrays.

    A plain explode would make Spark test the array's size below the search of
    the text, that is, search the text twice.
    """
    return tagged.select(*kept, F.explode_outer(array).alias(name)).filter(F.col(name).isNotNull())


def review_summary(tagged: DataFrame) -> DataFrame:
    rated = [F.count_if(F.col("rating") == stars).alias(f"rating_{stars}") for stars in range(1, 6)]
    return tagged.groupBy(_report_date()).agg(
        F.count("*").alias("total_reviews"),
        F.avg("rating").alias("avg_rating"),
        *rated,
        F.count_if(F.col("sentiment") > 0).alias("positive_count"),
        F.count_if(F.col("sentiment") < 0).alias("negative_count"),
        F.count_if("has_images").alias("with_images_count"),
        F.avg("text_length").alias("avg_text_length"),
    )


def keyword_frequency(tagged: DataFrame, lexicon: Lexicon = REVIEW_LEXICON) -> DataFrame:
    each = _one_row_per(tagged, "keywords", "keyword", "created_date", "rating")
    counted = each.groupBy(_report_date(), "keyword").agg(
        F.count("*").alias("frequency"), F.avg("rating").alias("avg_rating_with_keyword")
    )
    return counted.withColumn("keyword_type", text.keyword_type(F.col("keyword"), lexicon))


def aspect_sentiment(tagged: DataFrame) -> DataFrame:
    """All aspects in one pass; an aspect nobody mentions has no row."""
    each = _one_row_per(tagged, "aspects", "aspect", "created_date", "sentiment")
    return each.groupBy(_report_date(), "aspect").agg(
        F.count("*").alias("mention_count"),
        F.count_if(F.col("sentiment") > 0).alias("positive_mentions"),
        F.count_if(F.col("sentiment") < 0).alias("negative_mentions"),
        F.avg("sentiment").alias("sentiment_score"),
    )


def _most_frequent(words: Sequence[str], counts: Mapping[str, Column], k: int) -> Column:
    """The k words with the highest counts, most frequent first, comma separated."""
    scored = F.array_compact(F.array(*[
        F.when(counts[w] > 0, F.struct((-counts[w]).alias("n"), F.lit(w).alias("w"))) for w in words
    ]))
    return F.array_join(F.transform(F.slice(F.array_sort(scored), 1, k), lambda s: s["w"]), ",")


def product_reviews(tagged: DataFrame, lexicon: Lexicon = REVIEW_LEXICON, k: int = 3) -> DataFrame:
    """Per product: rating, share of positive and negative reviews, top keywords.

    The lexicon is short, so each word is a counter of the same aggregate; the
    top keywords then need neither an explode nor a second shuffle.
    """
    counters = {w: f"_word_{i}" for i, w in enumerate(lexicon.words)}
    totals = tagged.groupBy(_report_date(), "product_id").agg(
        F.count("*").alias("review_count"),
        F.avg("rating").alias("avg_rating"),
        F.count_if(F.col("sentiment") > 0).alias("_positive"),
        F.count_if(F.col("sentiment") < 0).alias("_negative"),
        *[F.count_if(F.array_contains("keywords", w)).alias(c) for w, c in counters.items()],
    )
    counts = {w: F.col(c) for w, c in counters.items()}
    return totals.select(
        "report_date", "product_id", "review_count", "avg_rating",
        ratio(F.col("_positive"), F.col("review_count")).alias("positive_ratio"),
        ratio(F.col("_negative"), F.col("review_count")).alias("negative_ratio"),
        _most_frequent(lexicon.positive, counts, k).alias("top_positive_keywords"),
        _most_frequent(lexicon.negative, counts, k).alias("top_negative_keywords"),
    )
