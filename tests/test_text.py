from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventlake.functions import search, text
from eventlake.functions.text import REVIEW_ASPECTS, REVIEW_LEXICON, Lexicon


def values(spark, texts, column):
    df = spark.createDataFrame(list(enumerate(texts)), "i INT, t STRING")
    return [r["v"] for r in df.select("i", column.alias("v")).orderBy("i").collect()]


def test_keywords_overlap_and_have_no_negation(spark):
    texts = ["좋아요", "나쁘지 않아요", "싸구려 포장", "", None, "보통"]
    assert values(spark, texts, text.keywords(F.col("t"), REVIEW_LEXICON)) == [
        ["좋아요", "좋아"], ["나쁘"], ["싸구려"], [], [], [],
    ]
    assert values(spark, texts, text.aspects(F.col("t"), REVIEW_ASPECTS)) == [
        [], [], ["price", "packaging"], [], [], [],
    ]


def test_sentiment_is_a_float_between_minus_one_and_one(spark):
    texts = ["좋아요 별로", "좋아요", "실망", "최고 만족 별로", "", None]
    found = values(spark, texts, text.sentiment(F.col("t"), REVIEW_LEXICON))
    assert found[:3] == [0.3333333432674408, 1.0, -1.0]
    assert found[3] == 0.3333333432674408
    assert found[4:] == [0.0, 0.0]


def test_first_keyword(spark):
    texts = ["배송이 늦어서 실망", "ABC", None]
    assert values(spark, texts, text.first_keyword(F.col("t"), text.FIRST_KEYWORD_LEXICON)) == ["늦", "", None]


def test_keyword_type(spark):
    texts = ["최고", "최악", "보통"]
    assert values(spark, texts, text.keyword_type(F.col("t"), REVIEW_LEXICON)) == [
        "positive", "negative", "neutral",
    ]


SMALL = Lexicon(positive=("ab", "abc", "d"), negative=("b", "ca"))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="abcdABCD ", max_size=12), min_size=1, max_size=30))
def test_keywords_against_brute_force(spark, texts):
    found = values(spark, texts, text.keywords(F.col("t"), SMALL))
    assert found == [[w for w in SMALL.words if w in t.lower()] for t in texts]


def test_text_search_stays_in_generated_code(spark):
    df = spark.createDataFrame([("a",)], "t STRING").select(text.keywords(F.col("t"), SMALL))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "lambda" not in plan


def test_query_pattern_first_match_wins(spark):
    queries = ["엄마 생일선물 추천", "나이키 vs 자라", "노트북 후기", "운동화 5만원대", "운동화 추천", "나이키 운동화 260", "BEST 가방"]
    assert values(spark, queries, search.query_pattern(F.col("t"))) == [
        "natural", "comparison", "comparison", "specific", "recommendation", "structured", "recommendation",
    ]


def test_query_repair(spark):
    queries = [
        " 아디다다스  운동화 ", "뉴발스란 가방", "스니커 추천", "노트북", "widget", None,
        "가방끈 애플펜 삼성폰 자라홈 나이키즈", "자라라",
    ]
    assert values(spark, queries, search.repair_query(F.col("t"))) == [
        "아디다스 운동화", "뉴발란스 가방", "스니커즈 추천", "노트북", "widget", None,
        "가방끈 애플펜 삼성폰 자라홈 나이키즈", "자라",
    ]
