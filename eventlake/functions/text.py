"""Lexicon based text expressions; all built-in, so they stay in generated code."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Lexicon:
    positive: tuple[str, ...]
    negative: tuple[str, ...]

    @property
    def words(self) -> tuple[str, ...]:
        return self.positive + self.negative


# The Korean review lexicon and the aspect words.
REVIEW_LEXICON = Lexicon(
    positive=(
        "좋아요", "좋아", "최고", "만족", "추천", "재구매", "빨라요", "빠르", "빠른",
        "괜찮", "예뻐", "예쁘", "훌륭", "대박", "감사", "친절", "꼼꼼", "완벽",
    ),
    negative=(
        "별로", "실망", "늦", "아쉬", "환불", "싸구려", "안좋", "나빠", "나쁘",
        "불량", "찢어", "고장", "불만", "최악", "짜증", "화나", "후회",
    ),
)
# The shorter lexicon for the first keyword of a message.
FIRST_KEYWORD_LEXICON = Lexicon(
    positive=("좋아요", "최고", "만족", "추천", "재구매", "빠르", "괜찮", "예뻐"),
    negative=("별로", "실망", "늦", "아쉬", "환불", "싸구려", "안좋"),
)
REVIEW_ASPECTS = {
    "delivery": ("배송", "도착", "배달", "운송"),
    "quality": ("품질", "퀄리티", "재질", "소재", "마감"),
    "price": ("가격", "가성비", "저렴", "비싸", "싸", "비쌈"),
    "packaging": ("포장", "박스", "패키지", "패키징"),
    "size": ("사이즈", "크기", "크", "작", "맞", "핏"),
    "design": ("디자인", "색상", "색깔", "모양", "스타일"),
}


def _found(candidates: Sequence[Column]) -> Column:
    """The candidates that are not NULL. array_except stays in generated code,
    where `lower(text)` is computed once; array_compact would not."""
    return F.array_except(F.array(*candidates), F.array(F.lit(None).cast("string")))


def keywords(text: Column, lexicon: Lexicon) -> Column:
    """Every lexicon word found anywhere in the text, in lexicon order, once each."""
    lowered = F.lower(text)
    return _found([F.when(F.contains(lowered, F.lit(w)), F.lit(w)) for w in lexicon.words])


def keyword_sentiment(found: Column, lexicon: Lexicon) -> Column:
    """(positive - negative) / all over the words found, as a 32-bit float; 0 when none.

    Takes the array that `keywords` returns, so that the text is searched once.
    """
    good = F.size(F.array_intersect(found, F.lit(list(lexicon.positive))))
    bad = F.size(F.array_intersect(found, F.lit(list(lexicon.negative))))
    return F.coalesce(F.try_divide(good - bad, good + bad), F.lit(0.0)).cast("float")


def sentiment(text: Column, lexicon: Lexicon) -> Column:
    return keyword_sentiment(keywords(text, lexicon), lexicon)


def aspects(text: Column, words: Mapping[str, Sequence[str]]) -> Column:
    """The aspects of which at least one word occurs in the text."""
    lowered = F.lower(text)
    named = []
    for aspect, terms in words.items():
        hit = F.contains(lowered, F.lit(terms[0]))
        for term in terms[1:]:
            hit = hit | F.contains(lowered, F.lit(term))
        named.append(F.when(hit, F.lit(aspect)))
    return _found(named)


def first_keyword(text: Column, lexicon: Lexicon) -> Column:
    """The leftmost lexicon word of the text, '' when there is none."""
    return F.regexp_extract(F.lower(text), f"({'|'.join(map(re.escape, lexicon.words))})", 1)


def keyword_type(keyword: Column, lexicon: Lexicon) -> Column:
    return (
        F.when(keyword.isin(*lexicon.positive), "positive")
        .when(keyword.isin(*lexicon.negative), "negative")
        .otherwise("neutral")
    )
