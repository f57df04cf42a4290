"""Search query expressions: pattern label and spelling repair."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tell-tale words of each query pattern, first match wins.
SEARCH_PATTERNS = (
    ("natural", "선물"),
    ("comparison", " vs |뭐가 좋아요|후기"),
    ("specific", "원대|원 이하|무료배송|당일배송|신상|세일|할인"),
    ("recommendation", "추천|가성비|인기|순위|best |베스트"),
)
# Brand and item words that a query may misspell.
SEARCH_VOCABULARY = (
    "나이키", "아디다스", "뉴발란스", "컨버스", "자라", "유니클로",
    "삼성", "애플", "소니", "샤오미", "로지텍", "레노버",
    "이니스프리", "설화수", "라네즈", "에스티로더", "시세이도",
    "운동화", "청바지", "티셔츠", "원피스", "자켓", "가방", "백팩", "스니커즈",
    "이어폰", "노트북", "태블릿", "마우스", "키보드", "모니터", "스피커",
    "립스틱", "파운데이션", "쿠션", "마스크팩", "선크림", "스킨", "로션",
)
OTHER_PATTERN = "structured"


def query_pattern(query: Column, patterns: Sequence[tuple[str, str]] = SEARCH_PATTERNS) -> Column:
    label = F.lit(OTHER_PATTERN)
    for name, regex in reversed(patterns):
        label = F.when(F.lower(query).rlike(regex), name).otherwise(label)
    return label


def misspellings(vocabulary: Sequence[str]) -> dict[str, str]:
    """Every term with one letter lost, one doubled or two neighbours swapped -> the term.

    A spelling that several terms share goes to the first of them in alphabetical order; a term is
    never taken for another one misspelt.
    """
    found: dict[str, str] = {}
    for term in sorted(set(vocabulary)):
        for i in range(len(term)):
            lost = term[:i] + term[i + 1 :]
            doubled = term[: i + 1] + term[i:]
            swapped = term[:i] + term[i + 1 : i + 2] + term[i] + term[i + 2 :]
            for spelling in (lost, doubled, swapped):
                found.setdefault(spelling, term)
    return {spelling: term for spelling, term in found.items() if spelling and spelling not in set(vocabulary)}


def repair_query(
    query: Column, vocabulary: Sequence[str] = SEARCH_VOCABULARY, least_letters: int = 3
) -> Column:
    """Lower the query, squeeze blanks and repair misspelt vocabulary words.

    A word of at least `least_letters` that is a term with one letter lost, one doubled or two
    neighbours swapped becomes that term; any other word stays. The spellings are worked out
    beforehand, so a word costs one lookup. For a vocabulary of many thousand terms join
    `misspellings` as a table on the distinct words instead.
    """
    spellings = misspellings(vocabulary)
    known = F.create_map(*[F.lit(part) for pair in sorted(spellings.items()) for part in pair])

    def repair(word: Column) -> Column:
        return F.when(F.length(word) >= least_letters, F.coalesce(F.try_element_at(known, word), word)).otherwise(word)

    words = F.split(F.regexp_replace(F.trim(F.lower(query)), r"\s+", " "), " ")
    return F.array_join(F.transform(words, repair), " ")
