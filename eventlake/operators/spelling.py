"""Spelling repair by a deletion index: tables joined by equality, for a vocabulary of any size.

Two words that are at most `edits` edits apart have a common rest after at most as many letters are deleted
from each. All such rests of the vocabulary are the index. Words look up their own rests, and what they meet is
verified by its true distance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rests(word: Column, edits: int) -> Column:
    """The word and what is left of it after up to so many letters are deleted, each once."""
    def shorter(w: Column) -> Column:
        places = F.sequence(F.lit(1), F.greatest(F.length(w), F.lit(1)))
        return F.transform(places, lambda i: F.concat(F.substring(w, F.lit(1), i - 1), F.substring(w, i + 1, F.length(w))))

    found = level = F.array(word)
    for _ in range(edits):
        level = F.array_distinct(F.flatten(F.transform(level, shorter)))
        found = F.array_union(found, level)
    return found


def deletion_index(terms: DataFrame, edits: int = 2) -> DataFrame:
    """rest, term, weight: every rest of every term. `terms` has one row per term, with its frequency as weight."""
    return terms.filter(F.length("term") > 0).select(F.explode(rests(F.col("term"), edits)).alias("rest"), "term", "weight")


def allowed_edits(word: Column, edits: int, least_letters: int) -> Column:
    """None for short words, one for middling ones, all for long ones."""
    length = F.length(word)
    return F.when(length < least_letters, 0).when(length < 2 * least_letters, F.lit(min(1, edits))).otherwise(edits)


def repaired_words(words: DataFrame, index: DataFrame, edits: int = 2, least_letters: int = 3) -> DataFrame:
    """word, term, distance for every distinct word that a term is near to.

    The nearest term wins, then the most frequent, then the first by alphabet; a word that is a term is
    itself. Candidates are reduced to the best of each word before they are gathered. Words that no term is
    near to have no row.
    """
    asked = words.select("word").filter(F.length("word") > 0).distinct()
    met = asked.select("word", F.explode(rests(F.col("word"), edits)).alias("rest")).join(index, "rest")
    distance = F.levenshtein("word", "term")
    near = met.select("word", "term", "weight", distance.alias("distance")).filter(
        F.col("distance") <= allowed_edits(F.col("word"), edits, least_letters)
    )
    best = F.min(F.struct("distance", (-F.col("weight")).alias("rare"), "term"))
    return near.groupBy("word").agg(best.alias("best")).select("word", F.col("best.term").alias("term"), F.col("best.distance").alias("distance"))


def repaired_queries(queries: DataFrame, index: DataFrame, edits: int = 2, least_letters: int = 3) -> DataFrame:
    """query and query_norm for every distinct query: lower case, single blanks, words repaired.

    Each distinct query is split once, and each distinct word repaired once.
    """
    tidy = F.regexp_replace(F.trim(F.lower("query")), r"\s+", " ")
    split = queries.select("query").filter(F.col("query").isNotNull()).distinct().select(
        "query", F.posexplode(F.split(tidy, " ")).alias("place", "word")
    )
    known = repaired_words(split, index, edits, least_letters)
    spelt = split.join(known, "word", "left").withColumn("word", F.coalesce("term", "word"))
    listed = F.array_sort(F.collect_list(F.struct("place", "word")))
    return spelt.groupBy("query").agg(F.array_join(listed["word"], " ").alias("query_norm"))


def vocabulary(names: DataFrame, column: str) -> DataFrame:
    """term and weight: the words of a column and how often each occurs."""
    words = names.select(F.explode(F.split(F.lower(column), r"[^\p{L}\p{N}]+")).alias("term"))
    return words.filter(F.length("term") > 0).groupBy("term").agg(F.count("*").alias("weight"))
