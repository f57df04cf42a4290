"""The registered queries of this subpackage, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm import (
    language, lm, merkle, neighbours, packing, piece_codec, runs, sharding, simhash, token_counts, toxicity, url_filter, vector_links,
)
from eventlake.llm.common import fold_is, table

Query = Callable[[SparkSession, str], DataFrame]


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(~fold_is("doc_id", 5, 0))
    return toxicity.score(documents, toxicity.fit(documents, labels)).select(
        "doc_id", fold_is("doc_id", 5, 0).alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
    )


def op1_vector_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_links.linked(table(spark, sf_dir, "embeddings"), least=0.98)


def op2_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held_out = fold_is("doc_id", 7, 2)
    model, scored = lm.fit_and_score(documents, ~held_out, held_out.alias("held_out"))
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = language.fit(documents.where(~fold_is("doc_id", 4, 2)))
    return language.predict(documents, model).select(
        "doc_id", fold_is("doc_id", 4, 2).alias("held_out"), "lang_pred", "score", "accepted"
    )


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.search(vectors, vectors.where("vec_id % 20 = 0"), k=20)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op7_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = piece_codec.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.shard(table(spark, sf_dir, "documents"), shards=24)
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def with_copies(documents: DataFrame) -> DataFrame:
    """The documents, of which one in ten repeats a stretch of its own words up to its end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    chosen = documents.select("doc_id", "text", g.alias("g"), F.coalesce(h % 10 == 0, F.lit(False)).alias("chosen"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    split = chosen.withColumn("words", F.when(F.col("chosen"), words))
    n = F.size("words")
    first = (F.col("g") % n).cast("int")
    period = (1 + F.floor((n - first) / (3 + F.col("g") % 8))).cast("int")
    # the stretch, repeated until it is long enough: no expression that is worked out anew for each word
    again = F.flatten(F.array_repeat(F.slice("words", first + 1, period), F.ceil((n - first) / period).cast("int")))
    repeated = F.concat(F.slice("words", F.lit(1), first), F.slice(again, F.lit(1), n - first))
    return split.select("doc_id", F.when(F.col("chosen") & (n > 0), F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(with_copies(table(spark, sf_dir, "documents")), least=24, exponent=3)
    # runs come by start and period, so a later one must be truly greater
    greatest = F.aggregate(
        "runs", F.get("runs", F.lit(0)),
        lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best),
    )
    listed = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.array_join(F.transform(listed, lambda x: F.concat(x, F.lit("\n"))), "")
    return found.withColumn("best", greatest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best")["start"].alias("start"),
        F.col("best")["length"].alias("length"), F.col("best")["period"].alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


URL_RULES = [
    url_filter.Rule("allow", "com", "/"), url_filter.Rule("block", "example.com", "/en/"),
    url_filter.Rule("allow", "www.example.com", "/en/"), url_filter.Rule("block", "net", "/es/"),
    url_filter.Rule("block", "net", "/fr/"),
]


def op12_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.judge(pages, URL_RULES, url_filter.fit(pages, URL_RULES)).select(
        "page_id", "host", "path", "rule", "verdict", "score"
    )


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lowered = merkle.leaf(text=F.translate("text", url_filter.UPPER, url_filter.LOWER))
    tampered = F.when(fold_is("doc_id", 5, 0), lowered)
    found = merkle.manifest(table(spark, sf_dir, "documents"), {"tampered": tampered})
    folded = merkle.fold(F.coalesce("tampered", "leaf"), F.col("path"))
    return found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(merkle.proof(F.col("path")).cast("binary"), 256).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def all_queries() -> dict[str, Query]:
    return {name: query for name, query in globals().items() if name.startswith("op") and callable(query)}
