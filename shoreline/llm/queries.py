"""Queries of the operators over the test tables, and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoreline.llm import (
    decontamination,
    importance,
    infill,
    jaccard,
    language,
    licences,
    mixing,
    oracles,
    passages,
    personal,
    quality,
    sharding,
    token_counts,
    urls,
)
from shoreline.llm.text import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


@query
def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judged(table(spark, folder, "documents").select("doc_id", "text")).drop("text")


@query
def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


@query
def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed_counts(table(spark, folder, "documents"))


@query
def op10_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judged(table(spark, folder, "pages").select("page_id", "url")).drop("url")


@query
def op1_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.linked_components(table(spark, folder, "documents"), n=3, num=90, den=100)


@query
def op1_ngram_jaccard_links(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.link_counts(table(spark, folder, "documents"), n=3, num=90, den=100)


@query
def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licences.licences(table(spark, folder, "documents"))


@query
def op3_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = passages.without_repeats(table(spark, folder, "documents"))
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return kept.select("doc_id", "n_words", "n_removed", digest.alias("kept_sha256"))


@query
def op4_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_rows(table(spark, folder, "documents"))


@query
def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(table(spark, folder, "documents"))


@query
def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.by_limit(token_counts.histogram(table(spark, folder, "documents")))


@query
def op11_pii(spark: SparkSession, folder: str) -> DataFrame:
    return personal.digests(personal.spans(table(spark, folder, "documents").select("doc_id", "text"), keep=["doc_id"]))


@query
def op12_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    found = importance.scored(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


@query
def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    out = infill.infilled(table(spark, folder, "documents").select("doc_id", "text"))
    back = infill.restored(F.col("output"), F.col("form"))
    return out.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(back.cast("binary"), 256).alias("restored_sha256"),
    )


ORACLES.update({
    "op12_importance_resampling": oracles.IMPORTANCE,
    "op13_fill_in_middle": oracles.FILL_IN_MIDDLE,
    "op1_ngram_jaccard_join": oracles.NGRAM_JOIN,
    "op1_ngram_jaccard_links": oracles.NGRAM_LINKS,
    "op2_license_scan": oracles.LICENSES,
    "op3_substring_dedup": oracles.SUBSTRING_DEDUP,
    "op6_quality_rules": oracles.QUALITY,
    "op7_decontamination": oracles.DECONTAMINATION,
    "op8_mixing": oracles.MIXING,
})
