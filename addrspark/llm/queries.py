"""Registered queries: each operator with its production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from addrspark.llm import (
    conversation_trie,
    decontaminate,
    exact_dedup,
    hash_tree,
    host_reputation,
    license_scan,
    mixing,
    near_join,
    quality,
    quality_rules,
    spelling_variants,
    substring_dedup,
    token_counts,
)

# The rank file of a public tokenizer, under the same path on every machine.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_exact_dedup(spark, sf):
    return exact_dedup.exact_duplicates(table(spark, sf, "documents"))


@query
def op2_url_filters(spark, sf):
    pages = table(spark, sf, "pages")
    outcomes = host_reputation.page_outcomes(pages, table(spark, sf, "documents"), table(spark, sf, "labels"))
    judged = host_reputation.judge_urls(pages, outcomes)
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query
def op7_sharding(spark, sf):
    return hash_tree.assign_shards(table(spark, sf, "documents"))


@query
def op9_source_mixing(spark, sf):
    return mixing.mix_sources(table(spark, sf, "documents"))


@query
def op5_license_scan(spark, sf):
    return license_scan.scan_licenses(table(spark, sf, "documents")).drop("places")


@query
def op3_ngram_join(spark, sf):
    return near_join.similar_texts(table(spark, sf, "documents"))


@query
def op10_substring_dedup(spark, sf):
    return substring_dedup.remove_repeats(table(spark, sf, "documents")).drop("kept_text")


@query
def op8_decontamination(spark, sf):
    marked = decontaminate.mark_leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return marked.select(
        "row.doc_id",
        (F.size("items") > 0).alias("contaminated"),
        F.col("items.item").alias("item_ids"),
        F.coalesce(F.array_max("items.score"), F.lit(0.0)).alias("best_score"),
    )


@query
def op6_quality(spark, sf):
    rated = quality.grade_documents(table(spark, sf, "documents"), table(spark, sf, "labels"))
    keep = (F.col("p_grade_2") >= 0.5).alias("keep")
    return rated.select("row.doc_id", "expected_grade", "p_grade_1", "p_grade_2", keep)


@query
def op4_token_counts(spark, sf):
    return token_counts.count_tokens(table(spark, sf, "documents"), VOCABULARY)


@query
def op11_quality_rules(spark, sf):
    return quality_rules.rule_digest(table(spark, sf, "documents"))


@query
def op12_conversation_trie(spark, sf):
    return conversation_trie.conversation_trie(table(spark, sf, "conversations"), rebuild=True)


@query
def op13_spelling_variants(spark, sf):
    return spelling_variants.spelling_variants(table(spark, sf, "documents"))
