"""From documents to sharded training text: the stages, each over all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from addrspark.llm import decontaminate, hash_tree, mixing, near_join, quality
from addrspark.llm.shared import numbered, restored, written


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that probably have the top grade: neither toxic nor of low quality."""
    return quality.good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of similar texts: the one with the smallest doc_id, null last.

    Rows are told apart by a number of their own, so a doc_id on several rows or none at all loses nothing:
    every class keeps exactly one row, and a text that resembles no other keeps its own. Of rows equal in doc_id
    one stays by that number.
    """
    lines = numbered(docs, "lines")
    field = {c: F.col("row").getField(f"in_{docs.columns.index(c)}").alias(c) for c in ("doc_id", "text")}
    similar = near_join.similar_texts(lines.select("line", field["text"]), id_col="line").select("line", "class_id")
    named = similar.join(lines.select("line", field["doc_id"]), "line")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "line"))
    kept = named.groupBy("class_id").agg(first.alias("first")).select("first.line")
    rows = lines.join(kept, "line", "left_semi")
    return rows.select(*restored(rows, docs.columns))


def drop_benchmark_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mixture takes: a row per document, epoch and output shard of the mixture."""
    return mixing.mixed_texts(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its text, its shard and its slot there; (shard, slot) names a row, whatever its doc_id."""
    lines = numbered(docs, "lines")
    field = {c: F.col("row").getField(f"in_{docs.columns.index(c)}").alias(c) for c in ("doc_id", "text", "lang", "source")}
    placed = hash_tree.assign_shards(lines.select("line", field["doc_id"], field["text"]), carry="line")
    return placed.join(lines.select("line", field["text"], field["lang"], field["source"]), "line").drop("line")


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_benchmark_text),
    ("mixing sources to target weights", mix),
    ("sharding", shard),
]

# The quality model is fitted, which SQL cannot express; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table, each result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
