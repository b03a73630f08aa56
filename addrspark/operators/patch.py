"""Partial updates of documents by key."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from addrspark.operators.checks import require_columns
from addrspark.operators.dedup import last_wins
from addrspark.session import shared_folder


def one_patch_per_key(
    patches: DataFrame, keys: list[str], order: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(patches with a key of their own, patches whose key is repeated).

    With ``order`` the patch with its highest value wins, the column goes, and nothing is repeated.
    """
    if order:
        return last_wins(patches, keys, order).drop(order), patches.drop(order).limit(0)
    counted = patches.withColumn("key_patches", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    return (
        counted.filter(F.col("key_patches") == 1).drop("key_patches"),
        counted.filter(F.col("key_patches") > 1).drop("key_patches"),
    )


def patch_documents(
    documents: DataFrame,
    patches: DataFrame,
    key: str | list[str] = "id_via",
    strict: bool = False,
    order: str | None = None,
    known: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents with the patch's columns overwritten, patches of unknown keys, patches of repeated keys).

    ``key`` is a column or several of them, such as those of the document id. Every other column of
    ``patches`` overwrites the document's, also with null. Patches that share a key are not applied, unless
    ``order`` names a column whose highest value wins. ``known`` may name a cheaper frame with the
    documents' keys. ``strict`` raises when a key is unknown.
    """
    keys = [key] if isinstance(key, str) else list(key)
    fields = [c for c in patches.columns if c not in (*keys, order)]
    require_columns(documents, *keys, *fields)
    single, repeated = one_patch_per_key(patches, keys, order)
    renamed = single.withColumnsRenamed({f: f"new_{f}" for f in fields}).withColumn("patched", F.lit(True))
    joined = documents.join(renamed, keys, "left")
    updated = joined.select(
        *[
            F.when(F.col("patched"), F.col(f"new_{c}")).otherwise(F.col(c)).alias(c) if c in fields else F.col(c)
            for c in documents.columns
        ]
    )
    unknown = single.join((documents if known is None else known).select(*keys), keys, "left_anti")
    if strict:
        example = unknown.select(*keys).head(1)
        if example:
            raise LookupError(f"no document with {', '.join(keys)} = {', '.join(map(repr, example[0]))}")
    return updated, unknown, repeated


BUCKET = "key_bucket"


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def write_buckets(documents: DataFrame, path: str, key: str | list[str], buckets: int, mode: str = "errorifexists") -> None:
    """Documents in one folder per bucket of their key, for ``patch_buckets``.

    A bucket is what one patch rewrites, so there should be so many that a bucket is some hundred megabytes. The
    rebalance hint lets adaptive execution cut the files of a bucket that one key fills.
    """
    keys = [key] if isinstance(key, str) else list(key)
    require_columns(documents, *keys)
    placed = documents.withColumn(BUCKET, bucket_of(keys, buckets))
    placed.hint("rebalance", BUCKET).write.mode(mode).partitionBy(BUCKET).parquet(path)


def patch_buckets(
    spark: SparkSession,
    path: str,
    patches: DataFrame,
    key: str | list[str],
    buckets: int,
    strict: bool = False,
    order: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Patch the documents in ``path`` in place; returns (patches of unknown keys, patches of repeated keys).

    Patches mean what they mean to ``patch_documents``. Only buckets that a known key's patch falls into
    are read and rewritten, by dynamic partition overwrite: files of all others stay as they are, and
    should the job fail, so do these. ``buckets`` must be the number that the folder was written with.
    """
    keys = [key] if isinstance(key, str) else list(key)
    require_columns(patches, *keys)
    bounded = patches.withColumn(BUCKET, bucket_of(keys, buckets))
    # At most as many numbers as there are buckets.
    asked = [r[0] for r in bounded.select(BUCKET).distinct().collect()]
    stored = spark.read.parquet(path)
    documents = stored.filter(F.col(BUCKET).isin(asked))
    known = documents.select(*keys, BUCKET).join(patches.select(*keys).distinct(), keys, "left_semi")
    touched = [r[0] for r in known.select(BUCKET).distinct().collect()]
    rewritten = documents.filter(F.col(BUCKET).isin(touched))
    updated, unknown, repeated = patch_documents(rewritten, patches, keys, order=order, known=documents)
    # The reports are settled first, since the rewritten files are what they are told from.
    unknown, repeated = settled_rows(unknown), settled_rows(repeated)
    if strict and (example := unknown.head(1)):
        raise LookupError(f"no document with {', '.join(keys)} = {', '.join(repr(example[0][k]) for k in keys)}")
    if touched:
        writer = updated.hint("rebalance", BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(BUCKET).parquet(path)
    return unknown, repeated


def settled_rows(df: DataFrame) -> DataFrame:
    """The rows as they are now, written to the shared folder."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/addrspark-report-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
