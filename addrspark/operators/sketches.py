"""Distinct counts that can be merged: one small sketch per group, stored instead of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A sketch of 2**LOG_SIZE registers.
LOG_SIZE = 12


def distinct_sketches(rows: DataFrame, keys: list[str], value: str, log_size: int = LOG_SIZE) -> DataFrame:
    """One row per group of ``keys`` with ``sketch``, of the distinct non-null values of ``value`` in it.

    Values are whole numbers, texts or bytes. Sketches are combined before the shuffle.
    """
    return rows.groupBy(*keys).agg(F.hll_sketch_agg(value, log_size).alias("sketch"))


def merged_sketches(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches merged to the coarser groups of ``keys``, without the rows they were made of."""
    return sketches.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"))


def estimated(sketches: DataFrame, alias: str = "estimate") -> DataFrame:
    """Sketches replaced by the estimated number of distinct values."""
    return sketches.withColumn(alias, F.hll_sketch_estimate("sketch")).drop("sketch")


def relative_error(log_size: int = LOG_SIZE) -> float:
    """Three standard errors of an estimate, as a share of the true number."""
    return 3 * 1.04 / (1 << log_size) ** 0.5
