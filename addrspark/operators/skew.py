"""Helpers that keep one very frequent key from ending up in one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on keys where null equals null; the right side's keys are not kept."""
    twin = {k: f"right_{k}" for k in keys}
    matched = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(t)) for k, t in twin.items()])
    return left.join(right.withColumnsRenamed(twin), matched, how).drop(*twin.values())


def heavy_keys(df: DataFrame, keys: list[str], more_than: int) -> DataFrame:
    """Keys with over ``more_than`` rows, and their count.

    Counting combines map-side, so a hot key costs one partial row per task. There are at most rows /
    ``more_than`` such keys; how to join them is left to adaptive execution.
    """
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("key_rows")).filter(F.col("key_rows") > more_than)
