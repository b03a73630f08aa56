"""Evaluate costly columns once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evaluate_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that later filters will test.

    A filter on an ordinary column is pushed below it and evaluates the column's expression a second
    time. Columns that come out of a (one-row) generator stop the filter above it.
    """
    made = F.struct(*[col.alias(name) for name, col in columns.items()])
    return df.select("*", F.inline(F.array(made)))
