"""Column presence, row limits and outcome counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def require_columns(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; found {df.columns}")


def pick_column(df: DataFrame, *candidates: str) -> str:
    """The first candidate the frame has."""
    for name in candidates:
        if name in df.columns:
            return name
    raise ValueError(f"none of {list(candidates)} in {df.columns}")


def text_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*map(str, df.columns))


def capped(df: DataFrame, rows: int | None) -> DataFrame:
    """The optional input cap of the audit jobs. Off by default: a limit funnels through one task."""
    return df if rows is None else df.limit(rows)


def outcome_counts(good: DataFrame, rejects: DataFrame) -> DataFrame:
    """One row with the number of accepted and rejected rows."""
    marked = good.select(F.lit(1).alias("ok")).unionByName(rejects.select(F.lit(0).alias("ok")))
    return marked.agg(
        F.coalesce(F.sum("ok"), F.lit(0)).cast("bigint").alias("succeeded"),
        F.count_if(F.col("ok") == 0).alias("failed"),
    )


def require_empty(rejects: DataFrame, what: str) -> None:
    """The strict mode of any step that returns rejects: raise when there is one, showing it."""
    found = rejects.head(1)
    if found:
        raise ValueError(f"{what}: {found[0].asDict()}")
