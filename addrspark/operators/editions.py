"""Differences between two editions of a table, copies counted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from addrspark.operators.checks import require_columns
from addrspark.operators.dedup import COPY_RUN

# How many copies of a row each set operation keeps of n_old and n_new.
OPERATIONS = {
    "except": "greatest(n_old - n_new, 0)",
    "added": "greatest(n_new - n_old, 0)",
    "intersect": "least(n_old, n_new)",
    "union": "n_old + n_new",
}


def counted_editions(old: DataFrame, new: DataFrame) -> DataFrame:
    """Distinct rows of both editions with ``n_old`` and ``n_new``, their copies in each; nulls are equal.

    Columns are matched by name. Both editions pass one shuffle together, and copies are counted before it,
    so a row on a third of all lines is a few rows by then. Every set operation follows from the two counts.
    """
    require_columns(new, *old.columns)
    require_columns(old, *new.columns)
    tagged = old.select("*", F.lit(1).alias("in_old")).unionByName(new.select("*", F.lit(0).alias("in_old")))
    grouped = tagged.groupBy(*[F.col(f"`{c}`") for c in old.columns])
    return grouped.agg(F.count_if(F.col("in_old") == 1).alias("n_old"), F.count_if(F.col("in_old") == 0).alias("n_new"))


def repeated(counted: DataFrame, times: Column, run: int = COPY_RUN) -> DataFrame:
    """Every row as often as ``times`` says, without the counts.

    Many copies of one row are written out by several tasks, in runs of ``run``.
    """
    columns = [c for c in counted.columns if c not in ("n_old", "n_new")]
    some = counted.withColumn("copies", times).filter(F.col("copies") > 0)
    runs = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("copies") - 1) / F.lit(run))))
    cut = some.withColumn("copy_run", runs)
    long = F.col("copies") > run
    spread = cut.filter(long).repartition(*[F.col(f"`{c}`") for c in columns], "copy_run").unionByName(cut.filter(~long))
    left = F.least(F.col("copies") - F.col("copy_run") * run, F.lit(run))
    return spread.select(*[F.col(f"`{c}`") for c in columns], F.explode(F.array_repeat(F.lit(0), left.cast("int"))).alias("copy")).drop("copy")


def edition_rows(old: DataFrame, new: DataFrame, operation: str) -> DataFrame:
    """``old`` and ``new`` under a set operation that counts copies: except, added, intersect or union."""
    if operation not in OPERATIONS:
        raise ValueError(f"{operation!r} is none of {sorted(OPERATIONS)}")
    return repeated(counted_editions(old, new), F.expr(OPERATIONS[operation]))


def edition_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Every row of either edition with ``change``: kept, removed or added; as often as it was."""
    counted = counted_editions(old, new)
    parts = {"kept": "intersect", "removed": "except", "added": "added"}
    each = F.array(*[F.struct(F.lit(k).alias("change"), F.expr(OPERATIONS[o]).cast("bigint").alias("change_n")) for k, o in parts.items()])
    # One row per kind of change first, so that the shuffle runs once for all three.
    kinds = counted.select("*", F.inline(each)).withColumn("n_old", F.col("change_n")).withColumn("n_new", F.lit(0)).drop("change_n")
    return repeated(kinds, F.col("n_old"))
