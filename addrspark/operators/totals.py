"""Totals over several groupings at once, with exact distinct counts."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from addrspark.operators.checks import require_columns


def rollup_sets(columns: list[str]) -> list[list[str]]:
    """All columns, all but the last, and so on to none."""
    return [columns[:k] for k in range(len(columns), -1, -1)]


def cube_sets(columns: list[str]) -> list[list[str]]:
    """Every choice of the columns."""
    return [list(c) for k in range(len(columns), -1, -1) for c in combinations(columns, k)]


# Copies of a group and value that are counted apart at first, so that no task gets all of them.
SALTS = 8
# Rows that a task of the shuffles gets where their number is known; each is copied for every set.
ROWS_PER_TASK = 200_000


def totals(
    rows: DataFrame, columns: list[str], sets: list[list[str]], distinct: str, count: str = "n", distinct_count: str = "n_distinct", tasks: int | None = None
) -> DataFrame:
    """Per grouping set and group: the columns, ``grouping_id``, ``count`` rows and the distinct non-null values of ``distinct``.

    A column that the set leaves out is null, and its bit in ``grouping_id``, the first column's being the
    highest, tells this null from one in the data, as ``GROUPING_ID`` does. Without rows there is only the
    total of nothing, if the empty set is asked for.

    Rows are counted by all columns and the distinct value before they are copied for the sets, so sets multiply
    groups and not rows. The counts of a value then meet in one task, so that its copies are told apart where they are
    made, and only sums per set and group move after that. Both shuffles have ``tasks`` partitions, by default the
    session's number; about a task per ROWS_PER_TASK rows keeps the hash tables small, however many rows there are.
    """
    require_columns(rows, *columns, distinct)
    if any(c not in columns for s in sets for c in s):
        raise ValueError(f"sets name columns besides {columns}")
    tasks = tasks or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [f"by_{i}" for i in range(len(columns))]
    named = rows.select(
        *[F.col(f"`{c}`").alias(b) for c, b in zip(columns, by, strict=True)], F.col(f"`{distinct}`").alias("value"),
        (F.spark_partition_id() % SALTS).alias("salt"),
    )
    fine = named.repartition(tasks, *by, "value", "salt").groupBy(*by, "value", "salt").agg(F.count(F.lit(1)).alias("n"))
    kinds = [fine.schema[b].dataType for b in by]

    def grouped(chosen: list[str]):
        mask = sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in chosen)
        kept = [F.col(f"by_{i}") if c in chosen else F.lit(None).cast(kinds[i]) for i, c in enumerate(columns)]
        return F.struct(F.lit(mask).cast("bigint").alias("grouping_id"), *[k.alias(f"to_{i}") for i, k in enumerate(kept)])

    copied = fine.repartition(tasks, "value").select("value", "n", F.inline(F.array(*[grouped(s) for s in sets])))
    keys = ["grouping_id", *[f"to_{i}" for i in range(len(columns))]]
    by_value = copied.groupBy(*keys, "value").agg(F.sum("n").alias("n"))
    if [] in sets:
        # Of no rows the total is still a row.
        nothing = rows.sparkSession.range(0, 1, 1, 1).select(
            F.lit((1 << len(columns)) - 1).cast("bigint").alias("grouping_id"),
            *[F.lit(None).cast(k).alias(f"to_{i}") for i, k in enumerate(kinds)],
            F.lit(None).cast(fine.schema["value"].dataType).alias("value"), F.lit(0).cast("bigint").alias("n"),
        )
        by_value = by_value.unionByName(nothing)
    counted = by_value.groupBy(*keys).agg(F.sum("n").alias("n"), F.count("value").alias("values"))
    return counted.select(
        *[F.col(f"to_{i}").alias(c) for i, c in enumerate(columns)], "grouping_id",
        F.col("n").alias(count), F.col("values").alias(distinct_count),
    )
