"""Written tables and joins shared by the text operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from addrspark.session import shared_folder


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a frame that is read more than once as Parquet in the shared folder and read it again.

    The table survives lost executors, so retried tasks see the same rows. It stays in the folder until
    that is emptied, since the caller's lazy result still reads it.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/addrspark-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """(line, row): every row as a struct under a number of its own, written so that numbers stay.

    Fields of ``row`` are named ``in_0``, ``in_1``, ... so that columns may have any name.
    """
    fields = [F.col(f"`{c}`").alias(f"in_{i}") for i, c in enumerate(docs.columns)]
    return written(docs.select(F.monotonically_increasing_id().alias("line"), F.struct(*fields).alias("row")), name)


def restored(rows: DataFrame, columns: list[str]) -> list:
    """The columns of a frame that ``numbered`` has packed."""
    return [rows["row"].getField(f"in_{i}").alias(c) for i, c in enumerate(columns)]


def with_common(left: DataFrame, right: DataFrame, on: list[str], times: str, share: int = 1000) -> DataFrame:
    """Inner join of ``left`` with ``right``, where column ``times`` of ``right`` counts the rows of ``left`` with its key.

    Keys on more than one in ``share`` rows, of which there are fewer than ``share``, are broadcast, with the
    rows of ``right`` that they have; all others are joined by a shuffle. Both sides are read twice and should
    be written tables. ``times`` is dropped.
    """
    total = right.select(*on, times).distinct().agg(F.sum(times)).first()[0] or 0
    heavy = F.col(times) * share > total
    common = right.filter(heavy).drop(times)
    keys = F.broadcast(common.select(*on).distinct())
    rest = left.join(keys, on, "left_anti").join(right.filter(~heavy).drop(times), on)
    return left.join(F.broadcast(common), on).unionByName(rest)
