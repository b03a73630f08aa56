"""Duplicate audit and removal for keyed rows such as door numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from addrspark.functions.text import joined_name
from addrspark.operators.skew import null_safe_join

DOOR_KEY = ["id_via", "numpuerta"]
DOOR_COLUMNS = ["id_via", "numpuerta", "tipo_via", "nom_via", "ubigeo", "lon_x", "lat_y"]

# Bounds of a heavy key's buckets are looked up in groups of this size.
BOUND_GROUP = 64
# Copies of one identical row are written out in runs of this length.
COPY_RUN = 100_000


def _nulls_first(columns: list[str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in columns]


def _others(df: DataFrame, keys: list[str]) -> list[str]:
    return [c for c in df.columns if c not in keys]


def distinct_count(df: DataFrame, column: str, alias: str, approximate: bool = False) -> DataFrame:
    """One row with the number of distinct non-null values."""
    count = F.approx_count_distinct(column) if approximate else F.count_distinct(F.col(column))
    return df.agg(count.alias(alias))


def duplicate_keys(df: DataFrame, keys: list[str] = DOOR_KEY) -> DataFrame:
    """Keys held by more than one row, with the row count. Null keys form a group of their own."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).filter(F.col("count") > 1)


def duplicate_rows(
    df: DataFrame, keys: list[str] = DOOR_KEY, null_safe: bool = False, sort: bool = False
) -> DataFrame:
    """Rows whose key occurs more than once.

    Rows with a null key are left out unless ``null_safe``. The duplicate keys come from a map-side
    combined count; a hot key then is one row on the small side of a semi join, and adaptive execution
    splits its rows on the other side. ``sort`` orders the result by key and then by the other columns.
    """
    repeated = duplicate_keys(df if null_safe else df.dropna(subset=keys), keys).select(*keys)
    if null_safe:
        rows = null_safe_join(df, repeated, keys, "left_semi")
    else:
        rows = df.join(repeated, keys, "left_semi").select(*df.columns)
    return rows.orderBy(*_nulls_first([*keys, *_others(df, keys)])) if sort else rows


def split_duplicates(
    df: DataFrame, keys: list[str] = DOOR_KEY, heavy_rows: int = 1_000_000
) -> DataFrame:
    """Number the rows of every repeated key from 1 in ``dup_group``; row i belongs to output i.

    Numbers follow column order, null first, whatever the key's size. Ordinary keys are numbered by a
    window, keys with more than ``heavy_rows`` rows bucket by bucket in ``_number_heavy``. Keys are counted
    first, so only rows of repeated keys are ordered.
    """
    rows = df.dropna(subset=keys)
    repeated = duplicate_keys(rows, keys)
    heavy = repeated.filter(F.col("count") > heavy_rows)
    few = repeated.filter(F.col("count") <= heavy_rows).select(*keys)
    in_order = Window.partitionBy(*keys).orderBy(*_nulls_first(_others(df, keys)))
    ordinary = rows.join(few, keys, "left_semi").withColumn("dup_group", F.row_number().over(in_order).cast("bigint"))
    return ordinary.select(*df.columns, "dup_group").unionByName(_number_heavy(rows, keys, heavy, heavy_rows))


def _number_heavy(rows: DataFrame, keys: list[str], heavy: DataFrame, heavy_rows: int) -> DataFrame:
    """Numbers 1..n for the rows of each heavy key without ever sorting the key in one task.

    Identical rows collapse map-side to (row, copies). The distinct rows fall into range buckets in column
    order; bounds are the rows whose hash is 0 modulo ``heavy_rows``, so a bucket has about that many rows
    and the bounds depend on the data only. Bucket totals give the offsets. Copies are written out at the
    end in runs that spread over tasks.
    """
    others = _others(rows, keys)
    run = min(COPY_RUN, heavy_rows)
    copies = (
        rows.join(heavy.select(*keys), keys, "left_semi")
        .groupBy(*rows.columns)
        .agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("place", F.struct(*others))
    )
    chosen = copies.filter(F.pmod(F.xxhash64(*others), F.lit(heavy_rows)) == 0)
    bounds = chosen.groupBy(*keys).agg(F.sort_array(F.collect_list("place")).alias("bounds"))
    bounds = bounds.withColumn("coarse", F.filter("bounds", lambda b, i: F.pmod(i + 1, F.lit(BOUND_GROUP)) == 0))

    def upto_place(places: Column) -> Column:
        return F.size(F.filter(places, lambda b: b <= F.col("place")))

    known = copies.join(bounds, keys, "left").withColumn("group", upto_place(F.coalesce("coarse", F.array())))
    near = F.slice("bounds", F.col("group") * BOUND_GROUP + 1, F.lit(BOUND_GROUP))
    bucket = F.col("group") * BOUND_GROUP + F.coalesce(F.when(F.col("bounds").isNotNull(), upto_place(near)), F.lit(0))
    placed = known.withColumn("bucket", bucket).drop("bounds", "coarse", "group", "place")
    totals = placed.groupBy(*keys, "bucket").agg(F.sum("copies").alias("bucket_rows"))
    before = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys, "bucket", F.coalesce(F.sum("bucket_rows").over(before), F.lit(0)).alias("offset")
    )
    upto = (
        Window.partitionBy(*keys, "bucket")
        .orderBy(*_nulls_first(others))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    spans = (
        placed.withColumn("end", F.sum("copies").over(upto))
        .join(offsets, [*keys, "bucket"])
        .withColumn("first", F.col("offset") + F.col("end") - F.col("copies") + 1)
        .select(*rows.columns, "first", "copies")
    )
    runs = spans.withColumn(
        "run", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("copies") - 1) / F.lit(run))))
    ).repartition(*keys, "first", "run")
    start = F.col("first") + F.col("run") * run
    stop = F.least(start + run - 1, F.col("first") + F.col("copies") - 1)
    return runs.select(*rows.columns, F.explode(F.sequence(start, stop)).alias("dup_group"))


def unique_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key; null keys count as equal. The smallest row in column order is kept.

    Spark limits each map task to its best row per key before the shuffle, so a hot key shrinks to one
    row per task.
    """
    pick = Window.partitionBy(*keys).orderBy(*_nulls_first(_others(df, keys)))
    return (
        df.withColumn("pick", F.row_number().over(pick)).filter(F.col("pick") == 1).drop("pick")
    )


def last_wins(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row per key: the one with the highest ``order``, other columns breaking ties."""
    rest = [c for c in df.columns if c not in (*keys, order)]
    pick = Window.partitionBy(*keys).orderBy(F.col(order).desc_nulls_last(), *_nulls_first(rest))
    return (
        df.withColumn("pick", F.row_number().over(pick)).filter(F.col("pick") == 1).drop("pick")
    )


def door_rows(doors: DataFrame) -> DataFrame:
    """Doors renamed to document terms: id_via, numpuerta, name, postcode, lon, lat."""
    return doors.select(
        "id_via",
        "numpuerta",
        joined_name(F.col("tipo_via"), F.col("nom_via")).alias("name"),
        F.col("ubigeo").alias("postcode"),
        F.col("lon_x").alias("lon"),
        F.col("lat_y").alias("lat"),
    )


def unique_doors(doors: DataFrame) -> DataFrame:
    """One row per (street, door number)."""
    return unique_rows(door_rows(doors), DOOR_KEY).select(
        "id_via", "name", "postcode", "numpuerta", "lon", "lat"
    )


def duplicates_among_unique(doors: DataFrame) -> DataFrame:
    """Data-quality check: must be empty."""
    return duplicate_rows(unique_doors(doors), DOOR_KEY)
