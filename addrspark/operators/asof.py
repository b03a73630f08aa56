"""As-of joins: every row with the newest row of its key that is not later."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from addrspark.operators.checks import require_columns

BUCKET_SECONDS = 30 * 86_400
HEAVY_ROWS = 1_000_000


def _micros(df: DataFrame, column: str) -> Column:
    """Times as microseconds, numbers as they are: something that orders and divides."""
    kind = df.schema[column].dataType.typeName()
    if kind in ("date", "timestamp", "timestamp_ntz"):
        return F.unix_micros(F.col(column).cast("timestamp"))
    return F.col(column).cast("bigint")


def as_of_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_time: str,
    right_time: str,
    bucket: int | None = None,
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Rows of ``left`` with the columns of the newest row of ``right`` of their key that is not later.

    Rows without such a row, with a null key or a null time keep nulls. Of several rows of ``right`` with one
    key and time the largest in column order counts. Columns besides the keys must have different names. Times
    are dates, timestamps or whole numbers; ``bucket`` is a width in seconds, or in units for numbers.

    Both sides are merged by time and the last row of ``right`` is carried on, bucket of time by bucket. What a
    bucket starts with comes from the last rows of the buckets before it, a row per key and bucket. So a key's
    rows meet in pieces, and no times are compared by a range join. A bucket with more than ``heavy_rows`` rows of ``left``
    is cut by hash, and its rows of ``right`` repeated for each cut; there is at most one such bucket for
    ``heavy_rows`` rows, so their list is broadcast.
    """
    require_columns(left, *keys, left_time)
    require_columns(right, *keys, right_time)
    added = [c for c in right.columns if c not in keys]
    clash = sorted(set(added) & set(left.columns))
    if clash:
        raise ValueError(f"both sides have columns {clash}")
    times = left.schema[left_time].dataType.typeName() in ("date", "timestamp", "timestamp_ntz")
    width = (bucket or BUCKET_SECONDS) * (1_000_000 if times else 1)
    names = [f"asof_key_{i}" for i in range(len(keys))]

    def tagged(df: DataFrame, time: str, columns: list[str], alias: str) -> DataFrame:
        return df.select(
            *[F.col(f"`{k}`").alias(n) for k, n in zip(keys, names, strict=True)],
            _micros(df, time).alias("at"),
            F.floor(_micros(df, time) / F.lit(width)).alias("bucket"),
            F.struct(*[F.col(f"`{c}`") for c in columns]).alias(alias),
        )

    asked = tagged(left, left_time, left.columns, "row")
    known = tagged(right, right_time, added, "found").dropna(subset=[*names, "at"])
    timed = asked.dropna(subset=[*names, "at"])

    newest = known.groupBy(*names, "bucket").agg(F.max(F.struct("at", "found")).alias("newest"))
    counts = timed.groupBy(*names, "bucket").agg(F.count(F.lit(1)).alias("n"))
    in_order = Window.partitionBy(*names).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = newest.join(counts, [*names, "bucket"], "full")
    carried = buckets.withColumn("start", F.last("newest", ignorenulls=True).over(in_order))
    carried = carried.filter(F.col("n").isNotNull() & F.col("start").isNotNull())
    carried = carried.select(*names, F.col("start.at").alias("at"), "bucket", F.col("start.found").alias("found"))

    crowded = F.broadcast(counts.filter(F.col("n") > heavy_rows).withColumn("cuts", F.ceil(F.col("n") / F.lit(heavy_rows))).drop("n"))
    cuts = F.coalesce("cuts", F.lit(1))
    spread = timed.join(crowded, [*names, "bucket"], "left")
    spread = spread.withColumn("cut", F.pmod(F.xxhash64("at", "row"), cuts)).drop("cuts")
    offered = known.unionByName(carried).join(crowded, [*names, "bucket"], "left")
    offered = offered.withColumn("cut", F.explode(F.sequence(F.lit(0).cast("bigint"), cuts - 1))).drop("cuts")

    merged = spread.withColumn("found", F.lit(None).cast(offered.schema["found"].dataType)).unionByName(
        offered.withColumn("row", F.lit(None).cast(asked.schema["row"].dataType))
    )
    # At one time rows of the right side come first, the largest of them last.
    upto = Window.partitionBy(*names, "bucket", "cut").orderBy("at", F.col("row").isNotNull(), "found")
    upto = upto.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = merged.withColumn("found", F.last("found", ignorenulls=True).over(upto)).filter(F.col("row").isNotNull())
    met = met.select("row", "found")
    unmatched = asked.filter(F.greatest(*[F.col(n).isNull() for n in [*names, "at"]]))
    both = met.unionByName(unmatched.select("row", F.lit(None).cast(met.schema["found"].dataType).alias("found")))
    return both.select("row.*", *[F.col("found").getField(c).alias(c) for c in added])
