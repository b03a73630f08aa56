"""Sessions and trailing counts over times, with every key cut by time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from addrspark.operators.asof import _micros
from addrspark.operators.checks import require_columns

CHUNK_SECONDS = 86_400


def sessions(rows: DataFrame, keys: list[str], time: str, gap_seconds: int, chunk_seconds: int = CHUNK_SECONDS) -> DataFrame:
    """Per key and session: keys, session_start, session_end, n rows. A session ends where more than the gap passes.

    Null keys form a key of their own; rows with a null time belong to no session. Rows at one time are in
    one session.

    A key is worked on in chunks of time. Inside a chunk a window finds the sessions; the first of a chunk goes
    on from the last one before it if they are near enough, which another window finds that sees a row
    per session and chunk.
    """
    require_columns(rows, *keys, time)
    gap = gap_seconds * 1_000_000
    chunk = F.floor(F.col("at") / F.lit(chunk_seconds * 1_000_000))
    timed = rows.select(*keys, _micros(rows, time).alias("at")).filter(F.col("at").isNotNull()).withColumn("chunk", chunk)
    # Rows of one time are one row, which bounds what one moment of a hot key holds.
    timed = timed.groupBy(*keys, "chunk", "at").agg(F.count(F.lit(1)).alias("n"))
    in_chunk = Window.partitionBy(*keys, "chunk").orderBy("at")
    begins = F.coalesce(F.col("at") - F.lag("at").over(in_chunk) > gap, F.lit(True))
    marked = timed.withColumn("begins", begins.cast("int"))
    numbered = marked.withColumn("number", F.sum("begins").over(in_chunk.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    parts = numbered.groupBy(*keys, "chunk", "number").agg(F.min("at").alias("low"), F.max("at").alias("high"), F.sum("n").alias("n"))
    in_order = Window.partitionBy(*keys).orderBy("low")
    begins = F.coalesce(F.col("low") - F.lag("high").over(in_order) > gap, F.lit(True)).cast("int")
    joined = parts.withColumn("begins", begins)
    joined = joined.withColumn("session", F.sum("begins").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    whole = joined.groupBy(*keys, "session").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"))
    return whole.select(*keys, F.timestamp_micros("low").alias("session_start"), F.timestamp_micros("high").alias("session_end"), "n")


def trailing_counts(rows: DataFrame, keys: list[str], time: str, seconds: int, alias: str = "n") -> DataFrame:
    """Every row with the number of rows of its key from ``seconds`` before its time up to its time, itself included.

    Null keys form a key of their own; rows with a null time get a null count.

    A key is cut into chunks as long as the frame, and a chunk sees the times of the one before it as well.
    Rows of one time enter as one row with their number, so what a window holds is bounded by distinct times.
    """
    require_columns(rows, *keys, time)
    width = seconds * 1_000_000
    timed = rows.withColumns({"frame_at": _micros(rows, time)})
    timed = timed.withColumn("frame_chunk", F.floor(F.col("frame_at") / F.lit(width)))
    names = [f"frame_key_{i}" for i in range(len(keys))]
    named = timed.select("*", *[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)])
    times = named.filter(F.col("frame_at").isNotNull()).groupBy(*names, "frame_chunk", "frame_at").agg(F.count(F.lit(1)).alias("times"))
    seen = times.withColumn("own", F.lit(True)).unionByName(
        times.withColumn("frame_chunk", F.col("frame_chunk") + 1).withColumn("own", F.lit(False))
    )
    frame = Window.partitionBy(*names, "frame_chunk").orderBy("frame_at").rangeBetween(-width, Window.currentRow)
    counted = seen.withColumn(alias, F.sum("times").over(frame)).filter("own").select(*names, "frame_at", alias)
    condition = F.col("l.frame_at") == F.col("r.frame_at")
    for n in names:
        condition = condition & F.col(f"l.{n}").eqNullSafe(F.col(f"r.{n}"))
    met = named.alias("l").join(counted.alias("r"), condition, "left")
    return met.select(*[F.col(f"l.`{c}`") for c in rows.columns], F.col(f"r.{alias}"))
