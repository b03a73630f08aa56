"""Readers with explicit schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from addrspark.functions.once import evaluate_once
from addrspark.functions.wkb import decode_shapes
from addrspark.operators.checks import pick_column, require_columns
from addrspark.schemas import DISTRICT_SHEET

_BROKEN = "broken_line"
_STRICT = {"mode": "PERMISSIVE", "allowSingleQuotes": "false"}


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


# Rows of heavy work a task gets; splits are cut by bytes and may hold millions of narrow rows.
ROWS_PER_TASK = 100_000


def tasks_for(df: DataFrame, rows_each: int = ROWS_PER_TASK) -> int:
    """Tasks that keep every core busy and get no more than about ``rows_each`` rows of a frame straight from a scan.

    Parquet counts its rows in the footers, so no column is read.
    """
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows_each))


def spread(df: DataFrame) -> DataFrame:
    """Give every core rows, and no task many more than ROWS_PER_TASK, when there are too few splits for that.

    For work that is heavy per row, on frames straight from a scan (counting the partitions and rows of others
    would run their shuffles). Inputs with enough splits pass unchanged, without a shuffle.
    """
    tasks = tasks_for(df)
    return df.repartition(tasks) if df.rdd.getNumPartitions() < tasks else df


def read_ndjson(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows, bad lines). A bad line is kept with the reason and does not stop the rest."""
    return parse_ndjson(spark.read.text(path), "value", schema)


def parse_ndjson(lines: DataFrame, column: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Like ``read_ndjson`` for lines already in a column; other columns are kept."""
    others = [c for c in lines.columns if c != column]
    parsed = marked_ndjson(lines, column, schema)
    good = F.col("reason").isNull()
    return (
        parsed.filter(good).select(*others, *[F.col("row").getField(f.name).alias(f.name) for f in schema.fields]),
        parsed.filter(~good).select(*others, F.col(column).alias("line"), "reason"),
    )


def marked_ndjson(lines: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    """``lines`` with the parsed ``row`` and the ``reason`` why a line is bad, null for a good one.

    Works on streams too, where good and bad lines must come out of one pass.
    """
    wide = T.StructType([*schema.fields, T.StructField(_BROKEN, T.StringType(), True)])
    options = {**_STRICT, "columnNameOfCorruptRecord": _BROKEN}
    line = F.col(column)
    parsed = evaluate_once(lines, {"row": F.from_json(line, wide, options), "whole": _is_json(line)})
    good = F.col("whole") & F.col(f"row.{_BROKEN}").isNull()
    reason = F.when(good, F.lit(None)).when(F.col("whole"), F.lit("wrong type")).otherwise(F.lit("invalid JSON"))
    return parsed.withColumn("reason", reason).drop("whole")


def _is_json(line: Column) -> Column:
    """One complete JSON value and nothing after it.

    Spark's parser stops after the first value. As first item of a list whose second item is a digest of
    the line, the line must end where its value ends for the digest to be found.
    """
    digest = F.md5(line)
    pair = F.from_json(F.concat(F.lit("["), line, F.lit(',"'), digest, F.lit('"]')), "array<string>", _STRICT)
    return F.coalesce(F.get(pair, F.lit(1)) == digest, F.lit(False))


def read_delimited(
    spark: SparkSession, path: str, schema: T.StructType, separator: str = ";"
) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of text with a header line; columns are found by name, others are left out.

    Rejects keep their texts and say which values do not fit their type.
    """
    lines = spark.read.option("sep", separator).option("header", True).option("inferSchema", False).csv(path)
    return typed_columns(lines, schema)


def typed_columns(lines: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of a frame of texts whose columns are named like the schema's."""
    require_columns(lines, *schema.names)
    texts = lines.select(*[F.col(f"`{n}`") for n in schema.names])
    values = F.struct(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields])
    misfit = [
        F.when(F.col(f"`{f.name}`").isNotNull() & F.col("typed_values").getField(f.name).isNull(), F.lit(f.name))
        for f in schema.fields
    ]
    typed = evaluate_once(texts, {"typed_values": values}).withColumn("misfits", F.concat_ws(",", *misfit))
    reason = F.concat(F.lit("does not fit: "), F.col("misfits"))
    return (
        typed.filter(F.col("misfits") == "").select("typed_values.*"),
        typed.filter(F.col("misfits") != "").withColumn("reason", reason).drop("typed_values", "misfits"),
    )


def read_district_sheet(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return read_delimited(spark, path, DISTRICT_SHEET)


def read_any(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects), the reader chosen by file extension. Parquet is typed already and has no rejects."""
    if path.endswith((".ndjson", ".json")):
        return read_ndjson(spark, path, schema)
    if path.endswith(".parquet"):
        rows = spark.read.parquet(path)
        return rows, rows.limit(0).withColumn("reason", F.lit(""))
    if path.endswith(".csv"):
        return read_delimited(spark, path, schema)
    raise ValueError(f"unsupported file type: {path!r} is not .ndjson, .json, .parquet or .csv")


def read_shapes(spark: SparkSession, path: str, geometry: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows with the shape column decoded, rows with invalid bytes).

    The column is ``geometry`` or ``geom`` unless named.
    """
    df = spark.read.parquet(path)
    return decode_shapes(spread(df), pick_column(df, *([geometry] if geometry else ["geometry", "geom"])))


def register(df: DataFrame, name: str, reused: bool = False) -> DataFrame:
    """Make the frame available to SQL; persist it when more than one query reads it."""
    kept = df.persist() if reused else df
    kept.createOrReplaceTempView(name)
    return kept
