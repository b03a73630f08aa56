"""Writers. All run in parallel; none brings rows to the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from addrspark.functions.wkb import encode_wkb
from addrspark.operators.skew import null_safe_join

CHUNK = 1000


def write_ndjson(df: DataFrame, path: str, sort: list[str] | None = None, mode: str = "errorifexists") -> None:
    """One JSON document per line with nulls spelled out; ``sort`` orders the whole output."""
    ordered = df.orderBy(*sort) if sort else df
    ordered.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_duplicate_groups(
    split: DataFrame,
    path: str,
    sort: list[str] | None = None,
    mode: str = "errorifexists",
    folders: bool = False,
) -> None:
    """CSV with header, ranged by ``dup_group`` and then by ``sort``; the number is a column.

    With ``folders`` there is one folder per number instead, as many as the most frequent key has rows. The
    rebalance hint then lets adaptive execution cut the low groups, which hold most rows, into several files.
    """
    order = ["dup_group", *(sort or [])]
    if not folders:
        ranged = split.repartitionByRange(*order).sortWithinPartitions(*order)
        ranged.write.mode(mode).option("header", True).csv(path)
        return
    balanced = split.hint("rebalance", "dup_group")
    if sort:
        balanced = balanced.sortWithinPartitions(*order)
    balanced.write.mode(mode).partitionBy("dup_group").option("header", True).csv(path)


def json_array_lines(df: DataFrame, sort: list[str], fields: list[str] | None = None) -> DataFrame:
    """Lines that read one after the other form a JSON array of the rows, ordered by ``sort``.

    The rows must be unique in ``sort``; one row, the first, is looked up to leave out its comma.
    """
    head = df.orderBy(*sort).limit(1).select(*sort).withColumn("head", F.lit(True))
    record = F.to_json(F.struct(*(fields or df.columns)), {"ignoreNullFields": "false"})
    marked = null_safe_join(df, F.broadcast(head), sort, "left")
    comma = F.when(F.col("head"), F.lit("")).otherwise(F.lit(","))
    body = marked.select(F.lit(1).alias("place"), *sort, F.concat(comma, record).alias("value"))
    blank = [F.lit(None).cast(df.schema[c].dataType).alias(c) for c in sort]
    one = df.sparkSession.range(1)
    opening = one.select(F.lit(0).alias("place"), *blank, F.lit("[").alias("value"))
    closing = one.select(F.lit(2).alias("place"), *blank, F.lit("]").alias("value"))
    return opening.unionByName(body).unionByName(closing)


def write_json_array(
    df: DataFrame, path: str, sort: list[str], fields: list[str] | None = None, mode: str = "errorifexists"
) -> None:
    """Text parts that concatenated in name order are one JSON array."""
    lines = json_array_lines(df, sort, fields)
    lines.orderBy("place", *sort).select("value").write.mode(mode).text(path)


def write_shapes(df: DataFrame, path: str, geometry: str = "geometry", mode: str = "errorifexists") -> None:
    """Parquet with the shape as WKB; a column that is binary already is written as it is."""
    if isinstance(df.schema[geometry].dataType, T.StructType):
        df = df.withColumn(geometry, encode_wkb(F.col(geometry)))
    df.write.mode(mode).parquet(path)


def write_dimension(districts: DataFrame, path: str, mode: str = "errorifexists") -> None:
    districts.write.mode(mode).parquet(path)


def document_id(keys: list[str]) -> Column:
    """An id that is the same on every run, so loading twice replaces instead of adding."""
    return F.sha2(F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}), 256)


def bulk_lines(
    documents: DataFrame, index: str, id_keys: list[str] | None = None, source: list[str] | None = None
) -> DataFrame:
    """One ``value`` per document: the action line and the source line of a bulk request."""
    target = [F.lit(index).alias("_index")]
    if id_keys:
        target.append(document_id(id_keys).alias("_id"))
    action = F.to_json(F.struct(F.struct(*target).alias("index")))
    body = F.to_json(F.struct(*(source or documents.columns)), {"ignoreNullFields": "false"})
    return documents.select(F.concat_ws("\n", action, body).alias("value"))


def bulk_chunks(lines: DataFrame, chunk_size: int = CHUNK) -> DataFrame:
    """Bulk lines with the number of their ``chunk``; a chunk stays in one task and has at most ``chunk_size``.

    Numbers follow tasks and the order of rows in them, so another run may deal documents differently; ids in
    the lines, not chunk numbers, make a repeated export safe.
    """
    place = F.monotonically_increasing_id()
    task, row = F.shiftright(place, 33), place.bitwiseAND(F.lit((1 << 33) - 1))
    chunk = F.shiftleft(task, 33) + F.floor(row / F.lit(chunk_size))
    return lines.select(chunk.cast("bigint").alias("chunk"), "value")


def bulk_export(
    documents: DataFrame,
    path: str,
    index: str,
    chunk_size: int = CHUNK,
    id_keys: list[str] | None = None,
    source: list[str] | None = None,
    mode: str = "errorifexists",
    file_per_chunk: bool = True,
) -> None:
    """Bulk request files of at most ``chunk_size`` documents each.

    For many documents pass ``file_per_chunk=False``: Parquet files hold several chunks each, told apart by
    the column ``chunk``.
    """
    lines = bulk_lines(documents, index, id_keys, source)
    if file_per_chunk:
        lines.write.mode(mode).option("maxRecordsPerFile", chunk_size).text(path)
    else:
        bulk_chunks(lines, chunk_size).write.mode(mode).parquet(path)


def create_index_table(spark: SparkSession, name: str, schema: T.StructType) -> bool:
    """Create an empty table with the schema unless it exists; True when it was created."""
    if spark.catalog.tableExists(name):
        return False
    spark.createDataFrame([], schema).write.mode("ignore").saveAsTable(name)
    return True
