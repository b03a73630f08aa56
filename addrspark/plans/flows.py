"""The four end-to-end jobs: inputs on storage to outputs on storage."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from addrspark.functions.once import evaluate_once
from addrspark.functions.projection import shape_to_utm
from addrspark.functions.shapes import point
from addrspark.functions.text import parse_coordinate
from addrspark.functions.wkb import point_wkb
from addrspark.operators import documents as docs
from addrspark.operators.checks import require_columns, text_column_names
from addrspark.operators.dedup import unique_rows
from addrspark.operators.mapping import apply_mapping
from addrspark.operators.skew import null_safe_join
from addrspark.operators.spatial import address_points, hex_indexed
from addrspark.schemas import DOCUMENT, DOCUMENT_FIELDS, LOTS
from addrspark.session import settled
from addrspark.sinks import writers
from addrspark.sources import readers


def build_district_dimension(spark: SparkSession, sheet_path: str, out: str) -> DataFrame:
    """The district sheet as a dimension; returns the rows that do not fit."""
    sheet, rejects = readers.read_district_sheet(spark, sheet_path)
    writers.write_dimension(docs.district_dimension(sheet), out)
    return rejects


def build_street_documents(spark: SparkSession, doors_path: str, districts_path: str, out: str) -> None:
    """Doors to one nested document per street."""
    districts = spark.read.parquet(districts_path)
    result = docs.street_documents(spark.read.parquet(doors_path), districts)
    writers.write_ndjson(result.select(*DOCUMENT_FIELDS), out)


def build_block_documents(
    spark: SparkSession, lots_path: str, districts_path: str, out: str, rejects_out: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Lots to one nested document per block; lots with shapes (Parquet) are placed at centroids.

    Returns (lines that could not be read, lots that could not be placed); the latter are also written
    where ``rejects_out`` is given.
    """
    districts = spark.read.parquet(districts_path)
    lots, broken = readers.read_any(spark, lots_path, LOTS)
    with_shape = any(c in lots.columns for c in ("geometry", "geom"))
    build = docs.shape_block_documents if with_shape else docs.block_documents
    result, rejects = build(lots, districts)
    writers.write_ndjson(result.select(*DOCUMENT_FIELDS), out, sort=["name", "context"])
    if rejects_out:
        writers.write_ndjson(rejects, rejects_out)
    return broken, rejects


def build_address_points(
    spark: SparkSession, lots_path: str, roads_path: str, out: str, key: str = "lot_id", zone: int = 18
) -> tuple[DataFrame, DataFrame]:
    """Lots and roads in degrees to one frontage point per lot, in UTM metres.

    Lots are read by two joins, so decoding and projecting them is settled first. Returns the lots and the
    roads whose bytes are no shape.
    """

    def metres(path: str) -> tuple[DataFrame, DataFrame]:
        shapes, rejects = readers.read_shapes(spark, path, "geometry")
        return shapes.withColumn("geometry", shape_to_utm("geometry", zone)), rejects

    lots, bad_lots = metres(lots_path)
    roads, bad_roads = metres(roads_path)
    points = address_points(settled(lots.select(key, "geometry")), roads, key)
    writers.write_shapes(points.withColumn("geometry", point_wkb(F.col("x"), F.col("y"))), out)
    return bad_lots, bad_roads


def index_shapes(
    spark: SparkSession, shapes_path: str, out: str, resolution: int = 8, geometry: str = "geometry"
) -> tuple[DataFrame, DataFrame]:
    """Shapes to hexagon cells; the geometry becomes the hexagon.

    Returns (rows whose bytes are no shape, shapes of an unsupported kind).
    """
    shapes, broken = readers.read_shapes(spark, shapes_path, geometry)
    indexed, unsupported = hex_indexed(shapes, geometry, resolution)
    writers.write_shapes(indexed, out, geometry)
    return broken, unsupported


def clean_points(sheet: DataFrame, lon: str, lat: str) -> DataFrame:
    """Rows with usable coordinate text as points; the two columns become numbers."""
    named = text_column_names(sheet)
    require_columns(named, lon, lat)
    parsed = evaluate_once(named, {"clean_x": parse_coordinate(F.col(lon)), "clean_y": parse_coordinate(F.col(lat))})
    numbers = parsed.dropna(subset=["clean_x", "clean_y"]).withColumns({lon: F.col("clean_x"), lat: F.col("clean_y")})
    return numbers.drop("clean_x", "clean_y").withColumn("geometry", point(F.col(lon), F.col(lat)))


def build_points(
    spark: SparkSession, sheet_path: str, schema: T.StructType, out: str, lon: str = "LONGITUD", lat: str = "LATITUD"
) -> DataFrame:
    """A sheet (CSV or Parquet export) with coordinate text to point Parquet; returns lines that do not fit."""
    sheet, rejects = readers.read_any(spark, sheet_path, schema)
    writers.write_shapes(clean_points(sheet, lon, lat), out)
    return rejects


def flatten_to_points(spark: SparkSession, documents_path: str, out: str) -> tuple[DataFrame, DataFrame]:
    """Nested documents to one point per house number; returns (broken lines, houses without coordinates)."""
    documents, broken = readers.read_ndjson(spark, documents_path, DOCUMENT)
    points, rejects = docs.placed_points(docs.flatten_documents(documents))
    located = points.withColumn("geometry", point_wkb(F.col("lon"), F.col("lat")))
    writers.write_shapes(located, out)
    return broken, rejects


def build_department_list(spark: SparkSession, sheet: DataFrame, out: str) -> None:
    """Departments with their sorted provinces as one JSON array."""
    require_columns(sheet, "Departamento", "Provincia")
    names = docs.sorted_names(sheet, "Departamento", "Provincia", "departamento", "provincias")
    writers.write_json_array(names, out, sort=["departamento"], fields=["departamento", "provincias"])


def load_documents(
    spark: SparkSession,
    documents_path: str,
    table: str,
    schema: T.StructType,
    rejects_out: str,
    key: list[str] | None = None,
) -> dict[str, int]:
    """Create the table if absent, append the documents that fit, keep the rest; returns the counts.

    With ``key`` the job may be run again: a document whose key the table has already is not appended
    (null keys are equal), of several in the input with one key the smallest row is, and the rejects of an
    earlier run are replaced. The counts are observed while writing, not by another pass. For input that keeps
    arriving see ``addrspark.streaming.load``.
    """
    writers.create_index_table(spark, table, schema)
    lines, broken = readers.read_ndjson(spark, documents_path, as_text(schema))
    good, misfits = apply_mapping(lines, schema)
    if key:
        known = spark.table(table).select(*key)
        good = null_safe_join(unique_rows(good, key), known, key, "left_anti")
    lost = misfits.select(F.to_json(F.struct(*lines.columns)).alias("line"), "reason")
    accepted, refused = Observation("accepted"), Observation("refused")
    n = F.count(F.lit(1)).alias("n")
    # Rejects go first: should their folder exist already, nothing has been appended yet.
    writers.write_ndjson(broken.unionByName(lost).observe(refused, n), rejects_out, mode="overwrite" if key else "errorifexists")
    good.select(*schema.names).observe(accepted, n).write.mode("append").saveAsTable(table)
    return {"succeeded": accepted.get["n"], "failed": refused.get["n"]}


def as_text(kind: T.DataType) -> T.DataType:
    """The same structure with text leaves, so that a misfit is seen by the mapping and not lost before."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, as_text(f.dataType), True) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(as_text(kind.elementType))
    return T.StringType()
