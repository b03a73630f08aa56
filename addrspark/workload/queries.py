"""Registered queries: every operator over the whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from addrspark import schemas
from addrspark.functions import hexgrid, projection, shapes, tables, text, wkb
from addrspark.functions.once import evaluate_once
from addrspark.operators import asof, checks, dedup, documents, editions, intervals, mapping, patch, sketches, spatial, timewindows, totals
from addrspark.plans.flows import as_text, clean_points
from addrspark.session import shared_folder
from addrspark.sinks import geoparquet, writers
from addrspark.sources import readers
from addrspark.streaming import load
from addrspark.workload import fixtures as fx

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def scaled(col: Column, factor: float) -> Column:
    """Fixed-point copy of a DOUBLE, comparable between engines."""
    return F.floor(col * factor + 0.5).cast("bigint")


def doors(spark: SparkSession, sf: str) -> DataFrame:
    return fx.view(spark, sf, fx.DOORS)


def districts(spark: SparkSession, sf: str) -> DataFrame:
    return fx.view(spark, sf, fx.DISTRICTS)


def streets(spark: SparkSession, sf: str) -> DataFrame:
    return documents.street_documents(doors(spark, sf), districts(spark, sf))


def houses_text(col: str) -> Column:
    """Readable list of a document's houses, coordinates in millionths of a degree."""
    return F.array_join(
        F.transform(
            F.col(col),
            lambda h: F.concat_ws(
                "/",
                F.coalesce(h.number, F.lit("-")),
                scaled(h.location.lon, 1e6).cast("string"),
                scaled(h.location.lat, 1e6).cast("string"),
            ),
        ),
        " ",
    )


@query
def distinct_streets(spark, sf):
    return dedup.distinct_count(doors(spark, sf), "id_via", "unique_id_count")


@query
def duplicate_keys(spark, sf):
    return dedup.duplicate_keys(doors(spark, sf)).withColumnRenamed("count", "copies")


@query
def duplicate_details(spark, sf):
    return dedup.duplicate_rows(doors(spark, sf))


@query
def duplicate_details_null_safe(spark, sf):
    return dedup.duplicate_rows(doors(spark, sf), null_safe=True)


@query
def duplicate_split(spark, sf):
    return dedup.split_duplicates(doors(spark, sf))


@query
def unique_doors(spark, sf):
    unique = dedup.unique_doors(doors(spark, sf))
    return unique.withColumn("number", text.number_text(unique, "numpuerta"))


@query
def unique_invariant(spark, sf):
    return dedup.duplicates_among_unique(doors(spark, sf)).agg(F.count(F.lit(1)).alias("duplicates"))


@query
def door_map(spark, sf):
    maps = documents.door_maps(doors(spark, sf))
    return maps.select(
        "id_via", "name", "postcode", F.explode("housenumbers").alias("number", "location")
    ).select("id_via", "name", "postcode", "number", "location.lon", "location.lat")


@query
def street_documents(spark, sf):
    return documents.flatten_documents(streets(spark, sf))


@query
def street_documents_nested(spark, sf):
    return streets(spark, sf).select(
        *schemas.DOCUMENT_SCALARS, houses_text("housenumbers").alias("houses")
    )


@query
def street_documents_summary(spark, sf):
    sized = streets(spark, sf).select(F.size("housenumbers").cast("bigint").alias("houses"), "cod_departament")
    return sized.groupBy("cod_departament").agg(
        F.count(F.lit(1)).alias("documents"),
        F.sum("houses").cast("bigint").alias("houses"),
        F.max("houses").alias("largest"),
    )


@query
def blocks_v1(spark, sf):
    blocks, _ = documents.block_documents(fx.view(spark, sf, fx.LOTS), districts(spark, sf))
    return blocks.select(*schemas.DOCUMENT_SCALARS, houses_text("housenumbers").alias("houses"))


@query
def blocks_v1_summary(spark, sf):
    blocks, _ = documents.block_documents(fx.view(spark, sf, fx.LOTS), districts(spark, sf))
    sized = blocks.select("cod_departament", F.size("housenumbers").cast("bigint").alias("lots"))
    return sized.groupBy("cod_departament").agg(
        F.count(F.lit(1)).alias("documents"),
        F.sum("lots").cast("bigint").alias("lots"),
        F.max("lots").alias("largest"),
    )


@query
def blocks_v1_rejects(spark, sf):
    _, rejects = documents.block_documents(fx.view(spark, sf, fx.LOTS), districts(spark, sf))
    return rejects


@query
def blocks_v2(spark, sf):
    blocks, _ = documents.shape_block_documents(fx.shaped_lots(spark, sf), districts(spark, sf))
    flat = documents.flatten_documents(blocks)
    return flat.withColumns({"lon": scaled(F.col("lon"), 1e8), "lat": scaled(F.col("lat"), 1e8)})


@query
def blocks_v2_rejects(spark, sf):
    _, rejects = documents.shape_block_documents(fx.shaped_lots(spark, sf), districts(spark, sf))
    return rejects.select("event_id", "name_manzana", "name_lote", "name_urb", "postcode", "reason")


@query
def flatten_documents(spark, sf):
    blocks, _ = documents.block_documents(fx.view(spark, sf, fx.LOTS), districts(spark, sf))
    points, _ = documents.placed_points(documents.flatten_documents(blocks))
    return points


@query
def ubigeo_last_wins(spark, sf):
    return documents.district_dimension(fx.view(spark, sf, fx.DISTRICT_EDITIONS), order="edition")


@query
def provinces_by_department(spark, sf):
    words = fx.table(spark, sf, "documents", heavy=True).select("lang", F.explode(F.split("text", " ")).alias("word"))
    sheet = words.select(
        F.col("lang").alias("Departamento"), F.concat(F.lit(" "), "word", F.lit("\xa0 ")).alias("Provincia")
    )
    names = documents.sorted_names(sheet, "Departamento", "Provincia", "departamento", "provincias")
    return names.select(
        "departamento", F.array_join("provincias", "|").alias("provincias"), F.size("provincias").cast("bigint").alias("names")
    )


@query
def accents_removed(spark, sf):
    texts = fx.table(spark, sf, "documents", heavy=True).select("text").unionByName(
        fx.table(spark, sf, "conversations", heavy=True).select("text")
    )
    return texts.select(F.md5("text").alias("text_md5"), text.remove_accents(F.col("text")).alias("plain"))


@query
def clean_coordinates(spark, sf):
    points = clean_points(fx.view(spark, sf, fx.SHEET), "LONGITUD", "LATITUD")
    return points.select("c_custkey", F.col("LONGITUD").alias("lon"), F.col("LATITUD").alias("lat"))


def json_rows(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    lines = fx.view(spark, sf, fx.JSON_LINES, heavy=True)
    return readers.parse_ndjson(lines, "line", JSON_SCHEMA)


@query
def ndjson_good(spark, sf):
    return json_rows(spark, sf)[0]


@query
def ndjson_rejects(spark, sf):
    return json_rows(spark, sf)[1]


@query
def load_summary(spark, sf):
    return checks.outcome_counts(*json_rows(spark, sf))


def mapped(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    raw = fx.view(spark, sf, fx.RAW_DOCUMENTS, heavy=True)
    location = F.struct("lon", "lat").alias("location")
    nested = raw.withColumn("housenumbers", F.array(F.struct("number", location)))
    return mapping.apply_mapping(
        nested.drop("number", "lon", "lat"),
        schemas.T.StructType(
            [schemas.T.StructField("row_no", schemas.T.LongType()), *schemas.schema_from_mapping(schemas.INDEX_MAPPING)]
        ),
    )


@query
def apply_mapping(spark, sf):
    good, _ = mapped(spark, sf)
    return good.select("row_no", "id_via", "name", "postcode", F.explode("housenumbers").alias("h")).select(
        "row_no", "id_via", "name", "postcode", "h.number",
        F.col("h.location.lon").cast("double").alias("lon"), F.col("h.location.lat").cast("double").alias("lat"),
    )


@query
def apply_mapping_rejects(spark, sf):
    return mapped(spark, sf)[1].select("row_no", "id_via", "reason")


@query
def keyword_fields(spark, sf):
    table = fx.table(spark, sf, "documents")
    limits = {"text": schemas.keyword_limits(schemas.INDEX_MAPPING)["name"]}
    return mapping.with_keywords(table, limits).select("doc_id", "text_keyword")


@query
def utm_project(spark, sf):
    metres = projection.to_utm(fx.view(spark, sf, fx.PLACES))
    return metres.select("c_custkey", scaled(F.col("x"), 1e3).alias("x_mm"), scaled(F.col("y"), 1e3).alias("y_mm"))


@query
def polygon_centroid(spark, sf):
    center = shapes.centroid("geometry")
    return fx.metric_lots(spark, sf).withColumn("c", center).select(
        "lot_id", scaled(F.col("c.x"), 1e3).alias("x_mm"), scaled(F.col("c.y"), 1e3).alias("y_mm")
    )


def frontages(spark: SparkSession, sf: str, reach: float) -> DataFrame:
    parts = spatial.shape_parts(fx.metric_lots(spark, sf), "lot_id", "geometry")
    segments = spatial.road_segments(fx.metric_roads(spark, sf), "geometry")
    best = spatial.nearest_edges(spatial.part_edges(parts, "lot_id"), segments, "lot_id", reach)
    return best.select(
        "lot_id", F.col("part").cast("bigint").alias("part"), F.col("edge").cast("bigint").alias("edge"),
        scaled(F.col("distance"), 1e3).alias("distance_mm"),
    )


@query
def nearest_edge(spark, sf):
    return frontages(spark, sf, 15.0)


@query
def nearest_edge_3m(spark, sf):
    return frontages(spark, sf, 3.0)


@query
def address_points(spark, sf):
    points = spatial.address_points(fx.metric_lots(spark, sf), fx.metric_roads(spark, sf))
    return points.select(
        "lot_id", F.col("part").cast("bigint").alias("part"), F.col("edge").cast("bigint").alias("edge"),
        scaled(F.col("x"), 1e3).alias("x_mm"), scaled(F.col("y"), 1e3).alias("y_mm"),
    )


@query
def hex_index(spark, sf):
    places = fx.view(spark, sf, fx.PLACES)
    return places.select(
        "c_custkey",
        hexgrid.hex_cell("lon", "lat", 8).alias("cell"),
        hexgrid.hex_cell("lon", "lat", 7).alias("cell_7"),
    )


@query
def hex_boundary(spark, sf):
    places = fx.view(spark, sf, fx.PLACES)
    cells = places.withColumn("cell", hexgrid.hex_cell("lon", "lat"))
    return cells.select("c_custkey", F.posexplode(hexgrid.hex_boundary("cell")).alias("corner", "v")).select(
        "c_custkey", F.col("corner").cast("bigint").alias("corner"),
        scaled(F.col("v.x"), 1e7).alias("lon_e7"), scaled(F.col("v.y"), 1e7).alias("lat_e7"),
    )


@query
def hex_shapes(spark, sf):
    lots, _ = wkb.decode_shapes(fx.shaped_lots(spark, sf), "geometry")
    indexed, _ = spatial.hex_indexed(lots)
    return indexed.select("event_id", "hex_index", F.size("hex_cells").cast("bigint").alias("cells"))


@query
def hex_multi_shapes(spark, sf):
    corners = fx.view(spark, sf, fx.LOT_CORNERS, heavy=True)
    part = F.array(F.array(*fx.corners()))
    shifted = F.array(F.transform(part[0], lambda v: shapes.vertex(v.x + 0.5, v.y - 0.25)))
    pairs = evaluate_once(corners, {"geometry": shapes.shape("MultiPolygon", F.array(part, shifted))})
    indexed, _ = spatial.hex_indexed(pairs, keep_geometry=False)
    return indexed.select("event_id", "hex_index", F.size("hex_cells").cast("bigint").alias("cells"))


def ring_vertices(lots: DataFrame) -> DataFrame:
    rings = lots.select("lot_id", F.posexplode("geometry.parts").alias("part", "rings")).select(
        "lot_id", "part", F.posexplode("rings").alias("ring", "vertices")
    )
    return rings.select(
        "lot_id", F.col("part").cast("bigint").alias("part"), F.col("ring").cast("bigint").alias("ring"),
        F.posexplode("vertices").alias("place", "v"),
    ).select("lot_id", "part", "ring", F.col("place").cast("bigint").alias("place"), "v.x", "v.y")


@query
def wkb_roundtrip(spark, sf):
    bytes_of = fx.metric_lots(spark, sf).withColumn("geometry", wkb.encode_wkb(F.col("geometry")))
    back, _ = wkb.decode_shapes(bytes_of, "geometry")
    return ring_vertices(back)


def patched(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    known = doors(spark, sf).select("id_via").distinct()
    return patch.patch_documents(streets(spark, sf), fx.view(spark, sf, fx.PATCHES), known=known)


@query
def patch_documents(spark, sf):
    updated = patched(spark, sf)[0]
    return updated.select("id_via", "name", "postcode", houses_text("housenumbers").alias("houses"))


@query
def patch_unknown(spark, sf):
    return patched(spark, sf)[1]


@query
def patch_repeated(spark, sf):
    return patched(spark, sf)[2]


@query
def bulk_export_lines(spark, sf):
    lines = writers.bulk_lines(
        streets(spark, sf), "streets", ["id_via", "name", "postcode", "part"], schemas.DOCUMENT_FIELDS
    )
    pair = F.split("value", "\n")
    source = F.from_json(pair[1], as_text(schemas.DOCUMENT))
    return lines.select(
        F.get_json_object(pair[0], "$.index._index").alias("target"),
        F.get_json_object(pair[0], "$.index._id").alias("doc_id"),
        source.alias("source"),
    ).select(
        "target", "doc_id", "source.id_via", "source.name", "source.context",
        F.size("source.housenumbers").cast("bigint").alias("houses"),
    )


@query
def bulk_chunks(spark, sf):
    chunks = writers.bulk_chunks(writers.bulk_lines(streets(spark, sf), "streets", ["id_via", "name", "postcode", "part"]), 100)
    sizes = chunks.groupBy("chunk").agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.sum("n").cast("bigint").alias("documents"), (F.max("n") <= 100).alias("within_size"))


@query
def nested_keywords(spark, sf):
    limits = {k: v for k, v in schemas.keyword_limits(schemas.INDEX_MAPPING).items() if "." in k}
    houses = mapping.with_keywords(streets(spark, sf), limits).select("id_via", "name", "postcode", F.explode("housenumbers").alias("h"))
    return houses.select("id_via", "name", "postcode", "h.number", "h.number_keyword")


@query
def blocks_v2_broken(spark, sf):
    _, rejects = documents.shape_block_documents(fx.broken_lots(spark, sf), districts(spark, sf))
    return rejects.filter(F.col("reason") == "no valid WKB").select("event_id", "name_manzana", "name_lote", "reason")


@query
def hex_rejects(spark, sf):
    good, broken = wkb.decode_shapes(fx.broken_lots(spark, sf), "geometry")
    _, unsupported = spatial.hex_indexed(good)
    return broken.select("event_id", "reason").unionByName(unsupported.select("event_id", "reason"))


def fresh(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, for queries that write and read again."""
    return f"{shared_folder(spark)}/addrspark-{name}-{uuid.uuid4().hex}"


JSON_SCHEMA = schemas.T.StructType(
    [
        schemas.T.StructField("event_id", schemas.T.LongType()),
        schemas.T.StructField("event_type", schemas.T.StringType()),
        schemas.T.StructField("user_id", schemas.T.LongType()),
    ]
)


def stream_loaded(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The JSON lines of the batch queries, every fifth sent twice, in several files in no order of time."""
    lines = fx.view(spark, sf, fx.JSON_LINES)
    twice = lines.filter("line_no % 5 = 0")
    folder = fresh(spark, "stream")
    lines.unionByName(twice).select("line").repartition(6).write.text(f"{folder}/in")
    load.load_available(
        spark, f"{folder}/in", JSON_SCHEMA, "event_id", f"{folder}/out", f"{folder}/state", files_per_batch=2
    )
    return load.loaded(spark, f"{folder}/out", JSON_SCHEMA)


@query
def stream_load_good(spark, sf):
    return stream_loaded(spark, sf)[0]


@query
def stream_load_rejects(spark, sf):
    return stream_loaded(spark, sf)[1]


@query
def stream_hourly_counts(spark, sf):
    """Counts per hour and kind of events that arrive in several files, every count brought up to date."""
    folder = fresh(spark, "counts")
    events = fx.table(spark, sf, "events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    events.repartition(5).write.parquet(f"{folder}/in")
    arriving = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(f"{folder}/in")
    load.start_counts(arriving, "ts", "1 hour", ["event_type"], f"{folder}/out", f"{folder}/state", "60 days").awaitTermination()
    counts = load.current_counts(spark, f"{folder}/out", ["event_type"])
    return counts.select("event_type", F.date_format("begin", "yyyy-MM-dd HH:mm").alias("begin"), "n")


@query
def district_as_of(spark, sf):
    doors = fx.view(spark, sf, fx.DATED_DOORS)
    return asof.as_of_join(doors, fx.view(spark, sf, fx.DATED_DISTRICTS), ["postcode"], "recorded", "valid_from")


@query
def events_in_spans(spark, sf):
    events = fx.table(spark, sf, "events").select("event_id", "event_type", "ts")
    totals = {"events": ("count", "*"), "first_event": ("min", "event_id"), "last_event": ("max", "event_id")}
    met = intervals.join_spans(events, fx.view(spark, sf, fx.SPANS), "ts", "span_start", "span_end", ["event_type"], totals)
    return met.groupBy("span_id").agg(
        F.sum("events").alias("events"), F.min("first_event").alias("first_event"), F.max("last_event").alias("last_event")
    )


@query
def edition_changes(spark, sf):
    return editions.edition_changes(fx.view(spark, sf, fx.OLD_EDITION), fx.view(spark, sf, fx.NEW_EDITION))


def placed_doors(spark: SparkSession, sf: str) -> DataFrame:
    names = districts(spark, sf).withColumnRenamed("postcode", "ubigeo").drop("context")
    return doors(spark, sf).join(names, "ubigeo", "left")


HIERARCHY = ["cod_departament", "cod_province", "tipo_via"]


def door_totals(spark: SparkSession, sf: str, sets: list[list[str]]) -> DataFrame:
    tasks = readers.tasks_for(doors(spark, sf), totals.ROWS_PER_TASK)
    return totals.totals(placed_doors(spark, sf), HIERARCHY, sets, "id_via", "doors", "streets", tasks)


@query
def door_totals_rollup(spark, sf):
    return door_totals(spark, sf, totals.rollup_sets(HIERARCHY))


@query
def door_totals_cube(spark, sf):
    return door_totals(spark, sf, totals.cube_sets(HIERARCHY))


@query
def user_sessions(spark, sf):
    found = timewindows.sessions(fx.table(spark, sf, "events"), ["user_id"], "ts", 6 * 3600)
    texts = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") for c in ("session_start", "session_end")}
    return found.withColumns(texts)


@query
def trailing_hour_counts(spark, sf):
    events = fx.table(spark, sf, "events").select("event_id", "event_type", "ts")
    return timewindows.trailing_counts(events, ["event_type"], "ts", 3600).drop("ts")


def district_sheet(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """A sheet with a header and more columns than are wanted, written and read again by column names."""
    path = fresh(spark, "sheet")
    sheet = fx.view(spark, sf, fx.DISTRICT_SHEET).withColumnRenamed("REGION_NATURAL", "REGION NATURAL")
    sheet.write.option("sep", ";").option("header", True).csv(path)
    return readers.read_district_sheet(spark, path)


@query
def district_sheet_rows(spark, sf):
    return district_sheet(spark, sf)[0].withColumnRenamed("REGION NATURAL", "region_natural")


@query
def district_sheet_rejects(spark, sf):
    return district_sheet(spark, sf)[1].withColumnRenamed("REGION NATURAL", "region_natural")


@query
def ndjson_lines(spark, sf):
    """Doors as JSON lines, nulls spelled out: the lines of the files written."""
    path = fresh(spark, "ndjson")
    writers.write_ndjson(doors(spark, sf).select("id_via", "numpuerta", "tipo_via", "nom_via", "ubigeo"), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


@query
def json_array_lines(spark, sf):
    names = documents.sorted_names(
        fx.view(spark, sf, fx.PROVINCE_SHEET), "Departamento", "Provincia", "departamento", "provincias"
    )
    lines = writers.json_array_lines(names, ["departamento"], ["departamento", "provincias"])
    return lines.select(F.col("place").cast("bigint").alias("place"), "departamento", F.col("value").alias("line"))


@query
def json_array_text(spark, sf):
    """The written parts, put together in order of their names, as one text."""
    path = fresh(spark, "array")
    names = documents.sorted_names(
        fx.view(spark, sf, fx.PROVINCE_SHEET), "Departamento", "Provincia", "departamento", "provincias"
    )
    writers.write_json_array(names, path, ["departamento"], ["departamento", "provincias"])
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value")
    parsed = F.from_json(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("file", "value"))), lambda x: x["value"]), ""),
                         "array<struct<departamento: string, provincias: array<string>>>")
    return files.agg(parsed.alias("rows")).select(F.inline("rows")).select("departamento", F.array_join("provincias", "|").alias("provincias"))


@query
def flatten_rejects(spark, sf):
    blocks, _ = documents.block_documents(fx.view(spark, sf, fx.UNPLACED_LOTS), districts(spark, sf))
    _, rejects = documents.placed_points(documents.flatten_documents(blocks))
    return rejects


@query
def point_geometry(spark, sf):
    """Cleaned coordinates as point bytes, and what the bytes say when they are read again."""
    points = clean_points(fx.view(spark, sf, fx.SHEET), "LONGITUD", "LATITUD")
    bytes_of = points.select("c_custkey", wkb.point_wkb(F.col("LONGITUD"), F.col("LATITUD")).alias("geometry"))
    head = bytes_of.withColumn("head", F.hex(F.substring("geometry", 1, 5))).withColumn("n_bytes", F.octet_length("geometry").cast("bigint"))
    back, _ = wkb.decode_shapes(head, "geometry")
    vertex = F.col("geometry.parts")[0][0][0]
    return back.select("c_custkey", "head", "n_bytes", F.col("geometry.kind").alias("kind"), vertex["x"].alias("x"), vertex["y"].alias("y"))


@query
def hex_geometry(spark, sf):
    """The hexagon that takes the place of a lot's shape, corner by corner."""
    lots, _ = wkb.decode_shapes(fx.shaped_lots(spark, sf), "geometry")
    indexed, _ = spatial.hex_indexed(lots)
    corners = indexed.select("event_id", F.col("geometry.kind").alias("kind"), F.posexplode(F.col("geometry.parts")[0][0]).alias("corner", "v"))
    return corners.select(
        "event_id", "kind", F.col("corner").cast("bigint").alias("corner"),
        scaled(F.col("v.x"), 1e7).alias("lon_e7"), scaled(F.col("v.y"), 1e7).alias("lat_e7"),
    )


@query
def nearest_edge_dense(spark, sf):
    """Lots and roads drawn a hundred and twenty-eight times as small, so that they crowd a few cells of the grid.

    Division by a power of two is exact, so the nearest edges are the same ones.
    """
    small = 128.0
    parts = spatial.shape_parts(fx.metric_lots(spark, sf), "lot_id", "geometry")
    ends = {c: F.col(c) / small for c in spatial.ENDS}
    edges = spatial.part_edges(parts, "lot_id").withColumns(ends)
    segments = spatial.road_segments(fx.metric_roads(spark, sf), "geometry").withColumns(ends)
    best = spatial.nearest_edges(edges, segments, "lot_id", 15.0 / small, most_pairs=100_000)
    return best.select(
        "lot_id", F.col("part").cast("bigint").alias("part"), F.col("edge").cast("bigint").alias("edge"),
        scaled(F.col("distance") * small, 1e3).alias("distance_mm"),
    )


BUCKETS = 16


@query
def patch_buckets(spark, sf):
    """Documents patched in place: only the folders of patched buckets are written again."""
    path = fresh(spark, "buckets")
    patch.write_buckets(streets(spark, sf), path, "id_via", BUCKETS)
    patch.patch_buckets(spark, path, fx.view(spark, sf, fx.PATCHES), "id_via", BUCKETS)
    return spark.read.parquet(path).select("id_via", "name", "postcode", houses_text("housenumbers").alias("houses"))


# The projected coordinates that the lots are in.
LOT_CRS = '{"type": "ProjectedCRS", "name": "WGS 84 / UTM zone 18S", "id": {"authority": "EPSG", "code": 32718}}'


def written_lots(spark: SparkSession, sf: str) -> str:
    path = fresh(spark, "geo")
    geoparquet.write_geoparquet(fx.metric_lots(spark, sf), path, crs=LOT_CRS)
    return path


@query
def geo_roundtrip(spark, sf):
    lots, _, _ = geoparquet.read_geoparquet(spark, written_lots(spark, sf))
    return ring_vertices(lots)


@query
def geo_metadata(spark, sf):
    """What the footers of the written files say, put together."""
    files = geoparquet.geo_metadata(spark, written_lots(spark, sf))
    return files.agg(
        F.min("version").alias("version"), F.max("primary_column").alias("primary_column"), F.max("encoding").alias("encoding"),
        F.array_join(F.sort_array(F.array_distinct(F.flatten(F.collect_list("kinds")))), ",").alias("kinds"),
        F.max(F.get_json_object("crs", "$.id.code")).alias("crs_code"),
        F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"), F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax"),
    )


@query
def street_sketch_error(spark, sf):
    """Whether streets per district, estimated from merged sketches of each kind of street, are as near as stated."""
    kinds = doors(spark, sf).select("tipo_via", (F.col("ubigeo") % 10).alias("sector"), "id_via")
    stored = sketches.distinct_sketches(kinds, ["sector", "tipo_via"], "id_via")
    near = sketches.estimated(sketches.merged_sketches(stored, ["sector"]))
    exact = kinds.groupBy("sector").agg(F.count_distinct("id_via").alias("streets"))
    off = F.abs(F.col("estimate") - F.col("streets")) <= F.col("streets") * sketches.relative_error() + 1
    return near.join(exact, "sector").select("sector", "streets", off.alias("as_stated"))


@query
def shape_edges_sql(spark, sf):
    tables.register_table_functions(spark)
    lots = fx.metric_lots(spark, sf)
    return spark.sql("SELECT * FROM shape_edges(TABLE({lots}))", lots=lots)


@query
def duplicate_folders(spark, sf):
    """The rows of every rank as they stand in its folder of CSV files."""
    path = fresh(spark, "ranks")
    writers.write_duplicate_groups(dedup.split_duplicates(doors(spark, sf)), path, sort=["id_via", "numpuerta"], folders=True)
    rows = spark.read.option("header", True).csv(path)
    return rows.select(
        F.col("id_via").cast("bigint").alias("id_via"), F.col("numpuerta").cast("bigint").alias("numpuerta"),
        "tipo_via", "nom_via", F.col("dup_group").cast("bigint").alias("dup_group"),
    )


@query
def ordered_lines(spark, sf):
    """Whether the lines of a sorted output stand in order, inside every file and from file to file."""
    path = fresh(spark, "ordered")
    unique = dedup.unique_doors(doors(spark, sf)).select("id_via", "numpuerta")
    writers.write_ndjson(unique, path, sort=["id_via", "numpuerta"])
    files = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_name").alias("file"),
        F.transform(F.filter(F.split("value", "\n"), lambda x: x != ""), lambda x: F.from_json(x, "id_via BIGINT, numpuerta BIGINT")).alias("keys"),
    )
    ends = files.select(
        "file", F.size("keys").cast("bigint").alias("n"), (F.sort_array("keys") == F.col("keys")).alias("sorted"),
        F.array_min("keys").alias("low"), F.array_max("keys").alias("high"),
    ).filter("n > 0")
    before = F.lag("high").over(Window.orderBy("file"))
    follows = ends.withColumn("follows", F.coalesce(before <= F.col("low"), F.lit(True)))
    return follows.agg(F.sum("n").alias("lines"), F.min(F.col("sorted") & F.col("follows")).alias("in_order"))


@query
def rows_by_extension(spark, sf):
    """The same rows from NDJSON, CSV and Parquet, told apart by the path's ending."""
    rows = fx.view(spark, sf, fx.LOTS).select("lote", F.col("nombre_urbanizacion").alias("estate"), "postcode")
    folder = fresh(spark, "kinds")
    rows.write.json(f"{folder}.ndjson")
    rows.write.option("sep", ";").option("header", True).option("emptyValue", "").csv(f"{folder}.csv")
    rows.write.parquet(f"{folder}.parquet")
    kinds = [readers.read_any(spark, f"{folder}.{k}", rows.schema)[0].withColumn("kind", F.lit(k)) for k in ("ndjson", "csv", "parquet")]
    both = kinds[0].unionByName(kinds[1]).unionByName(kinds[2])
    return both.groupBy("kind", "estate", "postcode").agg(F.count(F.lit(1)).alias("lots"))


@query
def registered_view(spark, sf):
    """Streets per district by SQL over registered frames, the dimension written and read again."""
    path = fresh(spark, "districts")
    writers.write_dimension(districts(spark, sf), path)
    readers.register(readers.read_parquet(spark, path, ["postcode", "cod_departament", "cod_district"]), "registered_districts")
    readers.register(doors(spark, sf), "registered_doors")
    return spark.sql("""
        SELECT cod_departament, cod_district, count(DISTINCT id_via) AS streets
        FROM registered_doors JOIN registered_districts ON ubigeo = postcode GROUP BY cod_departament, cod_district""")


@query
def index_table(spark, sf):
    """Documents in the index table, which is made once and then found to exist."""
    name = f"addrspark_index_{uuid.uuid4().hex}"
    documents_of = streets(spark, sf).select("id_via", "name", "postcode", "context")
    made = [writers.create_index_table(spark, name, documents_of.schema) for _ in range(2)]
    documents_of.write.mode("append").saveAsTable(name)
    return spark.table(name).groupBy("context").agg(F.count(F.lit(1)).alias("documents")).withColumn("made_once", F.lit(made == [True, False]))
