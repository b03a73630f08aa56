import csv
import glob
import json
import os
import struct

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from addrspark import schemas
from addrspark.functions import wkb
from addrspark.functions.shapes import point
from addrspark.operators import documents, mapping, patch
from addrspark.plans import flows
from addrspark.session import settled, size_shuffles
from addrspark.sinks import writers
from addrspark.sources import readers

SMALL = T.StructType().add("a", T.LongType()).add("b", T.StringType())


def text_lines(path):
    return [line for f in sorted(glob.glob(f"{path}/part-*")) for line in open(f, encoding="utf-8").read().splitlines()]


def test_bad_lines_do_not_stop_the_rest(spark, tmp_path):
    lines = [
        '{"a": 1, "b": "ñ"}', '{"a": 2', "", "   ", '{"a": 3}}', '{"a": 4},{"a": 5}', '{"a": 6}]', "{'a': 7}",
        '{"a": "x"}', '{"a": 8, "a": 9}', '{"b": "q\\"]"}', "nonsense", '{"a": null}', '  {"a": 10}  ', '[{"a": 1}] x',
    ]
    path = tmp_path / "in.ndjson"
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    good, bad = readers.read_ndjson(spark, str(path), SMALL)
    assert sorted((r.a or 0, r.b or "") for r in good.collect()) == [
        (0, ""), (0, 'q"]'), (1, "ñ"), (9, ""), (10, ""),
    ]
    reasons = {r.line: r.reason for r in bad.collect()}
    assert reasons.pop('{"a": "x"}') == "wrong type"
    assert set(reasons.values()) == {"invalid JSON"}
    assert good.count() + bad.count() == len(lines)


def test_reader_by_extension(spark, tmp_path):
    (tmp_path / "x.ndjson").write_text('{"a": 1, "b": "z"}\n')
    (tmp_path / "x.csv").write_text("a;b\n2;y\n")
    spark.createDataFrame([(3, "x")], SMALL).write.parquet(str(tmp_path / "x.parquet"))
    rows = [readers.read_any(spark, str(tmp_path / f"x.{e}"), SMALL)[0].first().a for e in ("ndjson", "csv", "parquet")]
    assert rows == [1, 2, 3]
    with pytest.raises(ValueError):
        readers.read_any(spark, "x.gpkg", SMALL)
    assert readers.read_parquet(spark, str(tmp_path / "x.parquet"), ["b"]).columns == ["b"]
    readers.register(readers.read_parquet(spark, str(tmp_path / "x.parquet")), "registered", reused=True)
    assert spark.sql("SELECT a FROM registered").first().a == 3


def test_spread_leaves_wide_inputs_alone(spark):
    wide = spark.range(100, numPartitions=16)
    assert readers.spread(wide) is wide
    assert readers.spread(spark.range(100, numPartitions=1)).rdd.getNumPartitions() == 8


def test_spread_bounds_the_rows_of_a_task(spark):
    rows = 12 * readers.ROWS_PER_TASK + 1
    assert readers.spread(spark.range(rows, numPartitions=8)).rdd.getNumPartitions() == 13


def test_ndjson_spells_out_nulls(spark, tmp_path):
    out = str(tmp_path / "out")
    writers.write_ndjson(spark.createDataFrame([(1, "ñ"), (None, None)], SMALL), out, sort=["a"])
    assert text_lines(out) == ['{"a":null,"b":null}', '{"a":1,"b":"ñ"}']


def test_duplicate_groups_as_csv(spark, tmp_path):
    out = str(tmp_path / "groups")
    df = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (2, "z", 1)], "a int, b string, dup_group bigint")
    writers.write_duplicate_groups(df, out, folders=True)
    assert sorted(os.path.basename(d) for d in glob.glob(f"{out}/dup_group=*")) == ["dup_group=1", "dup_group=2"]
    rows = [r for f in glob.glob(f"{out}/dup_group=1/*.csv") for r in csv.DictReader(open(f))]
    assert sorted(r["b"] for r in rows) == ["x", "z"]
    none = str(tmp_path / "none")
    writers.write_duplicate_groups(df.limit(0), none, folders=True)
    assert glob.glob(f"{none}/dup_group=*") == []


@pytest.mark.parametrize("n", [0, 1, 40])
def test_json_array(spark, tmp_path, n):
    out = str(tmp_path / "array")
    df = spark.range(n).select((F.col("id") % 7).alias("g"), "id", F.lit(None).cast("string").alias("x")).repartition(5)
    writers.write_json_array(df, out, sort=["g", "id"], fields=["id", "x"])
    got = json.loads("\n".join(text_lines(out)))
    assert got == [{"id": i, "x": None} for i in sorted(range(n), key=lambda i: (i % 7, i))]


def test_bulk_chunks_in_few_files(spark, tmp_path):
    docs = spark.range(0, 100, 1, 3).selectExpr("id id_via")
    writers.bulk_export(docs, str(tmp_path / "bulk"), "streets", chunk_size=7, file_per_chunk=False)
    back = spark.read.parquet(str(tmp_path / "bulk"))
    sizes = [r["count"] for r in back.groupBy("chunk").count().collect()]
    assert sum(sizes) == 100 and max(sizes) == 7 and len(sizes) == 15


def test_duplicate_groups_as_a_column(spark, tmp_path):
    df = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (2, "z", 1)], "a int, b string, dup_group bigint")
    writers.write_duplicate_groups(df, str(tmp_path / "out"), ["a"])
    back = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert sorted((r.dup_group, r.b) for r in back.collect()) == [("1", "x"), ("1", "z"), ("2", "y")]


def test_bulk_export_in_chunks(spark, tmp_path):
    out = str(tmp_path / "bulk")
    docs = spark.range(10).select(F.col("id").alias("id_via"), F.lit("ñ").alias("name")).coalesce(1)
    writers.bulk_export(docs, out, "streets", chunk_size=4, id_keys=["id_via"])
    chunks = [open(f, encoding="utf-8").read().splitlines() for f in sorted(glob.glob(f"{out}/part-*"))]
    assert sorted(len(c) for c in chunks) == [4, 8, 8]
    pairs = [(json.loads(c[i]), json.loads(c[i + 1])) for c in chunks for i in range(0, len(c), 2)]
    assert {s["id_via"] for _, s in pairs} == set(range(10))
    assert all(a["index"]["_index"] == "streets" for a, _ in pairs)
    ids = {s["id_via"]: a["index"]["_id"] for a, s in pairs}
    again = writers.bulk_lines(docs.repartition(3), "streets", ["id_via"]).collect()
    assert {json.loads(r.value.split("\n")[0])["index"]["_id"] for r in again} == set(ids.values())
    plain = writers.bulk_lines(docs, "streets").first().value.split("\n")[0]
    assert json.loads(plain) == {"index": {"_index": "streets"}}


def test_mapping_schema():
    schema = schemas.schema_from_mapping(schemas.INDEX_MAPPING)
    assert set(schema.fieldNames()) == set(schemas.DOCUMENT_FIELDS)
    house = schema["housenumbers"].dataType.elementType
    assert house["location"].dataType["lon"].dataType == T.FloatType()
    assert schema["id_via"].dataType == T.LongType()
    assert schemas.keyword_limits(schemas.INDEX_MAPPING)["name"] == 256
    with pytest.raises(ValueError):
        schemas.schema_from_mapping({"properties": {"x": {"type": "geo_shape"}}})


def test_mapping_keeps_what_fits(spark):
    raw = spark.createDataFrame(
        [
            (1, "5", [("1", ("1.5", "2"))]), (2, "x", [("1", ("1", "2"))]), (3, None, None),
            (4, "7.9", [("a", (None, "3")), ("b", ("bad", "3"))]), (5, "6", []), (6, "7", [(None, None)]),
        ],
        "id int, postcode string, housenumbers array<struct<number:string,location:struct<lon:string,lat:string>>>",
    )
    schema = schemas.schema_from_mapping(schemas.INDEX_MAPPING)
    good, bad = mapping.apply_mapping(raw, schema)
    rows = {r.postcode: r for r in good.collect()}
    assert set(rows) == {5, None, 6, 7} and good.schema == schema
    assert rows[5].housenumbers[0].location.lon == 1.5 and rows[7].housenumbers[0].location is None
    assert {r.id: r.reason for r in bad.collect()} == {2: "does not fit: postcode", 4: "does not fit: housenumbers"}
    assert good.count() + bad.count() == raw.count()
    with pytest.raises(ValueError):
        mapping.apply_mapping(spark.createDataFrame([("x",)], "housenumbers string"), schema)
    same, none = mapping.apply_mapping(good, schema)
    assert same.count() == 4 and none.count() == 0


def test_patch(spark):
    docs = spark.createDataFrame([(1, "a", 5), (1, "b", 6), (2, "c", 7), (None, "d", 8)], "id_via int, name string, n int")
    patches = spark.createDataFrame([(1, "X"), (2, None), (9, "Y")], "id_via int, name string")
    updated, unknown, repeated = patch.patch_documents(docs, patches)
    assert repeated.count() == 0
    assert sorted(updated.collect(), key=lambda r: r.n) == [(1, "X", 5), (1, "X", 6), (2, None, 7), (None, "d", 8)]
    assert [r.id_via for r in unknown.collect()] == [9]
    with pytest.raises(LookupError):
        patch.patch_documents(docs, patches, strict=True)
    with pytest.raises(ValueError):
        patch.patch_documents(docs, patches.withColumnRenamed("name", "other"))


def test_repeated_patches_do_not_double_documents(spark):
    docs = spark.createDataFrame([(1, "a", "p"), (1, "b", "q"), (2, "c", "p")], "id_via int, name string, postcode string")
    twice = spark.createDataFrame([(1, "X", 1), (1, "Y", 2), (2, "Z", 1)], "id_via int, name string, edition int")
    updated, _, repeated = patch.patch_documents(docs, twice.drop("edition"))
    assert sorted(r.name for r in updated.collect()) == ["Z", "a", "b"] and repeated.count() == 2
    updated, _, repeated = patch.patch_documents(docs, twice, order="edition")
    assert sorted(r.name for r in updated.collect()) == ["Y", "Y", "Z"] and repeated.count() == 0
    one = spark.createDataFrame([(1, "q", "N")], "id_via int, postcode string, name string")
    assert sorted(r.name for r in patch.patch_documents(docs, one, ["id_via", "postcode"])[0].collect()) == ["N", "a", "c"]


def test_delimited_columns_go_by_name(spark, tmp_path):
    sheet = "IDDIST;NOMBDEP;NOMBPROV;NOMBDIST;ubigeo;REGION NATURAL\n9;LIMA;LIMA;ATE;10;COSTA\n9;LIMA;LIMA;X;ten;COSTA\n"
    (tmp_path / "s.csv").write_text(sheet)
    good, bad = readers.read_district_sheet(spark, str(tmp_path / "s.csv"))
    assert [(r.ubigeo, r["REGION NATURAL"]) for r in good.collect()] == [(10, "COSTA")]
    assert [(r.ubigeo, r.reason) for r in bad.collect()] == [("ten", "does not fit: ubigeo")]
    with pytest.raises(ValueError):
        readers.read_delimited(spark, str(tmp_path / "s.csv"), T.StructType.fromDDL("missing int"))


def test_bad_lines_become_rejects(spark, tmp_path):
    (tmp_path / "x.ndjson").write_text('{"lon": 1.5}\n{broken\n{"lon": "abc"}\n')
    good, bad = readers.read_any(spark, str(tmp_path / "x.ndjson"), T.StructType.fromDDL("lon double"))
    assert [r.lon for r in good.collect()] == [1.5] and sorted(r.line for r in bad.collect()) == ['{"lon": "abc"}', "{broken"]


DISTRICT_SHEET = "ubigeo;NOMBDEP;NOMBPROV;NOMBDIST;REGION NATURAL\n10;LIMA;LIMA;ATE;COSTA\n11;LIMA;LIMA;;COSTA\n"


def districts(spark, tmp_path):
    (tmp_path / "sheet.csv").write_text(DISTRICT_SHEET, encoding="utf-8")
    out = str(tmp_path / "districts.parquet")
    flows.build_district_dimension(spark, str(tmp_path / "sheet.csv"), out)
    return out


def test_street_flow_and_load(spark, tmp_path):
    doors = str(tmp_path / "doors.parquet")
    spark.createDataFrame(
        [
            (1, 5, "AV", "Á", 10, -77.0, -12.0), (1, 5, "AV", "Á", 10, -76.0, -12.0), (1, None, "AV", "Á", 10, -77.5, -12.5),
            (2, 1, None, "B", 99, -77.0, -12.0),
        ],
        schemas.DOORS,
    ).write.parquet(doors)
    out = str(tmp_path / "streets")
    flows.build_street_documents(spark, doors, districts(spark, tmp_path), out)
    docs = {d["id_via"]: d for d in map(json.loads, text_lines(out))}
    assert list(docs[1]) == schemas.DOCUMENT_FIELDS
    assert docs[1]["housenumbers"] == [
        {"number": None, "location": {"lon": -77.5, "lat": -12.5}}, {"number": "5", "location": {"lon": -77.0, "lat": -12.0}},
    ]
    assert docs[1]["cod_district"] == "ATE" and docs[2]["cod_district"] is None and docs[2]["name"] is None

    points = str(tmp_path / "points")
    broken, rejects = flows.flatten_to_points(spark, out, points)
    back = spark.read.parquet(points)
    assert back.count() == 3 and rejects.count() == 0 and broken.count() == 0
    decoded = back.select(wkb.decode_wkb(F.col("geometry")).alias("g"), "lon").collect()
    assert all(r.g.parts[0][0][0].x == r.lon for r in decoded)

    broken = tmp_path / "extra.ndjson"
    broken.write_text("\n".join([*text_lines(out), "{oops", '{"id_via": "x"}']) + "\n", encoding="utf-8")
    schema = schemas.schema_from_mapping(schemas.INDEX_MAPPING)
    spark.sql("DROP TABLE IF EXISTS streets_test")
    for n in (1, 2):
        counts = flows.load_documents(spark, str(broken), "streets_test", schema, str(tmp_path / f"rejects{n}"))
        assert counts == {"succeeded": 2, "failed": 2}
        assert spark.table("streets_test").count() == 2 * n
    assert {json.loads(x)["reason"] for x in text_lines(tmp_path / "rejects1")} == {"invalid JSON", "does not fit: id_via"}
    assert not writers.create_index_table(spark, "streets_test", schema)
    spark.sql("DROP TABLE streets_test")


def test_block_flow(spark, tmp_path):
    lots = tmp_path / "lots.ndjson"
    rows = [
        {"manzana": "A", "lote": "1", "nombre_urbanizacion": "U", "id_urb": "7", "postcode": 10, "lon": 1.5, "lat": 2},
        {"manzana": "A", "lote": None, "nombre_urbanizacion": "U", "id_urb": "7", "postcode": 10, "lon": 1, "lat": 2},
        {"manzana": "  ", "lote": "1", "nombre_urbanizacion": "U", "id_urb": "7", "postcode": 10},
        {"manzana": "A", "lote": "1", "nombre_urbanizacion": "U", "id_urb": None, "postcode": 10},
        {"manzana": "B", "lote": "1", "nombre_urbanizacion": "U", "id_urb": "X7", "postcode": 10, "lon": 1, "lat": 2},
        {"manzana": "A", "lote": "9", "nombre_urbanizacion": "U", "id_urb": "7", "postcode": 99},
        {"manzana": "A", "lote": "9", "nombre_urbanizacion": "U", "id_urb": "7", "postcode": 11},
    ]
    lots.write_text("\n".join(json.dumps(r, ensure_ascii=False) for r in rows), encoding="utf-8")
    out, rejects = str(tmp_path / "blocks"), str(tmp_path / "rejects")
    flows.build_block_documents(spark, str(lots), districts(spark, tmp_path), out, rejects)
    first, second = map(json.loads, text_lines(out))
    assert (first["id_via"], first["context"], first["name"]) == (7, "A", "U")
    assert [h["number"] for h in first["housenumbers"]] == [None, "1"]
    assert (second["id_via"], second["context"]) == (None, "B")
    reasons = sorted(json.loads(x)["reason"] for x in text_lines(rejects))
    assert reasons == ["null in id_urb", "unknown district", "unknown district"]


def test_block_flow_with_shapes(spark, tmp_path):
    lots = str(tmp_path / "lots.parquet")
    at = lambda x, y: struct.pack("<BIdd", 1, 1, x, y)
    spark.createDataFrame(
        [("A", "1", "U", "10", at(1, 2)), ("A", "2", "U", "010", at(3, 4)), ("A", "3", "U", "s/n", at(5, 6)), ("A", " ", "U", "10", at(7, 8))],
        schemas.LOTS_WITH_SHAPE,
    ).write.parquet(lots)
    out, rejects = str(tmp_path / "blocks"), str(tmp_path / "rejects")
    flows.build_block_documents(spark, lots, districts(spark, tmp_path), out, rejects)
    docs = [json.loads(x) for x in text_lines(out)]
    assert sorted(d["housenumbers"][0]["location"]["lon"] for d in docs) == [1.0, 3.0]
    assert all(d["postcode"] == 10 and d["id_via"] is None for d in docs)
    assert [json.loads(x)["reason"] for x in text_lines(rejects)] == ["null in postcode_number"]
    with pytest.raises(ValueError):
        documents.shape_block_documents(spark.createDataFrame([("a",)], "x string"), spark.range(1))


def test_address_point_flow(spark, tmp_path):
    def square(lon, lat, s=0.0002):
        xy = [(lon, lat), (lon + s, lat), (lon + s, lat + s), (lon, lat + s), (lon, lat)]
        return struct.pack("<BIII", 1, 3, 1, 5) + b"".join(struct.pack("<dd", *p) for p in xy)

    road = struct.pack("<BII", 1, 2, 2) + struct.pack("<dddd", -77.01, -12.00005, -76.99, -12.00005)
    lots, roads, out = (str(tmp_path / n) for n in ("lots", "roads", "points"))
    spark.createDataFrame([(1, square(-77.0, -12.0)), (2, square(-77.0, -11.9))], "lot_id int, geometry binary").write.parquet(lots)
    spark.createDataFrame([(road,)], "geom binary").withColumnRenamed("geom", "geometry").write.parquet(roads)
    flows.build_address_points(spark, lots, roads, out)
    (row,) = spark.read.parquet(out).collect()
    assert row.lot_id == 1 and row.edge == 0 and row.distance == pytest.approx(5.53, abs=0.05)
    assert struct.unpack_from("<dd", row.geometry, 5) == (row.x, row.y)


def test_settled_uses_the_checkpoint_folder(spark):
    df = spark.range(5).withColumn("x", F.lit(1))
    kept = settled(df)
    if spark.sparkContext.getCheckpointDir():
        assert "Scan ExistingRDD" in kept._jdf.queryExecution().executedPlan().toString()
    else:
        assert kept is df
    assert kept.count() == 5


def test_shuffles_grow_with_the_input(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_shuffles(spark, 1) == 8
        assert size_shuffles(spark, 10**12) >= 900
        assert 10_000 <= size_shuffles(spark, 100 * 10**12) <= 50_008
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_hexagon_flow(spark, tmp_path):
    shapes, out = str(tmp_path / "shapes"), str(tmp_path / "out")
    spark.createDataFrame([(1, "a", struct.pack("<BIdd", 1, 1, -77, -12))], "id int, kept string, geom binary").write.parquet(shapes)
    with pytest.raises(Exception):
        flows.index_shapes(spark, shapes, out, geometry="missing")
    flows.index_shapes(spark, shapes, out, geometry="geom")
    row = spark.read.parquet(out).first()
    assert row.kept == "a" and row.hex_index.startswith("r8:") and row.geom[:5] == struct.pack("<BI", 1, 3)


def test_point_flow(spark, tmp_path):
    sheet, out = str(tmp_path / "sheet.csv"), str(tmp_path / "points")
    with open(sheet, "w", encoding="utf-8") as f:
        f.write("LONGITUD;LATITUD;n\n-77 .5; -12;a\nabc;-12;b\n;;c\n")
    flows.build_points(spark, sheet, T.StructType.fromDDL("LONGITUD STRING, LATITUD STRING, n STRING"), out)
    (row,) = spark.read.parquet(out).collect()
    assert (row.LONGITUD, row.LATITUD, row.n) == (-77.5, -12.0, "a")
    with pytest.raises(ValueError):
        flows.clean_points(spark.range(1), "LONGITUD", "LATITUD")


def test_department_list(spark, tmp_path):
    sheet = spark.createDataFrame(
        [(" Áncash", "Yungay ", "x"), ("Ancash", "Huaráz", "x"), ("Ancash", "Huaraz", "x"), ("Lima", "Lima", None), ("Ica", " ", "x")],
        "Departamento string, Provincia string, other string",
    )
    out = str(tmp_path / "departments")
    flows.build_department_list(spark, sheet, out)
    assert json.loads("".join(text_lines(out))) == [
        {"departamento": "Ancash", "provincias": ["Huaraz", "Yungay"]}, {"departamento": "Ica", "provincias": [""]},
    ]


def test_flatten_rejects(spark):
    docs = spark.createDataFrame(
        [(1, [("1", (1.0, 2.0)), (None, (1.0, 2.0)), ("3", None), ("4", (None, 2.0))]), (2, None), (3, [])],
        "id_via int, housenumbers array<struct<number:string,location:struct<lon:double,lat:double>>>",
    )
    flat = documents.flatten_documents(docs)
    points, rejects = documents.placed_points(flat)
    assert [r.number for r in points.collect()] == ["1", None] and [r.number for r in rejects.collect()] == ["3", "4"]
    strict, more = documents.placed_points(flat, need_number=True)
    assert strict.count() == 1 and more.count() == 3


def test_shapes_are_written_as_bytes(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 2.0)], "x double, y double").withColumn("geometry", point(F.col("x"), F.col("y")))
    writers.write_shapes(df, str(tmp_path / "a"))
    back, _ = readers.read_shapes(spark, str(tmp_path / "a"))
    assert back.first().geometry.kind == "Point"
    writers.write_shapes(spark.read.parquet(str(tmp_path / "a")), str(tmp_path / "b"))
    assert spark.read.parquet(str(tmp_path / "b")).first().geometry == spark.read.parquet(str(tmp_path / "a")).first().geometry


def test_keywords_beside_nested_fields(spark):
    limits = schemas.keyword_limits(schemas.INDEX_MAPPING)
    assert limits["housenumbers.number"] == 256 and "housenumbers.location" not in limits
    row = (1, "n", [("5", (1.0, 2.0)), ("x" * 257, None), (None, None)])
    df = spark.createDataFrame([row], "id int, name string, housenumbers array<struct<number: string, location: struct<lon: double, lat: double>>>")
    got = mapping.with_keywords(df, limits).first()
    assert got.name_keyword == "n" and [h.number_keyword for h in got.housenumbers] == ["5", None, None]
