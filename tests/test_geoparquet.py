"""Parquet with a footer about its shapes."""

import json
import struct

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from addrspark.sinks import geoparquet

CRS = '{"type": "GeographicCRS", "name": "WGS 84", "id": {"authority": "EPSG", "code": 4326}}'


def point(x, y):
    return struct.pack("<BIdd", 1, 1, x, y)


@pytest.fixture(scope="module")
def points(spark):
    rows = [(i, point(i, -i)) for i in range(20)] + [(99, None), (100, point(float("nan"), float("nan")))]
    return spark.createDataFrame(rows, "id bigint, place binary").repartition(3)


def files(path):
    return sorted(f for f in path.iterdir() if not f.name.startswith(("_", ".")))


def test_every_file_says_what_it_holds(spark, points, tmp_path):
    path = tmp_path / "out"
    geoparquet.write_geoparquet(points, str(path), "place", CRS)
    assert len(files(path)) == 3 and not [f for f in path.iterdir() if f.is_dir()]
    for file in files(path):
        geo = json.loads(pq.read_schema(file).metadata[b"geo"])
        column = geo["columns"]["place"]
        assert geo["primary_column"] == "place" and column["geometry_types"] == ["Point"] and column["crs"]["id"]["code"] == 4326
        xs = [struct.unpack("<dd", p[5:])[0] for p in pq.read_table(file).column("place").to_pylist() if p]
        assert column["bbox"][0] == min(x for x in xs if x == x) and column["bbox"][2] == max(x for x in xs if x == x)
    box = geoparquet.geo_metadata(spark, str(path)).agg(F.min("xmin"), F.min("ymin"), F.max("xmax"), F.max("ymax")).first()
    assert tuple(box) == (0, -19, 19, 0)
    good, bad, crs = geoparquet.read_geoparquet(spark, str(path))
    assert json.loads(crs) == json.loads(CRS)
    assert good.filter("place.kind = 'Point'").count() == 21 and [r.id for r in bad.collect()] == [99]


def test_modes(spark, points, tmp_path):
    path = f"file://{tmp_path}/out"
    geoparquet.write_geoparquet(points, path, "place")
    with pytest.raises(FileExistsError):
        geoparquet.write_geoparquet(points, path, "place")
    geoparquet.write_geoparquet(points, path, "place", mode="append")
    assert spark.read.parquet(path).count() == 44
    geoparquet.write_geoparquet(points.limit(5), path, "place", mode="overwrite")
    assert spark.read.parquet(path).count() == 5
    with pytest.raises(ValueError, match="unknown mode"):
        geoparquet.write_geoparquet(points, path, "place", mode="ignore")


def test_a_failed_task_leaves_no_file(spark, points, tmp_path):
    path = tmp_path / "out"
    geoparquet.write_geoparquet(points, str(path), "place")
    before = {f.name: f.stat().st_mtime_ns for f in files(path)}
    broken = points.unionByName(spark.createDataFrame([(7, b"\x01\x09")], points.schema))
    for mode in ("append", "overwrite"):
        with pytest.raises(Exception, match="(?s).*"):
            geoparquet.write_geoparquet(broken, str(path), "place", mode=mode)
        assert {f.name: f.stat().st_mtime_ns for f in files(path)} == before
        assert not [f for f in path.iterdir() if f.is_dir()]


def test_footers_must_agree(spark, points, tmp_path):
    path = str(tmp_path / "out")
    geoparquet.write_geoparquet(points, path, "place")
    geoparquet.write_geoparquet(points, path, "place", CRS, mode="append")
    with pytest.raises(ValueError, match="not the same"):
        geoparquet.read_geoparquet(spark, path)
    plain = str(tmp_path / "plain")
    points.write.parquet(plain)
    assert {r.primary_column for r in geoparquet.geo_metadata(spark, plain).collect()} == {None}
    with pytest.raises(ValueError, match="name no shape column"):
        geoparquet.read_geoparquet(spark, plain)


def test_nothing_to_write(spark, points, tmp_path):
    geoparquet.write_geoparquet(points.limit(0), str(tmp_path / "out"), "place")
    assert files(tmp_path / "out") == []
