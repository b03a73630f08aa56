import math
import random
import struct

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from addrspark import schemas
from addrspark.functions import hexgrid, projection, shapes, wkb
from addrspark.operators import spatial


def ring(*xy):
    return [{"x": float(x), "y": float(y)} for x, y in xy]


def frame(spark, rows):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("geometry", schemas.SHAPE)])
    data = [(i, None if g is None else {"kind": g[0], "parts": g[1]}) for i, g in enumerate(rows)]
    return spark.createDataFrame(data, schema)


SQUARE = ring((0, 0), (10, 0), (10, 10), (0, 10), (0, 0))
REVERSED = SQUARE[::-1]
HOLE = ring((6, 4), (8, 4), (8, 6), (6, 6), (6, 4))


def centers(spark, *geometries):
    df = frame(spark, geometries).orderBy("id").select(shapes.centroid("geometry").alias("c"))
    return [None if r.c is None else (r.c.x, r.c.y) for r in df.collect()]


def test_centroids(spark):
    holed = (100 * 5 - 4 * 7) / 96
    got = centers(
        spark,
        ("Polygon", [[SQUARE]]),
        ("Polygon", [[REVERSED]]),
        ("Polygon", [[SQUARE, HOLE]]),
        ("Polygon", [[REVERSED, HOLE]]),
        ("MultiPolygon", [[SQUARE], [ring((20, 0), (30, 0), (30, 10), (20, 10), (20, 0))]]),
        ("LineString", [[ring((0, 0), (10, 0), (10, 30))]]),
        ("Polygon", [[ring((0, 0), (10, 0), (4, 0), (0, 0))]]),
        ("Polygon", [[ring((3, 4), (3, 4), (3, 4), (3, 4))]]),
        ("Point", [[ring((1, 2))]]),
        ("MultiPoint", [[ring((0, 0))], [ring((2, 4))]]),
        ("Polygon", []),
        None,
    )
    want = [
        (5, 5), (5, 5), (holed, 5), (holed, 5), (15, 5), (5 * 0.25 + 10 * 0.75, 0 * 0.25 + 15 * 0.75), (5, 0), (3, 4),
        (1, 2), (1, 2),
    ]
    for g, w in zip(got, want):
        assert g == pytest.approx(w)
    assert got[10:] == [None, None]


def test_centroid_far_from_origin(spark):
    far = ring(*[(300000 + p["x"], 8660000 + p["y"]) for p in SQUARE])
    assert centers(spark, ("Polygon", [[far]])) == [(300005.0, 8660005.0)]


@pytest.mark.parametrize(
    "x, y, inside",
    [
        (5, 5, True), (0, 5, False), (10, 5, False), (5, 10, False), (0, 0, False), (11, 5, False), (-1, 0, False),
        (7, 5, False), (6, 5, False), (5.9, 5, True), (9, 5, True), (7, 4, False), (5, 0, False),
    ],
)
def test_contains(spark, x, y, inside):
    df = frame(spark, [("Polygon", [[SQUARE, HOLE]])])
    assert df.select(shapes.contains("geometry.parts[0]", f"{float(x)}D", f"{float(y)}D")).first()[0] is inside


def gap(a, b):
    """Segment distance by dense sampling, good to about 0.01."""
    at = lambda s, t: (s[0] + t * (s[2] - s[0]), s[1] + t * (s[3] - s[1]))
    steps = [i / 150 for i in range(151)]
    return min(math.dist(at(a, t), at(b, u)) for t in steps for u in steps)


def test_segment_distance(spark):
    rng = random.Random(3)
    rows = [tuple(rng.uniform(0, 10) for _ in range(8)) for _ in range(25)]
    rows.append((0.0, 0.0, 4.0, 0.0, 4.0, 0.0, 4.0, 0.0))
    rows.append((0.0, 0.0, 10.0, 10.0, 0.0, 10.0, 10.0, 0.0))
    names = [f"c{i}" for i in range(8)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names))
    got = df.withColumn("d", shapes.segment_distance(names[:4], names[4:])).collect()
    for r in got:
        assert r.d == pytest.approx(gap(r[:4], r[4:8]), abs=0.1)
    assert got[-1].d == 0 and got[-2].d == 0


def lot(i, x, y, w=20, h=25):
    return (i, ("Polygon", [[ring((x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y))]]))


def metric(spark, rows, key):
    schema = T.StructType([T.StructField(key, T.LongType()), T.StructField("geometry", schemas.SHAPE)])
    return spark.createDataFrame([(i, {"kind": g[0], "parts": g[1]}) for i, g in rows], schema)


def road(i, *xy):
    return (i, ("LineString", [[ring(*xy)]]))


def brute_force(lots, roads, reach):
    best = {}
    for i, (_, parts) in lots:
        for part, rings in enumerate(parts):
            shell = rings[0]
            for e in range(len(shell) - 1):
                a = (shell[e]["x"], shell[e]["y"], shell[e + 1]["x"], shell[e + 1]["y"])
                if a[:2] == a[2:]:
                    continue
                for _, (_, lines) in roads:
                    for line in lines:
                        for p, q in zip(line[0], line[0][1:]):
                            d = exact(a, (p["x"], p["y"], q["x"], q["y"]))
                            if d <= reach and ((i, part) not in best or d < best[i, part][0]):
                                best[i, part] = (d, e)
    return best


def exact(a, b):
    def to(px, py, s):
        ux, uy = s[2] - s[0], s[3] - s[1]
        n = ux * ux + uy * uy
        t = min(max(((px - s[0]) * ux + (py - s[1]) * uy) / n if n else 0.0, 0.0), 1.0)
        return math.hypot(px - (s[0] + t * ux), py - (s[1] + t * uy))

    side = lambda s, x, y: (s[2] - s[0]) * (y - s[1]) - (s[3] - s[1]) * (x - s[0])
    if side(a, *b[:2]) * side(a, *b[2:]) < 0 and side(b, *a[:2]) * side(b, *a[2:]) < 0:
        return 0.0
    return min(to(*a[:2], b), to(*a[2:], b), to(*b[:2], a), to(*b[2:], a))


@pytest.mark.parametrize("cell", [7.0, 60.0, 1000.0])
def test_grid_join_equals_brute_force(spark, cell):
    rng = random.Random(5)
    lots = [lot(i, rng.uniform(-300, 300), rng.uniform(-300, 300), rng.uniform(5, 90)) for i in range(60)]
    roads = [
        road(i, *[(rng.uniform(-400, 400), rng.uniform(-400, 400)) for _ in range(rng.choice([2, 3]))])
        for i in range(12)
    ]
    parts = spatial.shape_parts(metric(spark, lots, "lot_id"), "lot_id", "geometry")
    segments = spatial.road_segments(metric(spark, roads, "road_id"), "geometry")
    rows = spatial.nearest_edges(spatial.part_edges(parts, "lot_id"), segments, "lot_id", 15.0, cell).collect()
    want = brute_force(lots, roads, 15.0)
    assert {(r.lot_id, r.part) for r in rows} == set(want)
    for r in rows:
        d, edge = want[r.lot_id, r.part]
        assert r.distance == pytest.approx(d, abs=1e-9)
        assert r.edge == edge or d == pytest.approx(0, abs=1e-9)


def points(spark, lots, roads, **options):
    df = spatial.address_points(metric(spark, lots, "lot_id"), metric(spark, roads, "road_id"), **options)
    return {(r.lot_id, r.part): r for r in df.collect()}


def test_address_points(spark):
    street = road(1, (-100, -5), (300, -5))
    far = lot(2, 0, 500)
    both = ("MultiPolygon", [lot(0, 50, 0)[1][1][0], lot(0, 100, 0)[1][1][0]])
    clockwise = ("Polygon", [[lot(0, 200, 0)[1][1][0][0][::-1]]])
    thin = lot(5, 250, 0, 20, 1)
    got = points(spark, [lot(1, 0, 0), far, (3, both), (4, clockwise), thin], [street, street])
    assert {k: (r.x, r.y) for k, r in got.items()} == {
        (1, 0): (10.0, 2.0), (3, 0): (60.0, 2.0), (3, 1): (110.0, 2.0), (4, 0): (202.0, 12.5),  # its first edge ends as near as the one along the street
    }
    assert got[1, 0].distance == 5.0


def test_radius_is_inclusive_and_first_edge_wins(spark):
    at_limit = points(spark, [lot(1, 0, 0)], [road(1, (-100, -15), (100, -15))])
    assert at_limit[1, 0].edge == 0
    assert points(spark, [lot(1, 0, 0)], [road(1, (-100, -15.001), (100, -15.001))]) == {}
    corner = points(spark, [lot(1, 0, 0)], [road(1, (-3, -10), (-3, -3))])
    assert corner[1, 0].edge == 0  # edges 0 and 3 are equally far


def test_edge_without_length_is_skipped(spark):
    shape = ("Polygon", [[ring((0, 0), (0, 0), (20, 0), (20, 25), (0, 25), (0, 0))]])
    assert points(spark, [(1, shape)], [road(1, (-9, -5), (99, -5))])[1, 0].edge == 1


def test_nearest_join_is_an_equi_join(spark):
    parts = spatial.shape_parts(metric(spark, [lot(1, 0, 0)], "lot_id"), "lot_id", "geometry")
    segments = spatial.road_segments(metric(spark, [road(1, (0, 0), (9, 9))], "road_id"), "geometry")
    joined = spatial.nearest_edges(spatial.part_edges(parts, "lot_id"), segments, "lot_id")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def meridian_arc(lat):
    """Simpson integral of the meridian radius of curvature."""
    e2, n = projection.ECCENTRICITY**2, 2000
    f = lambda p: projection.SEMI_MAJOR * (1 - e2) / (1 - e2 * math.sin(p) ** 2) ** 1.5
    h = math.radians(lat) / n
    return h / 3 * sum(f(i * h) * (1 if i in (0, n) else 4 if i % 2 else 2) for i in range(n + 1))


def test_utm_on_the_central_meridian(spark):
    rows = [(-75.0, float(lat)) for lat in (-60, -18, -12, -0.5, 0)]
    df = projection.to_utm(spark.createDataFrame(rows, "lon double, lat double"))
    for r in df.collect():
        assert r.x == pytest.approx(500000.0, abs=1e-6)
        assert r.y == pytest.approx(10000000.0 + projection.SCALE * meridian_arc(r.lat), abs=1e-5)


def snyder(lon, lat):
    """Classical power series (Snyder 1987), good to millimetres near the meridian."""
    e2 = projection.ECCENTRICITY**2
    p, ep = math.radians(lat), e2 / (1 - e2)
    n = projection.SEMI_MAJOR / math.sqrt(1 - e2 * math.sin(p) ** 2)
    t, c, a = math.tan(p) ** 2, ep * math.cos(p) ** 2, math.radians(lon + 75) * math.cos(p)
    x = n * (a + (1 - t + c) * a**3 / 6 + (5 - 18 * t + t * t + 72 * c - 58 * ep) * a**5 / 120)
    y = meridian_arc(lat) + n * math.tan(p) * (
        a * a / 2 + (5 - t + 9 * c + 4 * c * c) * a**4 / 24 + (61 - 58 * t + t * t + 600 * c - 330 * ep) * a**6 / 720
    )
    return 500000 + projection.SCALE * x, 10000000 + projection.SCALE * y


def test_utm_matches_the_classical_series(spark):
    rows = [(-77.0428, -12.0464), (-79.03, -8.11), (-72.0, -16.4), (-75.2, -0.1)]
    df = projection.to_utm(spark.createDataFrame(rows, "lon double, lat double"))
    for r in df.collect():
        assert (r.x, r.y) == pytest.approx(snyder(r.lon, r.lat), abs=0.02)


def test_shape_projection_matches_point_projection(spark):
    shape = frame(spark, [("Polygon", [[ring((-77, -12), (-77.001, -12), (-77, -12.001), (-77, -12))]])])
    moved = shape.select(projection.shape_to_utm("geometry").alias("g")).first().g
    flat = spark.createDataFrame([(-77.001, -12.0)], "lon double, lat double")
    p = projection.to_utm(flat).first()
    assert (moved.parts[0][0][1].x, moved.parts[0][0][1].y) == (p.x, p.y)
    with pytest.raises(ValueError):
        projection.utm_meridian(61)


def test_hexagons_hold_their_points(spark):
    rng = random.Random(2)
    rows = [(rng.uniform(-81, -69), rng.uniform(-18, 0)) for _ in range(300)]
    df = spark.createDataFrame(rows, "lon double, lat double").withColumn("cell", hexgrid.hex_cell("lon", "lat"))
    df = df.withColumn("ring", hexgrid.hex_boundary("cell"))
    # Edges are straight in the projected plane, so the test runs there.
    plane = "transform(ring, v -> named_struct('x', v.x, 'y', sin(radians(v.y))))"
    inside = shapes.contains(f"array({plane})", "lon", "sin(radians(lat))")
    rows = df.withColumn("inside", inside).collect()
    assert all(r.inside for r in rows)
    assert all(len(r.ring) == 7 and r.ring[0] == r.ring[6] for r in rows)
    again = spark.createDataFrame([(r.ring[0].x + r.ring[3].x, r.ring[0].y + r.ring[3].y, r.cell) for r in rows],
                                  "lon double, lat double, cell string")
    middle = again.withColumn("back", hexgrid.hex_cell("lon / 2", "lat / 2"))
    assert all(r.back == r.cell for r in middle.collect())


def test_hexagon_area(spark):
    cells = 2 + 120 * 7**8
    assert 1.5 * math.sqrt(3) * hexgrid.hex_side(8) ** 2 == pytest.approx(4 * math.pi * hexgrid.RADIUS**2 / cells)
    assert spark.range(1).select(hexgrid.hex_cell("double(null)", "1D")).first()[0] is None


def test_hex_index_of_shapes(spark):
    here = ring((-77, -12), (-76.999, -12), (-76.999, -11.999), (-77, -11.999), (-77, -12))
    there = ring((-75, -10), (-74.999, -10), (-74.999, -9.999), (-75, -9.999), (-75, -10))
    df = frame(
        spark,
        [
            ("Point", [[ring((-77, -12))]]), ("Polygon", [[here]]), ("MultiPolygon", [[here], [there], [here]]),
            ("LineString", [[here]]), None, ("Polygon", []),
        ],
    )
    good, rejects = spatial.hex_indexed(df)
    rows = {r.id: r for r in good.collect()}
    assert set(rows) == {0, 1, 2}
    assert rows[1].hex_index == rows[1].hex_cells[0] and len(rows[2].hex_cells) == 3
    assert rows[2].hex_index == str(list(rows[2].hex_cells)) and rows[2].hex_cells[0] == rows[2].hex_cells[2]
    assert rows[2].geometry.kind == "MultiPolygon" and len(rows[2].geometry.parts[1][0]) == 7
    assert rows[0].geometry.kind == "Polygon"
    assert {r.id: r.reason for r in rejects.collect()} == {
        3: "unsupported shape: LineString", 4: "unsupported shape: null", 5: "unsupported shape: Polygon",
    }
    bare, _ = spatial.hex_indexed(df, resolution=7, keep_geometry=False)
    assert "geometry" not in bare.columns and bare.first().hex_index.startswith("r7:")


def test_wkb_round_trip(spark):
    geometries = [
        ("Point", [[ring((1, 2))]]), ("LineString", [[ring((0, 0), (1, 1))]]), ("Polygon", [[SQUARE, HOLE]]),
        ("MultiPoint", [[ring((0, 0))], [ring((2, 4))]]), ("MultiLineString", [[ring((0, 0), (1, 1))]]),
        ("MultiPolygon", [[SQUARE, HOLE], [REVERSED]]), ("Polygon", []), ("Point", []), None,
    ]
    df = frame(spark, geometries).withColumn("b", wkb.encode_wkb(F.col("geometry")))
    for r in df.withColumn("back", wkb.decode_wkb(F.col("b"))).collect():
        assert r.back == r.geometry


def test_wkb_dialects(spark):
    big_endian = struct.pack(">BIdd", 0, 1, 1.5, -2.5)
    with_srid = struct.pack("<BIIdd", 1, 1 | 0x20000000, 4326, 1.5, -2.5)
    with_z = struct.pack("<BIddd", 1, 1001, 1.5, -2.5, 9.0)
    ewkb_z = struct.pack("<BIddd", 1, 1 | 0x80000000, 1.5, -2.5, 9.0)
    df = spark.createDataFrame([(b,) for b in (big_endian, with_srid, with_z, ewkb_z)], "geometry binary")
    good, bad = wkb.decode_shapes(df, "geometry")
    assert [(r.geometry.parts[0][0][0].x, r.geometry.parts[0][0][0].y) for r in good.collect()] == [(1.5, -2.5)] * 4
    assert bad.count() == 0


def test_malformed_wkb_is_rejected(spark):
    whole = struct.pack("<BIdd", 1, 1, 1.5, -2.5)
    rows = [(whole[:-1],), (b"",), (b"\x07" + whole[1:],), (struct.pack("<BI", 1, 99),), (None,), (whole,)]
    good, bad = wkb.decode_shapes(spark.createDataFrame(rows, "geometry binary"), "geometry")
    assert good.count() == 1 and bad.count() == 5
    collection = struct.pack("<BII", 1, 7, 1) + whole
    shape = spark.createDataFrame([(collection,)], "b binary").select(wkb.decode_wkb(F.col("b"))).first()[0]
    assert shape.kind == "GeometryCollection" and shape.parts == []


def test_point_bytes_match_the_shape_encoder(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 1.0)], "x double, y double").select(
        wkb.point_wkb(F.col("x"), F.col("y")).alias("a"),
        wkb.encode_wkb(shapes.point(F.col("x"), F.col("y"))).alias("b"),
    )
    first, second = df.collect()
    assert first.a == first.b and second.a is None
