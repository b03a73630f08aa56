"""Crowded squares are cut until both sides are few, and nothing is lost."""

import math
import random

import pytest
from pyspark.sql import functions as F

from addrspark.operators import quadtree, spatial


def to_segment(px, py, ax, ay, bx, by):
    dx, dy = bx - ax, by - ay
    t = 0.0 if dx == dy == 0 else max(0.0, min(1.0, ((px - ax) * dx + (py - ay) * dy) / (dx * dx + dy * dy)))
    return math.hypot(px - ax - t * dx, py - ay - t * dy)


def apart(e, r):
    """Distance of segments that do not cross (the data has none that do)."""
    ends = [to_segment(*e[:2], *r), to_segment(*e[2:], *r), to_segment(*r[:2], *e), to_segment(*r[2:], *e)]
    return min(ends)


@pytest.fixture(scope="module")
def crowd(spark):
    """Short edges and roads, all inside one cell of the grid, the roads a little below the edges."""
    rng = random.Random(1)
    edges, roads = [], []
    for i in range(1500):
        x, y = rng.uniform(1, 58), rng.uniform(1, 58)
        edges.append((i, 0, 0, x, y, x + 0.2, y))
    for _ in range(1500):
        x, y = rng.uniform(1, 58), rng.uniform(1, 58)
        roads.append((x, y, x + rng.uniform(0.05, 0.3), y))
    roads.append((1.0, 30.0, 58.0, 30.0))  # one that passes through everything
    edge_rows = spark.createDataFrame(edges, "id int, part int, edge int, x1 double, y1 double, x2 double, y2 double")
    return edges, roads, edge_rows, spark.createDataFrame(roads, "x1 double, y1 double, x2 double, y2 double")


def test_leaves_hold_few_pairs(crowd):
    _, _, edge_rows, road_rows = crowd
    placed = [df.select("*", F.lit(0).cast("bigint").alias("quad_x"), F.lit(0).cast("bigint").alias("quad_y")) for df in (edge_rows, road_rows)]
    for most, least in ((20_000, 10), (2_000, 50)):
        left, right = quadtree.leaves(*placed, 60.0, 0.5, 0.001, most_pairs=most)
        sizes = [{tuple(r[:3]): r["count"] for r in df.groupBy(*quadtree.SQUARE).count().collect()} for df in (left, right)]
        assert max(n * sizes[1].get(square, 0) for square, n in sizes[0].items()) <= most
        assert len(sizes[0]) > least
        # A short edge meets few leaves: cutting does not multiply rows without end.
        assert sum(sizes[0].values()) < 4 * 1500
    whole = quadtree.leaves(*placed, 60.0, 0.5, 0.001, most_pairs=10**9)
    assert whole[0].count() == 1500 and whole[1].count() == 1501


def test_rows_that_are_all_near_each_other_stay_whole(spark):
    rows = spark.createDataFrame([(30.0, 30.0, 30.1, 30.0)] * 300, "x1 double, y1 double, x2 double, y2 double")
    placed = rows.select("*", F.lit(0).cast("bigint").alias("quad_x"), F.lit(0).cast("bigint").alias("quad_y"))
    left, right = quadtree.leaves(placed, placed, 60.0, 15.0, 0.001, most_pairs=100)
    assert left.count() <= 4 * 300 and right.count() <= 4 * 300


@pytest.mark.parametrize("most_pairs", [500, 50_000, None])
def test_nearest_edges_of_a_crowd(crowd, most_pairs):
    edges, roads, edge_rows, road_rows = crowd
    want = {}
    for i, part, _, *e in edges:
        best = min(apart(e, r) for r in roads)
        if best <= 0.5:
            want[i, part] = best
    found = spatial.nearest_edges(edge_rows, road_rows, "id", 0.5, 60.0, most_pairs).collect()
    got = {(r["id"], r.part): r.distance for r in found}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_long_diagonals_and_empty_sides(spark):
    rng = random.Random(2)
    edges = [(i, 0, 0, *(rng.uniform(-200, 200) for _ in range(2))) for i in range(200)]
    edges = [(*e, e[3] + 1, e[4]) for e in edges]
    roads = [(-250.0, -240.0, 260.0, 250.0), (200.0, -200.0, -200.0, 190.0)]
    table = spark.createDataFrame(edges, "id int, part int, edge int, x1 double, y1 double, x2 double, y2 double")
    lines = spark.createDataFrame(roads, "x1 double, y1 double, x2 double, y2 double")
    plain = {tuple(r) for r in spatial.nearest_edges(table, lines, "id", 15.0).collect()}
    cut = {tuple(r) for r in spatial.nearest_edges(table, lines, "id", 15.0, 500.0, most_pairs=2).collect()}
    assert plain == cut and plain
    assert spatial.nearest_edges(table, lines.limit(0), "id", 15.0, most_pairs=1).count() == 0
    assert spatial.nearest_edges(table.limit(0), lines, "id", 15.0, most_pairs=1).count() == 0
