"""Lots, roads and shapes: nearest frontage, address points, hexagon index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from addrspark.functions import hexgrid
from addrspark.functions.shapes import LINEAR, POLYGONAL, contains, edges, segment_distance
from addrspark.functions.text import list_text
from addrspark.operators import quadtree

ENDS = ["x1", "y1", "x2", "y2"]
# Search radius and inward offset in metres.
MAX_DISTANCE = 15.0
INSET = 2.0
CELL = 60.0
# Metres; no projected coordinate on the globe is larger.
MAX_COORDINATE = 1.0e8


def shape_parts(shapes: DataFrame, key: str, geometry: str) -> DataFrame:
    """One row per polygon of a polygon or multipolygon: key, part (from 0), rings."""
    return shapes.filter(F.col(geometry).kind.isin(POLYGONAL)).select(
        key, F.posexplode(F.col(geometry).parts).alias("part", "rings")
    )


def part_edges(parts: DataFrame, key: str) -> DataFrame:
    """Edges of each shell: key, part, edge (from 0), x1, y1, x2, y2. Edges without length are left out."""
    exploded = parts.select(key, "part", F.posexplode(edges("rings[0]")).alias("edge", "ends"))
    flat = exploded.select(key, "part", "edge", *[F.col(f"ends.{c}").alias(c) for c in ENDS])
    return flat.filter(_finite()).filter((F.col("x1") != F.col("x2")) | (F.col("y1") != F.col("y2")))


def road_segments(roads: DataFrame, geometry: str) -> DataFrame:
    """Distinct straight segments of all lines. Only positions matter, so copies are dropped."""
    lines = roads.filter(F.col(geometry).kind.isin(LINEAR)).select(
        F.explode(F.flatten(F.col(geometry).parts)).alias("line")
    )
    return (
        lines.select(F.explode(edges("line")).alias("ends"))
        .select(*[F.col(f"ends.{c}").alias(c) for c in ENDS])
        .filter(_finite())
        .distinct()
    )


def _finite() -> Column:
    """An edge with an infinite or missing coordinate is near nothing."""
    return F.greatest(*[F.abs(F.col(c)) for c in ENDS]) < F.lit(MAX_COORDINATE)


def _on_grid(df: DataFrame, size: float, pad: float) -> DataFrame:
    """Repeat each segment for every grid cell its box, grown by ``pad``, meets.

    A long segment is covered piece by piece, so a diagonal does not claim its whole bounding box. The
    segment itself stays in one piece for the exact distance.
    """
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    pieces = F.greatest(F.ceil(F.greatest(F.abs(dx), F.abs(dy)) / F.lit(4 * size)), F.lit(1).cast("bigint"))

    def span(start: str, step: Column) -> Column:
        a = F.col(start) + step * (F.col("piece") / F.col("pieces"))
        b = F.col(start) + step * ((F.col("piece") + 1) / F.col("pieces"))
        low = F.floor((F.least(a, b) - pad) / F.lit(size))
        high = F.floor((F.greatest(a, b) + pad) / F.lit(size))
        return F.sequence(low, high)

    return (
        df.withColumn("pieces", pieces)
        .withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("pieces") - 1)))
        .withColumns({"cells_x": span("x1", dx), "cells_y": span("y1", dy)})
        .withColumn("cell_x", F.explode("cells_x"))
        .withColumn("cell_y", F.explode("cells_y"))
        .drop("pieces", "piece", "cells_x", "cells_y")
    )


def nearest_edges(
    edge_rows: DataFrame,
    segments: DataFrame,
    key: str,
    max_distance: float = MAX_DISTANCE,
    cell: float = CELL,
    most_pairs: int | None = None,
) -> DataFrame:
    """Per (key, part) the edge nearest to any road within ``max_distance``: edge, distance.

    Equal distances go to the lowest edge. Edges and roads meet through an equi-join on grid cells: two
    things within the radius always share one. The smallest (distance, edge) of a part combines before
    anything is shuffled again, and a crowded cell is split by adaptive execution because edges are
    independent of each other. Where cells may be crowded on both sides, ``most_pairs`` lets them be cut by a
    quadtree until they hold no more pairs than that, if cutting helps.
    """
    reach = 0.001  # metres; absorbs rounding in the cell bounds
    left = _on_grid(edge_rows, cell, max_distance + reach)
    right = _on_grid(segments, cell, reach)
    on = ["cell_x", "cell_y"]
    if most_pairs is not None:
        named = [df.withColumnsRenamed({"cell_x": "quad_x", "cell_y": "quad_y"}).distinct() for df in (left, right)]
        left, right = quadtree.leaves(*named, cell, max_distance + reach, reach, most_pairs)
        on = quadtree.SQUARE
    right = right.withColumnsRenamed({c: f"road_{c}" for c in ENDS})

    def apart(a: str, b: str) -> Column:
        """Lower bound of the distance along one axis."""
        return F.greatest(
            F.least(F.col(f"road_{a}"), F.col(f"road_{b}")) - F.greatest(F.col(a), F.col(b)),
            F.least(F.col(a), F.col(b)) - F.greatest(F.col(f"road_{a}"), F.col(f"road_{b}")),
        )

    near = (
        left.join(right, on)
        .filter((apart("x1", "x2") <= max_distance) & (apart("y1", "y2") <= max_distance))
        .select(
            key,
            "part",
            "edge",
            segment_distance(ENDS, [f"road_{c}" for c in ENDS]).alias("distance"),
        )
        .filter(F.col("distance") <= max_distance)
    )
    best = F.min(F.struct("distance", "edge")).alias("best")
    return near.groupBy(key, "part").agg(best).select(key, "part", "best.edge", "best.distance")


def address_points(
    lots: DataFrame,
    roads: DataFrame,
    key: str = "lot_id",
    geometry: str = "geometry",
    max_distance: float = MAX_DISTANCE,
    inset: float = INSET,
    cell: float = CELL,
    most_pairs: int | None = None,
) -> DataFrame:
    """One point per lot part, ``inset`` metres inside the middle of the edge nearest to a road.

    Shapes are in metres; ``key`` is unique per lot. A part without a road in reach gives no row, nor does
    one where neither side of the edge lies inside. Columns: key, part, edge, distance, x, y.
    """
    parts = shape_parts(lots, key, geometry)
    best = nearest_edges(part_edges(parts, key), road_segments(roads, geometry), key, max_distance, cell, most_pairs)
    shell = F.col("rings")[0]
    start, end = F.element_at(shell, F.col("edge") + 1), F.element_at(shell, F.col("edge") + 2)
    faced = best.join(parts, [key, "part"]).select(
        key, "part", "edge", "distance", "rings",
        start.x.alias("x1"), start.y.alias("y1"), end.x.alias("x2"), end.y.alias("y2"),
    )
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    length = F.sqrt(dx * dx + dy * dy)
    moved = faced.withColumns(
        {
            "mid_x": F.col("x1") + dx * 0.5,
            "mid_y": F.col("y1") + dy * 0.5,
            "off_x": -dy / length * inset,
            "off_y": dx / length * inset,
        }
    )
    plus = contains("rings", "mid_x + off_x", "mid_y + off_y")
    minus = contains("rings", "mid_x - off_x", "mid_y - off_y")
    side = F.when(plus, F.lit(1.0)).when(minus, F.lit(-1.0))
    return (
        moved.withColumn("side", side)
        .filter(F.col("side").isNotNull())
        .select(
            key, "part", "edge", "distance",
            (F.col("mid_x") + F.col("side") * F.col("off_x")).alias("x"),
            (F.col("mid_y") + F.col("side") * F.col("off_y")).alias("y"),
        )
    )


def hex_indexed(
    shapes: DataFrame, geometry: str = "geometry", resolution: int = 8, keep_geometry: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(shapes with their hexagon index, rejects of an unsupported kind).

    ``hex_cells`` lists one cell per part, ``hex_index`` is the cell of a single shape or the list printed
    as text. The geometry becomes the hexagon (one per part) or, without ``keep_geometry``, is dropped.
    Every row is worked on by itself: no shuffle.
    """
    usable = hexgrid.supported(geometry)
    cells = shapes.filter(usable).withColumn("hexes", hexgrid.shape_cells(geometry, resolution, keep_geometry))
    multi = F.col(geometry).kind == "MultiPolygon"
    names = F.expr("transform(hexes, h -> h.cell)")
    index = {"hex_cells": names, "hex_index": F.when(multi, list_text(names)).otherwise(names[0])}
    if keep_geometry:
        index[geometry] = F.struct(
            F.when(multi, F.lit("MultiPolygon")).otherwise(F.lit("Polygon")).alias("kind"),
            F.expr("transform(hexes, h -> array(h.boundary))").alias("parts"),
        )
    indexed = cells.withColumns(index).drop("hexes")
    reason = F.concat(F.lit("unsupported shape: "), F.coalesce(F.col(geometry).kind, F.lit("null")))
    rejects = shapes.filter(~usable).withColumn("reason", reason)
    return (indexed if keep_geometry else indexed.drop(geometry)), rejects
