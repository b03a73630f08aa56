"""Hexagon cells of equal area as column math.

Points go through the cylindrical equal-area projection to a plane tiled with pointy-top hexagons. A cell
id is ``r<resolution>:<q>:<r>`` in axial coordinates. Sizes follow the usual aperture-7 sequence of
2 + 120 * 7^resolution cells per globe, so resolution 8 is about 0.74 km2.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from addrspark.functions.shapes import POLYGONAL, centroid_sql, let, number, one_of

RADIUS = 6371007.181
# Hexagons are regular on the ground at this latitude and stretched, at equal area, elsewhere.
STANDARD_PARALLEL = 10.0
_K = math.cos(math.radians(STANDARD_PARALLEL))
# Squared side of a hexagon as large as the globe.
_AREA_FACTOR = 8 * math.pi * RADIUS**2 / (3 * math.sqrt(3))


def hex_side(resolution: int) -> float:
    """Side of a cell in projected metres."""
    return math.sqrt(_AREA_FACTOR / (2 + 120 * 7**resolution))


def _axial(lon: str, lat: str, resolution: int) -> str:
    """``struct<q, r>`` of the cell holding the point."""
    side = number(hex_side(resolution))
    plane = (
        f"named_struct('x', radians({lon}) * {number(RADIUS * _K)},"
        f" 'y', sin(radians({lat})) * {number(RADIUS / _K)})"
    )
    fraction = (
        f"named_struct('q', (p.x * {number(math.sqrt(3) / 3)} - p.y / 3D) / {side},"
        f" 'r', (p.y * {number(2 / 3)}) / {side})"
    )
    rounded = (
        "named_struct('fq', f.q, 'fr', f.r, 'q', floor(f.q + 0.5D), 'r', floor(f.r + 0.5D),"
        " 's', floor(-f.q - f.r + 0.5D))"
    )
    # The coordinate that was rounded furthest follows from the other two.
    dq, dr, ds = "abs(n.q - n.fq)", "abs(n.r - n.fr)", "abs(n.s + n.fq + n.fr)"
    repaired = (
        f"CASE WHEN {dq} > {dr} AND {dq} > {ds} THEN named_struct('q', -n.r - n.s, 'r', n.r)"
        f" WHEN {dr} > {ds} THEN named_struct('q', n.q, 'r', -n.q - n.s)"
        " ELSE named_struct('q', n.q, 'r', n.r) END"
    )
    return let("n", let("f", let("p", plane, fraction), rounded), repaired)


def _id(axial: str, resolution: int) -> str:
    return f"concat_ws(':', 'r{resolution}', string({axial}.q), string({axial}.r))"


def hex_cell(lon: str, lat: str, resolution: int = 8) -> Column:
    """Cell id of a point; null for a null coordinate."""
    cell = let("h", _axial(lon, lat, resolution), _id("h", resolution))
    return F.expr(f"CASE WHEN {lon} IS NOT NULL AND {lat} IS NOT NULL THEN {cell} END")


def _boundary(axial: str, side: str) -> str:
    """Closed ring of seven (lon, lat) vertices."""
    center = (
        f"named_struct('x', ({axial}.q * {number(math.sqrt(3))} + {axial}.r * {number(math.sqrt(3) / 2)}) * {side},"
        f" 'y', {axial}.r * {side} * 1.5D)"
    )

    def corner(k: int) -> str:
        angle = math.radians(60 * k + 30)
        x = f"(c.x + {side} * {number(math.cos(angle))})"
        y = f"(c.y + {side} * {number(math.sin(angle))}) * {number(_K / RADIUS)}"
        return (
            f"named_struct('x', degrees({x} / {number(RADIUS * _K)}),"
            f" 'y', degrees(asin(least(greatest({y}, -1D), 1D))))"
        )

    return let("c", center, f"array({', '.join(corner(k % 6) for k in range(7))})")


def hex_boundary(cell: str) -> Column:
    """Boundary ring of a cell id, whatever its resolution."""
    parsed = "named_struct('q', bigint(id[1]), 'r', bigint(id[2]), 'resolution', double(substring(id[0], 2)))"
    side = f"sqrt({number(_AREA_FACTOR)} / (2D + 120D * pow(7D, h.resolution)))"
    ring = let("h", let("id", f"split({cell}, ':')", parsed), let("side", side, _boundary("h", "side")))
    return F.expr(f"CASE WHEN {cell} IS NOT NULL THEN {ring} END")


def supported(geometry: str) -> Column:
    """True for a point, polygon or multipolygon that has at least one part."""
    known = one_of(f"{geometry}.kind", ["Point", *POLYGONAL])
    return F.expr(f"coalesce({known} AND size({geometry}.parts) > 0, false)")


def shape_cells(geometry: str, resolution: int = 8, boundary: bool = True) -> Column:
    """Per part of a supported shape ``struct<cell, boundary>``, in part order; ``struct<cell>`` without ``boundary``.

    A point counts itself, a polygon its centroid.
    """
    areal = one_of(f"{geometry}.kind", POLYGONAL)
    axial = let("g", centroid_sql("array(piece)", areal, areal), _axial("g.x", "g.y", resolution))
    ring = f", 'boundary', {_boundary('h', number(hex_side(resolution)))}" if boundary else ""
    cell = f"named_struct('cell', {_id('h', resolution)}{ring})"
    return F.expr(f"transform({geometry}.parts, piece -> {let('h', axial, cell)})")
