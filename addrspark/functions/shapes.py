"""Column math on shapes: ``struct<kind, parts array<array<array<struct<x, y>>>>>``.

A part is a list of rings (polygon: shell first, then holes), a single line, or a single point; every
shape kind has the same form. Arguments are column names or SQL expressions, since nested lambdas read
best in SQL; results are columns evaluated in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

POLYGONAL = ["Polygon", "MultiPolygon"]
LINEAR = ["LineString", "MultiLineString"]


def number(value: float) -> str:
    """A DOUBLE literal."""
    return f"({value!r}D)"


def let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, which is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def one_of(kind: str, kinds: list[str]) -> str:
    names = ", ".join(f"'{k}'" for k in kinds)
    return f"({kind} IN ({names}))"


def vertex(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def shape(kind: str, parts: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), parts.alias("parts"))


def point(x: Column, y: Column) -> Column:
    return shape("Point", F.array(F.array(F.array(vertex(x, y)))))


def _steps(ring: str, body: str) -> str:
    """``body`` for every pair ``p``, ``q`` of consecutive vertices."""
    n = f"greatest(size({ring}) - 1, 0)"
    return f"zip_with(slice({ring}, 1, {n}), slice({ring}, 2, {n}), (p, q) -> {body})"


def edges(ring: str) -> Column:
    """Consecutive vertex pairs of a ring or line as ``array<struct<x1, y1, x2, y2>>``."""
    return F.expr(_steps(ring, "named_struct('x1', p.x, 'y1', p.y, 'x2', q.x, 'y2', q.y)"))


def _moment(w: str, mx: str, my: str) -> str:
    return f"named_struct('w', {w}, 'mx', {mx}, 'my', {my})"


def _total(moments: str) -> str:
    add = _moment("a.w + m.w", "a.mx + m.mx", "a.my + m.my")
    return f"aggregate({moments}, {_moment('0D', '0D', '0D')}, (a, m) -> {add})"


def _walked(ring: str, weight: str, share: str) -> str:
    """Total over every pair ``a.p``, ``q`` of consecutive vertices, of weight ``c`` and moments ``share``.

    One walk that carries the vertex before, as lambdas run uncompiled and each array between them costs a pass.
    """
    n = f"greatest(size({ring}) - 1, 0)"
    begin = "named_struct('p', try_element_at({ring}, 1), 'w', 0D, 'mx', 0D, 'my', 0D)".format(ring=ring)
    step = "named_struct('p', q, 'w', a.w + c, 'mx', a.mx + {x}, 'my', a.my + {y})".format(
        x=share.format(axis="x"), y=share.format(axis="y")
    )
    return f"aggregate(slice({ring}, 2, {n}), {begin}, (a, q) -> {let('c', weight, step)})"


def _area_moment(ring: str) -> str:
    """Doubled signed area of a ring and its first moments, relative to the vertex ``o``."""
    cross = "((a.p.x - o.x) * (q.y - o.y) - (q.x - o.x) * (a.p.y - o.y))"
    return _walked(ring, cross, "((a.p.{axis} - o.{axis}) + (q.{axis} - o.{axis})) * c")


def _length_moment(ring: str) -> str:
    length = "sqrt((q.x - a.p.x) * (q.x - a.p.x) + (q.y - a.p.y) * (q.y - a.p.y))"
    return _walked(ring, length, "((a.p.{axis} - o.{axis}) + (q.{axis} - o.{axis})) / 2D * c")


def _point_moment(ring: str) -> str:
    return _total(f"transform({ring}, p -> {_moment('1D', 'p.x - o.x', 'p.y - o.y')})")


def _signed_area_moment(ring: str, index: str) -> str:
    """Shells count positive and holes negative, whichever way they are wound."""
    factor = f"(CASE WHEN s.w < 0 THEN -1D ELSE 1D END * CASE WHEN {index} > 0 THEN -1D ELSE 1D END)"
    return let("s", _area_moment(ring), _moment(f"s.w * {factor}", f"s.mx * {factor}", f"s.my * {factor}"))


def _over_rings(parts: str, body: str) -> str:
    return _total(f"flatten(transform({parts}, part -> transform(part, (ring, i) -> {body})))")


def centroid_sql(parts: str, areal: str, linear: str) -> str:
    """Centroid of parts: by area; by length if there is none; else mean of the vertices."""

    def weighted(moment: str, divisor: str, otherwise: str) -> str:
        at = "named_struct('x', o.x + t.mx / ({d} * t.w), 'y', o.y + t.my / ({d} * t.w))".format(d=divisor)
        return let("t", moment, f"CASE WHEN t.w <> 0 THEN {at} ELSE {otherwise} END")

    by_points = weighted(_over_rings(parts, _point_moment("ring")), "1D", "NULL")
    by_length = weighted(_over_rings(parts, _length_moment("ring")), "1D", by_points)
    by_area = weighted(_over_rings(parts, _signed_area_moment("ring", "i")), "3D", by_length)
    choice = f"CASE WHEN {areal} THEN {by_area} WHEN {linear} THEN {by_length} ELSE {by_points} END"
    return let("o", f"try_element_at(flatten(flatten({parts})), 1)", choice)


def centroid(geometry: str) -> Column:
    """``struct<x, y>`` of the whole shape."""
    kind = f"{geometry}.kind"
    return F.expr(centroid_sql(f"{geometry}.parts", one_of(kind, POLYGONAL), one_of(kind, POLYGONAL + LINEAR)))


def map_vertices(geometry: str, body: str) -> Column:
    """The shape with every vertex ``v`` replaced by ``body``."""
    moved = f"transform({geometry}.parts, part -> transform(part, ring -> transform(ring, v -> {body})))"
    return F.expr(
        f"CASE WHEN {geometry} IS NOT NULL THEN named_struct('kind', {geometry}.kind, 'parts', {moved}) END"
    )


def contains(part: str, x: str, y: str) -> Column:
    """Strictly inside a polygon part: on none of its rings, and an odd number of their edges to the right."""
    spans = "((p.y > at.y) <> (q.y > at.y))"
    hit = "p.x + try_divide((at.y - p.y) * (q.x - p.x), q.y - p.y)"
    on_edge = (
        "(q.x - p.x) * (at.y - p.y) = (q.y - p.y) * (at.x - p.x)"
        " AND at.x BETWEEN least(p.x, q.x) AND greatest(p.x, q.x)"
        " AND at.y BETWEEN least(p.y, q.y) AND greatest(p.y, q.y)"
    )
    step = f"CASE WHEN {on_edge} THEN 'on' WHEN {spans} AND {hit} > at.x THEN 'right' ELSE 'clear' END"
    sides = f"flatten(transform({part}, ring -> {_steps('ring', step)}))"
    odd = "size(filter(sides, s -> s = 'right')) % 2 = 1 AND NOT array_contains(sides, 'on')"
    return F.expr(let("at", f"named_struct('x', {x}, 'y', {y})", let("sides", sides, odd)))


def _gap(px: str, py: str, ax: str, ay: str, bx: str, by: str) -> str:
    """Squared distance from the point p to the segment a-b; a = b is a point."""
    ux, uy = f"({bx} - {ax})", f"({by} - {ay})"
    along = f"try_divide(({px} - {ax}) * {ux} + ({py} - {ay}) * {uy}, {ux} * {ux} + {uy} * {uy})"
    t = f"least(greatest(coalesce({along}, 0D), 0D), 1D)"
    dx, dy = f"({px} - ({ax} + {t} * {ux}))", f"({py} - ({ay} + {t} * {uy}))"
    return f"({dx} * {dx} + {dy} * {dy})"


def _side(ax: str, ay: str, bx: str, by: str, px: str, py: str) -> str:
    return f"signum(({bx} - {ax}) * ({py} - {ay}) - ({by} - {ay}) * ({px} - {ax}))"


def segment_distance(a: list[str], b: list[str]) -> Column:
    """Distance between two segments given as ``[x1, y1, x2, y2]``; 0 when they cross.

    Touching segments need no crossing test: an end then is at distance 0.
    """
    start, end, left, right = a[:2], a[2:], b[:2], b[2:]
    crossing = (
        f"{_side(*a, *left)} * {_side(*a, *right)} < 0 AND {_side(*b, *start)} * {_side(*b, *end)} < 0"
    )
    gaps = ", ".join([_gap(*start, *b), _gap(*end, *b), _gap(*left, *a), _gap(*right, *a)])
    return F.expr(f"CASE WHEN {crossing} THEN 0D ELSE sqrt(least({gaps})) END")
