"""Geographic coordinates to UTM metres (WGS 84) as column math.

Krüger's series to sixth order in the third flattening, after Karney (2011), "Transverse Mercator with an
accuracy of a few nanometers".
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from addrspark.functions.shapes import let, map_vertices, number

# WGS 84 ellipsoid and the UTM grid.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257223563
SCALE = 0.9996
FALSE_EASTING = 500000.0
FALSE_NORTHING_SOUTH = 10000000.0

# Numerators and denominators of the series, one row per harmonic, powers of n rising
# from the harmonic's own number.
SERIES = [
    [(1, 2), (-2, 3), (5, 16), (41, 180), (-127, 288), (7891, 37800)],
    [(13, 48), (-3, 5), (557, 1440), (281, 630), (-1983433, 1935360)],
    [(61, 240), (-103, 140), (15061, 26880), (167603, 181440)],
    [(49561, 161280), (-179, 168), (6601661, 7257600)],
    [(34729, 80640), (-3418889, 1995840)],
    [(212378941, 319334400)],
]

ECCENTRICITY = math.sqrt(FLATTENING * (2 - FLATTENING))
_N = FLATTENING / (2 - FLATTENING)
RECTIFYING_RADIUS = SEMI_MAJOR / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64 + _N**6 / 256)
HARMONICS = [
    sum(p / q * _N ** (j + k) for k, (p, q) in enumerate(row)) for j, row in enumerate(SERIES, start=1)
]


def utm_meridian(zone: int) -> float:
    """Central meridian of a zone in degrees."""
    if not 1 <= zone <= 60:
        raise ValueError(f"UTM zone {zone} is not in 1..60")
    return zone * 6.0 - 183.0


def _conformal(lat: str) -> str:
    """Tangent of the conformal latitude."""
    s, e = f"sin(radians({lat}))", number(ECCENTRICITY)
    return f"sinh(atanh({s}) - {e} * atanh({e} * {s}))"


def _sphere(t: str, offset: str) -> str:
    """Transverse coordinates on the conformal sphere."""
    root = f"sqrt({t} * {t} + cos({offset}) * cos({offset}))"
    return f"named_struct('xi', atan2({t}, cos({offset})), 'eta', asinh(sin({offset}) / {root}))"


def _grid(c: str, south: bool) -> str:
    def series(start: str, first: str, second: str) -> str:
        terms = [
            f"{number(a)} * {first}({number(2.0 * j)} * {c}.xi) * {second}({number(2.0 * j)} * {c}.eta)"
            for j, a in enumerate(HARMONICS, start=1)
        ]
        return " + ".join([start, *terms])

    factor = number(SCALE * RECTIFYING_RADIUS)
    north = number(FALSE_NORTHING_SOUTH if south else 0.0)
    easting = f"{number(FALSE_EASTING)} + {factor} * ({series(f'{c}.eta', 'cos', 'sinh')})"
    northing = f"{north} + {factor} * ({series(f'{c}.xi', 'sin', 'cosh')})"
    return f"named_struct('x', {easting}, 'y', {northing})"


def to_utm(
    df: DataFrame, lon: str = "lon", lat: str = "lat", zone: int = 18, south: bool = True,
    x: str = "x", y: str = "y",
) -> DataFrame:
    """Add easting and northing in metres. Each step is its own projection, so nothing is recomputed."""
    offset = f"radians({lon} - {number(utm_meridian(zone))})"
    return (
        df.withColumn("utm_t", F.expr(_conformal(lat)))
        .withColumn("utm_sphere", F.expr(_sphere("utm_t", offset)))
        .withColumn("utm_grid", F.expr(_grid("utm_sphere", south)))
        .withColumns({x: F.col("utm_grid.x"), y: F.col("utm_grid.y")})
        .drop("utm_t", "utm_sphere", "utm_grid")
    )


def shape_to_utm(geometry: str, zone: int = 18, south: bool = True) -> Column:
    """The shape with degrees replaced by UTM metres."""
    offset = f"radians(v.x - {number(utm_meridian(zone))})"
    sphere = let("t", _conformal("v.y"), _sphere("t", offset))
    return map_vertices(geometry, let("c", sphere, _grid("c", south)))
