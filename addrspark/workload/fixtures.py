"""Address-like views over the test tables (see FIXTURES.md).

The statements are valid in Spark SQL and in DuckDB: `{name}` stands for a table, exponents keep numbers
DOUBLE in both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from addrspark.functions.shapes import shape, vertex
from addrspark.functions.wkb import encode_wkb
from addrspark.sources.readers import spread

NBSP = "\u00a0"

DOORS = """
SELECT l_orderkey AS id_via,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_linenumber AS BIGINT) END AS numpuerta,
       CASE l_returnflag WHEN 'A' THEN 'AV' WHEN 'R' THEN 'JR' END AS tipo_via,
       'VIA ' || CAST(l_orderkey % 500 AS STRING) AS nom_via,
       CASE WHEN l_suppkey % 10 = 0 THEN l_suppkey + 900000000 ELSE l_suppkey END AS ubigeo,
       -77e0 + l_partkey / 1e4 AS lon_x,
       -12e0 + l_linenumber / 1e3 + l_quantity / 1e5 AS lat_y
FROM {lineitem}
"""

DISTRICTS = """
SELECT s_suppkey AS postcode, r_name AS cod_departament, n_name AS cod_province, s_name AS cod_district,
       'REGION ' || CAST(n_nationkey % 3 AS STRING) AS context
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
"""

DISTRICT_EDITIONS = (
    "SELECT postcode, cod_departament, cod_province, cod_district, context, 1 AS edition FROM ("
    + DISTRICTS
    + ") UNION ALL SELECT postcode, cod_departament, cod_province, cod_district || ' (2022)', context,"
    " 2 AS edition FROM ("
    + DISTRICTS
    + ") WHERE cod_departament <> 'REGION_1'"
)

_LOT_NAMES = (
    "CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 11 = 0 THEN '" + NBSP * 2 + "' ELSE event_type END"
)

LOTS = f"""
SELECT {_LOT_NAMES} AS manzana,
       CASE WHEN event_id % 7 = 0 THEN '  ' ELSE CAST(event_id % 50 AS STRING) END AS lote,
       'URB ' || CAST(user_id % 20 AS STRING) AS nombre_urbanizacion,
       CASE WHEN user_id % 2 = 0 THEN 'X' ELSE '' END || CAST(user_id AS STRING) AS id_urb,
       user_id % 120 AS postcode,
       -77e0 + value / 1e3 AS lon,
       -12e0 - value / 1e3 AS lat
FROM {{events}}
"""

LOT_CORNERS = f"""
SELECT event_id,
       {_LOT_NAMES} AS name_manzana,
       CASE WHEN event_id % 7 = 0 THEN '  ' ELSE CAST(event_id % 50 AS STRING) END AS name_lote,
       'URB ' || CAST(user_id % 20 AS STRING) AS name_urb,
       CASE WHEN user_id % 17 = 0 THEN 'S/N' ELSE CAST(user_id % 120 AS STRING) END AS postcode,
       -77e0 + value / 1e3 AS x0, -12e0 - value / 1e3 AS y0,
       -77e0 + value / 1e3 + 2e-4 AS x1, -12e0 - value / 1e3 AS y1,
       -77e0 + value / 1e3 + 2e-4 + (event_id % 3) * 1e-5 AS x2, -12e0 - value / 1e3 + 3e-4 AS y2,
       -77e0 + value / 1e3 AS x3, -12e0 - value / 1e3 + 3e-4 + (event_id % 5) * 1e-5 AS y3
FROM {{events}}
"""

SHEET = f"""
SELECT c_custkey,
       CASE c_custkey % 8
            WHEN 1 THEN '-7' || '{NBSP}' || CAST(c_custkey % 10 AS STRING) || '.5'
            WHEN 2 THEN '   -7' || CAST(c_custkey % 10 AS STRING) || '.25'
            WHEN 3 THEN 'abc'
            WHEN 4 THEN ''
            WHEN 5 THEN '1.0d'
            WHEN 6 THEN '1_000'
            WHEN 7 THEN NULL
            ELSE '-7' || CAST(c_custkey % 10 AS STRING) || '.125' END AS LONGITUD,
       CASE WHEN c_nationkey = 3 THEN '+-12' ELSE '-12.' || CAST(c_custkey % 1000 AS STRING) END AS LATITUD
FROM {{customer}}
"""

PLACES = """
SELECT c_custkey,
       -81e0 + (c_custkey % 1200) / 1e2 AS lon,
       -18e0 + (c_custkey % 1700) / 1e2 AS lat
FROM {customer}
"""

JSON_LINES = """
SELECT event_id AS line_no,
       CASE WHEN event_id % 17 = 0 THEN '{{' WHEN event_id % 19 = 0 THEN '] ' ELSE '' END ||
       '{{"event_id": ' || CAST(event_id AS STRING) || ', "event_type": "' || event_type ||
       '", "user_id": ' || CASE WHEN event_id % 23 = 0 THEN '"none"' ELSE CAST(user_id AS STRING) END ||
       '}}' || CASE WHEN event_id % 29 = 0 THEN '}}' ELSE '' END AS line
FROM {events}
"""

RAW_DOCUMENTS = """
SELECT l_orderkey * 10 + l_linenumber AS row_no,
       CASE WHEN l_linenumber = 3 THEN 'X' ELSE '' END || CAST(l_orderkey AS STRING) AS id_via,
       l_shipmode_text AS name,
       CAST(l_suppkey AS STRING) || CASE WHEN l_linenumber = 5 THEN '.75' ELSE '' END AS postcode,
       CAST(l_linenumber AS STRING) AS number,
       CASE WHEN l_linenumber = 2 AND l_returnflag = 'A' THEN 'n/a' ELSE CAST(l_partkey AS STRING) || '.5' END
           AS lon,
       CAST(l_suppkey AS STRING) || '.25' AS lat
FROM (SELECT *, l_returnflag || ' ' || l_linestatus AS l_shipmode_text FROM {lineitem})
"""

PATCHES = """
SELECT CASE WHEN o_orderstatus = 'P' THEN o_orderkey + 900000000 ELSE o_orderkey END AS id_via,
       'EDITED ' || o_orderpriority AS name
FROM {orders} WHERE o_orderstatus <> 'O'
UNION ALL SELECT o_orderkey AS id_via, 'AGAIN' AS name FROM {orders} WHERE o_orderkey % 40 = 7
"""


def _quad(p: str) -> str:
    """Corner columns of a lot in metres, laid out on a grid of 50 lots per row."""
    x, y = f"(3e5 + ({p} % 50) * 4e1)", f"(866e4 + floor(({p}) / 5e1) * 4e1)"
    return (
        f"{x} AS x0, {y} AS y0, {x} + 2e1 AS x1, {y} + ({p}) % 5 AS y1, "
        f"{x} + 2e1 + ({p}) % 3 AS x2, {y} + 25e0 + ({p}) % 5 AS y2, "
        f"{x} + ({p}) % 4 AS x3, {y} + 25e0 + ({p}) % 2 AS y3"
    )


# One row per lot part. Every tenth lot also owns the next lot's shape; every sixth has a square hole.
LOT_PARTS = f"""
SELECT p_partkey AS lot_id, nth AS part, nth = 0 AND p_partkey % 6 = 0 AS hollow, {_quad("(p_partkey + nth)")}
FROM (SELECT p_partkey, unnest(CASE WHEN p_partkey % 10 = 0 THEN [0, 1] ELSE [0] END) AS nth FROM {{part}})
"""

# Doors with the day they were recorded, and districts as they were from a day on, several editions each.
DATED_DOORS = """
SELECT l_orderkey AS id_via, CAST(l_linenumber AS BIGINT) AS numpuerta, l_partkey AS lot,
       CASE WHEN l_suppkey % 10 = 0 THEN l_suppkey + 900000000 WHEN l_partkey % 97 = 0 THEN NULL ELSE l_suppkey END AS postcode,
       CASE WHEN l_partkey % 89 = 0 THEN NULL ELSE l_shipdate END AS recorded
FROM {lineitem}
"""

DATED_DISTRICTS = " UNION ALL ".join(
    f"""SELECT s_suppkey AS postcode, s_name || ' {e}' AS district_then,
       CAST(DATE '1995-06-01' + CAST((s_suppkey * 37) % 700 + {e * 450} AS INT) AS TIMESTAMP) AS valid_from
FROM {{supplier}}"""
    for e in range(4)
)

# The sheet of districts as texts: another order of columns, one more of them, and some numbers that are none.
DISTRICT_SHEET = """
SELECT s_name AS NOMBDIST, 'x' || s_name AS extra,
       CASE WHEN s_suppkey % 9 = 4 THEN 'S/N ' || CAST(s_suppkey AS STRING) ELSE CAST(s_suppkey AS STRING) END AS ubigeo,
       r_name AS NOMBDEP, CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE n_name END AS NOMBPROV,
       'REGION ' || CAST(n_nationkey % 3 AS STRING) AS REGION_NATURAL
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
"""

PROVINCE_SHEET = """
SELECT r_name AS Departamento, ' ' || n_name || ' "' || CAST(c_custkey % 4 AS STRING) || '"' AS Provincia
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
"""

# Lots of which some have no longitude or no latitude.
UNPLACED_LOTS = f"""
SELECT event_type AS manzana, CAST(event_id AS STRING) AS lote, 'URB ' || CAST(user_id % 20 AS STRING) AS nombre_urbanizacion,
       CAST(user_id AS STRING) AS id_urb, user_id % 120 AS postcode,
       CASE WHEN event_id % 7 = 0 THEN NULL ELSE -77e0 + value / 1e3 END AS lon,
       CASE WHEN event_id % 11 = 0 THEN NULL ELSE -12e0 - value / 1e3 END AS lat
FROM {{events}}
"""

# Spans of minutes to weeks that begin with an event, to hold events of the same kind.
SPANS = """
SELECT event_id AS span_id, event_type, ts AS span_start,
       ts + INTERVAL '1' MINUTE * CAST(CASE WHEN event_id % 400 = 0 THEN 30000 ELSE (event_id % 500) * 3 END AS INT) AS span_end
FROM {events} WHERE event_id % 20 = 0
"""

# Two editions of a narrow table with many copies of a row.
OLD_EDITION = """
SELECT l_suppkey % 7 AS sector, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_linenumber END AS floor, l_returnflag AS flag
FROM {lineitem} WHERE l_orderkey % 10 < 7
"""
NEW_EDITION = """
SELECT l_suppkey % 7 AS sector, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_linenumber END AS floor, l_returnflag AS flag
FROM {lineitem} WHERE l_orderkey % 10 > 2
"""

ROADS = """
SELECT s_suppkey AS road_id, 299900e0 AS x1, 302100e0 AS x2,
       866e4 + s_suppkey * 4e1 - 3e0 - (s_suppkey % 7) * 25e-1 AS y
FROM {supplier}
"""

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str, heavy: bool = False) -> DataFrame:
    """A test table; ``heavy`` for work that costs much per row, as each table is one Parquet split."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df) if heavy else df


def view(spark: SparkSession, sf_dir: str, statement: str, heavy: bool = False) -> DataFrame:
    """Run a fixture statement over the Parquet tables."""
    used = {t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in statement}
    df = spark.sql(statement, **used)
    return spread(df) if heavy else df


def duck(statement: str) -> str:
    """The same statement for DuckDB, where the tables are views of their own name."""
    return statement.format(**{t: t for t in TABLES})


def corners() -> list:
    return [vertex(F.col(f"x{i}"), F.col(f"y{i}")) for i in (0, 1, 2, 3, 0)]


def shaped_lots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lots with their polygon as WKB bytes."""
    lots = view(spark, sf_dir, LOT_CORNERS, heavy=True)
    return lots.withColumn(
        "geometry", encode_wkb(shape("Polygon", F.array(F.array(F.array(*corners())))))
    ).drop(*[f"{a}{i}" for a in "xy" for i in range(4)])


def broken_lots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with bytes that are no shape in every 23rd lot and none in every 31st."""
    lots = shaped_lots(spark, sf_dir)
    cut = F.substring("geometry", 1, 9)
    return lots.withColumn(
        "geometry", F.when(F.col("event_id") % 23 == 0, cut).when(F.col("event_id") % 31 != 0, F.col("geometry"))
    )


def _lot_shape(p) -> tuple:
    """Shell and optional hole of the lot numbered ``p``."""
    x = F.lit(3e5) + (p % 50) * 4e1
    y = F.lit(866e4) + F.floor(p / 5e1) * 4e1
    shell = F.array(
        vertex(x, y),
        vertex(x + 2e1, y + p % 5),
        vertex(x + 2e1 + p % 3, y + 25e0 + p % 5),
        vertex(x + p % 4, y + 25e0 + p % 2),
        vertex(x, y),
    )
    hole = F.array(*[vertex(x + dx, y + dy) for dx, dy in ((8, 10), (12, 10), (12, 14), (8, 14), (8, 10))])
    return shell, hole


def metric_lots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lot_id, geometry: polygons and multipolygons in metres."""
    p = F.col("p_partkey")
    shell, hole = _lot_shape(p)
    next_shell, _ = _lot_shape(p + 1)
    own = F.when(p % 6 == 0, F.array(shell, hole)).otherwise(F.array(shell))
    geometry = F.when(p % 10 == 0, shape("MultiPolygon", F.array(own, F.array(next_shell)))).otherwise(
        shape("Polygon", F.array(own))
    )
    parts = table(spark, sf_dir, "part", heavy=True)
    return parts.select(p.alias("lot_id"), geometry.alias("geometry"))


def metric_roads(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.array(vertex(F.col("x1"), F.col("y")), vertex(F.col("x2"), F.col("y")))
    return view(spark, sf_dir, ROADS).select(
        "road_id", shape("LineString", F.array(F.array(line))).alias("geometry")
    )
