"""Table functions for SQL."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

EDGES = "lot_id bigint, part bigint, ring bigint, edge bigint, x1 double, y1 double, x2 double, y2 double"


def _places(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... within each of consecutive groups of these sizes."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


class _ShapeEdges:
    """Edges of all rings of a table (lot_id, geometry), one batch at a time; other columns are not looked at."""

    def eval(self, batch: pa.RecordBatch) -> Iterator[pa.Table]:
        geometry = batch.column("geometry")
        parts = geometry.flatten()[geometry.type.get_field_index("parts")]  # a null shape has no parts, whatever stands behind it
        per_row = parts.value_lengths().fill_null(0).to_numpy()
        rings = parts.flatten()
        per_part = rings.value_lengths().fill_null(0).to_numpy()
        vertices = rings.flatten()
        per_ring = vertices.value_lengths().fill_null(0).to_numpy()
        points = vertices.flatten()
        x, y = (points.field(a).to_numpy(zero_copy_only=False) for a in ("x", "y"))
        row = np.repeat(np.repeat(np.arange(len(per_row)), per_row), per_part)
        part = np.repeat(_places(per_row), per_part)
        ring = _places(per_part)
        edges = np.maximum(per_ring - 1, 0)
        of = np.repeat(np.arange(len(per_ring)), edges)
        at = (np.cumsum(per_ring) - per_ring)[of] + _places(edges)
        yield pa.table(
            {
                "lot_id": batch.column("lot_id").take(pa.array(row[of])),
                "part": part[of], "ring": ring[of], "edge": _places(edges),
                "x1": x[at], "y1": y[at], "x2": x[at + 1], "y2": y[at + 1],
            }
        )


def register_table_functions(spark: SparkSession) -> None:
    """Make ``shape_edges`` known to SQL: ``SELECT * FROM shape_edges(TABLE(lots))``.

    ``lots`` has lot_id and geometry, a shape as the library's readers give it. Partitions of the input are
    worked on apart, in Arrow batches. Rows do not depend on each other: ``PARTITION BY lot_id`` gives the same rows,
    but sorts them and calls the function once per lot, which costs far more than the edges do.
    """
    spark.udtf.register("shape_edges", F.arrow_udtf(_ShapeEdges, returnType=EDGES))
