"""Quadtrees that follow the data: squares as join keys, small where both sides are crowded."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from addrspark.session import shared_folder

# A square with more pairs than this is cut in four.
MOST_PAIRS = 1_000_000
DEPTH = 12
# A cut must leave at most this share of a square's pairs, or it stays whole.
WORTH = 0.75
SQUARE = ["quad_level", "quad_x", "quad_y"]
ENDS = ["x1", "y1", "x2", "y2"]


def _written(df: DataFrame, name: str) -> DataFrame:
    path = f"{shared_folder(df.sparkSession)}/addrspark-quad-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _in_square(size: Column, pad: float) -> Column:
    """Whether the segment comes within ``pad`` of the square, told by its box and by its direction.

    Squares at a corner may be taken in that the segment just misses, none is left out that it meets.
    """
    half = size / 2 + pad
    centre_x, centre_y = (F.col("quad_x") + 0.5) * size, (F.col("quad_y") + 0.5) * size
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    boxes = (
        (F.least("x1", "x2") <= centre_x + half) & (F.greatest("x1", "x2") >= centre_x - half)
        & (F.least("y1", "y2") <= centre_y + half) & (F.greatest("y1", "y2") >= centre_y - half)
    )
    aside = F.abs((centre_x - F.col("x1")) * dy - (centre_y - F.col("y1")) * dx)
    # A little more than needed: rounding must not lose a square that is only touched.
    return boxes & (aside <= half * (F.abs(dx) + F.abs(dy)) * (1 + 1e-9) + 1e-6)


def _quarters(placed: DataFrame, size: float, pad: float) -> DataFrame:
    """Rows of squares in those quarters that they meet."""
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)])
    four = placed.withColumn("quarter", F.explode(steps)).withColumns(
        {
            "quad_level": F.col("quad_level") + 1,
            "quad_x": F.col("quad_x") * 2 + F.col("quarter.i"),
            "quad_y": F.col("quad_y") * 2 + F.col("quarter.j"),
        }
    )
    return four.drop("quarter").filter(_in_square(F.lit(size), pad))


def _counted(left: DataFrame, right: DataFrame) -> DataFrame:
    """Squares that both sides have, with the number of pairs in them."""
    sides = [df.groupBy(*SQUARE).agg(F.count(F.lit(1)).alias(n)) for df, n in ((left, "lefts"), (right, "rights"))]
    return sides[0].join(sides[1], SQUARE).withColumn("pairs", F.col("lefts").cast("double") * F.col("rights"))


def leaves(
    left: DataFrame,
    right: DataFrame,
    size: float,
    left_pad: float,
    right_pad: float,
    most_pairs: int = MOST_PAIRS,
    depth: int = DEPTH,
) -> tuple[DataFrame, DataFrame]:
    """(left, right) with SQUARE, the leaf of a quadtree; a row is repeated for every leaf that it meets.

    Both sides are segments x1, y1, x2, y2 that have a square of width ``size`` each, in quad_x and quad_y,
    for every one that they come near; ``left_pad`` and ``right_pad`` say how near. Segments within the sum
    of the pads of each other share a leaf. A square that holds more than ``most_pairs`` pairs is cut in four, at most
    ``depth`` times, unless its quarters would hold nearly as many: then its rows are all near each other.

    Every pass counts pairs per square, and works on the rows of crowded squares only, which are written in
    between; nothing but the counts is gathered, and no square is any single task's before the join.
    """
    both = [_written(df.withColumn("quad_level", F.lit(0)), "squares") for df in (left, right)]
    done: list[list[DataFrame]] = [[], []]
    counts = _counted(*both)
    for level in range(depth):
        crowded = _written(counts.filter(F.col("pairs") > most_pairs).select(*SQUARE, "pairs"), "crowded")
        if crowded.isEmpty():
            break
        inside = [_written(df.join(crowded.drop("pairs"), SQUARE, "left_semi"), "inside") for df in both]
        quarters = [_written(_quarters(df, size / 2 ** (level + 1), pad), "quarters") for df, pad in zip(inside, (left_pad, right_pad), strict=True)]
        counts = _written(_counted(*quarters), "counts")
        above = [F.col("quad_level") - 1, F.shiftright("quad_x", 1), F.shiftright("quad_y", 1)]
        after = counts.groupBy(*[c.alias(n) for c, n in zip(above, SQUARE, strict=True)]).agg(F.sum("pairs").alias("after"))
        judged = crowded.join(after, SQUARE, "left")
        cut = _written(judged.filter(F.coalesce("after", F.lit(0.0)) <= F.col("pairs") * WORTH).select(*SQUARE), "cut")
        for k in range(2):
            done[k].append(both[k].join(cut, SQUARE, "left_anti"))
        parents = [F.col("quad_level") + 1, F.col("quad_x"), F.col("quad_y")]
        kept = cut.select(*[c.alias(f"up_{n}") for c, n in zip(parents, SQUARE, strict=True)])
        here = [F.col("quad_level") == F.col("up_quad_level"), F.shiftright("quad_x", 1) == F.col("up_quad_x"), F.shiftright("quad_y", 1) == F.col("up_quad_y")]
        condition = here[0] & here[1] & here[2]
        both = [_written(df.join(kept, condition, "left_semi"), "open") for df in quarters]
        counts = counts.join(kept, condition, "left_semi")
    out = []
    for k in range(2):
        rows = both[k]
        for more in done[k]:
            rows = rows.unionByName(more)
        out.append(rows)
    return out[0], out[1]
