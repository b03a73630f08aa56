"""Placement of rows by a hierarchical weighted hash tree: region, rack, shard.

At each level every child draws ln(u) / weight with u hashed from the key and the child, and the largest
draw wins. A child's draw depends on nothing but the key, the child and its weight, so a changed weight
moves rows only into or out of the subtrees it belongs to. Everything is SQL on one row; no row needs
another one to be placed.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from addrspark.llm.shared import written

REGION_SHARDS, RACK_SHARDS = 8, 4
# Slots are numbered in this many independent buckets per shard.
SLOT_BUCKETS = 4096


class Leaf(NamedTuple):
    """A shard and its place in the tree; numbers within a parent are the children's lasting names."""

    region: int
    rack: int
    place: int
    shard: int
    weight: float = 1.0


def even_tree(shards: int) -> list[Leaf]:
    """Shards of equal weight in racks of 4 and regions of 8."""
    return [
        Leaf(s // REGION_SHARDS, s % REGION_SHARDS // RACK_SHARDS, s % RACK_SHARDS, s) for s in range(shards)
    ]


def grown(tree: list[Leaf], weight: float = 1.0) -> list[Leaf]:
    """The tree with one more shard, as a region of its own.

    No other region's weight changes, so rows move only into the new shard. (Added to a standing region it
    would raise that region's weight, and rows drawn into the region could land on any of its shards.)
    """
    return [*tree, Leaf(max(x.region for x in tree) + 1, 0, 0, max(x.shard for x in tree) + 1, weight)]


def _nested(tree: list[Leaf]) -> tuple[list, list, list, list]:
    """Weights of regions, racks and shards, and shard numbers, indexed by the children's names."""
    regions = range(max(x.region for x in tree) + 1)
    racks = [range(max([x.rack for x in tree if x.region == r], default=0) + 1) for r in regions]
    spots = [
        [range(max([x.place for x in tree if (x.region, x.rack) == (r, k)], default=0) + 1) for k in racks[r]]
        for r in regions
    ]
    leaf = {(x.region, x.rack, x.place): x for x in tree}
    weights = [
        [[leaf[r, k, p].weight if (r, k, p) in leaf else 0.0 for p in spots[r][k]] for k in racks[r]] for r in regions
    ]
    numbers = [[[leaf[r, k, p].shard if (r, k, p) in leaf else -1 for p in spots[r][k]] for k in racks[r]] for r in regions]
    by_rack = [[float(sum(w)) for w in region] for region in weights]
    return [float(sum(r)) for r in by_rack], by_rack, weights, numbers


def _literal(values: list, kind: str) -> Column:
    if not isinstance(values, list):
        return F.lit(values).cast(kind)
    return F.array(*[_literal(v, kind) for v in values])


def _winner(key: Column, path: Column, weights: Column) -> Column:
    """Index of the child with the largest weighted draw. One md5 serves four children, 32 bits each."""
    blocks = F.sequence(F.lit(0), F.floor((F.size(weights) - 1) / F.lit(4)).cast("int"))
    hashes = F.transform(blocks, lambda b: F.md5(F.concat_ws("/", key, path, b.cast("string"))))

    def draws(h: Column) -> Column:
        def draw(w: Column, i: Column) -> Column:
            word = F.substring(F.get(h, F.floor(i / F.lit(4)).cast("int")), F.pmod(i, F.lit(4)) * 8 + 1, F.lit(8))
            u = (F.conv(word, 16, 10).cast("double") + 0.5) / F.lit(2.0**32)
            return F.when(w > 0, F.ln(u) / F.when(w > 0, w)).otherwise(F.lit(float("-inf")))

        return F.transform(weights, draw)

    # The one-element array makes the hashes a bound variable, computed once per row.
    scores = F.transform(F.array(hashes), draws)
    best = F.transform(scores, lambda s: F.array_position(s, F.array_max(s)) - 1)
    return F.get(best, F.lit(0)).cast("int")


def shard_of(docs: DataFrame, key: Column, tree: list[Leaf], alias: str) -> DataFrame:
    """``docs`` with the shard of ``key`` in column ``alias``; one projection per level."""
    top, racks, leaves, numbers = _nested(tree)
    r, k, p = f"{alias}_region", f"{alias}_rack", f"{alias}_place"
    text = F.coalesce(key.cast("string"), F.lit(""))
    named = docs.withColumn(r, _winner(text, F.lit("r"), _literal(top, "double")))
    named = named.withColumn(k, _winner(text, F.concat_ws("/", F.lit("k"), F.col(r)), F.get(_literal(racks, "double"), F.col(r))))
    in_rack = F.get(F.get(_literal(leaves, "double"), F.col(r)), F.col(k))
    named = named.withColumn(p, _winner(text, F.concat_ws("/", F.lit("p"), F.col(r), F.col(k)), in_rack))
    found = F.get(F.get(F.get(_literal(numbers, "int"), F.col(r)), F.col(k)), F.col(p))
    return named.withColumn(alias, found).drop(r, k, p)


def assign_shards(
    docs: DataFrame,
    shards: int = 24,
    id_col: str = "doc_id",
    text_col: str = "text",
    tree: list[Leaf] | None = None,
    carry: str | None = None,
) -> DataFrame:
    """One row per input row: id, size, text_crc32, law, shard, slot, grown_shard.

    The id and the tree decide (law ``key``); rows with a null id share one place. Size is the UTF-8 length
    of the text plus 8, a null text has none and the checksum of an empty one. ``slot`` numbers the rows of
    a shard without gaps from 0 by (hash bucket, id, checksum, size); rows equal in all of these are
    interchangeable. Buckets are numbered apart and set off by their sizes, so no shard is sorted in one
    task. Only id and text of ``docs`` are read, and the column ``carry``, which is handed on and must not be
    named like one of the others; an empty table gives an empty result.
    """
    tree = tree or even_tree(shards)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("id"),
        (F.octet_length(text) + 8).cast("bigint").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        *([carry] if carry else []),
    )
    placed = shard_of(shard_of(rows, F.col("id"), tree, "shard"), F.col("id"), grown(tree), "grown_shard")
    hashed = F.md5(F.concat(F.lit("slot/"), F.coalesce(F.col("id").cast("string"), F.lit(""))))
    bucket = F.conv(F.substring(hashed, 1, 3), 16, 10).cast("int")
    placed = written(placed.withColumn("bucket", bucket), "placed")
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("shard", "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    )
    inside = Window.partitionBy("shard", "bucket").orderBy(F.col("id").asc_nulls_last(), "text_crc32", "size")
    numbered = placed.withColumn("place", F.row_number().over(inside)).join(offsets, ["shard", "bucket"])
    return numbered.select(
        F.col("id").alias(id_col), "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("offset") + F.col("place") - 1).alias("slot"), "grown_shard",
        *([carry] if carry else []),
    )
