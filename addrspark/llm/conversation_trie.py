"""Prefix trie of conversations, with totals of every subtree.

A node is a sequence of first turns, named by two 64-bit exclusive-or sums over (turn, depth), so that its
name comes from running sums and no step goes turn by turn. Subtree totals roll up by bands of depths: a node
adds to its ancestors inside its band only, and the totals that reach the roots of bands form a trie of their
own, a band's height flatter, that is rolled up the same way before its totals go to the band above. A node is
copied at most ``band`` times, and rounds grow with the logarithm of the depth.

A conversation of any length is spread: turns are ordered by range partitions, running sums are taken in
stretches of depths, and paths are kept per band. Nodes that many conversations share are combined before
the shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from addrspark.llm.mixing import blank_split
from addrspark.llm.shared import with_common, written

BAND = 16
STRETCH = 4096
END_BITS = 12
FAMILY = 20
NODE = ["a", "b", "depth"]


def ordered_turns(conversations: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """(conv_id, pos, digest, words) of every turn; ``pos`` counts from 1 in a conversation.

    Order is by turn, null first; turns of one number are ordered by a digest of role and text, and what is
    equal in these too is interchangeable. A null role or text is an empty one. Rows without a conv_id belong
    to no conversation. Range partitions cut long conversations, and counts of the parts before are added.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    said = F.md5(F.encode(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), "UTF-8"))
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.unhex(said).alias("digest"),
        F.size(blank_split(text)).cast("bigint").alias("words"),
        F.monotonically_increasing_id().alias("line"),
    )
    order = [F.col("turn").asc_nulls_first(), "digest"]
    ranged = turns.repartitionByRange("conv_id", *order, "line").withColumn("part", F.spark_partition_id())
    ranged = written(ranged.drop("line"), "turns")
    # A conversation that goes on from an earlier part is the first of its part: a row per part at most.
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged.groupBy("part", "conv_id").agg(F.count(F.lit(1)).alias("n"))
    carried = counts.withColumn("before", F.sum("n").over(before)).filter(F.col("before").isNotNull()).drop("n")
    local = F.row_number().over(Window.partitionBy("part", "conv_id").orderBy(*order))
    placed = ranged.withColumn("local", local).join(F.broadcast(carried), ["part", "conv_id"], "left")
    return placed.select("conv_id", (F.col("local") + F.coalesce("before", F.lit(0))).alias("pos"), "digest", "words")


def sequences(placed: DataFrame) -> DataFrame:
    """Conversations as they are: (conv_id, depth, digest, words), and a row of depth 0 for each."""
    roots = placed.filter("pos = 1").select("conv_id", F.lit(0).cast("bigint").alias("depth"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("bigint").alias("words"))
    return roots.unionByName(placed.withColumnRenamed("pos", "depth"))


def rebuilt(placed: DataFrame, family: int = FAMILY, stretch: int = STRETCH) -> DataFrame:
    """Sequences that open with turns of the family's first conversation, as ``sequences`` gives them.

    Conversation c opens with the first h turns of conversation c - c % family (fewer if it has fewer) in
    place of its own first h, where h is the checksum of c modulo 4. A conversation may end up without turns.
    """
    most = 3
    opening = [F.max(F.when(F.col("pos") == i, F.struct("digest", "words"))).alias(f"t{i}") for i in range(1, most + 1)]
    own = placed.groupBy("conv_id").agg(F.max("pos").alias("n"), *opening)
    hashed = F.crc32(F.encode(F.col("conv_id").cast("string"), "UTF-8"))
    heads = own.filter(F.col("conv_id") % family == 0).select(
        F.col("conv_id").alias("first"), F.array_compact(F.array(*[f"t{i}" for i in range(1, most + 1)])).alias("heads")
    )
    convs = own.select("conv_id", "n", (F.col("conv_id") - F.col("conv_id") % family).alias("first"), (hashed % 4).cast("int").alias("h"))
    convs = convs.join(heads, "first", "left")
    k = F.least("h", F.coalesce(F.size("heads"), F.lit(0)))
    convs = convs.withColumn("heads", F.when(k > 0, F.slice("heads", 1, k))).withColumn("k", k)
    convs = written(convs.select("conv_id", "n", "h", "k", "heads"), "convs")

    # One row per stretch of a conversation, so that a long one meets its turns in several places.
    stretches = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / F.lit(stretch))))
    by_stretch = convs.filter(F.col("n") > F.col("h")).select("conv_id", "h", "k", stretches.alias("stretch"))
    turns = placed.withColumn("stretch", F.floor((F.col("pos") - 1) / F.lit(stretch)))
    turns = turns.join(by_stretch, ["conv_id", "stretch"]).filter(F.col("pos") > F.col("h"))
    turns = turns.select("conv_id", (F.col("pos") - F.col("h") + F.col("k")).alias("depth"), "digest", "words")
    opened = convs.select("conv_id", F.posexplode("heads").alias("i", "head"))
    opened = opened.select("conv_id", (F.col("i") + 1).cast("bigint").alias("depth"), "head.digest", "head.words")
    roots = convs.select("conv_id", F.lit(0).cast("bigint").alias("depth"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("bigint").alias("words"))
    return roots.unionByName(opened).unionByName(turns)


def _steps(turns: DataFrame, stretch: int) -> tuple[DataFrame, int]:
    """(every prefix of every conversation with its node and the node's parent, the largest depth)."""
    own = {s: F.when(F.col("depth") == 0, 0).otherwise(F.xxhash64(F.lit(k), "digest", "depth")) for k, s in enumerate("xy")}
    part = F.floor(F.col("depth") / F.lit(stretch)).alias("stretch")
    rows = turns.select("conv_id", "depth", "words", part, *[c.cast("bigint").alias(s) for s, c in own.items()])
    in_part = Window.partitionBy("conv_id", "stretch")
    upto = in_part.orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.select(
        "*", F.bit_xor("x").over(upto).alias("a"), F.bit_xor("y").over(upto).alias("b"),
        F.lead("depth").over(in_part.orderBy("depth")).isNull().alias("ends"),
    )
    rows = written(rows, "steps")
    deepest = rows.agg(F.max("depth")).first()[0]
    if deepest is not None and deepest >= stretch:  # some conversation has several stretches
        before = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
        sums = rows.groupBy("conv_id", "stretch").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
        after = Window.partitionBy("conv_id").orderBy("stretch")
        carried = sums.select(
            "conv_id", "stretch", F.bit_xor("x").over(before).alias("ca"), F.bit_xor("y").over(before).alias("cb"),
            F.lead("stretch").over(after).isNull().alias("last"),
        )
        carried = carried.filter(F.col("ca").isNotNull() | ~F.col("last"))
        rows = rows.join(carried, ["conv_id", "stretch"], "left")
        for name in "ab":
            rows = rows.withColumn(name, F.col(name).bitwiseXOR(F.coalesce(f"c{name}", F.lit(0))))
        rows = written(rows.withColumn("ends", F.col("ends") & F.coalesce("last", F.lit(True))), "steps")
    parent = {f"p{n}": F.col(n).bitwiseXOR(F.col(s)) for n, s in zip("ab", "xy", strict=True)}
    return rows.select("conv_id", *NODE, "words", "ends", *[c.alias(n) for n, c in parent.items()]), deepest or 0


def _paths(steps: DataFrame, band: int, height: int) -> DataFrame:
    """Per conversation and band of ``band`` levels, each ``height`` depths high: its nodes in order."""
    level = steps.filter(F.col("depth") % height == 0)
    path = F.sort_array(F.collect_list(F.struct("depth", "a", "b")))
    return level.groupBy("conv_id", F.floor(F.col("depth") / F.lit(band * height)).alias("band")).agg(path.alias("path"))


SUMS = ["leaves", "saved", "children"]


def _rolled_up(nodes: DataFrame, steps: DataFrame, deepest: int, band: int, height: int = 1) -> DataFrame:
    """What every node adds to itself and its ancestors: rows of NODE, conv_id and SUMS, to be summed per node.

    ``nodes`` are those at depths that ``height`` divides, each with the smallest conversation that has it.
    """
    paths = _paths(steps, band, height)
    at = F.floor(F.col("depth") / F.lit(band * height))
    met = nodes.withColumn("band", at).join(paths, ["conv_id", "band"])
    place = (F.floor(F.col("depth") / F.lit(height)) % band + 1).cast("int")
    added = _to_each(met, F.slice("path", 1, place))
    if deepest < band * height:
        return added
    root = F.element_at("path", 1)
    roots = met.select(*[root[c].alias(c) for c in NODE], "conv_id", *SUMS)
    roots = written(_summed(roots), "roots")
    whole = _summed(_rolled_up(roots, steps, deepest, band, band * height))
    above = whole.filter(F.col("depth") > 0).withColumn("band", at - 1).join(paths, ["conv_id", "band"])
    return added.unionByName(_to_each(above, F.col("path")))


def _to_each(nodes: DataFrame, path: Column) -> DataFrame:
    exploded = nodes.select(F.explode(path).alias("to"), "conv_id", *SUMS)
    return exploded.select(*[F.col("to")[c].alias(c) for c in NODE], "conv_id", *SUMS)


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*NODE).agg(F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in SUMS])


def _end_digests(steps: DataFrame) -> DataFrame:
    """NODE, ends_sha256: the digest of the conversations that end at a node, in order of their numbers.

    A digest of one text cannot be put together from parts, so a node's list passes through one task. It does
    so as a stream of strings, each joined beforehand from the up to 4096 conversations of a range of numbers.
    """
    ends = steps.filter("ends").groupBy(*NODE, F.shiftright("conv_id", END_BITS).alias("range"))
    numbers = F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string"))
    ends = ends.agg(F.array_join(numbers, ",").alias("text"))
    ends = ends.repartition(*NODE).sortWithinPartitions(*NODE, "range")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            done = []
            keys = zip(*[batch.column(c).to_pylist() for c in NODE], strict=True)
            for node, text in zip(keys, batch.column("text").to_pylist(), strict=True):
                if node == key:
                    state.update(b"," + text.encode())
                    continue
                if key is not None:
                    done.append((*key, state.hexdigest()))
                key, state = node, hashlib.sha256(text.encode())
            yield _digested(done)
        if key is not None:
            yield _digested([(*key, state.hexdigest())])

    def _digested(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * 4
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[*NODE, "ends_sha256"])

    return ends.mapInArrow(digest, "a bigint, b bigint, depth bigint, ends_sha256 string")


def prefix_trie(turns: DataFrame, band: int = BAND, stretch: int = STRETCH) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``turns`` are sequences as ``sequences`` gives them. A node is named by its smallest conversation and its
    depth; the root has depth 0 and no parent. ``n_leaves`` are the nodes without children in its subtree,
    itself included; ``saved_tokens`` adds up (n_convs - 1) times the words of the last turn over the subtree.
    Equal conversations are members of the same nodes. No conversations, no nodes.
    """
    steps, deepest = _steps(turns, stretch)
    nodes = steps.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"),
        F.min("ends").alias("leaf"), F.min("pa").alias("pa"), F.min("pb").alias("pb"),
    )
    saved = ((F.col("n_convs") - 1) * F.col("words")).alias("saved")
    zero = F.lit(0).cast("bigint")
    nodes = written(nodes.select("*", F.col("leaf").cast("bigint").alias("leaves"), saved, zero.alias("children")), "nodes")
    added = _rolled_up(nodes.select(*NODE, "conv_id", *SUMS), steps, deepest, band).drop("conv_id")
    child = nodes.filter("depth > 0").select(
        F.col("pa").alias("a"), F.col("pb").alias("b"), (F.col("depth") - 1).alias("depth"),
        zero.alias("leaves"), zero.alias("saved"), F.lit(1).cast("bigint").alias("children"),
    )
    totals = added.unionByName(child).groupBy(*NODE).agg(*[F.sum(c).alias(c) for c in SUMS])
    known = nodes.select(*NODE, "conv_id", "n_convs", "pa", "pb").join(totals, NODE)
    known = written(known.join(_end_digests(steps), NODE, "left"), "trie")

    parents = known.filter("children > 0").select(
        F.col("a").alias("pa"), F.col("b").alias("pb"), (F.col("depth") + 1).alias("depth"),
        F.col("conv_id").alias("parent_conv_id"), F.col("children").alias("times"),
    )
    below = with_common(known.filter("depth > 0"), parents, ["pa", "pb", "depth"], "times")
    root = known.filter("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("bigint"))
    return below.unionByName(root.select(below.columns)).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame, rebuild: bool = False, band: int = BAND, stretch: int = STRETCH) -> DataFrame:
    """The prefix trie of a table (conv_id, turn, role, text); ``rebuild`` opens conversations as ``rebuilt`` does.

    Ties, nulls and repeated rows are dealt with as ``ordered_turns`` says; other columns are not read.
    """
    placed = ordered_turns(conversations, stretch)
    return prefix_trie(rebuilt(placed, stretch=stretch) if rebuild else sequences(placed), band, stretch)
