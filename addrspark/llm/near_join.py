"""Similarity join of texts on word n-grams by MinHash banding.

Signatures are cut into bands; band and row counts follow from the recall wanted at the threshold. Equal
texts become one node. Nodes that share a band hash meet their bucket's smallest node, its centre, and are
compared with it on full n-gram sets. What a member's set differs in from the centre's is kept, because
|A n B| = |C| - |C\\A| - |C\\B| + |(A^C) n (B^C)|: the members of a centre are then compared with each
other on these small differences alone, exactly, block against block. No pair is emitted on the way; a
block gives the number of links of each member and the edges of a spanning forest.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from addrspark.llm import words as W
from addrspark.llm.components import components
from addrspark.llm.shared import written

THRESHOLD = 0.8
GRAM = 5
RECALL = 0.9999
BLOCK = 512
COLUMNS = 4096
U64 = np.uint64


def choose_bands(threshold: float, recall: float, most_hashes: int = 128) -> tuple[int, int]:
    """(bands, rows): the most selective banding that finds a pair at the threshold with this probability.

    More rows admit fewer dissimilar pairs but need more bands. ValueError where no banding of ``most_hashes``
    hashes reaches the recall.
    """
    best = None
    for rows in range(1, most_hashes + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands * rows > most_hashes:
            break
        best = (bands, rows)
    if best is None:
        raise ValueError(f"no banding of {most_hashes} hashes finds pairs at {threshold} with probability {recall}")
    return best


def _multipliers(count: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.Generator(np.random.PCG64(20)).integers(0, 2**32, (2, count), dtype=np.uint64).astype(np.uint32)
    return draw[0] | np.uint32(1), draw[1]


def grams_of(words: W.Words, n: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): the n-grams of each row; a text of fewer words is one gram, one of none has none."""
    hashes, at = W.gram_hashes(words, n)
    counts = np.diff(words.first)
    per_row = np.maximum(counts - n + 1, 0)
    short = np.flatnonzero((counts > 0) & (counts < n))
    first = np.concatenate([[0], np.cumsum(per_row)])
    if len(short):
        whole = W._rolling(words.hashes, words.first[short], words.first[short + 1], W._odd(5))
        hashes = np.insert(hashes, first[short], W.mix(whole + counts[short].astype(U64)))
        per_row[short] = 1
        first = np.concatenate([[0], np.cumsum(per_row)])
    return hashes, first


def _node_ids(column: pa.Array, words: W.Words) -> np.ndarray:
    """A hash of each row's sequence of words; of its bytes where it has no words."""
    counts = np.diff(words.first)
    out = W.mix(W._rolling(words.hashes, words.first[:-1], words.first[1:], W._odd(11)) + counts.astype(U64))
    for i in np.flatnonzero(counts == 0):
        text = (column[i].as_py() or "").encode()
        raw = np.frombuffer(text, np.uint8).astype(U64) + U64(1)
        out[i] = W.mix(W._rolling(raw, np.array([0]), np.array([len(raw)]), W._odd(13)) + U64(len(raw)))[0] if len(raw) else U64(1)
    return out.view(np.int64)


def _signer(bands: int, rows: int, gram: int):
    scale, shift = _multipliers(bands * rows)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in W.row_slices(batch.column("text")):
                text = batch.column("text").slice(lo, hi - lo)
                words = W.scan_words(text, W.ALNUM_SPLIT, fold=True)
                hashes, first = grams_of(words, gram)
                some = np.flatnonzero(np.diff(first))
                keys = np.zeros((len(some), bands), dtype=U64)
                if len(some):
                    low = (hashes >> U64(32)).astype(np.uint32)
                    for k in range(bands * rows):
                        least = np.minimum.reduceat(low * scale[k] + shift[k], first[some])
                        keys[:, k // rows] = keys[:, k // rows] * U64(0x9E3779B97F4A7C15) + least + U64(1)
                    keys = W.mix(keys + np.arange(1, bands + 1, dtype=U64) * U64(0xC2B2AE3D27D4EB4F))
                sizes = np.zeros(hi - lo, dtype=np.int32)
                sizes[some] = bands
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(lo, hi - lo),
                        batch.column("stand_in").slice(lo, hi - lo),
                        pa.array(_node_ids(text, words)),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel().view(np.int64))),
                    ],
                    names=["id", "stand_in", "node", "bands"],
                )

    return sign


def _gram_set(text: str, gram: int) -> tuple[np.ndarray, int]:
    """(sorted distinct grams, node) of one text."""
    column = pa.array([text])
    words = W.scan_words(column, W.ALNUM_SPLIT, fold=True)
    return np.unique(grams_of(words, gram)[0]), int(_node_ids(column, words)[0])


def _comparer(threshold: float, gram: int):
    schema = pa.schema(
        [("member", pa.int64()), ("centre", pa.int64()), ("linked", pa.bool_()), ("centre_size", pa.int32()),
         ("member_size", pa.int32()), ("lacks", pa.int32()), ("differs", pa.list_(pa.int64()))]
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre_text, centre_set, centre_node = None, None, None
        for batch in batches:
            out: dict[str, list] = {name: [] for name in schema.names}
            columns = [batch.column(c) for c in ("member", "centre", "member_text", "centre_text")]
            for member, centre, text, other in zip(*(c.to_pylist() for c in columns), strict=True):
                if other != centre_text:
                    centre_text = other
                    centre_set, centre_node = _gram_set(other or "", gram)
                own, node = _gram_set(text or "", gram)
                if node != member or centre_node != centre:
                    continue  # another text under the same id
                shared = len(np.intersect1d(own, centre_set, assume_unique=True))
                whole = len(own) + len(centre_set) - shared
                differs = np.setxor1d(own, centre_set, assume_unique=True)
                lacks = len(centre_set) - shared
                row = (member, centre, shared >= threshold * whole, len(centre_set), len(own), lacks, differs.view(np.int64))
                for name, value in zip(schema.names, row, strict=True):
                    out[name].append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[f.name], f.type) for f in schema], schema=schema
            )

    return compare


def _linked_pairs(threshold: float, rows: dict, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether each member of ``left`` is linked to each of ``right``, from their differences to the centre."""
    lists = rows["differs"]
    both = np.concatenate([left, right])
    sizes = np.array([len(lists[i]) for i in both])
    member = np.repeat(np.arange(len(both)), sizes)
    values = np.concatenate([lists[i] for i in both]) if sizes.sum() else np.empty(0, np.int64)
    _, column, times = np.unique(values, return_inverse=True, return_counts=True)
    kept = times[column] > 1  # an element of a single member is in no intersection
    member, column = member[kept], column[kept]
    order = np.argsort(column, kind="stable")
    member, column = member[order], column[order]
    column = np.cumsum(np.concatenate([[0], np.diff(column) != 0])) if len(column) else column
    shared = np.zeros((len(left), len(right)), dtype=np.float32)
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, [low, low + COLUMNS])
        dense = np.zeros((len(both), COLUMNS), dtype=np.float32)
        dense[member[a:b], column[a:b] - low] = 1
        shared += dense[: len(left)] @ dense[len(left) :].T
    lacks, size, centre = rows["lacks"], rows["member_size"], rows["centre_size"][0]
    overlap = centre - lacks[left][:, None] - lacks[right][None, :] + shared
    union = size[left][:, None] + size[right][None, :] - overlap
    return overlap >= threshold * union


def _counted_elsewhere(members: np.ndarray, centres: np.ndarray, own: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Pairs that have a smaller common centre, or of which one is the other's centre."""
    sizes = np.array([len(c) for c in centres])
    row, centre = np.repeat(np.arange(len(members)), sizes), np.concatenate(centres)
    smaller = centre < own
    names, column = np.unique(centre[smaller], return_inverse=True)
    has = np.zeros((len(members), len(names)), dtype=np.float32)
    has[row[smaller], column] = 1
    found = has[left] @ has[right].T > 0
    place = np.searchsorted(members, centre)
    here = members[np.minimum(place, len(members) - 1)] == centre
    heads = np.zeros((len(members), len(members)), dtype=bool)
    heads[row[here], place[here]] = True
    return found | heads[np.ix_(left, right)] | heads[np.ix_(right, left)].T


def _block_linker(threshold: float):
    def link(table: pa.Table) -> pa.Table:
        _, first = np.unique(table.column("member").to_numpy(), return_index=True)
        table = table.take(pa.array(first))
        rows = {c: table.column(c).to_numpy() for c in ("member", "block", "centre_size", "member_size", "lacks")}
        rows["differs"] = table.column("differs").to_pandas().to_numpy()
        centres = table.column("centres").to_pandas().to_numpy()
        own, i, j = table.column("centre")[0].as_py(), table.column("i")[0].as_py(), table.column("j")[0].as_py()
        left, right = np.flatnonzero(rows["block"] == i), np.flatnonzero(rows["block"] == j)
        members = rows["member"]
        links, label = np.zeros(len(members), np.int64), np.arange(len(members))
        if len(left) and len(right):
            linked = _linked_pairs(threshold, rows, left, right)
            if i == j:
                linked &= left[:, None] < right[None, :]
            counted = linked & ~_counted_elsewhere(members, centres, own, left, right)
            np.add.at(links, left, counted.sum(axis=1))
            np.add.at(links, right, counted.sum(axis=0))
            a, b = np.nonzero(linked)
            a, b = left[a], right[b]
            while True:  # the least label of everything linked
                new = label.copy()
                np.minimum.at(new, a, label[b])
                np.minimum.at(new, b, label[a])
                new = new[new]
                if (new == label).all():
                    break
                label = new
        keep = (links > 0) | (label != np.arange(len(members)))
        return pa.table({"node": members[keep], "links": links[keep], "root": members[label][keep]})

    return link


def similar_texts(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    gram: int = GRAM,
    recall: float = RECALL,
    block: int = BLOCK,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: id, class_id, text_id, copies, n_links.

    Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased; a text of fewer than
    ``gram`` words is one gram. Texts with the same words are copies: ``text_id`` is their smallest id,
    ``copies`` their number. ``n_links`` counts the other texts whose n-gram sets have a Jaccard similarity
    of ``threshold`` or more; ``class_id`` is the smallest id among all texts connected by links.

    Texts without words (also null and empty ones) are copies where their bytes agree and never linked.
    Rows with a null id are compared like all others; class_id and text_id are null where no row of the class or
    text has an id. An id should name one text; of several, each is a text of its own. Columns other
    than id and text are not looked at. An empty table gives an empty result.
    """
    bands, rows = choose_bands(threshold, recall)
    # A text without an id is fetched by its hash.
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    texts = texts.withColumn("stand_in", F.when(F.col("id").isNull(), F.xxhash64("text")))
    ddl = "id bigint, stand_in bigint, node bigint, bands array<bigint>"
    signed = written(texts.mapInArrow(_signer(bands, rows, gram), ddl), "signed")
    firsts = [F.min("id").alias("rep"), F.min("stand_in").alias("stand_in"), F.count(F.lit(1)).alias("copies"), F.first("bands").alias("bands")]
    nodes = written(signed.groupBy("node").agg(*firsts), "nodes")
    edges = _star_edges(nodes)
    met = _with_texts(edges, nodes, texts)
    ddl = "member bigint, centre bigint, linked boolean, centre_size int, member_size int, lacks int, differs array<bigint>"
    compared = written(met.mapInArrow(_comparer(threshold, gram), ddl).dropDuplicates(["member", "centre"]), "compared")
    blocks = written(_block_links(compared, threshold, block), "blocks")

    stars = compared.filter("linked").select(F.col("member").alias("u"), F.col("centre").alias("v"))
    inner = blocks.filter(F.col("node") != F.col("root")).select(F.col("node").alias("u"), F.col("root").alias("v"))
    roots = components(stars.unionByName(inner))
    ends = stars.select(F.col("u").alias("node")).unionByName(stars.select(F.col("v").alias("node")))
    counts = ends.withColumn("links", F.lit(1).cast("bigint")).unionByName(blocks.select("node", "links"))
    counts = counts.groupBy("node").agg(F.sum("links").alias("n_links"))

    named = nodes.select("node", "rep", "copies").join(roots, "node", "left").join(counts, "node", "left")
    least = named.filter(F.col("root").isNotNull()).groupBy("root").agg(F.min("rep").alias("class_id"))
    known = named.join(least, "root", "left").select(
        "node", "copies", F.col("rep").alias("text_id"),
        F.coalesce("class_id", "rep").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )
    return signed.select("id", "node").join(known, "node").select(
        F.col("id").alias(id_col), "class_id", "text_id", "copies", "n_links"
    )


def _star_edges(nodes: DataFrame) -> DataFrame:
    """(member, centre): every node of a bucket with the bucket's smallest node."""
    rows = nodes.select("node", F.explode("bands").alias("bucket"))
    centres = (
        rows.groupBy("bucket")
        .agg(F.min("node").alias("centre"), F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
        .select("bucket", "centre")
    )
    met = rows.join(centres, "bucket").filter(F.col("node") != F.col("centre"))
    return written(met.select(F.col("node").alias("member"), "centre").distinct(), "stars")


def _text_key(id_col: str) -> list[Column]:
    return [F.coalesce(id_col, "stand_in").alias("key"), F.col(id_col).isNull().alias("unnamed")]


def _with_texts(edges: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """Edges with both texts. Texts are moved once by id or hash; both sides of the join read that exchange."""
    names = nodes.select("node", *_text_key("rep"))
    # Copies without an id are one text; ids name a text each.
    unnamed = texts.filter(F.col("id").isNull()).dropDuplicates(["stand_in"])
    texts = texts.filter(F.col("id").isNotNull()).unionByName(unnamed).select("text", *_text_key("id"))
    sides = []
    for side in ("member", "centre"):
        wanted = (edges if side == "member" else edges.select("centre").distinct()).join(
            names.withColumnRenamed("node", side), side
        )
        sides.append(wanted.join(texts, ["key", "unnamed"]).drop("key", "unnamed").withColumnRenamed("text", f"{side}_text"))
    return sides[0].join(sides[1], "centre").select("member", "centre", "member_text", "centre_text")


def _block_links(compared: DataFrame, threshold: float, block: int) -> DataFrame:
    """(node, links, root): links between members of one centre, and edges that connect them.

    A centre with more than ``block`` members is cut into blocks by hash; each pair of blocks is a group of
    its own, so a hot centre spreads over many tasks.
    """
    sizes = compared.groupBy("centre").agg(F.count(F.lit(1)).alias("members")).filter(F.col("members") > 1)
    centres = compared.groupBy("member").agg(F.collect_set("centre").alias("centres"))
    cut = (
        compared.join(sizes, "centre")
        .join(centres, "member")
        .withColumn("blocks", F.ceil(F.col("members") / F.lit(block)).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("member"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
        .select("centre", "i", "j", "member", "block", "centre_size", "member_size", "lacks", "differs", "centres")
    )
    return cut.groupBy("centre", "i", "j").applyInArrow(_block_linker(threshold), "node bigint, links bigint, root bigint")
