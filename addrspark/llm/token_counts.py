"""Token counts of documents in flat token files that have no index.

A file is nothing but token identifiers, documents ending in a separator identifier. Tasks read byte ranges of
files and search blocks of fixed size for separators with one vectorised comparison each; a prefix scan over
the block summaries then gives every block its place, the number of documents before it and where the last of
them ended, which stitches the documents that run over block and range boundaries.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from addrspark.llm import words as W
from addrspark.llm.shared import written
from addrspark.session import shared_folder

# Fixed value: how the vocabulary's texts are split before merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Fixed value: the first identifier that a vocabulary of 50 256 texts leaves free.
SEPARATOR = 50256
BLOCK_TOKENS = 1 << 16
# Blocks that one task reads in a row.
RANGE_BLOCKS = 256
SCAN_GROUP = 1024


@lru_cache(maxsize=2)
def encoder(path: str):
    """The tokenizer of a rank file, which every machine finds under the same path."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("flat", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _kind(width: int) -> np.dtype:
    if width not in (2, 4):
        raise ValueError(f"tokens take 2 or 4 bytes, not {width}")
    return np.dtype(f"<u{width}")


def _file_writer(folder: str, vocabulary: str, separator: int, width: int):
    kind = _kind(width)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(folder)
        # Another attempt of the task writes another file, and only the finished one is named by its rows.
        shard = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.bin"
        encode = encoder(vocabulary).encode_ordinary
        out, ordinal = None, 0
        try:
            for batch in batches:
                for lo, hi in W.row_slices(batch.column("text")):
                    part = batch.slice(lo, hi - lo)
                    if out is None:
                        out = system.open_output_stream(f"{root}/{shard}")
                    for text in part.column("text").to_pylist():
                        tokens = encode(text or "")
                        if tokens and max(tokens) > np.iinfo(kind).max:
                            raise ValueError(f"a token of this vocabulary does not fit into {width} bytes")
                        out.write(np.array([*tokens, separator], dtype=kind).tobytes())
                    count = len(part.column("id"))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([shard] * count), pa.array(np.arange(ordinal, ordinal + count)), part.column("id")],
                        names=["shard", "ordinal", "id"],
                    )
                    ordinal += count
        finally:
            if out is not None:
                out.close()

    return write


def write_flat_files(
    docs: DataFrame, folder: str, vocabulary: str, separator: int = SEPARATOR, width: int = 2, id_col: str = "doc_id"
) -> DataFrame:
    """Tokenise documents into flat files in ``folder``, one per task; returns (shard, ordinal, id) of each document.

    Files hold little-endian tokens of ``width`` bytes, 2 or 4, and nothing else; ``shard`` is a file's name and
    ``ordinal`` the document's number in it. ``folder`` is a URI that every machine can write to, and every
    machine finds the vocabulary's rank file under the same path.
    """
    if separator > np.iinfo(_kind(width)).max:
        raise ValueError(f"the separator {separator} does not fit into {width} bytes")
    system, root = fs.FileSystem.from_uri(folder)
    system.create_dir(root, recursive=True)
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    return written(rows.mapInArrow(_file_writer(folder, vocabulary, separator, width), "shard string, ordinal bigint, id bigint"), "files")


def file_ranges(
    spark: SparkSession, folder: str, width: int = 2, block_tokens: int = BLOCK_TOKENS, range_blocks: int = RANGE_BLOCKS
) -> DataFrame:
    """(shard, first_block, offset, length): byte ranges of all files in ``folder``, for files of any size.

    Only names and lengths are looked at. A file whose length is no multiple of ``width`` is an error.
    """
    size = block_tokens * range_blocks * _kind(width).itemsize
    files = spark.read.format("binaryFile").load(folder).select("path", "length")
    whole = F.when(F.col("length") % width == 0, F.col("length")).otherwise(
        F.raise_error(F.concat(F.col("path"), F.lit(" does not hold whole tokens")))
    )
    named = files.select(F.element_at(F.split("path", "/"), -1).alias("shard"), whole.alias("whole")).filter("whole > 0")
    last = F.floor((F.col("whole") - 1) / F.lit(size))
    cut = named.select("shard", "whole", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("nth"))
    offset = F.col("nth") * size
    return cut.select(
        "shard", (F.col("nth") * range_blocks).alias("first_block"), offset.alias("offset"),
        F.least(F.lit(size).cast("bigint"), F.col("whole") - offset).alias("length"),
    )


def _range_searcher(folder: str, separator: int, width: int, block_tokens: int):
    kind = _kind(width)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with system.open_input_file(f"{root}/{row['shard']}") as file:
                    for nth, at in enumerate(range(0, row["length"], block_tokens * width)):
                        size = min(block_tokens * width, row["length"] - at)
                        tokens = np.frombuffer(file.read_at(size, row["offset"] + at), dtype=kind)
                        ends = np.flatnonzero(tokens == separator).astype(np.int32)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([row["shard"]]), pa.array([row["first_block"] + nth]),
                                pa.array([len(tokens)], pa.int64()), pa.array([ends], pa.list_(pa.int32())),
                            ],
                            names=["shard", "block", "size", "ends"],
                        )

    return search


def search_files(
    spark: SparkSession,
    folder: str,
    separator: int = SEPARATOR,
    width: int = 2,
    block_tokens: int = BLOCK_TOKENS,
    range_blocks: int = RANGE_BLOCKS,
    ranges: DataFrame | None = None,
) -> DataFrame:
    """(shard, block, size, ends): the places of separators in every block of the files in ``folder``.

    Each range is read by the task that searches it, block by block. ``ranges`` may name some of the files only.
    """
    ranges = file_ranges(spark, folder, width, block_tokens, range_blocks) if ranges is None else ranges
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    searcher = _range_searcher(folder, separator, width, block_tokens)
    return ranges.repartition(tasks, "shard", "offset").mapInArrow(searcher, "shard string, block bigint, size bigint, ends array<int>")


def scan_separators(found: DataFrame) -> DataFrame:
    """Blocks with what a prefix scan knows of them: shard, block, start, ordinal, before, size, ends.

    ``found`` is what ``search_files`` gives. ``start`` is the place of the block in its file, ``ordinal`` the
    number of separators and ``before`` the place of the last one (-1: none) in all earlier blocks, ``ends`` the
    separators' places in the block. The scan runs over groups of 1024 blocks and then within each, so that a
    file of any length is no single task's.
    """
    found = found.select(
        "*", F.floor(F.col("block") / SCAN_GROUP).alias("part"), F.size("ends").alias("n"), F.array_max("ends").alias("last")
    )
    inside = Window.partitionBy("shard", "part").orderBy("block")
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    local = found.withColumns(
        {
            "start": F.coalesce(F.sum("size").over(earlier), F.lit(0)),
            "ordinal": F.coalesce(F.sum("n").over(earlier), F.lit(0)),
        }
    ).withColumn("before", F.max(F.col("start") + F.col("last")).over(earlier))
    groups = local.groupBy("shard", "part").agg(
        F.sum("size").alias("size"), F.sum("n").alias("n"), F.max(F.col("start") + F.col("last")).alias("last")
    )
    above = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.withColumns(
        {"base": F.coalesce(F.sum("size").over(above), F.lit(0)), "count": F.coalesce(F.sum("n").over(above), F.lit(0))}
    ).withColumn("reach", F.max(F.col("base") + F.col("last")).over(above))
    return local.join(groups.select("shard", "part", "base", "count", "reach"), ["shard", "part"]).select(
        "shard",
        "block",
        (F.col("base") + F.col("start")).alias("start"),
        (F.col("count") + F.col("ordinal")).alias("ordinal"),
        F.coalesce(F.col("base") + F.col("before"), F.col("reach"), F.lit(-1)).alias("before"),
        "size",
        "ends",
    )


def document_lengths(scanned: DataFrame) -> DataFrame:
    """(shard, block, nth, ordinal, first_token, n_tokens) of every document that a separator ends.

    ``nth`` counts the separators of the block from 0. Tokens behind a stream's last separator are no
    document; ``unfinished_tokens`` has them.
    """
    each = scanned.select("*", F.posexplode("ends").alias("nth", "end"))
    first = F.when(F.col("nth") == 0, F.col("before")).otherwise(F.col("start") + F.get("ends", F.col("nth") - 1)) + 1
    return each.select(
        "shard", "block", "nth", (F.col("ordinal") + F.col("nth")).alias("ordinal"), first.alias("first_token"),
        (F.col("start") + F.col("end") - first).alias("n_tokens"),
    )


def unfinished_tokens(scanned: DataFrame) -> DataFrame:
    """(shard, n_tokens) behind the last separator of each stream."""
    last = F.max(F.coalesce(F.col("start") + F.array_max("ends"), F.col("before")))
    whole = F.max(F.col("start") + F.col("size"))
    return scanned.groupBy("shard").agg((whole - last - 1).alias("n_tokens"))


def count_tokens(
    docs: DataFrame,
    vocabulary: str,
    separator: int = SEPARATOR,
    width: int = 2,
    block_tokens: int = BLOCK_TOKENS,
    range_blocks: int = RANGE_BLOCKS,
    id_col: str = "doc_id",
) -> DataFrame:
    """One row per input row: id, shard, ordinal, first_token, n_tokens.

    Documents are written to flat files in the shared folder, then found again in the files' ranges. A null
    text counts as empty and has no tokens; repeated rows and null ids are documents of their own; other columns
    are not looked at. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/addrspark-tokens-{uuid.uuid4().hex}"
    files = write_flat_files(docs, folder, vocabulary, separator, width, id_col)
    # Files of attempts that were given up are not named.
    ranges = file_ranges(spark, folder, width, block_tokens, range_blocks).join(files.select("shard").distinct(), "shard", "left_semi")
    found = written(search_files(spark, folder, separator, width, block_tokens, range_blocks, ranges), "found")
    lengths = document_lengths(scan_separators(found))
    return lengths.join(files, ["shard", "ordinal"]).select(F.col("id").alias(id_col), "shard", "ordinal", "first_token", "n_tokens")
