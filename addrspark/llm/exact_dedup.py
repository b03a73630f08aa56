"""Exact duplicates by sorting whole contents.

Sampled splitters range-partition the normalised texts, an external sort places equal texts next to
each other, and full comparisons of neighbours find the runs. The splitters are drawn from
(beginning of the text, hash of the text, id), so that what the driver samples stays small and a text
that a third of all rows share is cut over many partitions. Runs at the edges of partitions are
stitched by comparing their whole texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from addrspark.llm.shared import written

PREFIX_CHARS = 32

_RUNS = pa.schema(
    [
        ("id", pa.int64()),
        ("part", pa.int32()),
        ("run", pa.int64()),
        ("head", pa.int64()),
        ("is_head", pa.bool_()),
        ("run_size", pa.int64()),
        ("digest", pa.binary()),
        ("edge", pa.bool_()),
        ("edge_text", pa.string()),
    ]
)
_RUNS_DDL = (
    "id bigint, part int, run bigint, head bigint, is_head boolean, run_size bigint, "
    "digest binary, edge boolean, edge_text string"
)


def normalised(text: Column) -> Column:
    """Runs of blanks and line breaks become one space; null becomes empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256 (hex).

    Texts are equal when their normalised forms are identical; a null text is an empty one. The row
    with the smallest id of a group is kept; null ids come last, so ``keep_id`` is null only where
    every id of the group is. Of rows repeated with the same id and text exactly one is kept. Other
    columns of ``docs`` are not looked at, whatever their names. An empty table gives an empty result.
    """
    keyed = docs.select(F.col(id_col).cast("bigint").alias("id"), normalised(F.col(text_col)).alias("norm"))
    keyed = keyed.select(
        "id", "norm", F.substring("norm", 1, PREFIX_CHARS).alias("start"), F.xxhash64("norm").alias("hash")
    )
    by_id = F.col("id").asc_nulls_last()
    ordered = keyed.repartitionByRange("start", "hash", by_id).sortWithinPartitions("start", "hash", "norm", by_id)
    runs = written(ordered.select("id", "norm", "hash").mapInArrow(_find_runs, _RUNS_DDL), "runs")
    joined = runs.join(F.broadcast(_stitched(runs)), ["part", "run"], "left")
    return joined.select(
        F.col("id").alias(id_col),
        F.when(F.col("whole_size").isNull(), F.col("head")).otherwise(F.col("whole_head")).alias("keep_id"),
        F.coalesce("whole_size", "run_size").alias("group_size"),
        (F.col("is_head") & F.coalesce(F.col("leads"), F.lit(True))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def _stitched(runs: DataFrame) -> DataFrame:
    """What runs at partition edges belong to. At most a few rows per partition, so safe to broadcast."""
    same = Window.partitionBy("edge_text")
    in_order = same.orderBy("part", "run")
    return runs.filter(F.col("edge") & F.col("is_head")).select(
        "part",
        "run",
        F.first("head").over(in_order).alias("whole_head"),
        F.sum("run_size").over(same).alias("whole_size"),
        (F.row_number().over(in_order) == 1).alias("leads"),
    )


class _Run:
    """A run of equal texts: its text and the ids seen so far."""

    def __init__(self, text: str, hash_: int, number: int):
        self.text, self.hash, self.number, self.ids, self.nulls = text, hash_, number, [], 0


def _rows(runs: list[_Run], part: int, edges: list[bool]) -> Iterator[pa.RecordBatch]:
    """The rows of finished runs, ids in order and null ids last."""
    ids = [np.concatenate(run.ids) if run.ids else np.empty(0, np.int64) for run in runs]
    sizes = np.array([len(i) + run.nulls for i, run in zip(ids, runs, strict=True)])
    of = np.repeat(np.arange(len(runs)), sizes)
    firsts = np.cumsum(sizes) - sizes
    is_head = np.zeros(len(of), dtype=bool)
    is_head[firsts] = True
    chunks = [x for i, run in zip(ids, runs, strict=True) for x in (pa.array(i), pa.nulls(run.nulls, pa.int64())) if len(x)]
    texts = [run.text if edge else None for run, edge in zip(runs, edges, strict=True)]

    def each(values: list, kind: pa.DataType) -> pa.Array:
        return pa.array(values, kind).take(pa.array(of))

    yield pa.RecordBatch.from_arrays(
        [
            pa.concat_arrays(chunks),
            pa.repeat(pa.scalar(part, pa.int32()), len(of)),
            each([run.number for run in runs], pa.int64()),
            each([int(i[0]) if len(i) else None for i in ids], pa.int64()),
            pa.array(is_head),
            pa.array(sizes[of]),
            each([hashlib.sha256(run.text.encode()).digest() for run in runs], pa.binary()),
            each(edges, pa.bool_()),
            pc.if_else(pa.array(is_head), each(texts, pa.string()), pa.scalar(None, pa.string())),
        ],
        schema=_RUNS,
    )


def _find_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compare neighbours of a sorted partition. Only ids of the current runs are held.

    Runs that share the hash of the first or the last row may go on in another partition.
    """
    part = TaskContext.get().partitionId()
    done: list[_Run] = []
    edges: list[bool] = []
    waiting: list[_Run] = []  # runs with the hash of the latest row
    first_hash = None
    count = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        ids, texts, hashes = batch.column("id"), batch.column("norm"), batch.column("hash").to_numpy()
        n = batch.num_rows
        differs = np.ones(n, dtype=bool)
        if n > 1:
            differs[1:] = pc.not_equal(texts.slice(1), texts.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        if waiting and waiting[-1].text == texts[0].as_py():
            differs[0] = False
        starts = np.flatnonzero(differs)
        bounds = [0, *starts[starts > 0], n]
        for lo, hi in zip(bounds, bounds[1:], strict=False):
            if differs[lo]:
                if first_hash is None:
                    first_hash = hashes[lo]
                if waiting and waiting[-1].hash != hashes[lo]:
                    done += waiting
                    edges += [waiting[0].hash == first_hash] * len(waiting)
                    waiting = []
                waiting.append(_Run(texts[lo].as_py(), hashes[lo], count))
                count += 1
            piece = ids.slice(lo, hi - lo)
            waiting[-1].nulls += piece.null_count
            if piece.null_count < len(piece):
                waiting[-1].ids.append(piece.drop_null().to_numpy())
        if done:
            yield from _rows(done, part, edges)
            done, edges = [], []
    if waiting:
        yield from _rows(waiting, part, [True] * len(waiting))
