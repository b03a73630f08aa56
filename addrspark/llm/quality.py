"""Quality by ordinal regression on graded ratings.

Cumulative links: P(grade <= k) = sigmoid(threshold_k - weights . features), with one weight vector for all
grades and ordered thresholds. Features are hashed words, word beginnings, raw tokens' endings and coarse
shares that describe how a text looks. The model is fitted on a bounded sample of labelled rows and gives
every document its expected grade and the probability of reaching the top.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from addrspark.llm import words as W

BITS = 18
SAMPLE_ROWS = 9000
RANGE_BITS = 14
# A feature counts when it stands in so many sampled texts and is this many standard errors away from
# chance in one grade. Most words say nothing about quality; leaving them out keeps their noise out.
MIN_TEXTS = 5
MIN_Z = 5.0
PENALTY = 1.0
BEGINNING = 4
ENDING = 3
SHARE_STEPS = np.array([0.002, 0.01, 0.03, 0.1, 0.25, 0.5, 0.8])
U64 = np.uint64


class Model(NamedTuple):
    """Weights per feature and ordered thresholds between grades."""

    weights: np.ndarray
    thresholds: np.ndarray


def grade(quality: Column, toxic: Column) -> Column:
    """Ratings in order: 0 toxic, 1 of low quality, 2 good."""
    return F.when(toxic == 1, 0).when(quality == 0, 1).when(quality == 1, 2)


def _piece_hash(words: W.Words, begin: np.ndarray, end: np.ndarray, kind: int) -> np.ndarray:
    """Hash of short byte ranges."""
    out = np.full(len(begin), kind, dtype=U64)
    for k in range(max(BEGINNING, ENDING)):
        inside = begin + k < end
        at = np.minimum(begin + k, len(words.data) - 1)
        out = np.where(inside, out * U64(1099511628211) + words.data[at].astype(U64) + U64(1), out)
    return W.mix(out)


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of every distinct feature of each text, sorted by row."""
    n = len(column)
    words = W.scan_words(column, W.ALNUM_SPLIT, fold=True)
    tokens = W.scan_words(column, W.BLANK_SPLIT)
    rows, found = [], []

    def add(row: np.ndarray, hashes: np.ndarray) -> None:
        rows.append(row)
        found.append((hashes >> U64(64 - BITS)).astype(np.int64))

    row = W.rows_of(words)
    add(row, words.hashes)
    long = words.ends - words.starts > BEGINNING
    add(row[long], _piece_hash(words, words.starts[long], words.starts[long] + BEGINNING, 3))
    token_row, length = W.rows_of(tokens), tokens.ends - tokens.starts
    some = length > ENDING
    add(token_row[some], _piece_hash(tokens, tokens.ends[some] - ENDING, tokens.ends[some], 5))

    count = np.maximum(np.diff(tokens.first), 1)
    again = np.concatenate([[False], tokens.hashes[1:] == tokens.hashes[:-1]])[: len(length)]
    data = tokens.data
    upper = (data >= 0x41) & (data <= 0x5A) if len(data) else np.empty(0, bool)
    plain = W.ALNUM_SPLIT[data] if len(data) else np.empty(0, bool)
    last, second = tokens.ends - 1, np.maximum(tokens.ends - 2, tokens.starts)
    signs = [
        again,  # the token before, once more
        ~plain[last] & ~plain[second],  # ends in two signs, or is one
        upper[tokens.starts] & upper[np.minimum(tokens.starts + 1, last)] & (length > 1),
        ~plain[tokens.starts] & (length == 1),
        length > 18,
    ]
    for k, sign in enumerate(signs):
        share = np.bincount(token_row[sign], minlength=n) / count
        step = np.searchsorted(SHARE_STEPS, share)
        add(np.arange(n), W.mix(np.array(step, dtype=U64) + U64(1000 * (k + 1))))
    kinds = np.unique((token_row << 40) | (tokens.hashes >> U64(24)).astype(np.int64)) >> 40
    variety = np.bincount(kinds, minlength=n) / count
    spread = np.searchsorted(SHARE_STEPS, variety) * 8 + np.minimum(np.log2(count).astype(np.int64) // 2, 7)
    add(np.arange(n), W.mix(spread.astype(U64) + U64(9000)))
    key = np.unique((np.concatenate(rows) << BITS) | np.concatenate(found))
    return key >> BITS, key & ((1 << BITS) - 1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(first: np.ndarray, feature: np.ndarray, grades: np.ndarray, share: np.ndarray, levels: int) -> Model:
    """Penalised likelihood of the cumulative links by L-BFGS; ``share`` weighs rows.

    Only telling features have weights. The first threshold and the logs of the gaps above it are free,
    which keeps the thresholds in order.
    """
    number = len(grades)
    row = np.repeat(np.arange(number), np.diff(first))
    known = _telling(feature, grades[row], np.bincount(grades, minlength=levels))
    names = np.flatnonzero(known)
    row, column = row[known[feature]], (np.cumsum(known) - 1)[feature[known[feature]]]
    penalty = PENALTY / number

    def thresholds(p: np.ndarray) -> np.ndarray:
        return p[0] + np.concatenate([[0], np.cumsum(np.exp(p[1:]))])

    def loss(p: np.ndarray) -> tuple[float, np.ndarray]:
        weights, free = p[levels - 1 :], p[: levels - 1]
        ends = np.concatenate([[-40], thresholds(free), [40]])
        score = np.bincount(row, weights[column], number)
        upper, lower = _sigmoid(ends[grades + 1] - score), _sigmoid(ends[grades] - score)
        chance = np.maximum(upper - lower, 1e-12)
        d_upper, d_lower = (share * x * (1 - x) / chance / number for x in (upper, lower))
        slope = np.bincount(column, (d_upper - d_lower)[row], len(names)) + penalty * weights
        ends_slope = np.zeros(levels + 1)
        np.add.at(ends_slope, grades + 1, -d_upper)
        np.add.at(ends_slope, grades, d_lower)
        inner = ends_slope[1:levels]
        free_slope = [inner.sum(), *(inner[k:].sum() * np.exp(free[k]) for k in range(1, levels - 1))]
        return -(share * np.log(chance)).sum() / number + penalty * (weights @ weights) / 2, np.concatenate([free_slope, slope])

    start = np.zeros(levels - 1 + len(names))
    start[0] = -1
    best = _minimum(loss, start)
    weights = np.zeros(1 << BITS, dtype=np.float32)
    weights[names] = best[levels - 1 :]
    return Model(weights, thresholds(best[: levels - 1]))


def _telling(feature: np.ndarray, grade_of: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Features whose share of texts in some grade is far from that in the others."""
    levels, number = len(texts), texts.sum()
    held = np.bincount(feature * levels + grade_of, minlength=levels << BITS).reshape(-1, levels)
    total = held.sum(axis=1, keepdims=True)
    share = np.clip(total / number, 1e-9, 1 - 1e-9)
    inside, outside = held / np.maximum(texts, 1), (total - held) / np.maximum(number - texts, 1)
    error = np.sqrt(share * (1 - share) * (1 / np.maximum(texts, 1) + 1 / np.maximum(number - texts, 1)))
    return (np.abs(inside - outside) >= MIN_Z * error).any(axis=1) & (total[:, 0] >= MIN_TEXTS)


def _minimum(loss, p: np.ndarray, steps: int = 80, memory: int = 8) -> np.ndarray:
    """Limited-memory BFGS with halved steps."""
    value, slope = loss(p)
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        direction, parts = slope.copy(), []
        for s, y in reversed(moves):
            parts.append(s @ direction / (y @ s))
            direction -= parts[-1] * y
        if moves:
            s, y = moves[-1]
            direction *= s @ y / (y @ y)
        for (s, y), part in zip(moves, reversed(parts), strict=True):
            direction += s * (part - y @ direction / (y @ s))
        size = 1.0 if moves else 1 / max(np.abs(slope).sum(), 1e-12)
        for _ in range(20):
            new = p - size * direction
            new_value, new_slope = loss(new)
            if new_value <= value - 1e-4 * size * (slope @ direction):
                break
            size /= 2
        moved = (new - p, new_slope - slope)
        if moved[0] @ moved[1] > 1e-12:
            moves = [*moves, moved][-memory:]
        done = value - new_value < 1e-6
        p, value, slope = new, new_value, new_slope
        if done:
            break
    return p


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int, id_col: str) -> DataFrame:
    """(text, grade, share) of at most ``rows`` labelled documents, chosen by a hash of the id.

    Each grade gets a third; ``share`` is the root of the number of labels that a row stands for, half way
    between the grades' frequencies and equal weight of all grades. A document with several labels has the
    lowest. Labels with a null part are left out.
    """
    known = labels.select(F.col(id_col).alias("label_id"), grade(F.col("quality"), F.col("toxic")).alias("grade"))
    known = known.dropna().groupBy("label_id").agg(F.min("grade").alias("grade"))
    known = known.withColumn("hash", F.xxhash64("label_id")).withColumn("range", F.shiftright("hash", 64 - RANGE_BITS))
    # Counts per range of hashes tell which ranges hold the smallest ones; only their rows meet in a window.
    before = Window.partitionBy("grade").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = known.groupBy("grade", "range").agg(F.count(F.lit(1)).alias("n"))
    wanted = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).filter(F.col("before") < rows // 3)
    near = known.join(wanted.select("grade", "range"), ["grade", "range"], "left_semi")
    place = F.row_number().over(Window.partitionBy("grade").orderBy("hash", "label_id"))
    best = near.withColumn("place", place).filter(F.col("place") <= rows // 3)
    totals = known.groupBy("grade").agg(F.count(F.lit(1)).alias("total"))
    taken = best.groupBy("grade").agg(F.count(F.lit(1)).alias("taken")).join(totals, "grade")
    sample = best.join(taken, "grade").select("label_id", "grade", F.sqrt(F.col("total") / F.col("taken")).alias("share"))
    # The sample has at most ``rows`` rows of three numbers, so it is safe to broadcast.
    texts = docs.select(F.col(id_col).alias("label_id"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.join(F.broadcast(sample), "label_id")


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, id_col: str = "doc_id") -> Model | None:
    """The model of a bounded sample; None where nothing is labelled.

    Features are made in the tasks. What the driver gets is bounded by ``rows`` times the features of a
    text (at most 2**BITS, some hundreds for usual texts). Repeated rows of a sampled id count once.
    """
    sample = labelled_sample(docs, labels, rows, id_col).dropDuplicates(["label_id"])
    made = sample.mapInArrow(_feature_rows, "id bigint, grade int, share double, features binary").toArrow()
    if not made.num_rows:
        return None
    # Copies of one text would make all its words look telling.
    made = made.sort_by("id")
    seen = made.column("features").to_pylist()
    once = list({x: i for i, x in reversed(list(enumerate(seen)))}.values())
    made = made.take(sorted(once))
    lists = [np.frombuffer(x, dtype=np.int32) for x in made.column("features").to_pylist()]
    first = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    shares = made.column("share").to_numpy()
    return fit(first, np.concatenate(lists).astype(np.int64), made.column("grade").to_numpy(), shares / shares.mean(), 3)


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi in W.row_slices(batch.column("text")):
            part = batch.slice(lo, hi - lo)
            row, feature = features(part.column("text"))
            bounds = np.searchsorted(row, np.arange(hi - lo + 1))
            packed = [feature[a:b].astype(np.int32).tobytes() for a, b in zip(bounds, bounds[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [part.column("label_id").cast(pa.int64()), part.column("grade"), part.column("share"), pa.array(packed, pa.binary())],
                names=["id", "grade", "share", "features"],
            )


def _scorer(model: Model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in W.row_slices(batch.column("text")):
                part = batch.slice(lo, hi - lo)
                row, feature = features(part.column("text"))
                total = np.bincount(row, model.weights[feature], hi - lo)
                reach = 1 - _sigmoid(model.thresholds[None, :] - total[:, None])
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), pa.array(reach.sum(axis=1)), *(pa.array(np.ascontiguousarray(x)) for x in reach.T)],
                    names=["row", "expected_grade", "p_grade_1", "p_grade_2"],
                )

    return score


def grade_documents(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, id_col: str = "doc_id") -> DataFrame:
    """(row, expected_grade, p_grade_1, p_grade_2): every input row as a struct with its ratings.

    ``p_grade_k`` is the probability of grade k or better. A null text counts as empty; both get the rating
    of a text without words. Without any usable label every document has the top grade. Columns may have
    any names; repeated rows are rated each.
    """
    model = train(docs, labels, rows, id_col)
    whole = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.coalesce("text", F.lit("")).alias("text")
    )
    if model is None:
        one = F.lit(1.0)
        return whole.select("row", (one * 2).alias("expected_grade"), one.alias("p_grade_1"), one.alias("p_grade_2"))
    ratings = ["expected_grade", "p_grade_1", "p_grade_2"]
    shape = whole.select("row", *[F.lit(None).cast("double").alias(c) for c in ratings]).schema
    return whole.mapInArrow(_scorer(model), shape)


def good_documents(docs: DataFrame, labels: DataFrame, min_probability: float = 0.5, **options) -> DataFrame:
    """The rows of ``docs`` that reach the top grade with at least ``min_probability``.

    Nulls, empty texts and repeated rows are rated as ``grade_documents`` says; each row stays or goes by itself.
    """
    return grade_documents(docs, labels, **options).filter(F.col("p_grade_2") >= min_probability).select("row.*")
