"""Documents that hold benchmark items, found by BM25 over an index of the items.

Every passage of every document is a query, and its terms' postings give the candidates. A passage leaks an
item when it holds enough word n-grams of both its question and its answer, or a run of its words. Each item's
threshold is the least score that this can have, so retrieval above the thresholds loses no leak. Block-max WAND
prunes it: a passage goes on when the largest contributions of its terms reach the lowest threshold, a block of
items when the largest ones within the block, as its postings tell, reach the block's, and only the items of such
blocks are scored. What scores above its threshold is verified. The steps run on many passages at once, so
cursors become arrays. Scores are shares of the item's score for its own text.

Items are indexed in segments, each built in a task of its own; the driver sees the finished indexes, a part of
bounded size at a time, and no text.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from addrspark.llm import words as W
from addrspark.llm.shared import written

K1, B = 1.2, 0.75
MIN_OVERLAP = 0.5
GRAM = 5
RUN = 13
ITEM_BLOCK = 2
SEGMENT_ITEMS = 512
PASSAGES = 512
# Items scored at once.
PAIRS = 1 << 15
# Serialised indexes that go to every task at once.
PART_BYTES = 32 << 20
U64 = np.uint64


class Index(NamedTuple):
    """Items as sorted terms with their contributions, and block maxima per term (compressed rows)."""

    ids: list[int | None]
    terms: np.ndarray  # sorted term hashes
    most: np.ndarray  # largest contribution of each term
    post_start: np.ndarray  # per term, where its postings begin
    post_block: np.ndarray  # postings: a block of items that the term is in,
    post_most: np.ndarray  # and its largest contribution there
    item_start: np.ndarray  # per item, where its terms begin
    item_terms: np.ndarray
    item_weights: np.ndarray
    grams: list[tuple[np.ndarray, np.ndarray]]  # of question and answer
    part_words: list[tuple[int, int]]
    runs: list[np.ndarray]
    run_words: list[int]
    longest: int
    least: np.ndarray  # per item, the smallest score of a passage that leaks it
    block_least: np.ndarray
    gram_sets: list[tuple[int, np.ndarray]]  # per length, the sorted n-grams that verification counts


def question_and_answer(text: str, count: int) -> int:
    """The number of words of the question: up to the last question mark, else half of the item."""
    cut = text.rfind("?")
    if cut < 0:
        return count // 2
    words = W.scan_words(pa.array([text[: cut + 1]]), W.ALNUM_SPLIT, fold=True)
    return len(words.hashes) if 0 < len(words.hashes) < count else count // 2


def _gram_values(hashes: np.ndarray, n: int) -> np.ndarray:
    """Distinct hashes of the runs of ``n`` words, or of all words where there are fewer."""
    if not len(hashes):
        return np.empty(0, U64)
    n = min(n, len(hashes))
    words = W.Words(hashes, np.array([0, len(hashes)]), hashes, hashes, hashes)
    return np.unique(W.gram_hashes(words, n)[0])


def _distinct(windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sorted, first): the terms of every window in order, and whether each is the first of its kind there."""
    ordered = np.sort(windows, axis=1)
    return ordered, np.concatenate([np.ones((len(ordered), 1), bool), ordered[:, 1:] != ordered[:, :-1]], axis=1)


def least_score(places: np.ndarray, weights: np.ndarray, question: int, min_overlap: float) -> float:
    """A score that no passage stays below which leaks the item; ``places`` are its words as places in ``weights``.

    A run of the item brings the weights of its terms. For n-grams of question and answer each term's weight is
    dealt to the n-grams that hold it; so many n-grams as are needed bring at least the sum of the smallest shares.
    """
    runs, first = _distinct(np.lib.stride_tricks.sliding_window_view(places, min(RUN, len(places))))
    by_run = (weights[runs] * first).sum(axis=1).min()
    parts = [np.unique(np.lib.stride_tricks.sliding_window_view(p, min(GRAM, len(p))), axis=0) for p in (places[:question], places[question:]) if len(p)]
    holders = np.zeros(len(weights))
    for grams in parts:
        ordered, first = _distinct(grams)
        np.add.at(holders, ordered[first], 1)
    by_grams = 0.0
    for grams in parts:
        ordered, first = _distinct(grams)
        shares = np.sort(((weights / np.maximum(holders, 1))[ordered] * first).sum(axis=1))
        by_grams += shares[: int(np.ceil(min_overlap * len(grams) - 1e-9))].sum()
    return float(min(by_run, by_grams)) * (1 - 1e-9)


def _gram_sets(grams: list, part_words: list, runs: list, run_words: list) -> list[tuple[int, np.ndarray]]:
    counted = [(min(GRAM, n), g) for both, sizes in zip(grams, part_words, strict=True) for g, n in zip(both, sizes, strict=True)]
    counted += list(zip(run_words, runs, strict=True))
    return [(n, np.unique(np.concatenate([g for m, g in counted if m == n]))) for n in sorted({n for n, g in counted if len(g)})]


def build_index(
    items: list[tuple[int | None, str]], frequency: dict[int, int], total: int, mean: float, min_overlap: float = MIN_OVERLAP
) -> Index:
    """The index of one part of the items, with frequencies of all of them."""
    ids, item_words, splits = [], [], []
    for item, text in items:
        hashes = W.scan_words(pa.array([text]), W.ALNUM_SPLIT, fold=True).hashes
        if len(hashes):
            ids.append(item)
            item_words.append(hashes)
            splits.append(question_and_answer(text, len(hashes)))
    terms = np.unique(np.concatenate(item_words)) if item_words else np.empty(0, U64)
    idf = np.array([np.log(1 + (total - n + 0.5) / (n + 0.5)) for n in (frequency[int(t)] for t in terms.view(np.int64))])
    item_terms, item_weights, least = [], [], []
    for hashes, question in zip(item_words, splits, strict=True):
        own, places, times = np.unique(hashes, return_inverse=True, return_counts=True)
        at = np.searchsorted(terms, own)
        weight = idf[at] * times * (K1 + 1) / (times + K1 * (1 - B + B * len(hashes) / mean))
        item_terms.append(at)
        item_weights.append(weight / weight.sum())
        least.append(least_score(places, item_weights[-1], question, min_overlap))
    rows = np.concatenate(item_terms) if ids else np.empty(0, np.int64)
    weights = np.concatenate(item_weights) if ids else np.empty(0)
    item_sizes = np.array([len(t) for t in item_terms], dtype=np.int64)
    item_start = np.concatenate([[0], np.cumsum(item_sizes)])
    block = np.repeat(np.arange(len(ids)) // ITEM_BLOCK, item_sizes)
    n_blocks = len(ids) // ITEM_BLOCK + 1
    posting, place = np.unique(rows * n_blocks + block, return_inverse=True)
    post_most = np.zeros(len(posting))
    np.maximum.at(post_most, place, weights)
    post_start = np.searchsorted(posting // n_blocks, np.arange(len(terms) + 1))
    most = np.zeros(len(terms))
    np.maximum.at(most, rows, weights)
    grams = [(_gram_values(h[:q], GRAM), _gram_values(h[q:], GRAM)) for h, q in zip(item_words, splits, strict=True)]
    part_words = [(q, len(h) - q) for h, q in zip(item_words, splits, strict=True)]
    run_words = [min(RUN, len(h)) for h in item_words]
    runs = [_gram_values(h, n) for h, n in zip(item_words, run_words, strict=True)]
    longest = max((len(h) for h in item_words), default=0)
    block_least = np.full(n_blocks, np.inf)
    np.minimum.at(block_least, np.arange(len(ids)) // ITEM_BLOCK, least)
    return Index(
        ids, terms, most, post_start, posting % n_blocks, post_most, item_start, rows, weights, grams, part_words, runs,
        run_words, longest, np.array(least), block_least, _gram_sets(grams, part_words, runs, run_words),
    )


def _passages(first: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, begin, end) of passages of twice the longest item, each beginning half a passage on.

    Wherever an item stands in a text, one passage holds all of it.
    """
    step = max(longest, 64)
    counts = np.diff(first)
    number = np.maximum(-(-counts // step) - 1, np.minimum(counts, 1))
    row = np.repeat(np.arange(len(counts)), number)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number)
    begin = first[row] + nth * step
    return row, begin, np.minimum(begin + 2 * step, first[row + 1])


def _expanded(low: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers ``low`` to ``low + size`` of each pair in a row."""
    return np.repeat(low - (np.cumsum(size) - size), size) + np.arange(size.sum())


def _retrieve(index: Index, words: W.Words) -> Iterator[tuple[int, int, int, int, float]]:
    """(row, begin, end, item, score) of every passage and item whose score reaches the item's threshold."""
    row, begin, end = _passages(words.first, index.longest)
    place = np.minimum(np.searchsorted(index.terms, words.hashes), len(index.terms) - 1)
    known = np.flatnonzero(index.terms[place] == words.hashes)
    low, high = np.searchsorted(known, begin), np.searchsorted(known, end)
    n_terms, lowest = len(index.terms), index.least.min()
    for a in range(0, len(row), PASSAGES):
        size = high[a : a + PASSAGES] - low[a : a + PASSAGES]
        has = np.zeros((len(size), n_terms), dtype=bool)
        has[np.repeat(np.arange(len(size)), size), place[known[_expanded(low[a : a + PASSAGES], size)]]] = True
        able = has @ index.most >= lowest
        if not able.any():
            continue
        has[~able] = False
        for p, item, score in _scored(index, has):
            yield int(row[a + p]), int(begin[a + p]), int(end[a + p]), item, score


def _scored(index: Index, has: np.ndarray) -> Iterator[tuple[int, int, float]]:
    """(passage, item, score) above the item's threshold, for passages given by the terms that they hold."""
    n_blocks = len(index.block_least)
    passage, term = np.nonzero(has)
    size = index.post_start[term + 1] - index.post_start[term]
    entry = _expanded(index.post_start[term], size)
    reach = np.bincount(np.repeat(passage, size) * n_blocks + index.post_block[entry], index.post_most[entry], len(has) * n_blocks)
    reached = np.flatnonzero(reach >= np.tile(index.block_least, len(has)) * (1 - 1e-9))
    passage, block = np.divmod(reached, n_blocks)
    first = block * ITEM_BLOCK
    size = np.minimum(first + ITEM_BLOCK, len(index.ids)) - first
    passages, items = np.repeat(passage, size), _expanded(first, size)
    for a in range(0, len(items), PAIRS):
        passage, item = passages[a : a + PAIRS], items[a : a + PAIRS]
        sizes = index.item_start[item + 1] - index.item_start[item]
        entry = _expanded(index.item_start[item], sizes)
        of = np.repeat(np.arange(len(item)), sizes)
        score = np.bincount(of, index.item_weights[entry] * has[passage[of], index.item_terms[entry]], len(item))
        for k in np.flatnonzero(score >= index.least[item]):
            yield int(passage[k]), int(item[k]), float(score[k])


def _gram_places(index: Index, words: W.Words) -> np.ndarray:
    """Running number of the places of a slice where some n-gram of the items begins.

    A passage without any is no leak, which spares counting its n-grams.
    """
    marks = np.zeros(len(words.hashes) + 1, dtype=np.int64)
    for n, known in index.gram_sets:
        hashes, at = W.gram_hashes(words, n)
        place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        marks[at[known[place] == hashes] + 1] = 1
    return np.cumsum(marks)


def _verified(index: Index, item: int, hashes: np.ndarray, min_overlap: float) -> bool:
    """Enough n-grams of both question and answer, or a long run of the item word by word."""
    parts = index.grams[item]
    sizes = [min(GRAM, n) for n in index.part_words[item]]
    shares = [np.isin(p, _gram_values(hashes, n)).mean() if len(p) else 1.0 for p, n in zip(parts, sizes, strict=True)]
    if min(shares) >= min_overlap:
        return True
    return len(hashes) >= index.run_words[item] and bool(
        np.isin(index.runs[item], _gram_values(hashes, index.run_words[item])).any()
    )


def _marker(shipped: Broadcast, min_overlap: float):
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments = [Index(*pickle.loads(one)) for one in shipped.value]
        for batch in batches:
            for lo, hi in W.row_slices(batch.column("text")):
                part = batch.slice(lo, hi - lo)
                words = W.scan_words(part.column("text"), W.ALNUM_SPLIT, fold=True)
                found = part.column("items").to_pylist()
                for index in segments if len(words.hashes) else ():
                    items: list[dict[int, float]] = [{} for _ in range(hi - lo)]
                    begun = _gram_places(index, words)
                    for row, begin, end, item, score in _retrieve(index, words):
                        if begun[end] > begun[begin] and score > items[row].get(item, 0) and (
                            item in items[row] or _verified(index, item, words.hashes[begin:end], min_overlap)
                        ):
                            items[row][item] = score
                    for old, new in zip(found, items, strict=True):
                        old.extend({"item": index.ids[i], "score": s} for i, s in sorted(new.items()))
                yield part.set_column(part.schema.get_field_index("items"), "items", pa.array(found, part.schema.field("items").type))

    return mark


def mark_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    min_overlap: float = MIN_OVERLAP,
    text_col: str = "text",
) -> DataFrame:
    """(row, items): every input row as a struct, and the verified benchmark items in it with their scores.

    Words are runs of letters, digits and non-ASCII characters in lower case. Null and empty texts hold nothing, and neither do items without words; null item ids stay null. An
    item's question is its text up to the last question mark, else the first half; the rest is its answer. An
    item is found where ``min_overlap`` (above 0) of the 5-grams of both stand in a passage, or any 13 of its words
    in a row (all of them, in a shorter item). The score does not decide.
    Documents pass through in one piece without a shuffle, repeated rows are judged each, and their columns
    may have any name. Indexes of at most PART_BYTES, or of one segment, go to every task at once; a larger
    benchmark is taken part by part, with the documents written in between.
    """
    if not 0 < min_overlap <= 1:
        raise ValueError(f"min_overlap must be above 0 and at most 1, not {min_overlap}")
    indexes = _indexes(benchmark, min_overlap)
    sizes = indexes.select("segment", F.octet_length("index").alias("bytes")).collect()
    parts: list[list[int]] = [[]]
    room = PART_BYTES
    for r in sorted(sizes):
        if parts[-1] and r["bytes"] > room:
            parts.append([])
            room = PART_BYTES
        parts[-1].append(r["segment"])
        room -= r["bytes"]

    named = F.struct(*[F.col(f"`{c}`") for c in docs.columns]) if docs.columns else F.lit(None)
    marked = docs.select(
        named.alias("row"), F.lower(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("text"),
        F.array().cast("array<struct<item: bigint, score: double>>").alias("items"),
    )
    for k, part in enumerate(parts):
        chosen = indexes.filter(F.col("segment").isin(part)).select("index").collect()
        shipped = docs.sparkSession.sparkContext.broadcast([bytes(r["index"]) for r in chosen])
        marked = marked.mapInArrow(_marker(shipped, min_overlap), marked.schema)
        if k < len(parts) - 1:
            marked = written(marked, "marked")
    return marked.select("row", "items")


def _indexes(benchmark: DataFrame, min_overlap: float) -> DataFrame:
    """(segment, index): the serialised index of each segment of items, built in tasks from counts over all items.

    An item goes to a segment by hash, so segments have about SEGMENT_ITEMS items. Every segment gets the
    frequencies of its own terms.
    """
    text = F.lower(F.coalesce("text", F.lit("")))
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), text.alias("text"), F.monotonically_increasing_id().alias("line"))
    hashed = written(items.mapInArrow(_item_terms, "item_id bigint, text string, line bigint, length bigint, terms array<bigint>"), "terms")
    seen = hashed.filter("length > 0").agg(F.count(F.lit(1)), F.avg("length")).first()
    total, mean = seen[0], seen[1] or 1.0
    segments = max(1, -(-total // SEGMENT_ITEMS))
    placed = hashed.filter("length > 0").withColumn("segment", F.pmod(F.xxhash64("line"), F.lit(segments)))
    each = placed.select("segment", F.explode("terms").alias("term"))
    frequency = each.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    counts = each.distinct().join(frequency, "term").select(
        "segment", F.lit(None).cast("bigint").alias("item_id"), F.lit(None).cast("string").alias("text"), "term", "n"
    )
    texts = placed.select("segment", "item_id", "text", F.lit(None).cast("bigint").alias("term"), F.lit(None).cast("bigint").alias("n"))

    def build(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        known = {r["term"]: r["n"] for r in rows if r["term"] is not None}
        own = sorted(((r["item_id"], r["text"]) for r in rows if r["text"] is not None), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        index = build_index(own, known, total, mean, min_overlap)
        return pa.table({"segment": table.column("segment").slice(0, 1), "index": pa.array([pickle.dumps(tuple(index))], pa.binary())})

    return written(texts.unionByName(counts).groupBy("segment").applyInArrow(build, "segment bigint, index binary"), "indexes")


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every item with its length and distinct terms."""
    for batch in batches:
        lengths, terms = [], []
        for lo, hi in W.row_slices(batch.column("text")):
            words = W.scan_words(batch.column("text").slice(lo, hi - lo), W.ALNUM_SPLIT, fold=True)
            lengths += np.diff(words.first).tolist()
            terms += [np.unique(words.hashes[a:b]).view(np.int64) for a, b in zip(words.first, words.first[1:], strict=False)]
        given = [batch.column(c) for c in ("item_id", "text", "line")]
        made = [pa.array(lengths, pa.int64()), pa.array(terms, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays([*given, *made], names=["item_id", "text", "line", "length", "terms"])


def without_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item.

    Null and empty texts hold none and stay; repeated rows stay or go together, each on its own.
    """
    return mark_leaks(docs, benchmark, **options).filter(F.size("items") == 0).select("row.*")
