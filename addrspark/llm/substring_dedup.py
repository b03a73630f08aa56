"""Repeated passages found through difference-cover anchors.

Two equal runs of 20 words, wherever they start, share a position modulo 13 at which the cover {0, 1, 3, 9}
takes a hash of 8 words: any two residues have a pair of cover elements with their difference. So hashing
the cover's positions alone (4 in 13) finds every anchor that a repeated passage can have. Anchors seen
more than once extend to the windows of 20 words around them, and of windows with the same words all but
the earliest go.

Windows are settled in two steps. Neighbouring ones between two cuts that the words themselves determine
form a block; a block whose words stand earlier too settles all its windows at once. Only the windows of
other blocks are compared one by one, among them the earliest of every repeated one.

Each comparison is a shuffle by hash and a sort. What a slice of a task already sees twice sends one row
for its hash; the rest travels under keys of its own, so a passage that a third of all texts share costs a
row per slice. Texts are moved once, by id; all steps read that exchange.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from addrspark.llm import words as W

WINDOW = 20
# A perfect difference set: every difference modulo 13 occurs once. Anchors must fit: 8 + 13 - 1 = 20 words.
PERIOD, COVER = 13, (0, 1, 3, 9)
ANCHOR = WINDOW - PERIOD + 1
# A word starts a block where the hash of its anchor is 0 modulo this.
BLOCK_MEAN = 16
# Low bits of a packed hash that hold the position; higher parts of a position are held apart or left open.
PLACE_BITS = 16
HASHED = "first bigint, packed bigint, id bigint, late boolean, high int"
U64 = np.uint64
LOW = (1 << PLACE_BITS) - 1


def _spans(words: W.Words, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, position in the row) of word positions."""
    row = np.searchsorted(words.first, at, "right") - 1
    return row, at - words.first[row]


def _pack(hashes: np.ndarray, place: np.ndarray) -> np.ndarray:
    """47 bits of hash and 16 of position as a non-negative long."""
    top = (hashes >> U64(17)).astype(np.int64) << PLACE_BITS
    return top | (place & LOW)


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (packed, id) of the cover's anchors; a negative ``packed`` marks one known to repeat."""
    for batch in batches:
        for lo, hi in W.row_slices(batch.column("text")):
            words = W.scan_words(batch.column("text").slice(lo, hi - lo), W.BLANK_SPLIT)
            hashes, at = W.gram_hashes(words, ANCHOR)
            row, place = _spans(words, at)
            taken = np.isin(place % PERIOD, COVER) & (np.diff(words.first)[row] >= WINDOW)
            packed, ids = _pack(hashes[taken], place[taken]), batch.column("id").slice(lo, hi - lo).to_numpy()[row[taken]]
            order = np.argsort(packed, kind="stable")
            packed, ids = packed[order], ids[order]
            new = np.concatenate([[True], np.diff(packed >> PLACE_BITS) != 0])[: len(packed)]
            many = (~new) | np.concatenate([~new[1:], [False]])[: len(packed)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([packed[new], -1 - (packed[many] & LOW)])),
                    pa.array(np.concatenate([ids[new], ids[many]])),
                ],
                names=["packed", "id"],
            )


def _repeated_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a partition sorted by hash, (id, place) of the anchors that occur again."""
    last, last_id, last_sent = -1, 0, True
    for batch in batches:
        packed, ids = batch.column("packed").to_numpy(), batch.column("id").to_numpy()
        if not len(packed):
            continue
        known = packed < 0
        key = np.where(known, -1, packed >> PLACE_BITS)
        same = np.zeros(len(key), dtype=bool)
        same[1:] = (key[1:] == key[:-1]) & (key[1:] >= 0)
        same[0] = key[0] >= 0 and last >= 0 and key[0] == last >> PLACE_BITS
        again = same | np.concatenate([same[1:], [False]])
        out_ids, places = ids[known | again], np.where(known, -1 - packed, packed & LOW)[known | again]
        if same[0] and not last_sent:  # the first of the run ended the batch before
            out_ids, places = np.append(out_ids, last_id), np.append(places, last & LOW)
        yield pa.RecordBatch.from_arrays([pa.array(out_ids), pa.array(places.astype(np.int32))], names=["id", "place"])
        last, last_id, last_sent = int(packed[-1]), int(ids[-1]), bool(again[-1])


def _candidate_starts(words: W.Words, places: pa.Array) -> np.ndarray:
    """Word positions at which a window starts that contains an anchor at one of its row's ``places``."""
    total, counts = len(words.hashes), np.diff(words.first)
    marks = np.zeros(total + 1, dtype=np.int32)
    lists = places.flatten().to_numpy().astype(np.int64)
    row = np.repeat(np.arange(len(places)), places.value_lengths().fill_null(0).to_numpy().astype(np.int64))
    step = 1 << PLACE_BITS
    rounds = int(counts.max(initial=0)) // step + 1
    for k in range(rounds):  # a longer text may have the place again, one step on
        place = lists + k * step
        inside = place + ANCHOR <= counts[row]
        low = np.maximum(place[inside] - (WINDOW - ANCHOR), 0)
        high = np.minimum(place[inside], counts[row[inside]] - WINDOW)
        fits = low <= high
        base = words.first[row[inside]][fits]
        np.add.at(marks, base + low[fits], 1)
        np.add.at(marks, base + high[fits] + 1, -1)
    return np.flatnonzero(np.cumsum(marks[:-1]) > 0)


class _Blocks:
    """Blocks of a slice: windows ``begin`` to ``end`` (not included) of one text, and two hashes of their words."""

    def __init__(self, words: W.Words):
        hashes, at = W.gram_hashes(words, ANCHOR)
        cuts = at[hashes % U64(BLOCK_MEAN) == 0]
        row = np.searchsorted(words.first, cuts, "right") - 1
        fits = row[1:] == row[:-1]
        fits &= cuts[1:] + WINDOW - 1 <= words.first[row[1:] + 1]
        self.begin, self.end = cuts[:-1][fits], cuts[1:][fits]
        stop, size = self.end + WINDOW - 1, (self.end - self.begin).astype(U64)
        self.first = W.mix(W._rolling(words.hashes, self.begin, stop, W._odd(31)) + size)
        self.second = W.mix(W._rolling(W.mix(words.hashes + U64(37)), self.begin, stop, W._odd(37)) + size)

    def settled(self, words: W.Words, places: pa.Array, firsts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(begin, end) of the blocks named by place and hash in each row's lists."""
        at, wanted = _listed(words, places, firsts)
        k = np.minimum(np.searchsorted(self.begin, at), max(len(self.begin) - 1, 0))
        hit = (self.begin[k] == at) & (self.first[k] == wanted) if len(self.begin) else np.zeros(len(at), bool)
        return self.begin[k[hit]], self.end[k[hit]]


def _listed(words: W.Words, places: pa.Array, firsts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(word position, hash) of the entries of each row's lists that lie inside its text."""
    size = places.value_lengths().fill_null(0).to_numpy().astype(np.int64)
    row = np.repeat(np.arange(len(places)), size)
    place = places.flatten().to_numpy().astype(np.int64)
    fits = place + WINDOW <= np.diff(words.first)[row]
    return (words.first[row] + place)[fits], firsts.flatten().to_numpy().view(U64)[fits]


def _covered(size: int, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Positions below ``size`` inside any of the ranges."""
    marks = np.zeros(size + 1, dtype=np.int64)
    np.add.at(marks, begin, 1)
    np.add.at(marks, end, -1)
    return np.cumsum(marks[:-1]) > 0


def _earliest_of_slice(
    words: W.Words, at: np.ndarray, one: np.ndarray, more: np.ndarray, ids: np.ndarray, late: np.ndarray
) -> pa.RecordBatch:
    """Rows (first, packed, id, late, high) of hashed places; those that repeat an earlier one have a negative ``packed``."""
    row, place = _spans(words, at)
    ids, late = ids[row], late[row]
    order = np.lexsort((place, ids, late, more, one))
    one, more, ids, late, place = one[order], more[order], ids[order], late[order], place[order]
    new = np.ones(len(one), dtype=bool)
    new[1:] = (one[1:] != one[:-1]) | (more[1:] != more[:-1])
    # Equal places of repeated rows are not later than each other.
    run = np.maximum.accumulate(np.where(new, np.arange(len(one)), 0))
    new |= (ids == ids[run]) & (place == place[run]) & (late == late[run])
    packed = np.where(new, _pack(more, place), -1 - (place & LOW))
    high = pa.array((place >> PLACE_BITS).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [pa.array(one.view(np.int64)), pa.array(packed), pa.array(ids), pa.array(late), high],
        names=["first", "packed", "id", "late", "high"],
    )


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, W.Words, np.ndarray, np.ndarray]]:
    """(rows, words, ids, whether the given id is null) of each slice."""
    for batch in batches:
        for lo, hi in W.row_slices(batch.column("text")):
            rows = batch.slice(lo, hi - lo)
            late = rows.column("out_id").is_null().to_numpy(zero_copy_only=False)
            yield rows, W.scan_words(rows.column("text"), W.BLANK_SPLIT), rows.column("id").to_numpy(), late


def _block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The blocks whose windows are all candidates."""
    for rows, words, ids, late in _slices(batches):
        blocks = _Blocks(words)
        able = np.zeros(len(words.hashes) + 1, dtype=np.int64)
        able[1 + _candidate_starts(words, rows.column("places"))] = 1
        upto = np.cumsum(able)
        full = upto[blocks.end] - upto[blocks.begin] == blocks.end - blocks.begin
        yield _earliest_of_slice(words, blocks.begin[full], blocks.first[full], blocks.second[full], ids, late)


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The candidate windows outside of blocks that stand earlier."""
    for rows, words, ids, late in _slices(batches):
        begin, end = _Blocks(words).settled(words, rows.column("block_places"), rows.column("block_firsts"))
        at = _candidate_starts(words, rows.column("places"))
        at = at[~_covered(len(words.hashes), begin, end)[at]]
        yield _earliest_of_slice(words, at, _window_hashes(words, at), _window_hashes(words, at, seed=29), ids, late)


def _window_hashes(words: W.Words, at: np.ndarray, seed: int = 17) -> np.ndarray:
    """Hashes of the windows at ``at``."""
    out, base = np.zeros(len(at), dtype=U64), U64(W._odd(seed))
    for k in range(WINDOW):
        out = out * base + (words.hashes if seed == 17 else W.mix(words.hashes + U64(seed)))[at + k]
    return W.mix(out)


def _later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a partition sorted by hash and place, (id, place, first) of all rows but each run's earliest."""
    head = None  # (first, second hash, id, late, place) of the current run's earliest
    for batch in batches:
        one, packed, ids, late, high = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
        n = len(one)
        if not n:
            continue
        known = packed < 0
        place = np.where(known, -1 - packed, packed & LOW) + (high.astype(np.int64) << PLACE_BITS)
        more = packed >> PLACE_BITS
        new = np.ones(n, dtype=bool)
        new[1:] = (one[1:] != one[:-1]) | (more[1:] != more[:-1]) | known[1:] | known[:-1]
        goes_on = head is not None and not known[0] and (one[0], more[0]) == head[:2]
        if goes_on:
            new[0] = False
        run = np.maximum.accumulate(np.where(new, np.arange(n), -1))
        at = np.maximum(run, 0)
        first_id, first_late, first_place = ids[at], late[at], place[at]
        if goes_on:
            first_id[run < 0], first_late[run < 0], first_place[run < 0] = head[2:]
        later = known | ~((ids == first_id) & (late == first_late) & (place == first_place))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[later]), pa.array(place[later].astype(np.int32)), pa.array(one[later])],
            names=["id", "place", "first"],
        )
        head = None if known[-1] else (one[-1], more[-1], first_id[-1], first_late[-1], first_place[-1])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Apply the repeated blocks and windows to the texts; one counts where its hash stands at its place."""
    for rows, words, _, _ in _slices(batches):
        begin, end = _Blocks(words).settled(words, rows.column("block_places"), rows.column("block_firsts"))
        at, wanted = _listed(words, rows.column("window_places"), rows.column("window_firsts"))
        at = at[_window_hashes(words, at) == wanted]
        begin, end = np.concatenate([begin, at]), np.concatenate([end + WINDOW - 1, at + WINDOW])
        gone = _covered(len(words.hashes), begin, end)
        before = np.concatenate([[0], np.cumsum(gone)])
        removed = before[words.first[1:]] - before[words.first[:-1]]
        digests, kept_texts = [], []
        for i, text in enumerate(rows.column("text").to_pylist()):
            pieces = (text or "").encode().split()
            if removed[i]:
                keep = ~gone[words.first[i] : words.first[i + 1]]
                pieces = [pieces[k] for k in np.flatnonzero(keep)]
            kept = b" ".join(pieces)
            digests.append(hashlib.sha256(kept).hexdigest())
            kept_texts.append(kept.decode())
        yield pa.RecordBatch.from_arrays(
            [
                rows.column("out_id"), pa.array(np.diff(words.first)), pa.array(removed),
                pa.array(digests, pa.string()), pa.array(kept_texts, pa.string()),
            ],
            names=["id", "n_words", "n_removed", "kept_sha256", "kept_text"],
        )


def _by_hash(rows: DataFrame, hashed: Column, order: list[str]) -> DataFrame:
    """Rows of a hash together and sorted; rows known to repeat go anywhere."""
    key = F.when(F.col("packed") < 0, F.xxhash64("id", "packed")).otherwise(hashed)
    return rows.repartition(key).sortWithinPartitions(*order)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_words, n_removed, kept_sha256, kept_text.

    Words are split by blanks and line breaks and compared unchanged; a null text has none. Every word goes
    that lies in a window of 20 words whose sequence also starts earlier: in a row with a smaller id, or
    earlier in the same one. Windows are judged on the input. ``kept_text`` joins what stays by one space.
    Rows repeated under one id stand at equal places, none of which is earlier; texts that differ under one
    id are judged each. Null ids come after all others. Columns other than id and text are not looked at.
    An empty table gives an empty result.
    """
    given = F.col(id_col).cast("bigint")
    text = F.coalesce(F.col(text_col), F.lit(""))
    # One projection for all steps, so that its exchange by id is made once.
    rows = docs.select(F.coalesce(given, F.xxhash64(text)).alias("id"), given.alias("out_id"), text.alias("text"))
    anchors = rows.select("id", "text").mapInArrow(_anchors, "packed bigint, id bigint")
    sorted_anchors = _by_hash(anchors, F.shiftright("packed", PLACE_BITS), ["packed"])
    repeated = sorted_anchors.mapInArrow(_repeated_anchors, "id bigint, place int")
    places = repeated.groupBy("id").agg(F.collect_set("place").alias("places"))
    met = rows.join(places, "id")
    blocks = _later_places(met.mapInArrow(_block_rows, HASHED), "block")
    windows = _later_places(met.join(blocks, "id", "left").mapInArrow(_window_rows, HASHED), "window")
    cuts = rows.join(blocks, "id", "left").join(windows, "id", "left")
    return cuts.mapInArrow(
        _cut, "id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept_text string"
    ).withColumnRenamed("id", id_col)


def _later_places(rows: DataFrame, name: str) -> DataFrame:
    """Per id the places and hashes of the rows that repeat an earlier one."""
    order = ["first", F.shiftright("packed", PLACE_BITS), "late", "id", "high", "packed"]
    later = _by_hash(rows, F.col("first"), order).mapInArrow(_later, "id bigint, place int, first bigint")
    found = later.groupBy("id").agg(F.collect_list(F.struct("place", "first")).alias("found"))
    return found.select("id", F.col("found.place").alias(f"{name}_places"), F.col("found.first").alias(f"{name}_firsts"))
