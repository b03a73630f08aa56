"""Quality rules as a short-circuit cascade.

Rules are tests on counts of a text. Counts come in groups that are measured together, and a group is
measured only for the texts that no earlier rule rejected. A sample gives each group's time per byte and
which rules reject which of its texts; the order takes, again and again, the rule that rejects most of what
the rules before it leave, per time that it still has to spend. The order decides the time only: a text is
kept when no rule rejects it, whichever comes first.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from addrspark.llm import words as W

SAMPLE_ROWS = 2000
WINDOW = 5
# The characters counted as symbols.
SYMBOLS = b"#*$%&|<>"

Counts = dict[str, np.ndarray]


class Rule(NamedTuple):
    """``fails`` tells the texts to reject from counts of the named groups."""

    name: str
    groups: tuple[str, ...]
    fails: Callable[[Counts], np.ndarray]


# Thresholds, as whole-number comparisons so that SQL gives the same.
RULES = (
    Rule("few_words", ("words",), lambda c: c["n_words"] < 10),
    Rule("repeated_windows", ("words", "windows"), lambda c: 100 * c["n_repeat_words"] > 20 * c["n_words"]),
    Rule("symbols", ("words", "characters"), lambda c: 10 * c["n_symbols"] > c["n_words"]),
    Rule("duplicate_lines", ("lines",), lambda c: 10 * c["n_dup_lines"] > 3 * c["n_lines"]),
    Rule(
        "word_length",
        ("words", "characters"),
        lambda c: (c["word_chars"] < 3 * c["n_words"]) | (c["word_chars"] > 10 * c["n_words"]),
    ),
    Rule("capitals", ("characters",), lambda c: 10 * c["n_capitals"] > 4 * c["word_chars"]),
    Rule("exclamations", ("words", "characters"), lambda c: 2 * c["n_exclamations"] > c["n_words"]),
    Rule("letters", ("characters",), lambda c: 10 * c["n_letters"] < 4 * c["word_chars"]),
    Rule("top_word", ("words", "top_word"), lambda c: 10 * c["n_top_word"] > 4 * c["n_words"]),
)
BASE_GROUPS = ("words", "characters", "lines", "windows")

COUNTS = {
    "words": ("n_words",),
    "characters": ("word_chars", "n_symbols", "n_capitals", "n_exclamations", "n_letters"),
    "lines": ("n_lines", "n_dup_lines"),
    "windows": ("n_repeat_words",),
    "top_word": ("n_top_word",),
}
# Groups that need the words found; finding them is a group without counts.
NEEDS_SCAN = ("words", "windows", "top_word")

_ALL = np.ones(256, dtype=bool)
_LINE_BYTES = _ALL.copy()
_LINE_BYTES[0x0A] = False
_HEADS = _ALL.copy()
_HEADS[0x80:0xC0] = False
_LETTERS = np.zeros(256, dtype=bool)
_LETTERS[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x100)]] = True


def _marks(characters: bytes) -> np.ndarray:
    marks = np.zeros(256, dtype=bool)
    marks[list(characters)] = True
    return marks


_CHARACTERS = {
    "word_chars": W.BLANK_SPLIT & _HEADS,
    "n_symbols": _marks(SYMBOLS),
    "n_capitals": _marks(bytes(range(0x41, 0x5B))),
    "n_exclamations": _marks(b"!"),
    "n_letters": _LETTERS,
}


def _runs(row: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, first, size): pairs sorted, where runs of equal ones begin, and the sizes of the runs."""
    order = np.lexsort((values, row))
    r, v = row[order], values[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(len(r), 1), bool), (r[1:] != r[:-1]) | (v[1:] != v[:-1])]))
    return order, first, np.diff(np.append(first, len(r)))


class Texts:
    """Counts of the texts of a column, measured group by group for the rows that are still of interest."""

    def __init__(self, column: pa.Array):
        self.column = column
        self.counts: Counts = {}
        self.times: dict[str, float] = {}
        self.known: dict[str, np.ndarray] = {}
        self._scan: tuple[np.ndarray, W.Words] | None = None

    def measure(self, group: str, active: np.ndarray) -> None:
        """Measure ``group`` for the rows of the mask ``active`` that lack it."""
        if group not in self.known:
            self.known[group] = np.zeros(len(self.column), bool)
        known = self.known[group]
        rows = np.flatnonzero(active & ~known)
        if not len(rows):
            return
        for name in COUNTS[group]:
            self.counts.setdefault(name, np.zeros(len(self.column), np.int64))
        words = self._found(rows) if group in NEEDS_SCAN else None
        started = time.perf_counter()
        for name, values in getattr(self, f"_{group}")(rows, words).items():
            self.counts[name][rows] = values
        self.times[group] = self.times.get(group, 0.0) + time.perf_counter() - started
        known[rows] = True

    def _column(self, rows: np.ndarray) -> pa.Array:
        return self.column if len(rows) == len(self.column) else self.column.take(pa.array(rows))

    def _found(self, rows: np.ndarray) -> W.Words:
        """The words of the given rows; found anew only where an earlier scan does not hold them all."""
        started = time.perf_counter()
        if self._scan is None or not np.isin(rows, self._scan[0]).all():
            self._scan = rows, W.scan_words(self._column(rows), W.BLANK_SPLIT)
        held, words = self._scan
        if len(held) != len(rows):
            at = np.searchsorted(held, rows)
            size = words.first[at + 1] - words.first[at]
            first = np.concatenate([[0], np.cumsum(size)])
            take = np.repeat(words.first[at] - first[:-1], size) + np.arange(first[-1])
            words = W.Words(words.hashes[take], first, words.starts[take], words.ends[take], words.data)
        self.times["scan"] = self.times.get("scan", 0.0) + time.perf_counter() - started
        return words

    def _characters(self, rows: np.ndarray, _: None) -> Counts:
        offsets, data = W.text_buffers(self._column(rows))
        out = {name: np.zeros(len(rows), np.int64) for name in _CHARACTERS}
        for lo in range(int(offsets[0]), int(offsets[-1]), W.PIECE):  # in pieces, for texts of any length
            hi = min(lo + W.PIECE, int(offsets[-1]))
            edges = np.clip(offsets, lo, hi) - lo
            for name, marks in _CHARACTERS.items():
                sums = np.concatenate([[0], np.cumsum(marks[data[lo:hi]])])
                out[name] += sums[edges[1:]] - sums[edges[:-1]]
        return out

    def _words(self, rows: np.ndarray, words: W.Words) -> Counts:
        return {"n_words": np.diff(words.first)}

    def _lines(self, rows: np.ndarray, _: None) -> Counts:
        """Lines with a word, and how many of them equal an earlier one."""
        lines = W.scan_words(self._column(rows), _LINE_BYTES)
        row, values = W.rows_of(lines), lines.hashes
        if len(row):
            # From one line's start to the next there are only line breaks besides the line itself.
            wordy = np.logical_or.reduceat(W.BLANK_SPLIT[lines.data[: lines.ends[-1]]], lines.starts)
            row, values = row[wordy], values[wordy]
        n = np.bincount(row, minlength=len(rows))
        _, first, _ = _runs(row, values)
        return {"n_lines": n, "n_dup_lines": n - np.bincount(np.sort(row)[first], minlength=len(rows))}

    def _windows(self, rows: np.ndarray, words: W.Words) -> Counts:
        """Words in windows that stand in the text twice or more."""
        hashes, at = W.gram_hashes(words, WINDOW)
        row = W.rows_of(words)
        order, first, size = _runs(row[at], hashes)
        again = at[order[np.repeat(size > 1, size)]]
        change = np.zeros(len(row) + 1, np.int64)
        np.add.at(change, again, 1)
        np.add.at(change, again + WINDOW, -1)
        return {"n_repeat_words": np.bincount(row[np.cumsum(change[:-1]) > 0], minlength=len(rows))}

    def _top_word(self, rows: np.ndarray, words: W.Words) -> Counts:
        """Occurrences of the most frequent word."""
        row = W.rows_of(words)
        _, first, size = _runs(row, words.hashes)
        most = np.zeros(len(rows), np.int64)
        np.maximum.at(most, np.sort(row)[first], size)
        return {"n_top_word": most}


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi in W.row_slices(batch.column("text")):
            yield batch.slice(lo, hi - lo)


_SAMPLE_DDL = f"failed bigint, bytes bigint, {', '.join(f'{g} double' for g in ('scan', *COUNTS))}"


def _measurer(rules: Sequence[Rule]):
    """Which rules reject each sampled text, as bits; the slice's times go with its first text."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            texts, every = Texts(batch.column("text")), np.ones(batch.num_rows, bool)
            for group in COUNTS:
                texts.measure(group, every)
            failed = sum(rule.fails(texts.counts).astype(np.int64) << k for k, rule in enumerate(rules))
            sizes = np.diff(W.text_buffers(batch.column("text"))[0])
            spent = [np.zeros(batch.num_rows) for _ in range(len(COUNTS) + 1)]
            for column, group in zip(spent, ("scan", *COUNTS), strict=True):
                column[0] = texts.times.get(group, 0.0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (failed, sizes, *spent)], names=["failed", "bytes", "scan", *COUNTS]
            )

    return measure


def cascade_order(
    rules: Sequence[Rule], outcomes: list[tuple[int, int, int]], cost: dict[str, float]
) -> list[Rule]:
    """Rules by rejection per cost, each judged on the texts that the ones before it leave.

    ``outcomes`` are (rejecting rules as bits, texts, bytes), ``cost`` the seconds a byte of each group. A rule
    pays for its groups that no earlier rule has measured. Rules that reject nothing come last, cheapest first.
    """
    left, out, paid = list(range(len(rules))), [], set()
    while left:
        alive = [(m, n, b) for m, n, b in outcomes if not any(m >> k & 1 for k in out)]
        size = sum(b for _, _, b in alive)

        def worth(k: int, alive=alive, size=size) -> tuple[float, float, int]:
            needed = {*rules[k].groups, *(["scan"] if any(g in NEEDS_SCAN for g in rules[k].groups) else [])} - paid
            price = sum(cost.get(g, 0.0) for g in needed) * size + 1e-9
            return sum(n for m, n, _ in alive if m >> k & 1) / price, -price, -k

        best = max(left, key=worth)
        left.remove(best)
        out.append(best)
        paid |= {*rules[best].groups, *(["scan"] if any(g in NEEDS_SCAN for g in rules[best].groups) else [])}
    return [rules[k] for k in out]


def plan_cascade(docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules in the order that a sample of about ``sample_rows`` texts suggests.

    The driver sees one row per set of rules that rejects a sampled text, so at most one per sampled text.
    """
    total = docs.count()
    texts = docs.select(F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    if total > sample_rows:
        texts = texts.sample(sample_rows / total, seed=11)
    sums = [F.sum(c).alias(c) for c in ("bytes", "scan", *COUNTS)]
    seen = texts.mapInArrow(_measurer(rules), _SAMPLE_DDL).groupBy("failed").agg(F.count(F.lit(1)).alias("n"), *sums).collect()
    size = max(sum(r["bytes"] for r in seen), 1)
    cost = {g: sum(r[g] for r in seen) / size for g in ("scan", *COUNTS)}
    return cascade_order(rules, [(r["failed"], r["n"], r["bytes"]) for r in seen], cost)


def run_cascade(column: pa.Array, rules: Sequence[Rule], complete: Sequence[str] = ()) -> tuple[Texts, np.ndarray]:
    """(counts, number of the rejecting rule or -1) of a column of texts; later rules see what earlier ones leave."""
    texts, by = Texts(column), np.full(len(column), -1, np.int32)
    for k, rule in enumerate(rules):
        open_rows = by < 0
        if not open_rows.any():
            break
        for group in rule.groups:
            texts.measure(group, open_rows)
        rows = np.flatnonzero(open_rows)
        failed = rule.fails({name: values[rows] for name, values in texts.counts.items()})
        by[rows[failed]] = k
    for group in complete:
        texts.measure(group, np.ones(len(column), bool))
    return texts, by


def judge_texts(
    docs: DataFrame,
    rules: Sequence[Rule] = RULES,
    complete: Sequence[str] = (),
    text_col: str = "text",
    carry: Sequence[str] | None = None,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """(row, kept, rejected_by, counts): one row per input row, which passes through as a struct.

    ``carry`` names the columns of ``row``, all of them if not given. ``kept`` says that no rule rejects the
    text, ``rejected_by`` the first rule of the cascade that does; the cascade's order rests on measured times,
    so where several rules reject a text, another run may name another of them. ``counts`` are null where the
    cascade needed none; groups in ``complete`` are measured for every text.
    Words are runs without blanks and line breaks. A null text is an empty one, which has too few words.
    Repeated rows and null ids are judged each; an empty table gives an empty result. Texts pass whole, in
    slices of about 2 MB or one longer text, and without a shuffle.
    """
    order = plan_cascade(docs, rules, text_col, sample_rows)
    names = [n for g in COUNTS for n in COUNTS[g]]
    columns = docs.columns if carry is None else list(carry)
    given = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    )
    fields = ", ".join(f"{n}: bigint" for n in names)
    verdict = {"kept": "boolean", "rejected_by": "string", "counts": f"struct<{fields}>"}
    shape = given.select("row", *[F.lit(None).cast(kind).alias(c) for c, kind in verdict.items()]).schema

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            texts, by = run_cascade(batch.column("text"), order, complete)
            values = []
            for group, columns in COUNTS.items():
                unknown = ~texts.known.get(group, np.zeros(batch.num_rows, bool))
                empty = np.zeros(batch.num_rows, np.int64)
                values += [pa.array(texts.counts.get(c, empty).astype(np.int64), mask=unknown) for c in columns]
            named = pa.array([order[k].name if k >= 0 else None for k in by], pa.string())
            counts = pa.StructArray.from_arrays(values, names=names)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(by < 0), named, counts], names=["row", "kept", "rejected_by", "counts"]
            )

    return given.mapInArrow(judge, shape)


def rule_digest(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per row: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept."""
    judged = judge_texts(docs, complete=BASE_GROUPS, carry=[id_col])
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    flat = judged.select(F.col("row").getField(id_col).alias(id_col), *[f"counts.{c}" for c in counts], "kept")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return flat.select(id_col, *counts, failed.alias("base_failed"), (F.col("kept") & ~failed).alias("kept"))
