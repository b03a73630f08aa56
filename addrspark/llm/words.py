"""Vectorised splitting and hashing of words over Arrow text columns.

Everything works on the UTF-8 bytes of a whole batch. Separators are ASCII bytes, so multi-byte
characters never break. Bytes are taken in pieces that end between words, which bounds the memory for
texts of any length.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 19
SLICE_BYTES = 2 << 20
U64 = np.uint64


def _mask(separators: set[int]) -> np.ndarray:
    mask = np.ones(256, dtype=bool)
    mask[list(separators)] = False
    return mask


# Words split by blanks: every byte but 0x20 and 0x09 to 0x0D.
BLANK_SPLIT = _mask({0x20, *range(0x09, 0x0E)})
# Words of ASCII letters, digits and any non-ASCII character.
ALNUM_SPLIT = _mask({*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)})


class Words(NamedTuple):
    """Word hashes of a batch; the words of row i are ``hashes[first[i]:first[i + 1]]``.

    ``starts`` and ``ends`` are byte positions in ``data``.
    """

    hashes: np.ndarray
    first: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    data: np.ndarray


@lru_cache(maxsize=8)
def _byte_values(seed: int, fold: bool) -> np.ndarray:
    values = np.random.Generator(np.random.PCG64(seed)).integers(1, 2**63, 256, dtype=np.int64).astype(U64)
    if fold:
        values[0x41:0x5B] = values[0x61:0x7B]
    return values


def _odd(seed: int) -> int:
    return (0x9E3779B97F4A7C15 * (2 * seed + 1) + 0x632BE59BD9B4E018) % 2**64 | 1


@lru_cache(maxsize=16)
def powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, dtype=U64)
    out[0] = 1
    return np.cumprod(out, dtype=U64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread a 64-bit value over all its bits."""
    h = h ^ (h >> U64(32))
    h = h * U64(0xD6E8FEB86659FD93)
    h = h ^ (h >> U64(32))
    h = h * U64(0xD6E8FEB86659FD93)
    return h ^ (h >> U64(32))


def _rolling(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hash of ``values[starts:ends]`` for each pair, from prefix sums modulo 2**64."""
    size = 1 << max(int(len(values)).bit_length(), 10)
    up, down = powers(base, size), powers(pow(base, -1, 2**64), size)
    sums = np.zeros(len(values) + 1, dtype=U64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return (sums[ends] - sums[starts]) * down[starts]


def row_slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of about ``most`` text bytes; a longer text stands alone."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        yield at, to
        at = to


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a text column; null counts as empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return at, np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)


def scan_words(column: pa.Array, mask: np.ndarray, fold: bool = False, seed: int = 1) -> Words:
    """Split every text into words of ``mask`` bytes and hash each; ``fold`` lower-cases A-Z."""
    offsets, data = text_buffers(column)
    values, base = _byte_values(seed, fold), _odd(seed)
    hashes, starts, ends = [], [], []
    at, stop = int(offsets[0]), int(offsets[-1])
    while at < stop:
        to = _piece_end(data, offsets, mask, at, stop)
        piece = data[at:to]
        word = mask[piece]
        edges = offsets[np.searchsorted(offsets, at, "right") : np.searchsorted(offsets, to, "left")] - at
        before = np.empty(len(word), dtype=bool)
        before[0], before[1:] = False, word[:-1]
        before[edges] = False
        after = np.empty(len(word), dtype=bool)
        after[-1], after[:-1] = False, word[1:]
        after[edges - 1] = False
        s = np.flatnonzero(word & ~before)
        e = np.flatnonzero(word & ~after) + 1
        if len(s):
            hashes.append(mix(_rolling(values[piece], s, e, base) + (e - s).astype(U64)))
            starts.append(s + at)
            ends.append(e + at)
        at = to
    if not hashes:
        none = np.empty(0, np.int64)
        return Words(np.empty(0, U64), np.zeros(len(offsets), np.int64), none, none, data)
    starts_all = np.concatenate(starts)
    first = np.searchsorted(starts_all, offsets, "left")
    return Words(np.concatenate(hashes), first, starts_all, np.concatenate(ends), data)


def _piece_end(data: np.ndarray, offsets: np.ndarray, mask: np.ndarray, at: int, stop: int) -> int:
    """The end of the next piece: between two words or two texts."""
    size = PIECE
    while at + size < stop:
        to = at + size
        edge = int(offsets[np.searchsorted(offsets, to, "right") - 1])
        blanks = np.flatnonzero(~mask[data[at:to]])
        cut = max(edge, at + int(blanks[-1]) + 1 if len(blanks) else at)
        if cut > at:
            return cut
        size *= 2
    return stop


def gram_hashes(words: Words, n: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(hash, word position) of every run of ``n`` words inside one text, in order."""
    h, first = words.hashes, words.first
    if len(h) < n:
        return np.empty(0, U64), np.empty(0, np.int64)
    size = len(h) - n + 1
    out = np.zeros(size, dtype=U64)
    base = U64(_odd(seed))
    for k in range(n):
        out = out * base + h[k : k + size]
    left = np.repeat(first[1:], np.diff(first))[:size] - np.arange(size)
    at = np.flatnonzero(left >= n)
    return mix(out[at]), at


def rows_of(words: Words) -> np.ndarray:
    """The row of every word."""
    return np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))


def span_hashes(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """A hash of ``symbols[starts:ends]`` for each pair; symbols are any whole numbers."""
    values = mix(symbols.astype(U64) + U64(_odd(seed)))
    return mix(_rolling(values, starts, ends, _odd(seed + 1)) + (ends - starts).astype(U64))
