"""Array work on batches of texts: bounds of words, hashes of words and windows, window minima.

A batch is the bytes of some texts one after another and the offsets where each begins. All
functions look at whole batches at once and are small steps inside Spark tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text looked at together; a longer text is looked at alone.
CHUNK = 1 << 19
U64 = np.uint64
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """64 bits scattered so that every bit depends on every bit."""
    x = x + U64((0x9E3779B97F4A7C15 * (seed + 1)) & (2**64 - 1))
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


@lru_cache(maxsize=8)
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    def table(b: int) -> np.ndarray:
        row = np.full(size, b, U64)
        row[0] = 1
        return np.multiply.accumulate(row)

    return table(base), table(pow(base, -1, 2**64))


@lru_cache(maxsize=8)
def _symbols(seed: int) -> np.ndarray:
    return mix(np.arange(256, dtype=U64), seed + 100)


def base_of(seed: int) -> int:
    return int(mix(np.array([seed + 977], U64))[0]) | 1


class Sums:
    """Prefix sums from which the hash of any stretch of symbols follows in one step."""

    def __init__(self, symbols: np.ndarray, seed: int = 0):
        size = 1 << max(16, len(symbols)).bit_length() if len(symbols) >= 1 << 16 else 1 << 16
        up, self.down = _powers(base_of(seed), size)
        self.sums = np.zeros(len(symbols) + 1, U64)
        np.cumsum(symbols * up[: len(symbols)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start]

    def rolling(self, width: int) -> np.ndarray:
        count = max(0, len(self.sums) - width)
        return (self.sums[width:] - self.sums[:count]) * self.down[:count] if count else np.zeros(0, U64)


def byte_sums(data: np.ndarray, seed: int = 0) -> Sums:
    return Sums(_symbols(seed)[data], seed)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary array; nulls are empty."""
    wide = pa.large_binary() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else pa.large_string()
    column = pc.fill_null(column.cast(wide), b"" if wide == pa.large_binary() else "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def chunks(column: pa.Array | pa.ChunkedArray, limit: int = CHUNK) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, bytes and offsets (from 0) of consecutive rows of about ``limit`` bytes."""
    first = 0
    for part in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        data, offsets = buffers(part)
        row, n = 0, len(part)
        while row < n:
            stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
            stop = min(stop, n)
            yield first + row, data[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row]
            row = stop
        first += n


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every word: a maximal run of bytes that are not white."""
    solid = ~WHITE[data]
    opens = solid.copy()
    opens[1:] &= ~solid[:-1]
    inner = offsets[:-1][offsets[:-1] < offsets[1:]]
    opens[inner] |= solid[inner]
    shuts = solid.copy()
    shuts[:-1] &= ~solid[1:]
    last = inner_ends = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    shuts[last] |= solid[inner_ends]
    start, end = np.flatnonzero(opens), np.flatnonzero(shuts) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix(byte_sums(data).of(start, end) + (end - start).astype(U64))


def together(doc: np.ndarray, width: int) -> np.ndarray:
    """Whether the ``width`` words from each on are of one text."""
    count = max(0, len(doc) - width + 1)
    return doc[:count] == doc[width - 1 :] if count else np.zeros(0, bool)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[: len(values) - (width - size)], values[width - size :]) if size < width else values


_LOW = (1 << 24) - 1
_BLOCK = 1 << 23


def anchor_runs(grams: np.ndarray, valid: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, first window and number of windows of every run of windows with one anchor.

    A window is ``width`` consecutive grams; its anchor is the gram with the least hash, the
    last of several. The anchor and its place in the window follow from the window's content
    alone, so equal windows have equal anchors at equal places, and no window occurs twice in
    one run. ``valid`` says which windows count.
    """
    found = []
    for at in range(0, len(valid), _BLOCK):
        ok = np.flatnonzero(valid[at : at + _BLOCK])
        if not len(ok):
            continue
        part = grams[at : at + _BLOCK + width - 1]
        place = np.arange(len(part), dtype=U64)
        least = sliding_min((part & ~U64(_LOW)) | (U64(_LOW) - place), width)[ok]
        place = _LOW - (least & U64(_LOW)).astype(np.int64)
        opens = np.ones(len(ok), bool)
        opens[1:] = (place[1:] != place[:-1]) | (ok[1:] != ok[:-1] + 1)
        first = np.flatnonzero(opens)
        found.append((part[place[first]], ok[first] + at, np.diff(np.append(first, len(ok)))))
    if not found:
        return np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(map(np.concatenate, zip(*found)))


def covered(starts: np.ndarray, width: int, size: int) -> np.ndarray:
    """Which of ``size`` places lie in a stretch of ``width`` from one of the starts."""
    steps = np.zeros(size + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + width, -1)
    return np.cumsum(steps[:-1]) > 0


def isin(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Membership in a sorted array."""
    if not len(known):
        return np.zeros(len(values), bool)
    at = np.searchsorted(known, values)
    at[at == len(known)] = 0
    return known[at] == values


def ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one range after another."""
    return np.repeat(start - np.append(0, np.cumsum(count)[:-1]), count) + np.arange(count.sum())


def rows_in(rows: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which rows of two numbers are among the known ones, which are sorted by both."""
    hit = np.zeros(len(rows), bool)
    if not len(known):
        return hit
    place = np.searchsorted(known[:, 0], rows[:, 0])
    open_ = np.flatnonzero(place < len(known))
    while len(open_):  # a second turn only where several second numbers follow one first number
        at = place[open_]
        same = known[at, 0] == rows[open_, 0]
        hit[open_] = same & (known[at, 1] == rows[open_, 1])
        open_ = open_[same & ~hit[open_] & (at + 1 < len(known))]
        place[open_] += 1
    return hit
