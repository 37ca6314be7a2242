"""Words, hashes and sliding windows over many texts at once.

A portion of a batch is one flat byte array with row offsets; every function works on the
whole portion with numpy.  Separators are single ASCII bytes, so words of UTF-8 texts can be
found and hashed as bytes.  Hashes are 64 bits: polynomials modulo 2**64, then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Bytes of text handled at a time; one longer text is handled alone.
PORTION = 1 << 20

U64 = np.uint64
STEP = 0x9E3779B97F4A7C15
BASE = 0xD1342543DE82EF95  # odd, so it has an inverse modulo 2**64


def mix(values: np.ndarray) -> np.ndarray:
    """Spread each value over all 64 bits (one to one)."""
    x = values + U64(STEP)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def byte_class(members: bytes) -> np.ndarray:
    """For each byte value whether it is one of `members`."""
    found = np.zeros(256, bool)
    found[list(members)] = True
    return found


#: Bytes of words between white space (space and 0x09 to 0x0D).
SPACED = ~byte_class(bytes([0x20, *range(0x09, 0x0E)]))
#: Bytes of words of letters, digits and all that is not ASCII, after lower-casing.
ALPHANUMERIC = byte_class(bytes([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


class Portion(NamedTuple):
    """Rows [low, high) of a batch: their bytes end to end, and where each text begins."""

    low: int
    high: int
    data: np.ndarray
    offsets: np.ndarray


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    places = np.frombuffer(offsets, np.int64 if wide else np.int32)
    places = places[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[places[0] : places[-1]], places - places[0]


def portions(column: pa.Array, limit: int = PORTION) -> Iterator[Portion]:
    """Split a column into runs of rows of about `limit` bytes."""
    data, offsets = flat(column)
    low, rows = 0, len(offsets) - 1
    while low < rows:
        high = int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1
        high = min(rows, max(high, low + 1))
        own = offsets[low : high + 1]
        yield Portion(low, high, data[own[0] : own[-1]], own - own[0])
        low = high


#: For work that holds many arrays beside the bytes; caches hold it better, too.
SMALL_PORTION = 1 << 18


def at_least_one(column: pa.Array, limit: int = SMALL_PORTION) -> list[Portion]:
    """All portions of a column, an empty one where it has no rows."""
    return list(portions(column, limit)) or [Portion(0, 0, *flat(column))]


class Words(NamedTuple):
    """Begin and end byte of each word; row r has words first[r] to first[r + 1]."""

    begin: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def row(self) -> np.ndarray:
        """Row of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def find_words(data: np.ndarray, offsets: np.ndarray, members: np.ndarray = SPACED) -> Words:
    """Maximal runs of member bytes that do not cross rows."""
    inside = members[data]
    fresh = inside.copy()
    fresh[1:] &= ~inside[:-1]
    heads = offsets[:-1][np.diff(offsets) > 0]
    fresh[heads] = inside[heads]
    begin = np.flatnonzero(fresh)
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    tails = offsets[1:][np.diff(offsets) > 0] - 1
    last[tails] = inside[tails]
    return Words(begin, np.flatnonzero(last) + 1, np.searchsorted(begin, offsets))


def powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64, for i from 0 to count - 1."""
    up, down = np.full(count, BASE, U64), np.full(count, pow(BASE, -1, 1 << 64), U64)
    if count:
        up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


class Rolling:
    """Hashes of any stretch of a sequence of 64-bit values, by one pass of prefix sums."""

    def __init__(self, values: np.ndarray):
        up, self.down = powers(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, U64)
        np.cumsum(values * up[:-1], out=self.sums[1:])

    def stretch(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.sums[end] - self.sums[begin]) * self.down[begin]
        return mix(raw + (end - begin).astype(U64) * U64(STEP))

    def windows(self, size: int) -> np.ndarray:
        """Of each stretch of `size` values, in order of their first value."""
        if len(self.sums) <= size:
            return np.zeros(0, U64)
        raw = (self.sums[size:] - self.sums[:-size]) * self.down[: len(self.sums) - size]
        return mix(raw)


def byte_values(data: np.ndarray) -> np.ndarray:
    return mix(np.arange(256, dtype=U64))[data]


def word_hashes(data: np.ndarray, words: Words) -> np.ndarray:
    return Rolling(byte_values(data)).stretch(words.begin, words.end)


def starts_within(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Where windows of `size` units begin that stay inside a row, and the row of each."""
    counts = np.maximum(np.diff(first) - size + 1, 0)
    rows = np.repeat(np.arange(len(counts)), counts)
    before = np.concatenate([[0], np.cumsum(counts)])
    return np.arange(before[-1]) - before[rows] + first[:-1][rows], rows


class Runs(NamedTuple):
    """Neighbouring windows low to high (units of the portion) that share one anchor."""

    row: np.ndarray
    low: np.ndarray
    high: np.ndarray
    anchor: np.ndarray


def anchored_runs(grams: np.ndarray, first: np.ndarray, size: int, core: int) -> Runs:
    """Give each window of `size` units the least of its `core`-unit grams as its anchor.

    The choice depends on the window's content alone (the leftmost of equal ones), so equal
    windows have equal grams at equal distances.  `grams` are hashes of all cores.
    """
    begin, rows = starts_within(first, size)
    if not len(begin):
        return Runs(*[np.zeros(0, np.int64)] * 4)
    least = (grams & U64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=U64)
    width, span = size - core + 1, 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if width > span:
        least = np.minimum(least[: span - width], least[width - span :])
    anchor = (least[begin] & U64(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(len(begin), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (begin[1:] != begin[:-1] + 1)
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(begin)) - 1
    return Runs(rows[head], begin[head], begin[tail], anchor[head])


def expand(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All integers of the closed ranges low to high, and the range of each."""
    counts = high - low + 1
    which = np.repeat(np.arange(len(low)), counts)
    before = np.concatenate([[0], np.cumsum(counts)])
    return np.arange(before[-1]) - before[which] + low[which], which


def signed(values: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return values.astype(U64, copy=False).view(np.int64)


def covered(spans: pa.ListArray, first: np.ndarray) -> np.ndarray:
    """For each unit of a portion whether a span of its row covers it.

    `spans` holds structs of low and high (half-open, counted from the row's start).
    """
    change = np.zeros(first[-1] + 1, np.int32)
    row = np.repeat(np.arange(len(spans)), spans.value_lengths().fill_null(0).to_numpy())
    if len(row):
        fields = spans.flatten()
        np.add.at(change, first[row] + fields.field(0).to_numpy(), 1)
        np.add.at(change, first[row] + fields.field(1).to_numpy(), -1)
    return np.cumsum(change[:-1], dtype=np.int32) > 0


def spans_of(marked: np.ndarray, first: np.ndarray) -> pa.ListArray:
    """The maximal marked stretches of each row, as lists of low and high."""
    words = find_words(marked.view(np.uint8), first, np.arange(256) > 0)
    base = first[words.row()]
    fields = [
        pa.array((words.begin - base).astype(np.int32)),
        pa.array((words.end - base).astype(np.int32)),
    ]
    return pa.ListArray.from_arrays(
        pa.array(words.first.astype(np.int32)), pa.StructArray.from_arrays(fields, ["low", "high"])
    )


def cut(data: np.ndarray, keep: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Binary column of the kept bytes of each row."""
    ends = np.concatenate([[0], np.cumsum(keep)])[offsets].astype(np.int64)
    return pa.Array.from_buffers(
        pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(ends), pa.py_buffer(data[keep])]
    ).cast(pa.binary())


def join_words(data: np.ndarray, words: Words, keep: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """String column of the kept words of each row, joined by one space."""
    row, kept = words.row(), np.flatnonzero(keep)
    more = np.zeros(len(kept), np.int64)  # another kept word of the row follows
    more[:-1] = row[kept][1:] == row[kept][:-1]
    change = np.zeros(len(data) + 1, np.int8)
    change[words.begin[kept]] += 1
    change[words.end[kept] + more] -= 1
    spaced = data.copy()
    spaced[words.end[kept][more > 0]] = 0x20
    return cut(spaced, np.cumsum(change[:-1], dtype=np.int8) > 0, offsets).cast(pa.string())
