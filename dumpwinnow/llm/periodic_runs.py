"""Periodic runs of words, by the branching-tandem test on an enhanced suffix array.

The words of a portion of texts get one suffix array by prefix doubling.  A symbol is a word
together with its row, so no common prefix crosses texts.  Each round keeps the ranks it found;
longest common extensions, to the right (the LCP array) and to the left, are read off these
levels by halving steps.

LCP intervals are bounds in the array, the next smaller LCP values on either side; there are no
tree nodes.  A suffix i in an interval of depth d whose suffix i + d lies in another child of
the same interval begins a branching tandem repeat, the last square of a run of period d.  Only
suffixes of the smaller children are looked up in the inverse array, at i + d and i - d, so each
is looked up a logarithmic number of times.  A square is then rotated to the left as far as it
stays a square, by one common extension, which gives the whole run; of squares that end in the
same run the least period stays.

A run of exponent 4 and 6 words holds some 5 words twice; texts without such a repeat end there.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import (
    U64,
    Rolling,
    Words,
    expand,
    find_words,
    join_words,
    mix,
    portions,
    starts_within,
    word_hashes,
)

#: A run is at least this many words long, and this many times its period.
LEAST_WORDS = 6
LEAST_EXPONENT = 4


class Runs(NamedTuple):
    """Runs of a portion by row, start and period; start counts words of the whole portion."""

    start: np.ndarray
    length: np.ndarray
    period: np.ndarray


def rows_with_repeats(hashes: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """Whether a stretch of `size` words occurs twice in the row."""
    begin, rows = starts_within(first, size)
    grams = Rolling(hashes).stretch(begin, begin + size) ^ mix(rows.astype(U64))
    order = np.argsort(grams)
    again = grams[order[1:]] == grams[order[:-1]]
    found = np.zeros(len(first) - 1, bool)
    found[rows[order[1:][again]]] = True
    return found


def suffix_levels(symbols: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Ranks of the prefixes of 1, 2, 4, ... symbols of all suffixes, until all differ.

    `ends` tells for each place where its row ends; a prefix that meets the end is a shorter one
    and differs from all others.  A rank is the place of the first equal one in sorted order.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    new = np.ones(n, bool)
    new[1:] = symbols[order[1:]] != symbols[order[:-1]]
    rank = np.empty(n, np.int32)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    levels, size = [rank], 1
    new = np.append(new, True)
    active = order[~(new[:-1] & new[1:])]  # in order of rank
    while len(active):
        after = active + size
        inside = after < ends[active]
        second = np.where(inside, rank[np.minimum(after, n - 1)].astype(np.int64) + 1, 0)
        group = rank[active].astype(np.int64)
        order = np.argsort(group * (n + 1) + second, kind="stable")
        active, group, second = active[order], group[order], second[order]
        head = np.ones(len(active), bool)
        head[1:] = group[1:] != group[:-1]
        new = head.copy()
        new[1:] |= second[1:] != second[:-1]
        place = np.arange(len(active))
        of_group = np.maximum.accumulate(np.where(head, place, 0))
        of_new = np.maximum.accumulate(np.where(new, place, 0))
        rank = rank.copy()
        rank[active] = group + of_new - of_group
        levels.append(rank)
        size *= 2
        new = np.append(new, True)
        active = active[~(new[:-1] & new[1:])]
    return levels


def common_right(levels: list[np.ndarray], ends: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Length of the longest common prefix of the suffixes i and j (different ones of one row)."""
    i, j, last = i.copy(), j.copy(), len(ends) - 1
    begin = i.copy()
    for k in range(len(levels) - 1, -1, -1):
        inside = (i < ends[begin]) & (j < ends[begin])
        same = inside & (levels[k][np.minimum(i, last)] == levels[k][np.minimum(j, last)])
        i[same] += 1 << k
        j[same] += 1 << k
    return i - begin


def common_left(levels: list[np.ndarray], starts: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many words before i equal those before j (i < j in one row)."""
    i, j = i.copy(), j.copy()
    begin, low = i.copy(), starts[i]
    for k in range(len(levels) - 1, -1, -1):
        step = 1 << k
        inside = i - step >= low
        same = inside & (levels[k][np.maximum(i - step, 0)] == levels[k][np.maximum(j - step, 0)])
        i[same] -= step
        j[same] -= step
    return begin - i


def smaller_before(values: np.ndarray) -> np.ndarray:
    """For each place the nearest one before it with a smaller value, or else place 0."""
    found = np.maximum(np.arange(-1, len(values) - 1), 0)
    open_ = np.arange(len(values))
    while len(open_):
        open_ = open_[(values[found[open_]] >= values[open_]) & (found[open_] > 0)]
        found[open_] = found[found[open_]]
    return found


def branching_tandems(
    levels: list[np.ndarray], starts: np.ndarray, ends: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Begin and period of each square whose following word does not go on with the period."""
    inverse = levels[-1].astype(np.int64)
    n = len(inverse)
    suffix = np.empty(n, np.int64)
    suffix[inverse] = np.arange(n)
    lcp = np.zeros(n + 1, np.int64)
    near = np.flatnonzero(levels[0][suffix[1:]] == levels[0][suffix[:-1]]) + 1
    lcp[near] = common_right(levels, ends, suffix[near], suffix[near - 1])
    lcp[0] = lcp[n] = -1
    before = smaller_before(lcp)
    after = n - smaller_before(lcp[::-1])[::-1]
    # a boundary of depth d splits the interval [before, after) into children
    cut = np.flatnonzero(lcp[:n] > 0)
    low, high, depth = before[cut], after[cut], lcp[cut]
    order = np.lexsort((cut, low, depth))  # boundaries of one interval side by side
    cut, low, high, depth = cut[order], low[order], high[order], depth[order]
    head = np.ones(len(cut), bool)
    head[1:] = (low[1:] != low[:-1]) | (depth[1:] != depth[:-1])
    # children begin at the interval's start and at each boundary
    first = np.flatnonzero(head)
    interval = np.concatenate([first, np.arange(len(cut))])
    begin = np.concatenate([low[first], cut])
    order = np.lexsort((begin, low[interval], depth[interval]))
    interval, begin = interval[order], begin[order]
    owner = np.cumsum(np.concatenate([head, [False]])[:-1])[interval]
    end = high[interval].copy()
    inner = owner[1:] == owner[:-1]
    end[:-1][inner] = begin[1:][inner]
    # all children but one largest of each interval
    order = np.lexsort((end - begin, owner))
    largest = np.ones(len(order), bool)
    largest[:-1] = owner[order][1:] != owner[order][:-1]
    small = np.sort(order[~largest])
    at, which = expand(begin[small], end[small] - 1)
    child = small[which]
    i, d = suffix[at], depth[interval[child]]
    squares = []
    for there, inside in ((i + d, i + d < ends[i]), (i - d, i - d >= starts[i])):
        rank = inverse[np.where(inside, there, 0)]
        within = inside & (rank >= low[interval[child]]) & (rank < high[interval[child]])
        within &= (rank < begin[child]) | (rank >= end[child])
        squares.append((np.minimum(i, there)[within], d[within]))
    return np.concatenate([s for s, _ in squares]), np.concatenate([p for _, p in squares])


def runs_of(hashes: np.ndarray, first: np.ndarray, least_words: int, least_exponent: int) -> Runs:
    """All runs of the rows; row r has the words first[r] to first[r + 1]."""
    none = np.zeros(0, np.int64)
    # a run of period p repeats all but its first p words at distance p
    shared = max(1, min(least_words - 1, (least_exponent - 1) * 2))
    rows = np.flatnonzero(rows_with_repeats(hashes, first, shared))
    if not len(rows):
        return Runs(none, none, none)
    counts = np.diff(first)[rows]
    place, which = expand(first[rows], first[rows + 1] - 1)
    edge = np.concatenate([[0], np.cumsum(counts)])
    starts, ends = edge[which], edge[which + 1]
    _, word = np.unique(hashes[place], return_inverse=True)
    levels = suffix_levels(which * (int(word.max()) + 1) + word, ends)
    begin, period = branching_tandems(levels, starts, ends)
    if not len(begin):
        return Runs(none, none, none)
    back = common_left(levels, starts, begin, begin + period)
    start, end = begin - back, begin + 2 * period
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    least = np.ones(len(start), bool)
    least[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    length = end - start
    least &= (length >= least_words) & (length >= least_exponent * period)
    found = np.flatnonzero(least)
    found = found[np.lexsort((period[found], start[found]))]
    return Runs(place[start[found]], length[found], period[found])


def dropped_words(runs: Runs, count: int) -> np.ndarray:
    """Words that some run holds after its first period."""
    change = np.zeros(count + 1, np.int64)
    np.add.at(change, runs.start + runs.period, 1)
    np.add.at(change, runs.start + runs.length, -1)
    return np.cumsum(change[:-1]) > 0


def listed_runs(runs: Runs, words: Words) -> pa.ListArray:
    """For each row the list of its runs, places counted from the row's first word."""
    row = np.searchsorted(words.first, runs.start, "right") - 1
    offsets = np.searchsorted(row, np.arange(len(words.first)))
    fields = [
        pa.array(values.astype(np.int64))
        for values in (runs.start - words.first[row], runs.length, runs.period)
    ]
    return pa.ListArray.from_arrays(
        pa.array(offsets.astype(np.int32)),
        pa.StructArray.from_arrays(fields, ["start", "length", "period"]),
    )


def run_rows(least_words: int, least_exponent: int):
    """Task: texts to their runs and what is left of their words."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch["text"]):
                words = find_words(part.data, part.offsets)
                hashes = word_hashes(part.data, words)
                runs = runs_of(hashes, words.first, least_words, least_exponent)
                gone = dropped_words(runs, len(hashes))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"][part.low : part.high],
                        pa.array(np.diff(words.first)),
                        listed_runs(runs, words),
                        join_words(part.data, words, ~gone, part.offsets),
                    ],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    return task


def find_runs(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    least_words: int = LEAST_WORDS,
    least_exponent: int = LEAST_EXPONENT,
) -> DataFrame:
    """Per row: doc_id, n_words, runs (start, length, period; by start, then period), collapsed.

    A run is a stretch of words with smallest period p, at least `least_words` and
    `least_exponent` (2 or more) times p long, that no neighbouring word extends.  `collapsed`
    joins by one space the words that no run holds after its first p words.  Words are those
    between white space, unchanged, and compared by 64-bit hashes.  Null, empty and blank texts
    have no words and no runs, `collapsed` is empty.  Rows are independent of each other: null and
    repeated ids and repeated texts make no difference.  Other columns are ignored.
    """
    if least_exponent < 2 or least_words < 2:
        raise ValueError("a run has at least two words and two periods")
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")
    )
    return rows.mapInArrow(
        run_rows(least_words, least_exponent),
        "doc_id long, n_words long, runs array<struct<start long, length long, period long>>, "
        "collapsed string",
    )
