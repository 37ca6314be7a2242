"""Find benchmark items inside documents by a prefix-filtered containment join.

A benchmark item is cut into windows of `size` words.  A window's words are ordered by rarity
(how often the documents hold them, then hash); since all of them must be found, the necessary
prefix is its single rarest word.  Documents join on that word only.  A candidate then has to
fit inside the document (length and position of the word within the window), and is verified
word by word.

The windows are the stated query set.  They are dealt into blocks of about `block` windows, each
broadcast by itself, and all documents are read against each block.  Windows that the same items
hold form a group, and a block has only the group's number beside a window's words, so a
broadcast has a fixed bound however many items there are and however many share a window.
Tasks name the groups they find; Spark joins these with the items of each group.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rows import beside, by_value, keyed, struct_of, value_of
from .scratch import written
from .text import (
    ALPHANUMERIC,
    LOWER,
    Portion,
    Rolling,
    Words,
    at_least_one,
    covered,
    expand,
    find_words,
    portions,
    signed,
    spans_of,
    starts_within,
    word_hashes,
)

SIZE = 13
#: Windows of a broadcast; about 150 bytes each.
BLOCK = 200_000
#: Candidates verified at a time.
CANDIDATES = 1 << 20


def folded_words(data: np.ndarray, offsets: np.ndarray) -> tuple[Words, np.ndarray]:
    data = LOWER[data]
    words = find_words(data, offsets, ALPHANUMERIC)
    return words, word_hashes(data, words)


def window_rows(size: int):
    """Task: items to their windows, as word hashes."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch["text"]):
                words, hashes = folded_words(part.data, part.offsets)
                begin, rows = starts_within(words.first, size)
                counts = np.diff(words.first)
                short = np.flatnonzero((counts > 0) & (counts < size))
                begin = np.concatenate([begin, words.first[short]])
                rows = np.concatenate([rows, short])
                lengths = np.minimum(counts[rows], size)
                at, _ = expand(begin, begin + lengths - 1)
                ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["item"][part.low : part.high].take(pa.array(rows)),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(signed(hashes[at]))),
                    ],
                    ["item", "words"],
                )

    return task


def count_rows(vocabulary: Broadcast):
    """Task: documents to counts of the vocabulary's words."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        counts = np.zeros(len(known) + 1, np.int64)
        for batch in batches:
            for part in portions(batch["text"]):
                _, hashes = folded_words(part.data, part.offsets)
                place = np.searchsorted(known, hashes)
                place[known[np.minimum(place, len(known) - 1)] != hashes] = len(known)
                counts += np.bincount(place, minlength=len(counts))
        seen = np.flatnonzero(counts[:-1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(signed(known[seen])), pa.array(counts[seen])], ["word", "n"]
        )

    return task


class Index(NamedTuple):
    """Windows of a block in the order of their prefix word."""

    tokens: np.ndarray  # prefix words, ascending
    first: np.ndarray  # windows first[t] to first[t + 1] have prefix word t
    offset: np.ndarray  # place of the prefix word in the window
    length: np.ndarray
    digest: np.ndarray
    words: np.ndarray  # one row for each window, padded with 0
    group: np.ndarray  # place in `groups` of the group that holds the window
    groups: np.ndarray


def build_index(rows: pa.Table, size: int, rarity: dict[int, int]) -> Index:
    """Rows of (words, group): distinct windows with the number of their group."""
    lists = rows["words"].combine_chunks()
    length = lists.value_lengths().to_numpy().astype(np.int64)
    flat_words = lists.flatten().to_numpy().view(np.uint64)
    row = np.repeat(np.arange(len(length)), length)
    begin = np.concatenate([[0], np.cumsum(length)])
    column = np.arange(len(flat_words)) - begin[row]
    words = np.zeros((len(length), size), np.uint64)
    words[row, column] = flat_words
    unique, place = np.unique(flat_words, return_inverse=True)
    often = np.array([rarity.get(int(w), 0) for w in signed(unique)], np.int64)[place]
    order = np.lexsort((column, flat_words, often, row))
    prefix = order[begin[:-1]]  # the rarest word of each window, at its first place
    token, offset = flat_words[prefix], column[prefix]
    by_token = np.argsort(token, kind="stable")
    tokens, first = np.unique(token[by_token], return_index=True)
    groups, group = np.unique(rows["group"].to_numpy()[by_token], return_inverse=True)
    at = begin[:-1]
    return Index(
        tokens,
        np.append(first, len(token)),
        offset[by_token],
        length[by_token],
        Rolling(flat_words).stretch(at, at + length)[by_token],
        words[by_token],
        group,
        groups,
    )


def occurrences(index: Index, words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Verified places: first word of the occurrence, and the window."""
    none = np.zeros(0, np.int64)
    if not len(index.tokens) or not len(hashes):
        return none, none
    token = np.minimum(np.searchsorted(index.tokens, hashes), len(index.tokens) - 1)
    place = np.flatnonzero(index.tokens[token] == hashes)
    token = token[place]
    row = np.searchsorted(words.first, place, "right") - 1
    low, high = words.first[row], words.first[row + 1]
    rolling = Rolling(hashes)
    ends = np.cumsum(index.first[token + 1] - index.first[token])
    found: list[tuple[np.ndarray, np.ndarray]] = []
    done = 0
    while done < len(place):
        before = ends[done - 1] if done else 0
        upto = max(done + 1, int(np.searchsorted(ends, before + CANDIDATES, "right")))
        part = slice(done, upto)
        window, which = expand(index.first[token[part]], index.first[token[part] + 1] - 1)
        begin = place[part][which] - index.offset[window]
        end = begin + index.length[window]
        fits = (begin >= low[part][which]) & (end <= high[part][which])
        window, begin, end = window[fits], begin[fits], end[fits]
        same = rolling.stretch(begin, end) == index.digest[window]
        window, begin = window[same], begin[same]
        same = np.ones(len(window), bool)
        for k in range(index.words.shape[1]):
            inside = index.length[window] > k
            at = np.minimum(begin + k, len(hashes) - 1)
            same &= ~inside | (hashes[at] == index.words[window, k])
        found.append((begin[same], window[same]))
        done = upto
    if not found:
        return none, none
    return np.concatenate([b for b, _ in found]), np.concatenate([w for _, w in found])


HITS = "n_words long, hits array<struct<low int, high int>>, groups array<long>"


def hit_texts(broadcast: Broadcast):
    """Task: texts to word counts, spans of hit words and groups found."""

    def hits_of(index: Index, part: Portion) -> pa.StructArray:
        words, hashes = folded_words(part.data, part.offsets)
        begin, window = occurrences(index, words, hashes)
        change = np.zeros(len(hashes) + 1, np.int64)
        np.add.at(change, begin, 1)
        np.add.at(change, begin + index.length[window], -1)
        hit = np.cumsum(change[:-1]) > 0
        row = np.searchsorted(words.first, begin, "right") - 1
        pairs = np.unique(row * (len(index.groups) + 1) + index.group[window])
        row, group = np.divmod(pairs, len(index.groups) + 1)
        ends = np.searchsorted(row, np.arange(part.high - part.low + 1)).astype(np.int32)
        return struct_of(
            n_words=np.diff(words.first),
            hits=spans_of(hit, words.first),
            groups=pa.ListArray.from_arrays(pa.array(ends), pa.array(index.groups[group])),
        )

    def task(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index = value_of(broadcast)
        for text in texts:
            yield pa.concat_arrays([hits_of(index, part) for part in at_least_one(text)])

    return task


def merged_hits(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """Task: word counts and spans found in several blocks to maximal ones."""
    for n_words, hits in batches:
        first = np.concatenate([[0], np.cumsum(n_words.to_numpy())])
        yield struct_of(hits=spans_of(covered(hits, first), first))


def against_block(texts: DataFrame, rows: pa.Table, size: int) -> DataFrame:
    """All documents against one block of windows."""
    context = texts.sparkSession.sparkContext
    known = np.unique(rows["words"].combine_chunks().flatten().to_numpy().view(np.uint64))
    rarity: dict[int, int] = {}
    if len(known):
        counted = texts.select("text").mapInArrow(
            count_rows(context.broadcast(known)), "word long, n long"
        )
        # at most the words of one block
        counted = counted.groupBy("word").agg(F.sum("n").alias("n"))
        rarity = {r["word"]: r["n"] for r in counted.collect()}
    index = build_index(rows, size, rarity)
    found = beside(hit_texts(by_value(context, index)), HITS, "text").alias("found")
    more = ["text", "carried"] if "carried" in texts.columns else []
    rows = texts.select("key", "doc_id", found, *more)
    return rows.select("key", "doc_id", "found.*", *more)


def grouped_windows(items: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (words, group) and the items of each group (group, item).

    `items` has (item, text).  No row holds more than one item, however many hold a window.
    Two sets of items are taken as equal by their size and two 64-bit digests.
    """
    held = written(
        items.mapInArrow(window_rows(size), "item string, words array<long>").distinct()
    )
    windows = written(
        held.groupBy("words").agg(
            F.count("*").alias("n"),
            F.bit_xor(F.xxhash64("item")).alias("one"),
            F.bit_xor(F.xxhash64(F.lit(1), "item")).alias("two"),
        )
    )
    same = ["n", "one", "two"]
    # written, so that the numbers stay as they are
    groups = written(
        windows.groupBy(same)
        .agg(F.min("words").alias("words"))
        .withColumn("group", F.monotonically_increasing_id())
    )
    numbered = written(windows.join(groups.drop("words"), same).select("words", "group"))
    return numbered, held.join(groups.select("words", "group"), "words").select("group", "item")


def find_groups(
    texts: DataFrame, windows: DataFrame, size: int = SIZE, block: int = BLOCK
) -> DataFrame:
    """Per row of `keyed`: key, doc_id, n_words, hits, groups, and what it carries."""
    blocks = max(1, -(-windows.count() // block))
    dealt = windows.withColumn("block", F.pmod(F.xxhash64("words"), F.lit(blocks)))
    found = [
        against_block(
            texts if k == 0 else texts.select("key", "doc_id", "text"),
            dealt.where(F.col("block") == k).drop("block").toArrow(),
            size,
        )
        for k in range(blocks)
    ]
    if blocks == 1:
        return found[0]
    more = found[1]
    for rows in found[2:]:
        more = more.unionByName(rows)
    more = more.where(F.size("groups") > 0).groupBy("key").agg(
        F.flatten(F.collect_set("hits")).alias("more_hits"),
        F.flatten(F.collect_set("groups")).alias("more_groups"),
    )
    none = F.array().cast("array<long>")
    carried = ["text", "carried"] if "carried" in texts.columns else []
    joined = found[0].join(more, "key", "left").select(
        "key",
        "doc_id",
        "n_words",
        F.concat("hits", F.coalesce("more_hits", F.array())).alias("hits"),
        F.array_distinct(F.concat("groups", F.coalesce("more_groups", none))).alias("groups"),
        *carried,
    )
    merged = beside(merged_hits, "hits array<struct<low int, high int>>", "n_words", "hits")
    return joined.withColumn("hits", merged["hits"])


def find_hits(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    size: int = SIZE,
    block: int = BLOCK,
    carry: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """What find_items finds, with key and groups in place of items, and (group, item)."""
    named = items.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"),
        F.coalesce(F.col(item_text), F.lit("")).alias("text"),
    )
    windows, held = grouped_windows(named, size)
    return find_groups(keyed(docs, doc_id, text, carry), windows, size, block), held


def find_items(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, n_words, hits (maximal spans of hit words), items (ids, as text).

    Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased.  An item of
    fewer words than `size` is one window; an item without words occurs nowhere.  Every
    occurrence of every window counts.  Null texts have no words; a null item id is listed as
    the empty string; ids that repeat are listed once; repeated documents get equal rows.
    Columns other than those named are ignored, or come along in `carried` beside the text.
    The options are those of find_hits.
    """
    found, held = find_hits(docs, items, **options)
    # written, as the documents would be read once more for their groups
    found = written(found)
    pairs = found.select("key", F.explode("groups").alias("group")).distinct()
    listed = pairs.join(held, "group").groupBy("key").agg(F.collect_set("item").alias("items"))
    none = F.array().cast("array<string>")
    return (
        found.drop("groups")
        .join(listed, "key", "left")
        .withColumn("items", F.coalesce("items", none))
        .drop("key")
    )


def hit_share(found: DataFrame) -> DataFrame:
    """Add n_hit and contaminated: at least one word in twenty is hit."""
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, x: n + x["high"] - x["low"])
    return found.withColumn("n_hit", n_hit).withColumn(
        "contaminated", F.expr("n_hit > 0 and 20 * n_hit >= n_words")
    )


def judged(found: DataFrame) -> DataFrame:
    """Add n_hit, n_items and contaminated."""
    return hit_share(found).withColumn("n_items", F.size("items").cast("long"))
