"""SimHash near-duplicates, linked by tables of distances to reference fingerprints.

The 65 references are a staircase: reference t is a base fingerprint with its first t bits turned
over.  A fingerprint's row of the table holds its Hamming distances to all of them.  By the
triangle inequality two fingerprints that differ in k bits have no coordinates further apart
than k; and between two references a and b the coordinates take equal steps if none of the bits
from a to b differs.

1. Distinct fingerprints are dealt into groups that can hold a link: the 64 bits are cut into four
   blocks, and two fingerprints with at most two different bits take equal steps across two of
   the blocks at least.  The steps across each two blocks are a group's name.
2. A group of more than GROUP fingerprints is dealt again by the same rule, with its two open
   blocks cut into four; after the third time a group has 256 at most.  So there is no cap.
3. In a group a pair is discarded as soon as coordinates are more than two apart, first on a few
   references, then on all; the survivors are verified by their exact distance.

A fingerprint has at most 2,080 others within two bits, so the links stay few, and copies of a
text are one fingerprint before any of this.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .rows import quoted, whole_groups
from .scratch import written
from .text import LOWER, U64, find_words, mix, portions, signed, starts_within

SHINGLE = 3
SEED = 42
BITS = 64
#: Different bits of a link; the blocks of each dealing are two more.
MOST = 2
BLOCKS = MOST + 2
#: Fingerprints of a group that are compared with each other without being dealt again.
GROUP = 1024
#: Shingles hashed at a time.
HASHED = 1 << 16
#: Any constant serves; this one has no regular bits.
BASE = 0xB5AD4ECEDA1CE2A9
#: Reference t: the base with its lowest t bits turned over.
REFERENCES = np.array([BASE ^ ((1 << t) - 1) for t in range(BITS + 1)], U64)
#: References tried first: the ends of the staircase and steps between.
FIRST = (0, 16, 32, 48, 64)


def spaced_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of the lower-cased words with one space between, begins of the words, words by row."""
    data = LOWER[data]
    words = find_words(data, offsets)
    length = words.end - words.begin
    begin = np.concatenate([[0], np.cumsum(length + 1)])
    place = np.arange(len(data)) + np.repeat(
        np.concatenate([begin[:-1] - words.begin, [0]]), np.diff(np.concatenate([[0], words.end, [len(data)]]))
    )
    inside = np.zeros(len(data) + 1, np.int8)
    inside[words.begin] += 1
    inside[words.end] -= 1
    inside = np.cumsum(inside[:-1]) > 0
    spaced = np.full(begin[-1], 0x20, np.uint8)
    spaced[place[inside]] = data[inside]
    return spaced, begin, words.first


def fingerprints(data: np.ndarray, offsets: np.ndarray, size: int) -> np.ndarray:
    """SimHash of each row: the bits that more than half of its shingles' hashes have."""
    spaced, begin, first = spaced_words(data, offsets)
    at, rows = starts_within(first, size)
    counts = np.diff(first)
    short = np.flatnonzero((counts > 0) & (counts < size))
    low = np.concatenate([begin[at], begin[first[short]]])
    high = np.concatenate([begin[at + size], begin[first[short + 1]]]) - 1
    rows = np.concatenate([rows, short])
    order = np.argsort(rows, kind="stable")
    low, high, rows = low[order], high[order], rows[order]
    text = spaced.tobytes()
    votes = np.zeros((len(counts), BITS), np.int64)
    for k in range(0, len(rows), HASHED):
        part = slice(k, k + HASHED)
        found = [
            xxhash.xxh64_intdigest(text[a:b], SEED)
            for a, b in zip(low[part].tolist(), high[part].tolist(), strict=True)
        ]
        bits = np.unpackbits(np.array(found, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        head = np.flatnonzero(np.diff(rows[part], prepend=-1))
        votes[rows[part][head]] += np.add.reduceat(bits, head, axis=0, dtype=np.int32)
    held = np.maximum(counts - size + 1, np.minimum(counts, 1))
    majority = 2 * votes > held[:, None]
    return np.packbits(majority, axis=1, bitorder="little").view("<u8").reshape(-1).astype(U64)


def fingerprint_rows(size: int):
    """Task: texts to fingerprints."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch["text"]):
                found = fingerprints(part.data, part.offsets, size)
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"][part.low : part.high], pa.array(signed(found))],
                    ["doc_id", "node"],
                )

    return task


def distances(nodes: np.ndarray) -> np.ndarray:
    """The table: Hamming distance of each fingerprint to each reference."""
    return np.bitwise_count(nodes[:, None] ^ REFERENCES).astype(np.int8)


def layouts(level: int) -> list[tuple[int, ...]]:
    """For each way to choose the equal blocks `level` times, the steps that are still open."""
    found = [tuple(range(BITS))]
    for _ in range(level):
        found = [
            tuple(b for k, b in enumerate(layout) if k // (len(layout) // BLOCKS) not in equal)
            for layout in found
            for equal in combinations(range(BLOCKS), BLOCKS - MOST)
        ]
    return found


def group_names(nodes: np.ndarray, level: int) -> np.ndarray:
    """Name of each fingerprint's group under each layout of a level: nodes, layouts."""
    steps = np.diff(distances(nodes), axis=1) > 0
    names = []
    for number, layout in enumerate(layouts(level)):
        equal = steps.copy()
        equal[:, list(layout)] = False  # open steps do not count
        packed = np.packbits(equal, axis=1, bitorder="little").view("<u8").reshape(-1)
        names.append(mix(packed ^ mix(np.full(len(nodes), number + (level << 32), U64))))
    return np.stack(names, axis=1)


def dealt_rows(level: int, of: bool):
    """Task: fingerprints to one row for each group of a level.

    With `of` a row comes with the name of a large group of the level before, and only the ways
    to deal that group again are taken.
    """
    ways = len(layouts(1))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 8192):
                part = batch.slice(low, 8192)
                nodes = part["node"].to_numpy().view(U64)
                names = group_names(nodes, level)
                if of:
                    above = group_names(nodes, level - 1) == part["name"].to_numpy().view(U64)[:, None]
                    names = names[np.repeat(above, ways, axis=1)].reshape(len(nodes), -1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(signed(names.reshape(-1))),
                        pa.array(np.repeat(signed(nodes), names.shape[1])),
                    ],
                    ["name", "node"],
                )

    return task


def near_pairs(nodes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a group within MOST bits, as places, a part of the group at a time."""
    table = distances(nodes)
    first = table[:, FIRST]
    place = np.arange(len(nodes))
    for low in range(0, len(nodes), 64):
        x = place[low : low + 64]
        open_ = x[:, None] < place
        for column in first.T:
            open_ &= np.abs(column[x, None] - column) <= MOST
        a, b = np.nonzero(open_)
        a = x[a]
        near = np.abs(table[a] - table[b]).max(axis=1, initial=0) <= MOST
        a, b = a[near], b[near]
        near = np.bitwise_count(nodes[a] ^ nodes[b]) <= MOST
        yield a[near], b[near]


def link_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: fingerprints ordered by group to links."""
    for table in whole_groups(batches, "name"):
        name, nodes = table["name"].to_numpy(), table["node"].to_numpy()
        ends = np.append(np.flatnonzero(name[1:] != name[:-1]) + 1, len(name))
        begin = 0
        for end in ends.tolist():
            own = nodes[begin:end]
            begin = end
            for a, b in near_pairs(own.view(U64)):
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(own[a]), pa.array(own[b])], ["a", "b"])


def find_links(nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) of the distinct fingerprints `node` that differ in at most two bits."""
    links = None
    rows, level = nodes, 1
    while True:
        dealt = written(rows.mapInArrow(dealt_rows(level, level > 1), "name long, node long"))
        last = len(layouts(level)[0]) <= 2 * BLOCKS
        sizes = written(dealt.groupBy("name").agg(F.count("*").alias("n")).where("n > 1"))
        small = dealt.join(sizes if last else sizes.where(F.col("n") <= GROUP), "name", "left_semi")
        found = (
            small.repartition("name").sortWithinPartitions("name").mapInArrow(link_rows, "a long, b long")
        )
        found = written(found)
        links = found if links is None else links.unionByName(found)
        large = sizes.where(F.col("n") > GROUP)
        if last or large.isEmpty():
            return links
        rows, level = dealt.join(large, "name", "left_semi"), level + 1


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """Per row: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable).

    Words are those between white space, A-Z lower-cased; a shingle is `shingle` words joined by
    one space, and repeats count; a text of fewer words is one shingle.  A fingerprint has the bits
    that more than half of the shingles' XXH64 values (seed 42) have.  Null, empty and blank
    texts have the fingerprint zero and are linked like any other.  Fingerprints link at two or
    fewer different bits.  Repeated rows are in one component; a null id never becomes a
    component's id while another id is reachable.  Other columns are ignored.
    """
    texts = docs.select(
        F.col(quoted(doc_id)).alias("doc_id"), F.coalesce(F.col(quoted(text)), F.lit("")).alias("text")
    )
    sketches = written(texts.mapInArrow(fingerprint_rows(shingle), "doc_id long, node long"))
    nodes = written(sketches.groupBy("node").agg(F.min("doc_id").alias("id")))
    roots = components(find_links(nodes.select("node")))
    placed = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = placed.groupBy("root").agg(F.min("id").alias("component_id"))
    # written, so that a fingerprint of many rows can be split when they are joined to it
    named = written(placed.join(least, "root").select("node", "component_id"))
    return sketches.join(named, "node").select(
        "doc_id", F.lower(F.lpad(F.hex("node"), 16, "0")).alias("fingerprint"), "component_id"
    )
