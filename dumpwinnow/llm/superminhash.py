"""Near-duplicate documents by SuperMinHash signatures.

For each shingle a random permutation of the signature's slots is drawn step by step; step j
offers the value j + r (0 <= r < 1) to the slot it names.  The ranks that one shingle gives to
the slots are thus all different, which lowers the variance against independent hashes, and a
document is finished as soon as all its slots hold values below the next step.

Signatures are cut into bands.  Documents with equal sets are one node.  Nodes that share a
band are compared on their full sets, at first only with one leader of each band bucket.  Where
a bucket then still holds nodes of different components, these are compared across components
inside tasks, in blocks of bounded size: first by their signatures, whose agreement must not
be six deviations short of the threshold, and what is left on the full sets.  Only confirmed
links leave the tasks, and no candidate is given up.  Components follow from the links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .rows import keyed, releasing, whole_groups
from .scratch import written
from .text import (
    LOWER,
    SMALL_PORTION,
    SPACED,
    STEP,
    U64,
    Rolling,
    find_words,
    flat,
    mix,
    portions,
    signed,
    starts_within,
    word_hashes,
)

#: A pair of similarity 0.85 shares none of the bands with probability 6e-9, one of 0.8 5e-6.
BANDS = 40
ROWS = 6
#: Nodes of a bucket that one task compares with each other.
BLOCK = 1024
#: Pairs compared at a time by their signatures, and bytes of sets compared at a time.
PAIRS = 1 << 14
PAIR_BYTES = 4 << 20


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row, end to end, and where each row's begin."""
    data = LOWER[data]
    words = find_words(data, offsets, SPACED)
    rolling = Rolling(word_hashes(data, words))
    begin, rows = starts_within(words.first, size)
    counts = np.diff(words.first)
    short = np.flatnonzero((counts > 0) & (counts < size))
    hashes = np.concatenate(
        [
            rolling.stretch(begin, begin + size),
            rolling.stretch(words.first[short], words.first[short + 1]),
        ]
    )
    rows = np.concatenate([rows, short])
    order = np.lexsort((hashes, rows))
    hashes, rows = hashes[order], rows[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
    return hashes[new], np.searchsorted(rows[new], np.arange(len(offsets)))


def signatures(hashes: np.ndarray, first: np.ndarray, slots: int) -> np.ndarray:
    """SuperMinHash signature of each set; sets end to end, first[i] where each begins."""
    sets = len(first) - 1
    row = np.repeat(np.arange(sets), np.diff(first))
    result = np.full((sets, slots), np.iinfo(np.uint64).max, U64)
    best = result.reshape(-1)
    order = np.empty((len(hashes), slots), np.uint8)
    order[:] = np.arange(slots, dtype=np.uint8)
    live = np.arange(len(hashes))
    seeds = hashes
    open_sets = np.flatnonzero(np.diff(first) > 0)
    for step in range(slots):
        drawn = mix(seeds + U64((step * STEP) % (1 << 64)))
        other = step + (((drawn & U64(0xFFFFFFFF)) * U64(slots - step)) >> U64(32)).astype(np.int64)
        slot = order[live, other]
        order[live, other] = order[live, step]
        np.minimum.at(best, row[live] * slots + slot, (U64(step) << U64(32)) | (drawn >> U64(32)))
        done = result[open_sets].max(axis=1) < U64((step + 1) << 32)
        if done.any():
            ended = np.zeros(sets, bool)
            ended[open_sets[done]] = True
            open_sets = open_sets[~done]
            stay = ~ended[row[live]]
            live, seeds = live[stay], seeds[stay]
        if not len(live):
            break
    return result


def band_hashes(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One hash for each band of each signature; the band's number is part of it."""
    found = np.broadcast_to(np.arange(bands, dtype=U64), (len(signature), bands)).copy()
    cut = signature[:, : bands * rows].reshape(-1, bands, rows)
    for k in range(rows):
        found = mix(found ^ cut[:, :, k])
    return found


def sketch_rows(size: int, bands: int, rows: int):
    """Task: texts to set size, digest of the set, and band hashes."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch["text"], SMALL_PORTION):
                hashes, first = shingle_sets(part.data, part.offsets, size)
                counts = np.diff(first)
                sums = np.concatenate([[U64(0)], np.cumsum(mix(hashes))])
                node = mix((sums[first[1:]] - sums[first[:-1]]) ^ mix(counts.astype(U64)))
                signature = signatures(hashes, first, bands * rows)
                found = band_hashes(signature, bands, rows)
                brief = np.ascontiguousarray((signature & U64(0xFF)).astype(np.uint8))
                brief_ends = np.arange(len(counts) + 1, dtype=np.int32) * (bands * rows)
                own = slice(part.low, part.high)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"][own],
                        batch["key"][own],
                        pa.array(counts),
                        pa.array(signed(node)),
                        pa.ListArray.from_arrays(
                            pa.array(np.arange(len(counts) + 1, dtype=np.int32) * bands),
                            pa.array(signed(found.reshape(-1))),
                        ),
                        pa.Array.from_buffers(
                            pa.binary(),
                            len(counts),
                            [None, pa.py_buffer(brief_ends), pa.py_buffer(brief)],
                        ),
                    ],
                    ["doc_id", "key", "n_shingles", "node", "bands", "brief"],
                )

    return task


def set_rows(size: int):
    """Task: texts to their sets."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch["text"], SMALL_PORTION):
                hashes, first = shingle_sets(part.data, part.offsets, size)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["node"][part.low : part.high],
                        pa.ListArray.from_arrays(
                            pa.array(first.astype(np.int32)), pa.array(signed(hashes))
                        ),
                    ],
                    ["node", "members"],
                )

    return task


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, n_a, b, n_b) whose full sets are similar enough."""
    near = pairs.where(
        100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    ).select("a", "b").distinct()
    one = sets.select(F.col("node").alias("a"), F.col("members").alias("of_a"))
    two = sets.select(F.col("node").alias("b"), F.col("members").alias("of_b"))
    common = F.size(F.array_intersect("of_a", "of_b"))
    union = F.size("of_a") + F.size("of_b") - common
    return near.join(one, "a").join(two, "b").where(100 * common >= percent * union).select("a", "b")


def with_root(rows: DataFrame, roots: DataFrame) -> DataFrame:
    return rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def likely_pairs(group: dict[str, np.ndarray], percent: int, least: int):
    """Pairs of a block that have to be compared, as two arrays of places, a part at a time.

    They lie in different components, have sizes that allow a link, agree in at least `least`
    places of their signatures, and share no earlier bucket, which compares them as well.  The
    low bytes of the signatures serve the places alone: they agree where no bucket is shared.
    """
    brief, root, n, side = (group[k] for k in ("brief", "root", "n", "side"))
    earlier = np.ascontiguousarray(group["earlier"].T)
    place = np.arange(len(root))
    for low in range(0, len(root), 128):
        x = place[low : low + 128]
        open_ = (root[x, None] != root) & (100 * np.minimum(n[x, None], n) >= percent * np.maximum(n[x, None], n))
        # of two different chunks only pairs across; of one chunk each pair once
        open_ &= (side[x, None] < side) | ((side[x, None] == side) & (group["same"][0] & (x[:, None] < place)))
        i, j = np.nonzero(open_)
        for part in range(0, len(i), PAIRS):
            a, b = x[i[part : part + PAIRS]], j[part : part + PAIRS]
            near = (brief[a] == brief[b]).sum(axis=1) >= least
            a, b = a[near], b[near]
            first = np.ones(len(a), bool)
            for bucket in earlier:
                first &= bucket[a] != bucket[b]
            yield a[first], b[first]


def blocks_of(batches: Iterator[pa.RecordBatch], slots: int):
    """Blocks, each with its rows and their columns in numpy."""
    for table in whole_groups(batches, "block"):
        block = table["block"].to_numpy()
        ends = np.append(np.flatnonzero(block[1:] != block[:-1]) + 1, len(block))
        brief = flat(table["brief"])[0].reshape(-1, slots)
        columns = {k: table[k].to_numpy() for k in ("root", "n", "side", "same")}
        band = table["band"].to_numpy()
        buckets = table["earlier"].combine_chunks().flatten().to_numpy()
        first = np.concatenate([[0], np.cumsum(band, dtype=np.int64)])
        begin = 0
        for end in ends:
            own = {k: v[begin:end] for k, v in columns.items()}
            own["brief"] = brief[begin:end]
            own["earlier"] = buckets[first[begin] : first[end]].reshape(end - begin, band[begin])
            yield table.slice(begin, end - begin), own
            begin = end


def open_rows(percent: int, least: int, slots: int):
    """Task: keep the rows of each block that have a pair to compare."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, group in blocks_of(batches, slots):
            wanted = np.zeros(table.num_rows, bool)
            for a, b in likely_pairs(group, percent, least):
                wanted[a] = wanted[b] = True
            if wanted.any():
                yield from table.filter(pa.array(wanted)).to_batches()

    return task


def link_rows(percent: int, least: int, slots: int):
    """Task: compare pairs on their full sets; one link for each node and other component."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, group in blocks_of(batches, slots):
            lists = table["members"].combine_chunks()
            _, shingle = np.unique(lists.flatten().to_numpy(), return_inverse=True)
            row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
            held = np.zeros((len(lists), int(shingle.max(initial=0)) // 8 + 1), np.uint8)
            np.bitwise_or.at(held, (row, shingle // 8), np.uint8(1) << (shingle % 8).astype(np.uint8))
            n, root, node = group["n"], group["root"], table["node"].to_numpy()
            step = max(1, PAIR_BYTES // held.shape[1])
            for a, b in likely_pairs(group, percent, least):
                for part in range(0, len(a), step):
                    x, y = a[part : part + step], b[part : part + step]
                    common = np.bitwise_count(held[x] & held[y]).sum(axis=1, dtype=np.int64)
                    linked = 100 * common >= percent * (n[x] + n[y] - common)
                    x, y = x[linked], y[linked]
                    _, one = np.unique(np.stack([x, root[y]], axis=1), axis=0, return_index=True)
                    if len(one):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(node[x[one]]), pa.array(node[y[one]])], ["a", "b"]
                        )

    return task


BLOCK_ROWS = (
    "node long, block long, band int, same boolean, side int, n long, root long, brief binary, "
    "earlier array<long>"
)


def in_blocks(held: DataFrame) -> DataFrame:
    """Deal the nodes of each bucket into chunks, and chunks into pairs of chunks."""
    sizes = held.groupBy("bucket").agg(
        F.ceil(F.count("*") / BLOCK).cast("int").alias("chunks")
    )
    dealt = held.join(written(sizes), "bucket").withColumn(
        "chunk", F.pmod(F.xxhash64("node", "bucket"), F.col("chunks")).cast("int")
    )
    pairs = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    low, high = F.least("chunk", "other"), F.greatest("chunk", "other")
    return pairs.select(
        F.xxhash64("bucket", low, high).alias("block"),
        "band",
        (F.col("chunk") == F.col("other")).alias("same"),
        F.when(F.col("chunk") > F.col("other"), 1).otherwise(0).alias("side"),
        "node",
        "n",
        "root",
    )


def find_links(
    buckets: DataFrame, sets: DataFrame, sketches: DataFrame, percent: int, slots: int
) -> DataFrame:
    """(node, root) of all linked nodes; buckets: (bucket, band, node, n), none of one node.

    sketches: (node, brief, bands), the buckets of all its bands, shared or not.
    """
    lead = written(buckets.groupBy("bucket").agg(F.min(F.struct("node", "n")).alias("l")))
    pairs = buckets.join(lead, "bucket").where("node <> l.node").select(
        F.col("l.node").alias("a"), F.col("l.n").alias("n_a"), F.col("node").alias("b"), F.col("n").alias("n_b")
    )
    links = written(confirmed(pairs, sets, percent))
    held = with_root(buckets, written(components(links)))
    mixed = written(
        held.groupBy("bucket")
        .agg(F.min("root").alias("p"), F.max("root").alias("q"))
        .where("p < q")
        .select("bucket")
    )
    held = held.join(mixed, "bucket", "left_semi")
    p = percent / 100
    least = int(slots * (p - 6 * (p * (1 - p) / slots) ** 0.5))
    blocks = in_blocks(held).join(sketches, "node")
    blocks = blocks.withColumn("earlier", F.slice("bands", F.lit(1), F.col("band"))).drop("bands")
    likely = blocks.repartition("block").sortWithinPartitions("block").mapInArrow(
        releasing(open_rows(percent, least, slots)), BLOCK_ROWS
    )
    compared = likely.join(sets.select("node", "members"), "node")
    found = compared.repartition("block").sortWithinPartitions("block").mapInArrow(
        releasing(link_rows(percent, least, slots)), "a long, b long"
    )
    return components(links.unionByName(written(found)))


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = 5,
    percent: int = 80,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """Per row: doc_id, key, n_shingles, component_id (smallest doc_id reachable), kept.

    `key` is the row's id and text as rows.keyed hashes them.

    Words are those between white space, A-Z lower-cased; a text of fewer words than `shingle`
    is one shingle.  Linked are texts whose sets have 100 * intersection >= percent * union.
    Null, empty and blank texts have an empty set and link with nothing.  Rows that repeat an
    id with the same text are one document, and are kept alike.  A null id never becomes a
    component's id while another id is reachable; a component of null ids has a null id and
    its rows are kept.  Columns other than the two named are ignored.
    """
    texts = keyed(docs, doc_id, text)
    sketches = written(
        texts.select("doc_id", "key", "text").mapInArrow(
            releasing(sketch_rows(shingle, bands, rows)),
            "doc_id long, key long, n_shingles long, node long, bands array<long>, brief binary",
        )
    )
    filled = sketches.where("n_shingles > 0")
    nodes = written(
        filled.groupBy("node").agg(
            F.min("doc_id").alias("id"),
            F.min("key").alias("key"),
            F.first("n_shingles").alias("n"),
            F.first("bands").alias("bands"),
            F.first("brief").alias("brief"),
        )
    )
    banded = nodes.select("node", "n", F.posexplode("bands").alias("band", "bucket"))
    # written, so that a bucket of many nodes can be split when they are joined to it
    shared = written(
        banded.groupBy("bucket").agg(F.count("*").alias("held")).where("held > 1").select("bucket")
    )
    buckets = written(banded.join(shared, "bucket", "left_semi"))
    asked = buckets.select("node").distinct().join(nodes, "node").select("node", "key")
    sets = written(
        texts.select("key", "text")
        .join(asked, "key")
        .dropDuplicates(["key"])
        .select("node", "text")
        .mapInArrow(releasing(set_rows(shingle)), "node long, members array<long>")
    )
    roots = find_links(buckets, sets, nodes.select("node", "brief", "bands"), percent, bands * rows)
    placed = with_root(nodes.select("node", "id"), roots)
    named = placed.groupBy("root").agg(F.min("id").alias("component_id"))
    found = placed.join(named, "root").select("node", "component_id")
    linked = filled.select("doc_id", "key", "n_shingles", "node").join(found, "node").drop("node")
    alone = sketches.where("n_shingles = 0").select(
        "doc_id", "key", "n_shingles", F.col("doc_id").alias("component_id")
    )
    return linked.unionByName(alone).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )
