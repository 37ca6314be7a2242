"""Hard negatives for anchors, by full exact scores in the manner of the Four Russians.

Components become integers, and a row's integers are stored as bit planes: for each bit of the
two's complement and each group of eight dimensions one byte.  For an anchor and a group there
are only 256 possible sums of a subset of its eight components; these are computed once, by
doubling.  The inner product with a row is then a lookup for each byte of the row, summed over
the groups of a plane, and shifted and added from the sign plane down.

Anchors are the stated query set and go against all rows in blocks: a block of about
BLOCK_BYTES is broadcast, whatever the table's size.  Tasks build the tables of some anchors at a time and
keep only the best few rows of each anchor; Spark takes the best of these.  No row is grouped by
its label or its vector, so a frequent one weighs on no task.

1. Against each block all rows of the anchor's label give its positives.
2. Rows of other labels whose score lies in a positive's window give its negatives.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .rows import quoted
from .scratch import written

SCALE = 256
#: Larger components count as this many, so that scores of 1,024 dimensions fit a long.
LIMIT = (1 << 26) - 1
#: Bytes of the anchors in one broadcast.
BLOCK_BYTES = 16 << 20
#: Anchors whose tables are held, and rows scored with them at a time.
TABLES = 256
ROWS = 512
#: Id that stands for a null one: after all others.
LAST = (1 << 63) - 1
#: Below all scores.
LEAST = -(1 << 63) + 1


def planes_of(whole: np.ndarray, planes: int) -> np.ndarray:
    """Bit planes of integers (rows, dims): rows, planes from the lowest, groups of eight dims."""
    return np.stack([np.packbits((whole >> p) & 1, axis=1, bitorder="little") for p in range(planes)], axis=1)


def integers(lists: pa.ListArray, dims: int) -> np.ndarray:
    """Lists of integers as a matrix, filled up with zeros."""
    lengths = lists.value_lengths().to_numpy()
    row = np.repeat(np.arange(len(lists)), lengths)
    column = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    found = np.zeros((len(lists), dims), np.int64)
    found[row, column] = lists.flatten().to_numpy()
    return found


def packed_rows(dims: int, planes: int):
    """Task: rows with integers to rows with their bit planes."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = planes_of(integers(batch["whole"], dims), planes).reshape(batch.num_rows, -1)
            ends = np.arange(batch.num_rows + 1, dtype=np.int32) * packed.shape[1]
            raw = np.ascontiguousarray(packed)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"],
                    batch["label"],
                    pa.Array.from_buffers(
                        pa.binary(), batch.num_rows, [None, pa.py_buffer(ends), pa.py_buffer(raw)]
                    ),
                ],
                ["id", "label", "planes"],
            )

    return task


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """Sums of all subsets of each group of eight components: groups, 256, anchors."""
    groups = -(-anchors.shape[1] // 8)
    padded = np.zeros((groups * 8, len(anchors)), anchors.dtype)
    padded[: anchors.shape[1]] = anchors.T
    sums = np.zeros((groups, 256, len(anchors)), anchors.dtype)
    for bit in range(8):
        half = 1 << bit
        sums[:, half : 2 * half] = sums[:, :half] + padded[bit::8, None, :]
    return sums


def scores(sums: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Inner products of rows, given as bit planes, with the anchors of the tables."""
    total = np.zeros((len(planes), sums.shape[2]), sums.dtype)
    looked = np.empty_like(total)
    top = planes.shape[1] - 1
    for p in range(top, -1, -1):
        if p < top:
            total <<= 1
        for g in range(len(sums)):
            np.take(sums[g], planes[:, p, g], axis=0, out=looked, mode="clip")
            total += looked
        if p == top:  # the plane of the sign weighs negative
            np.negative(total, out=total)
    return total


class Best:
    """The first rows of each slot: larger scores first, then smaller ids."""

    def __init__(self, slots: int, limit: int):
        self.limit = limit
        self.score = np.full((slots, limit), LEAST)
        self.id = np.full((slots, limit), LAST)

    def beats(self, slots: slice, score: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Which rows (scores by row and slot) would enter."""
        least, last = self.score[slots, -1], self.id[slots, -1]
        found = score >= least
        tied = score == least
        if tied.any():
            found &= ~tied | (ids[:, None] < last)
        return found

    def offer(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(slot):
            return
        changed = np.unique(slot)
        slot = np.concatenate([np.repeat(changed, self.limit), slot])
        score = np.concatenate([self.score[changed].reshape(-1), score])
        ids = np.concatenate([self.id[changed].reshape(-1), ids])
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        head = np.ones(len(slot), bool)
        head[1:] = slot[1:] != slot[:-1]
        place = np.arange(len(slot))
        rank = place - np.maximum.accumulate(np.where(head, place, 0))
        stay = rank < self.limit
        self.score[slot[stay], rank[stay]] = score[stay]
        self.id[slot[stay], rank[stay]] = ids[stay]

    def rows(self, names: dict[str, np.ndarray]) -> pa.RecordBatch:
        """What is held, with the names of each slot."""
        slot, rank = np.nonzero(self.score > LEAST)
        return pa.RecordBatch.from_arrays(
            [*[pa.array(n[slot]) for n in names.values()], pa.array(self.score[slot, rank]), pa.array(self.id[slot, rank])],
            [*names, "score", "id"],
        )


def scored_chunks(
    batches: Iterator[pa.RecordBatch], anchors: np.ndarray, planes: int
) -> Iterator[tuple[np.ndarray, np.ndarray, slice, np.ndarray]]:
    """Ids and labels of some rows, some anchors, and all scores between them."""
    groups = -(-anchors.shape[1] // 8)
    bound = int(np.abs(anchors).sum(axis=1).max(initial=0)) << planes
    kind = np.int32 if bound < 1 << 31 else np.int64
    for batch in batches:
        ids = batch["id"].to_numpy()
        labels = batch["label"].to_numpy()
        packed = np.frombuffer(b"".join(batch["planes"].to_pylist()), np.uint8)
        packed = packed.reshape(batch.num_rows, planes, groups)
        for low in range(0, len(anchors), TABLES):
            own = slice(low, min(low + TABLES, len(anchors)))
            sums = subset_sums(anchors[own].astype(kind))
            for row in range(0, batch.num_rows, ROWS):
                some = slice(row, row + ROWS)
                yield ids[some], labels[some], own, scores(sums, packed[some])


def positive_rows(block: Broadcast, planes: int, count: int):
    """Task: rows to the best of each anchor's own label."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = block.value
        best = Best(len(anchors["id"]), count)
        for ids, labels, own, score in scored_chunks(batches, anchors["whole"], planes):
            fits = labels[:, None] == anchors["label"][own]
            fits &= ids[:, None] != anchors["id"][own]
            fits &= best.beats(own, score, ids)
            row, slot = np.nonzero(fits)
            best.offer(slot + own.start, score[row, slot].astype(np.int64), ids[row])
        yield best.rows({"anchor": anchors["anchor"]})

    return task


def negative_rows(block: Broadcast, planes: int, count: int):
    """Task: rows to the best of other labels in each positive's window."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = block.value
        # slots are an anchor's positives, all first ones before all second ones
        low, high = anchors["low"], anchors["high"]
        places, size = low.shape
        best = Best(places * size, count)
        for ids, labels, own, score in scored_chunks(batches, anchors["whole"], planes):
            other = labels[:, None] != anchors["label"][own]
            for k in range(places):
                slots = slice(k * size + own.start, k * size + own.stop)
                fits = other & (score >= low[k, own]) & (score <= high[k, own])
                fits &= best.beats(slots, score, ids)
                row, slot = np.nonzero(fits)
                best.offer(slot + slots.start, score[row, slot].astype(np.int64), ids[row])
        place = np.repeat(np.arange(places, dtype=np.int32), size)
        yield best.rows({"anchor": np.tile(anchors["anchor"], places), "positive": place})

    return task


def first_of(rows: DataFrame, by: list[str], count: int) -> DataFrame:
    """The first rows of each group, with their rank from 1; tasks drop later ones before the shuffle."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def hard_negatives(
    vectors: DataFrame,
    anchor: Column,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str | Column = "label",
    positives: int = 5,
    negatives: int = 3,
    least_percent: int = 50,
    most_percent: int = 95,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per anchor, positive and negative: anchor_id, positive_id, rank, negative_id and both scores.

    `anchor` tells which rows are anchors.  Components x become floor(256 * x), at most 2**26 - 1
    either way; a shorter vector is filled up with zeros, and an empty one scores 0.  Rows with a
    null label, a null vector or a component that is null or not finite take no part.

    Larger scores come first, of equal ones the smaller id.  An anchor's positives are its first
    rows of the same label and another id.  Negatives of a positive have another label and a score
    from `least_percent` to `most_percent` of the positive's.  Rows that repeat are candidates of
    their own; an anchor that repeats as a whole, in id, label and integers, is one anchor.  A null
    id counts as the largest, is returned as null, and is no anchor unless `anchor` says so.
    Columns other than those named are ignored.
    """
    label = F.col(quoted(label)) if isinstance(label, str) else label
    components = F.col(quoted(vector))
    scaled = F.transform(components, lambda x: F.floor(x.cast("double") * SCALE))
    bounded = F.transform(
        scaled, lambda x: F.least(F.greatest(x, F.lit(-LIMIT)), F.lit(LIMIT)).cast("int")
    )
    finite = F.forall(
        components,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))),
    )
    spark = vectors.sparkSession
    rows = written(
        vectors.where(label.isNotNull() & components.isNotNull() & finite).select(
            F.coalesce(F.col(quoted(id)), F.lit(LAST)).alias("id"),
            label.cast("long").alias("label"),
            bounded.alias("whole"),
            F.coalesce(anchor, F.lit(False)).alias("is_anchor"),
        )
    )
    shape = rows.agg(
        F.max(F.size("whole")),
        F.max(F.greatest(F.array_max("whole"), -F.array_min("whole"))),
    ).first()
    dims, planes = max(1, shape[0] or 0), int(shape[1] or 0).bit_length() + 1
    packed = written(
        rows.select("id", "label", "whole").mapInArrow(
            packed_rows(dims, planes), "id long, label long, planes binary"
        )
    )
    asked = rows.where("is_anchor").select("id", "label", "whole").distinct()
    asked = asked.withColumn("anchor", F.xxhash64("id", "label", "whole"))
    # dealt by hash into blocks of anchors whose bytes have a bound
    blocks = max(1, -(-asked.count() * dims * 8 // block_bytes))
    dealt = written(asked.withColumn("block", F.pmod("anchor", F.lit(blocks)).cast("int")))
    found = []
    for k in range(blocks):
        taken = dealt.where(F.col("block") == k).toArrow().combine_chunks()
        if not taken.num_rows:
            continue
        shared = {name: taken[name].to_numpy() for name in ("anchor", "id", "label")}
        shared["whole"] = integers(taken["whole"].combine_chunks(), dims)
        first = packed.mapInArrow(
            positive_rows(spark.sparkContext.broadcast(shared), planes, positives),
            "anchor long, score long, id long",
        )
        first = written(first_of(first, ["anchor"], positives))
        shared |= windows_of(first, shared["anchor"], positives, least_percent, most_percent)
        second = packed.mapInArrow(
            negative_rows(spark.sparkContext.broadcast(shared), planes, negatives),
            "anchor long, positive int, score long, id long",
        )
        pairs = first.select(
            "anchor",
            (F.col("rank") - 1).alias("positive"),
            F.col("id").alias("positive_id"),
            F.col("score").alias("positive_score"),
        ).join(dealt.where(F.col("block") == k).select("anchor", F.col("id").alias("anchor_id")), "anchor")
        found.append(
            written(first_of(second, ["anchor", "positive"], negatives).join(pairs, ["anchor", "positive"]))
        )
    if not found:
        found = [nothing(rows)]
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    known = [F.nullif(F.col(c), F.lit(LAST)).alias(c) for c in ("anchor_id", "positive_id")]
    return whole.select(
        *known,
        "rank",
        F.nullif(F.col("id"), F.lit(LAST)).alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def windows_of(
    first: DataFrame, anchors: np.ndarray, positives: int, least_percent: int, most_percent: int
) -> dict[str, np.ndarray]:
    """For a block: lowest and highest negative score by place of the positive and anchor.

    A window without a score stands for a positive that is missing.
    """
    rows = first.select("anchor", "rank", "score").toArrow()  # `positives` rows for each anchor
    order = np.argsort(anchors)
    place = order[np.searchsorted(anchors, rows["anchor"].to_numpy(), sorter=order)]
    rank, score = rows["rank"].to_numpy() - 1, rows["score"].to_numpy()
    low = np.full((positives, len(anchors)), 1, np.int64)
    high = np.zeros((positives, len(anchors)), np.int64)
    low[rank, place] = -(-least_percent * score // 100)
    high[rank, place] = most_percent * score // 100
    return {"low": low, "high": high}


def nothing(rows: DataFrame) -> DataFrame:
    columns = "rank int, id long, score long, anchor_id long, positive_id long, positive_score long"
    return rows.sparkSession.createDataFrame([], columns)
