"""Remove long byte strings that occur more than once, by a depth-limited radix sort.

Suffixes matter only through their first `size` bytes (400): two suffixes equal that far are a
repeat, and the order beyond it is irrelevant.  The sort is most significant digit first, and
a suffix that is alone in its bucket after a pass leaves the sort.

1. First digit: the anchor, the `core`-byte gram of least hash inside the suffix's first
   `size` bytes, with its distance from the suffix's start.  Neighbouring suffixes share their
   anchor, so they travel as one row, a run: about one row for every (size - core) / 2 bytes
   instead of one for every byte.  A bucket whose anchor occurs once holds no repeat.
2. Second digit: all bytes that the run's suffixes cover.  Runs equal here are repeats in
   whole, and one of them stands for all in the last pass.
3. Last digit: the `size` bytes of each suffix, only in buckets where different runs are left.
   Equal groups are exactly the repeated strings.  A bucket of few runs is sorted where it is
   gathered; the suffixes of a large one are shuffled by the digit.

Digits are compared by hashes of 64 bits each; a group is equal in two of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rows import keyed, whole_groups
from .scratch import written
from .text import (
    Rolling,
    anchored_runs,
    byte_values,
    covered,
    cut,
    expand,
    flat,
    mix,
    portions,
    signed,
    spans_of,
)

SIZE = 400
CORE = 200
#: Different runs of a bucket that one task sorts; suffixes of larger buckets are dealt out by
#: their last digit instead.
GATHERED = 256


def core_rows(size: int, core: int):
    """Task: texts to the anchor of each run of suffixes."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch["text"]):
                grams = Rolling(byte_values(part.data)).windows(core)
                runs = anchored_runs(grams, part.offsets, size, core)
                yield pa.RecordBatch.from_arrays([pa.array(signed(grams[runs.anchor]))], ["core"])

    return task


def run_rows(size: int, core: int):
    """Task: texts to runs of suffixes, with the first two digits."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch["key"].to_numpy()
            for part in portions(batch["text"]):
                hashes = Rolling(byte_values(part.data))
                grams = hashes.windows(core)
                runs = anchored_runs(grams, part.offsets, size, core)
                base = part.offsets[runs.row]
                whole = hashes.stretch(runs.low, runs.high + size)
                # where the anchor lies belongs to the digit
                whole ^= (runs.anchor - runs.low).astype(np.uint64) << np.uint64(40)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(signed(grams[runs.anchor])),
                        pa.array(signed(whole)),
                        pa.array(keys[part.low : part.high][runs.row]),
                        pa.array((runs.low - base).astype(np.int32)),
                        pa.array((runs.high - base).astype(np.int32)),
                    ],
                    ["core", "whole", "key", "low", "high"],
                )

    return task


def piece_rows(size: int):
    """Task: texts with the runs asked of them to the bytes of each run."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat(batch["text"])
            row = np.repeat(np.arange(batch.num_rows), batch["asked"].value_lengths().to_numpy())
            core, low, high = (batch["asked"].flatten().field(k).to_numpy() for k in range(3))
            begin = offsets[row] + low
            end = offsets[row] + high + size
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(core),
                    pa.array(batch["key"].to_numpy()[row]),
                    pa.array(low),
                    pa.array([data[a:b].tobytes() for a, b in zip(begin, end, strict=True)], pa.binary()),
                ],
                ["core", "key", "low", "bytes"],
            )

    return task


def sorted_buckets(size: int):
    """Task: pieces ordered by core to the spans of suffixes that are equal in `size` bytes."""

    def repeats(pieces: pa.Table) -> pa.RecordBatch:
        data, offsets = flat(pieces["bytes"])
        at, which = expand(offsets[:-1], offsets[1:] - size)
        digits = Rolling(byte_values(data)).stretch(at, at + size)
        digits ^= mix(pieces["core"].to_numpy().view(np.uint64))[which]
        _, group, counts = np.unique(digits, return_inverse=True, return_counts=True)
        again = np.zeros(len(data), bool)
        again[at] = counts[group] > 1
        spans = spans_of(again, offsets)
        row = np.repeat(np.arange(len(spans)), spans.value_lengths().to_numpy())
        low = pieces["low"].to_numpy()[row]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(pieces["key"].to_numpy()[row]),
                pa.array((low + spans.flatten().field(0).to_numpy()).astype(np.int32)),
                pa.array((low + spans.flatten().field(1).to_numpy() - 1 + size).astype(np.int32)),
            ],
            ["key", "low", "high"],
        )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pieces in whole_groups(batches, "core"):
            yield repeats(pieces)

    return task


def suffix_rows(size: int):
    """Task: pieces to one row for each suffix."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch["bytes"]):
                rows = slice(part.low, part.high)
                at, which = expand(part.offsets[:-1], part.offsets[1:] - size)
                digits = Rolling(byte_values(part.data)).stretch(at, at + size)
                place = batch["low"].to_numpy()[rows][which] + at - part.offsets[which]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(batch["core"].to_numpy()[rows][which]),
                        pa.array(signed(digits)),
                        pa.array(batch["key"].to_numpy()[rows][which]),
                        pa.array(place.astype(np.int32)),
                    ],
                    ["core", "digits", "key", "at"],
                )

    return task


def cut_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: merge the spans of each text and cut them out."""
    for batch in batches:
        for part in portions(batch["text"]):
            rows = slice(part.low, part.high)
            gone = covered(batch["spans"][rows], part.offsets)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"][rows],
                    pa.array(np.diff(part.offsets)),
                    spans_of(gone, part.offsets),
                    cut(part.data, ~gone, part.offsets),
                ],
                ["doc_id", "n_bytes", "removed", "kept"],
            )


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, core: int = CORE
) -> DataFrame:
    """Per row: doc_id, n_bytes, removed (maximal byte spans low to high), kept (bytes).

    A byte goes if a `size`-byte string over it also starts anywhere else, in the same text or
    another; matches never cross texts and are judged on the input.  Every occurrence goes,
    the first too.  A null text counts as empty; texts shorter than `size` stay whole; repeated
    rows (same id and text) are repeats of each other; a null id is an id like any other.
    Columns of `docs` other than the two named are ignored.
    """
    texts = keyed(docs, doc_id, text)
    # written, so that a bucket of many runs can be split when runs are joined to it
    seen = written(
        texts.select("text")
        .mapInArrow(core_rows(size, core), "core long")
        .groupBy("core")
        .agg(F.count("*").alias("n"))
        .where("n > 1")
        .select("core")
    )
    runs = written(
        texts.select("key", "text")
        .mapInArrow(
            run_rows(size, core), "core long, whole long, key long, low int, high int"
        )
        .join(seen, "core", "left_semi")
    )
    # written, so that runs of a frequent string can be split when they are joined to it
    wholes = written(
        runs.groupBy("core", "whole").agg(
            F.count("*").alias("copies"), F.min(F.struct("key", "low", "high")).alias("one")
        )
    )
    # buckets of the first digit in which a run differs from all others
    mixed = (
        wholes.groupBy("core")
        .agg(F.count("*").alias("kinds"), F.min("copies").alias("fewest"))
        .where("kinds > 1 and fewest = 1")
        .select("core", (F.col("kinds") > GATHERED).alias("crowded"))
    )
    ones = written(
        wholes.join(mixed, "core").select("core", "crowded", "one.key", "one.low", "one.high")
    )

    def pieces(of: str) -> DataFrame:
        asked = (
            ones.where(of)
            .groupBy("key")
            .agg(F.collect_list(F.struct("core", "low", "high")).alias("asked"))
        )
        # of rows that repeat, one stands for all
        held = texts.select("key", "text").join(asked, "key").dropDuplicates(["key"])
        return held.mapInArrow(piece_rows(size), "core long, key long, low int, bytes binary")

    sorted_ = (
        pieces("not crowded")
        .repartition("core")
        .sortWithinPartitions("core")
        .mapInArrow(sorted_buckets(size), "key long, low int, high int")
    )
    suffixes = pieces("crowded").mapInArrow(
        suffix_rows(size), "core long, digits long, key long, at int"
    )
    equal = (
        suffixes.groupBy("core", "digits")
        .agg(F.min(F.struct("key", "at")).alias("a"), F.max(F.struct("key", "at")).alias("b"))
        .where("a <> b")
        .select("core", "digits")
    )
    single = suffixes.join(equal, ["core", "digits"], "left_semi").select(
        "key", F.col("at").alias("low"), (F.col("at") + size).alias("high")
    )
    whole = runs.join(
        wholes.where("copies > 1").select("core", "whole"), ["core", "whole"], "left_semi"
    ).select("key", "low", (F.col("high") + size).alias("high"))
    spans = (
        whole.unionByName(sorted_)
        .unionByName(single)
        .groupBy("key")
        .agg(F.collect_set(F.struct("low", "high")).alias("spans"))  # rows that repeat share a key
    )
    return (
        texts.join(spans, "key", "left")
        .select("doc_id", "text", "spans")
        .mapInArrow(
            cut_rows,
            "doc_id long, n_bytes long, removed array<struct<low int, high int>>, kept binary",
        )
    )
