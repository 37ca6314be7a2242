"""Remove word windows that an earlier document holds too, by Rabin-Karp hashes.

Every window of `size` words (50) gets a rolling hash in one pass over prefix sums.  To count
them without shuffling one row for each word, windows are grouped by content first:

1. A window's anchor is the `core`-word gram of least hash in it.  Neighbouring windows share
   their anchor and travel as one run.  An anchor of one document alone ends there: none of
   its windows occurs in another.
2. Runs that cover the same words are counted as one; all but those of the first document
   that has them are repeated windows in whole.
3. Where an anchor's runs differ, the hash of each window is counted in Spark, with the
   first document that holds it.

Repeated windows of a document merge into maximal removal intervals.  A group is equal in two
independent 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rows import beside, keyed, releasing, struct_of
from .scratch import written
from .text import (
    Portion,
    Rolling,
    anchored_runs,
    at_least_one,
    covered,
    expand,
    find_words,
    join_words,
    portions,
    signed,
    spans_of,
    word_hashes,
)

SIZE = 50
CORE = 20
#: Rank of a document without an id: after all others.
LAST = (1 << 63) - 1


def core_rows(size: int, core: int):
    """Task: texts to the anchor of each run of windows."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ranks = batch["rank"].to_numpy()
            for part in portions(batch["text"]):
                words = find_words(part.data, part.offsets)
                grams = Rolling(word_hashes(part.data, words)).windows(core)
                runs = anchored_runs(grams, words.first, size, core)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(signed(grams[runs.anchor])),
                        pa.array(ranks[part.low : part.high][runs.row]),
                    ],
                    ["core", "rank"],
                )

    return task


def run_rows(size: int, core: int):
    """Task: texts to runs of windows that share an anchor."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ranks = batch["key"].to_numpy(), batch["rank"].to_numpy()
            for part in portions(batch["text"]):
                words = find_words(part.data, part.offsets)
                hashes = Rolling(word_hashes(part.data, words))
                grams = hashes.windows(core)
                runs = anchored_runs(grams, words.first, size, core)
                whole = hashes.stretch(runs.low, runs.high + size)
                # where the anchor lies belongs to the content
                whole ^= (runs.anchor - runs.low).astype(np.uint64) << np.uint64(40)
                base = words.first[runs.row]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(signed(grams[runs.anchor])),
                        pa.array(signed(whole)),
                        pa.array(keys[part.low : part.high][runs.row]),
                        pa.array(ranks[part.low : part.high][runs.row]),
                        pa.array((runs.low - base).astype(np.int32)),
                        pa.array((runs.high - base).astype(np.int32)),
                    ],
                    ["core", "whole", "key", "rank", "low", "high"],
                )

    return task


def window_rows(size: int):
    """Task: texts with the runs asked of them to one hash for each window."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ranks = batch["key"].to_numpy(), batch["rank"].to_numpy()
            for part in portions(batch["text"]):
                own = batch["asked"][part.low : part.high]
                row = np.repeat(np.arange(len(own)), own.value_lengths().to_numpy())
                core, low, high = (own.flatten().field(k).to_numpy() for k in range(3))
                at, which = expand(low, high)
                words = find_words(part.data, part.offsets)
                begin = at + words.first[row[which]]
                hashes = Rolling(word_hashes(part.data, words)).stretch(begin, begin + size)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(core[which]),
                        pa.array(signed(hashes)),
                        pa.array(keys[part.low : part.high][row[which]]),
                        pa.array(ranks[part.low : part.high][row[which]]),
                        pa.array(at.astype(np.int32)),
                    ],
                    ["core", "hash", "key", "rank", "at"],
                )

    return task


CUT = "n_words long, removed array<struct<low int, high int>>, kept string"


def cut_texts(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """Task: texts and spans to merged intervals and the words that stay."""

    def part_cut(part: Portion, spans: pa.ListArray) -> pa.StructArray:
        words = find_words(part.data, part.offsets)
        gone = covered(spans, words.first)
        return struct_of(
            n_words=np.diff(words.first),
            removed=spans_of(gone, words.first),
            kept=join_words(part.data, words, ~gone, part.offsets),
        )

    for text, spans in batches:
        yield pa.concat_arrays([part_cut(p, spans[p.low : p.high]) for p in at_least_one(text)])


def repeated_spans(texts: DataFrame, size: int, core: int) -> DataFrame:
    """Spans (key, spans) of windows that start in a document of smaller rank as well."""
    # written, so that an anchor of many runs can be split when runs are joined to it
    seen = written(
        texts.select("rank", "text")
        .mapInArrow(releasing(core_rows(size, core)), "core long, rank long")
        .groupBy("core")
        .agg(F.min("rank").alias("first"), F.max("rank").alias("last"))
        .where("first < last")
        .select("core")
    )
    runs = written(
        texts.select("key", "rank", "text")
        .mapInArrow(
            releasing(run_rows(size, core)), "core long, whole long, key long, rank long, low int, high int"
        )
        .join(seen, "core", "left_semi")
    )
    wholes = runs.groupBy("core", "whole").agg(F.min("rank").alias("first"))
    cores = wholes.groupBy("core").agg((F.min("first") < F.max("first")).alias("mixed"))
    # written, so that runs of a frequent string can be split when they are joined to it
    kinds = written(wholes.join(cores, "core"))
    found = written(runs.join(kinds, ["core", "whole"]))
    asked = (
        found.where("rank = first and mixed")
        .groupBy("key")
        .agg(F.collect_set(F.struct("core", "low", "high")).alias("asked"))
    )
    # of rows that repeat, one stands for all
    held = texts.join(asked, "key").dropDuplicates(["key"])
    windows = held.select("key", "rank", "text", "asked").mapInArrow(
        window_rows(size), "core long, hash long, key long, rank long, at int"
    )
    firsts = (
        windows.groupBy("core", "hash")
        .agg(F.min("rank").alias("first"), F.max("rank").alias("last"))
        .where("first < last")
        .select("core", "hash", "first")
    )
    single = windows.join(firsts, ["core", "hash"]).where("rank > first").select(
        "key", F.col("at").alias("low"), (F.col("at") + size).alias("high")
    )
    whole = found.where("rank > first").select(
        "key", "low", (F.col("high") + size).alias("high")
    )
    return (
        whole.unionByName(single)
        .groupBy("key")
        .agg(F.collect_set(F.struct("low", "high")).alias("spans"))
    )


def remove_windows(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, core: int = CORE, carry: bool = False
) -> DataFrame:
    """Per row: doc_id, n_words, removed (maximal word intervals), kept (text of the rest).

    A word goes if a window of `size` words over it also starts in a document of smaller id,
    judged on the input.  Windows do not cross documents, and repeats within one document stay.
    Kept words are joined by one space.  A null text has no words; texts of fewer words stay
    whole; a null id comes after all ids and equals other null ids; rows that share an id do
    not remove each other's words.  Columns other than the two named are ignored, or come along
    in `carried` beside the input text.
    """
    texts = keyed(docs, doc_id, text, carry).withColumn("rank", F.coalesce("doc_id", F.lit(LAST)))
    spans = repeated_spans(texts.select("key", "rank", "text"), size, core)
    more = ["text", "carried"] if carry else []
    cut = texts.join(spans, "key", "left").select(
        "doc_id", beside(cut_texts, CUT, "text", "spans").alias("cut"), *more
    )
    return cut.select("doc_id", "cut.*", *more)
