"""Language-model scores by prediction by partial matching over bytes.

The model is a trie of contexts of up to `ORDER` bytes with the symbols that followed them in
the training documents.  A symbol is looked for in the longest context; where it was not seen
there, an escape (method C: as likely as the context has different symbols) leads to the next
shorter context, from which the symbols of the longer one are excluded; below order 0 all
other symbols are equally likely.  A text starts in a context of padding and ends with an end
symbol, so its score is the log10 probability of the whole text.

With counts summed over suffixes, the symbols of a context are also symbols of every shorter
one.  What an exclusion takes away therefore depends on the longer context alone, and every
(context, symbol) pair has one fixed code length.  Spark computes these by joins.  To score,
documents are dealt into blocks of about `BLOCK_BYTES`; a block asks for the code lengths of
the distinct pairs it holds and gets just those, so no task ever holds the whole trie.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rows import released, releasing
from .scratch import written
from .text import LOWER, U64, Words, find_words, portions, signed, word_hashes

ORDER = 4
BLOCK_BYTES = 24 << 20
# two byte values that UTF-8 never uses
START = 0xFE
END = 0xFF
SYMBOLS = 257
#: Keys of words begin here, above those of byte pairs.
WORD = 1 << 62
#: The end of a text as a word.
STOP = WORD
#: Distinct keys that a counting task holds before it passes them on.
HELD = 2_000_000


def pair_keys(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(context, symbol) of every byte and end: ORDER + 1 bytes as one number; row offsets."""
    rows = len(offsets) - 1
    padded = np.full(len(data) + rows * (ORDER + 1), START, np.uint8)
    place = np.repeat(np.arange(rows) * (ORDER + 1) + ORDER, np.diff(offsets))
    padded[place + np.arange(len(data))] = data
    padded[offsets[1:] + np.arange(1, rows + 1) * (ORDER + 1) - 1] = END
    keys = np.zeros(max(len(padded) - ORDER, 0), U64)
    for k in range(ORDER + 1):
        keys = (keys << U64(8)) | padded[k : len(padded) - ORDER + k]
    return keys[padded[ORDER:] != START], offsets + np.arange(rows + 1)


def word_keys(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, Words]:
    data = LOWER[data]
    words = find_words(data, offsets)
    # never the key of the end of a text
    return np.maximum(word_hashes(data, words) >> U64(2), U64(1)) | U64(WORD), words


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    codes, distinct = pd.factorize(keys)
    return distinct, np.bincount(codes, counts, len(distinct)).astype(np.int64)


def count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: texts to distinct keys with their counts in training texts (0: none)."""

    def table() -> pa.RecordBatch:
        keys, counts = summed(np.concatenate(held), np.concatenate(sizes))
        return pa.RecordBatch.from_arrays([pa.array(signed(keys)), pa.array(counts)], ["key", "n"])

    held: list[np.ndarray] = []
    sizes: list[np.ndarray] = []
    total = 0
    for batch in batches:
        train = batch["train"].to_numpy(zero_copy_only=False)
        for part in portions(batch["text"]):
            own = train[part.low : part.high]
            pairs, ends = pair_keys(part.data, part.offsets)
            words, found = word_keys(part.data, part.offsets)
            for keys, rows in ((pairs, np.diff(ends)), (words, np.diff(found.first))):
                distinct, counts = summed(keys, np.repeat(own, rows))
                held.append(distinct)
                sizes.append(counts)
                total += len(distinct)
            held.append(np.array([STOP], U64))
            sizes.append(np.array([own.sum()]))
            if total > HELD:
                distinct, counts = summed(np.concatenate(held), np.concatenate(sizes))
                held, sizes, total = [distinct], [counts], len(distinct)
                if total > HELD // 2:
                    yield table()
                    held, sizes, total = [], [], 0
    if held:
        yield table()


def distinct_keys(block: pa.Table) -> pa.Table:
    """Task: the keys that one block of texts needs."""
    held = []
    for part in portions(block["text"]):
        held.append(pd.unique(pair_keys(part.data, part.offsets)[0]))
        held.append(pd.unique(word_keys(part.data, part.offsets)[0]))
    keys = np.append(pd.unique(np.concatenate(held)), U64(STOP))
    return pa.table({"block": np.full(len(keys), block["block"][0].as_py()), "key": signed(keys)})


def score_rows(tokens: int, distinct: int):
    """Task: one block of texts with the values of its keys to scores."""

    def task(texts: pa.Table, values: pa.Table) -> pa.Table:
        index = pd.Index(values["key"].to_numpy())
        value = np.append(values["value"].to_numpy(), 0.0)  # the last: not found
        scale = math.log10(tokens + 0.5 * (distinct + 1))
        columns: dict[str, list] = {k: [] for k in ("n_tokens", "n_known", "base_score", "score")}
        order = []
        for part in portions(texts["text"]):
            pairs, ends = pair_keys(part.data, part.offsets)
            lengths = value[index.get_indexer(signed(pairs))]
            words, found = word_keys(part.data, part.offsets)
            counts = np.diff(found.first)
            keys = np.insert(words, found.first[1:], U64(STOP))
            seen = value[index.get_indexer(signed(keys))]
            first = (found.first + np.arange(len(found.first)))[:-1]
            columns["n_tokens"].append(counts + 1)
            columns["n_known"].append(np.add.reduceat((seen > 0).astype(np.int64), first))
            columns["base_score"].append(np.add.reduceat(np.log10(seen + 0.5) - scale, first))
            columns["score"].append(np.add.reduceat(lengths, ends[:-1]))
            order.append(np.arange(part.low, part.high))
        found = {k: np.concatenate(v) for k, v in columns.items()}
        return pa.table({"doc_id": texts["doc_id"], "held_out": texts["held_out"], **found})

    return task


def low_bytes(key: Column | str, count: int) -> Column:
    column = F.col(key) if isinstance(key, str) else key
    return column.bitwiseAND(F.lit((1 << (8 * count)) - 1))


def context(key: str) -> Column:
    return F.shiftrightunsigned(key, 8)


def code_lengths(pairs: DataFrame) -> DataFrame:
    """(key, value): log10 probability of each (context, symbol) pair; pairs: (key, n)."""
    seen = {ORDER: pairs.where("n > 0")}
    for k in range(ORDER - 1, -1, -1):
        seen[k] = written(
            seen[k + 1].groupBy(low_bytes("key", k + 1).alias("key")).agg(F.sum("n").alias("n"))
        )
    totals = {
        k: seen[k]
        .groupBy(context("key").alias("context"))
        .agg(F.sum("n").alias("t"), F.count("*").alias("u"))
        for k in seen
    }
    # of each context: what its shorter one still holds without the context's own symbols
    rest = {}
    for k in range(1, ORDER + 1):
        shorter = seen[k - 1].select(F.col("key").alias("short"), F.col("n").alias("n_short"))
        own = (
            seen[k]
            .select(context("key").alias("context"), low_bytes("key", k).alias("short"))
            .join(shorter, "short")
            .groupBy("context")
            .agg(F.sum("n_short").alias("x"), F.count("*").alias("v"))
            .withColumn("parent", low_bytes("context", k - 1))
        )
        parents = totals[k - 1].withColumnRenamed("context", "parent")
        rest[k] = written(
            own.join(parents, "parent").select(
                "context", (F.col("t") - F.col("x")).alias("t"), (F.col("u") - F.col("v")).alias("u")
            )
        )
    top = totals[ORDER].withColumnsRenamed({"t": "t_top", "u": "u_top"})
    first = pairs.withColumn("context", context("key")).join(top, "context", "left")
    known = first.where("n > 0").select("key", F.expr("log10(n / (t_top + u_top))").alias("value"))
    # pairs that training texts do not hold walk down the shorter contexts
    walk = first.where("n = 0").select(
        "key",
        F.coalesce(F.expr("log10(u_top / (t_top + u_top))"), F.lit(0.0)).alias("value"),
        F.lit(False).alias("done"),
        F.col("u_top").isNotNull().alias("longer_seen"),
    )
    for k in range(ORDER - 1, -1, -1):
        excluded = rest[k + 1].select(
            F.col("context").alias("longer"), F.col("t").alias("t_rest"), F.col("u").alias("u_rest")
        )
        own = totals[k].withColumnRenamed("context", "own")
        counts = seen[k].select(F.col("key").alias("pair"), F.col("n").alias("c"))
        walk = (
            walk.withColumns(
                {
                    "longer": low_bytes(context("key"), k + 1),
                    "own": low_bytes(context("key"), k),
                    "pair": low_bytes("key", k + 1),
                }
            )
            .join(excluded, "longer", "left")
            .join(own, "own", "left")
            .join(counts, "pair", "left")
            .withColumns(
                {
                    "t": F.when(F.col("longer_seen"), F.col("t_rest")).otherwise(F.col("t")),
                    "u": F.when(F.col("longer_seen"), F.col("u_rest")).otherwise(F.col("u")),
                }
            )
            .select(
                "key",
                (
                    F.col("value")
                    + F.expr(
                        "case when done or coalesce(u, 0) = 0 then 0.0 "
                        "when c is not null then log10(c / (t + u)) else log10(u / (t + u)) end"
                    )
                ).alias("value"),
                (F.col("done") | F.col("c").isNotNull()).alias("done"),
                (F.col("longer_seen") | F.col("u").isNotNull()).alias("longer_seen"),
            )
        )
    used = totals[0].agg(F.sum("u")).first()[0] or 0
    rest_of_bytes = math.log10(SYMBOLS - used)
    uniform = walk.select(
        "key", (F.col("value") - F.when(F.col("done"), 0.0).otherwise(rest_of_bytes)).alias("value")
    )
    return known.unionByName(uniform)


def score_texts(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    held_out: Column | None = None,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    held_out marks documents to score but not to learn from (by default those whose crc32 of
    the id as text leaves 1 modulo 5; a null id counts as empty text).  base_score is the
    smoothed unigram score of the words with one end token.  A null text is empty: only its
    end is scored.  Without any training document all symbols are equally likely.  Repeated
    rows count as often as they occur.  Columns other than the two named are ignored.
    """
    if held_out is None:
        name = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
        held_out = F.crc32(name) % 5 == 1
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
    )
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    blocks = 1 + size // block_bytes
    counts = written(
        rows.select("text", (~F.col("held_out")).alias("train"))
        .mapInArrow(releasing(count_rows), "key long, n long")
        .groupBy("key")
        .agg(F.sum("n").alias("n"))
    )
    words = counts.where(F.col("key") >= WORD)
    tokens, distinct = words.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count(F.when(F.col("n") > 0, 1))
    ).first()
    values = written(
        code_lengths(counts.where(F.col("key") < WORD)).unionByName(
            words.where("n > 0").select("key", F.col("n").cast("double").alias("value"))
        )
    )
    # written with the place it was read at, which tells repeated rows apart: they spread over
    # all blocks, and both uses of a row see it in the same one
    place = F.xxhash64("doc_id", F.length("text"), F.monotonically_increasing_id())
    dealt = written(
        rows.select(F.pmod(place, F.lit(blocks)).alias("block"), "doc_id", "held_out", "text")
    ).repartition("block")
    asked = dealt.groupBy("block").applyInArrow(
        lambda block: released(distinct_keys(block)), "block long, key long"
    )
    score = score_rows(tokens, distinct)
    answers = asked.join(values, "key").select("block", "key", "value")
    scored = (
        dealt.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(
            lambda texts, values: released(score(texts, values)),
            "doc_id long, held_out boolean, n_tokens long, n_known long, "
            "base_score double, score double",
        )
    )
    return scored.withColumn("train_tokens", F.lit(tokens).cast("long"))
