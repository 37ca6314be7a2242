"""Quality rules: counts of each document, fixed limits, and boosted trees over the counts.

The trees are fitted on at most `TRAIN_ROWS` labelled documents (those of least hash of id,
which are a fair sample), so only that many rows of features reach the driver.  Scoring is one
pass over all documents with the flat node arrays broadcast.  The probability of a good
document may only fall as symbols, repeated lines, repeated words or shouting rise.
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
from .text import (
    LOWER,
    SPACED,
    Portion,
    Rolling,
    at_least_one,
    byte_class,
    byte_values,
    find_words,
    portions,
    starts_within,
)
from .trees import Forest, fit

TRAIN_ROWS = 20_000
#: Documents less likely good than this are rejected.
THRESHOLD = 0.5
REPEAT_WINDOW = 8
SYMBOLS = byte_class(b"#*$%&|<>")
UPPER = byte_class(bytes(range(0x41, 0x5B)))
LETTER = UPPER | byte_class(bytes(range(0x61, 0x7B)))
DIGIT = byte_class(bytes(range(0x30, 0x3A)))
#: Feature names, and +1 or -1 where the score must rise or fall with the feature.
FEATURES = {
    "log_words": 0,
    "word_length": 0,
    "symbols_per_word": -1,
    "dup_lines": -1,
    "repeated_words": -1,
    "upper_letters": -1,
    "digits": 0,
    "exclamations_per_word": -1,
    "stops_per_word": 0,
    "commas_per_word": 0,
    "distinct_words": 0,
    "other_alphabet": 0,
    "words_per_line": 0,
    "letters": 0,
}


class Statistics(NamedTuple):
    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray
    features: np.ndarray


def per_row(marked: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of marked units of each row."""
    sums = np.concatenate([[0], np.cumsum(marked)])[offsets]
    return np.diff(sums)


def groups_within(rows: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by row and hash; where a new value of a row begins; size of each value's group."""
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    head = np.flatnonzero(new)
    return order, new, np.diff(np.append(head, len(rows)))


def statistics(data: np.ndarray, offsets: np.ndarray) -> Statistics:
    """Counts and features of each text of a portion."""
    rows = len(offsets) - 1
    words = find_words(data, offsets)
    n_words = np.diff(words.first)
    inside, whole_char = SPACED[data], (data & 0xC0) != 0x80
    n_chars = per_row(whole_char, offsets)
    word_chars = per_row(inside & whole_char, offsets)
    n_symbols = per_row(SYMBOLS[data], offsets)
    rolling = Rolling(byte_values(data))
    hashes = rolling.stretch(words.begin, words.end)

    # lines that hold a word
    lines = find_words(data, offsets, np.arange(256) != 0x0A)
    holds = np.searchsorted(words.begin, lines.end) > np.searchsorted(words.begin, lines.begin)
    line_row = lines.row()[holds]
    _, new, _ = groups_within(line_row, rolling.stretch(lines.begin, lines.end)[holds])
    n_lines = np.bincount(line_row, minlength=rows)
    n_dup_lines = n_lines - np.bincount(np.sort(line_row)[new], minlength=rows)

    # words in windows that the text holds at least twice
    begin, window_row = starts_within(words.first, REPEAT_WINDOW)
    order, new, sizes = groups_within(window_row, Rolling(hashes).windows(REPEAT_WINDOW)[begin])
    twice = begin[order[np.repeat(sizes > 1, sizes)]]
    change = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(change, twice, 1)
    np.add.at(change, twice + REPEAT_WINDOW, -1)
    n_repeat_words = per_row(np.cumsum(change[:-1]) > 0, words.first)

    word_row = words.row()
    _, new, _ = groups_within(word_row, Rolling(byte_values(LOWER[data])).stretch(words.begin, words.end))
    distinct = np.bincount(word_row[new], minlength=rows)
    letters = per_row(LETTER[data], offsets)
    count = lambda byte: per_row(data == byte, offsets)
    share = lambda part, of: part / np.maximum(of, 1)
    features = np.stack(
        [
            np.log1p(n_words),
            share(word_chars, n_words),
            share(n_symbols, n_words),
            share(n_dup_lines, n_lines),
            share(n_repeat_words, n_words),
            share(per_row(UPPER[data], offsets), letters),
            share(per_row(DIGIT[data], offsets), n_chars),
            share(count(0x21), n_words),
            share(count(0x2E), n_words),
            share(count(0x2C), n_words),
            share(distinct, n_words),
            share(per_row(data >= 0xC0, offsets), n_chars),
            share(n_words, n_lines),
            share(letters, n_chars),
        ],
        axis=1,
    )
    return Statistics(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, features)


def feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: labelled texts to features."""
    for batch in batches:
        for part in portions(batch["text"]):
            found = statistics(part.data, part.offsets).features
            ends = np.arange(len(found) + 1, dtype=np.int32) * found.shape[1]
            own = slice(part.low, part.high)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"][own],
                    batch["label"][own],
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(found.reshape(-1))),
                ],
                ["doc_id", "label", "features"],
            )


VERDICT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, score double"
)


def judged_texts(model: Broadcast, threshold: float):
    """Task: texts to counts and verdict."""

    def judged(forest: Forest | None, part: Portion) -> pa.StructArray:
        s = statistics(part.data, part.offsets)
        failed = (s.n_words < 20) | (100 * s.n_repeat_words > 30 * s.n_words)
        score = np.ones(len(failed)) if forest is None else forest.probabilities(s.features)
        counts = {name: getattr(s, name).astype(np.int64) for name in s._fields[:5]}
        return struct_of(**counts, base_failed=failed, kept=~failed & (score >= threshold), score=score)

    def task(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        forest = value_of(model)
        for text in texts:
            yield pa.concat_arrays([judged(forest, part) for part in at_least_one(text)])

    return task


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """(doc_id, text, label) of at most `rows` labelled ids, those of least hash."""
    chosen = (
        labels.where("label in (0, 1) and doc_id is not null")
        .groupBy("doc_id")
        .agg(F.max("label").cast("double").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    return docs.join(F.broadcast(chosen), "doc_id")  # at most `rows` ids and labels


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Forest | None:
    """Trees from labelled rows (doc_id, label); None where not both labels occur."""
    sample = (
        labelled_sample(docs, labels, rows)
        .mapInArrow(feature_rows, "doc_id long, label double, features array<double>")
        .groupBy("doc_id")
        .agg(F.min(F.struct("features", "label")).alias("row"))
        .select("doc_id", "row.features", "row.label")
        .toPandas()
        .sort_values("doc_id")
    )
    if sample["label"].nunique() < 2:
        return None
    signs = np.array(list(FEATURES.values()))
    return fit(np.stack(sample["features"].to_numpy()), sample["label"].to_numpy(), signs)


def quality_rules(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    train_rows: int = TRAIN_ROWS,
    threshold: float = THRESHOLD,
    carry: bool = False,
) -> DataFrame:
    """Per document: doc_id, the five counts, base_failed, kept, score.

    base_failed: fewer than 20 words, or over 30 % of them in repeated 8-word windows.  kept:
    not base_failed and a score of at least `threshold`.  A null text counts as empty and so
    fails; a null id is kept as it is and never labelled; labels other than 0 and 1 are
    ignored, and with labels of one kind only, or none, the trees are left out (score 1).
    Repeated rows are judged alike.  Columns other than those named are ignored, or come along
    in `carried` beside the text.
    """
    texts = keyed(docs, doc_id, text, carry).drop("key")
    marks = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).alias("label"))
    trees = train(texts.select("doc_id", "text"), marks, train_rows)
    model = by_value(docs.sparkSession.sparkContext, trees)
    verdict = beside(judged_texts(model, threshold), VERDICT, "text").alias("verdict")
    more = ["text", "carried"] if carry else []
    return texts.select("doc_id", verdict, *more).select("doc_id", "verdict.*", *more)
