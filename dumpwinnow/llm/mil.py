"""Quality scores by attention-based multiple-instance learning.

A document is a bag of passages of `PASSAGE` words.  Each passage is encoded by the counts of
quality_rules and by its words hashed into `HASHED` columns, then by one layer.  Gated
attention gives each passage a weight: a softmax over w . (tanh(V e) * sigmoid(U e)) within
the document.  The weighted sum of the passages is scored by a logistic unit.  Only documents
have labels; the weights are learned from those.

The network is small and fitted by Adam in numpy on at most `TRAIN_ROWS` labelled documents of
at most `TRAIN_BYTES` (those of least hash of id); scoring reads every passage of all documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quality_rules import FEATURES, labelled_sample, statistics
from .text import LOWER, U64, find_words, portions, word_hashes

TRAIN_ROWS = 6_000
TRAIN_BYTES = 100_000
PASSAGE = 64
HASHED = 48
HIDDEN = 24
ATTENTION = 12
EPOCHS = 30
BATCH = 64
LIKELY = 0.3

Model = dict[str, np.ndarray]


def passages(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Encoded inputs of all passages, and the first passage of each text.

    A text without words is one passage of nothing.
    """
    words = find_words(data, offsets)
    counts = np.diff(words.first)
    pieces = np.maximum(-(-counts // PASSAGE), 1)
    first = np.concatenate([[0], np.cumsum(pieces)])
    row = np.repeat(np.arange(len(counts)), pieces)
    inside = np.arange(first[-1]) - first[row]
    begins = words.begin if len(words.begin) else np.zeros(1, np.int64)
    start = begins[np.minimum(words.first[row] + inside * PASSAGE, len(begins) - 1)]
    # the first passage begins with its text
    bounds = np.append(np.where(inside == 0, offsets[row], start), offsets[-1])
    features = statistics(data, bounds).features
    word = words.row()
    passage = first[word] + (np.arange(len(word)) - words.first[word]) // PASSAGE
    hashed = (word_hashes(LOWER[data], words) % U64(HASHED)).astype(np.int64)
    bag = np.bincount(passage * HASHED + hashed, minlength=first[-1] * HASHED)
    return np.hstack([features, np.sqrt(bag.reshape(-1, HASHED))]).astype(np.float32), first


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


def forward(model: Model, x: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
    """All values of the network for bags of passages first[i] to first[i + 1]."""
    row, head = np.repeat(np.arange(len(first) - 1), np.diff(first)), first[:-1]
    x = np.clip((x - model["mean"]) / model["spread"], -6, 6)
    e = np.maximum(x @ model["W"] + model["b"], 0)
    t, g = np.tanh(e @ model["V"]), sigmoid(e @ model["U"])
    s = (t * g) @ model["w"]
    weight = np.exp(s - np.maximum.reduceat(s, head)[row])
    weight /= np.add.reduceat(weight, head)[row]
    z = np.add.reduceat(weight[:, None] * e, head)
    p = sigmoid(z @ model["c"] + model["d"])
    return {"row": row, "x": x, "e": e, "t": t, "g": g, "weight": weight, "z": z, "p": p}


def gradients(model: Model, v: dict[str, np.ndarray], first: np.ndarray, y: np.ndarray) -> Model:
    """Of the mean log loss."""
    d = (v["p"] - y) / len(y)
    row, e, t, g, weight = v["row"], v["e"], v["t"], v["g"], v["weight"]
    dz = (d[:, None] * model["c"])[row]
    da = (e * dz).sum(axis=1)
    ds = weight * (da - np.add.reduceat(weight * da, first[:-1])[row])
    gate = ds[:, None] * model["w"]
    dt, dg = gate * g * (1 - t**2), gate * t * g * (1 - g)
    de = weight[:, None] * dz + dt @ model["V"].T + dg @ model["U"].T
    de *= e > 0
    return {
        "c": v["z"].T @ d,
        "d": d.sum(keepdims=True),
        "w": (t * g).T @ ds,
        "V": e.T @ dt,
        "U": e.T @ dg,
        "W": v["x"].T @ de,
        "b": de.sum(axis=0),
    }


def fit(x: np.ndarray, first: np.ndarray, y: np.ndarray, seed: int = 7) -> Model:
    draw = np.random.default_rng(seed)
    normal = lambda *shape: draw.normal(0, shape[0] ** -0.5, shape)
    model = {
        "mean": x.mean(axis=0),
        "spread": x.std(axis=0) + 1e-3,
        "W": normal(x.shape[1], HIDDEN),
        "b": np.zeros(HIDDEN),
        "V": normal(HIDDEN, ATTENTION),
        "U": normal(HIDDEN, ATTENTION),
        "w": normal(ATTENTION),
        "c": normal(HIDDEN),
        "d": np.zeros(1),
    }
    speed = {k: np.zeros_like(v) for k, v in model.items()}
    square = {k: np.zeros_like(v) for k, v in model.items()}
    step = 0
    for epoch in range(EPOCHS):
        rate = 0.004 * (1 - epoch / EPOCHS)
        order = draw.permutation(len(y))
        for low in range(0, len(order), BATCH):
            bags = order[low : low + BATCH]
            sizes = first[bags + 1] - first[bags]
            ends = np.concatenate([[0], np.cumsum(sizes)])
            at = np.arange(ends[-1]) + np.repeat(first[bags] - ends[:-1], sizes)
            step += 1
            for k, slope in gradients(model, forward(model, x[at], ends), ends, y[bags]).items():
                slope = slope + 1e-4 * model[k]
                speed[k] = 0.9 * speed[k] + 0.1 * slope
                square[k] = 0.999 * square[k] + 0.001 * slope**2
                model[k] = model[k] - rate * (speed[k] / (1 - 0.9**step)) / (
                    np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8
                )
    return model


def passage_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: labelled texts to the inputs of their passages, end to end."""
    for batch in batches:
        for part in portions(batch["text"]):
            x, first = passages(part.data, part.offsets)
            own = slice(part.low, part.high)
            ends = (first * x.shape[1]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"][own],
                    batch["label"][own],
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(x.reshape(-1))),
                ],
                ["doc_id", "label", "x"],
            )


def score_rows(shared: Broadcast):
    """Task: texts to scores and the weight of the passage that counts most."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part in portions(batch["text"]):
                x, first = passages(part.data, part.offsets)
                if model is None:
                    p, top = np.full(part.high - part.low, 0.5), np.ones(part.high - part.low)
                else:
                    v = forward(model, x, first)
                    p, top = v["p"], np.maximum.reduceat(v["weight"], first[:-1])
                own = slice(part.low, part.high)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"][own],
                        batch["held_out"][own],
                        pa.array(p.astype(float)),
                        pa.array((p >= LIKELY).astype(np.int32)),
                        pa.array(np.diff(first)),
                        pa.array(top.astype(float)),
                    ],
                    ["doc_id", "held_out", "score", "predicted", "n_passages", "top_weight"],
                )

    return task


def train(docs: DataFrame, labels: DataFrame, rows: int, most_bytes: int) -> Model | None:
    """Fit on labelled rows (doc_id, label); None where not both labels occur."""
    sample = (
        labelled_sample(docs.where(F.octet_length("text") <= most_bytes), labels, rows)
        .select("doc_id", "text", "label")
        .mapInArrow(passage_rows, "doc_id long, label double, x array<float>")
        .groupBy("doc_id")
        .agg(F.min(F.struct("x", "label")).alias("row"))
        .select("doc_id", "row.x", "row.label")
        .toPandas()
        .sort_values("doc_id")
    )
    if sample["label"].nunique() < 2:
        return None
    width = len(FEATURES) + HASHED
    first = np.concatenate([[0], np.cumsum([len(x) // width for x in sample["x"]])])
    x = np.concatenate(sample["x"].to_list()).reshape(-1, width)
    return fit(x, first, sample["label"].to_numpy())


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    held_out: Column | None = None,
    train_rows: int = TRAIN_ROWS,
    train_bytes: int = TRAIN_BYTES,
) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted, n_passages, top_weight.

    held_out marks documents whose labels are not learned from (by default those whose crc32
    of the id as text is divisible by 5; a null id counts as empty text).  A null text is
    empty and gets the score of an empty passage.  Labels other than 0 and 1 are ignored;
    without both of them every score is 0.5.  Repeated rows get equal scores.  Columns other
    than those named are ignored.
    """
    if held_out is None:
        held_out = F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 5 == 0
    texts = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        held_out.alias("held_out"),
    )
    own = labels.select(
        F.col(doc_id).alias("doc_id"), F.col(label).alias("label"), held_out.alias("held_out")
    )
    learned = ~F.col("held_out")
    model = train(
        texts.where(learned).drop("held_out"),
        own.where(learned).drop("held_out"),
        train_rows,
        train_bytes,
    )
    return texts.mapInArrow(
        score_rows(docs.sparkSession.sparkContext.broadcast(model)),
        "doc_id long, held_out boolean, score double, predicted int, n_passages long, "
        "top_weight double",
    )
