"""Quality rules, attention scores, PPM scores and SentencePiece paths."""

import math
import os
import re
import zlib
from array import array
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from dumpwinnow.llm import mil, ppm, quality_rules, trees
from dumpwinnow.llm import sentencepiece_nbest as sp
from dumpwinnow.llm.rows import by_value
from tests.llm.conftest import EDGE, words

SF_DIR = "/root/testdata/sf0.01"


def counts(text):
    """The five counts, word by word."""
    text = text or ""
    ws = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines, repeated = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in lines
            lines.add(line)
    seen = Counter(tuple(ws[i : i + 8]) for i in range(len(ws) - 7))
    twice = [False] * len(ws)
    for i in range(len(ws) - 7):
        if seen[tuple(ws[i : i + 8])] > 1:
            twice[i : i + 8] = [True] * 8
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(ws), sum(map(len, ws)), symbols, repeated, sum(twice)


def test_quality_counts_of_edge_rows(spark, edge, empty):
    labels = spark.createDataFrame([(1, 1), (6, 0), (7, None)], "doc_id long, quality int")
    rows = quality_rules.quality_rules(edge, labels, carry=True).collect()
    found = Counter((r["doc_id"], *[r[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]) for r in rows)
    assert found == Counter((i, *counts(t)) for i, t, _ in EDGE)
    for r in rows:
        failed = r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])
    assert quality_rules.quality_rules(empty, labels.limit(0)).collect() == []


def test_repeated_lines(spark):
    text = "a b\n\n \na b\nc\na b\n a b"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality_rules.quality_rules(docs, labels).first()["n_dup_lines"] == counts(text)[3] == 2


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_verdicts_follow_the_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_rules.quality_rules(docs, labels).where("not base_failed").join(labels, "doc_id").collect()
    assert sum(r["kept"] == (r["quality"] == 1) for r in rows) >= 0.95 * len(rows)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_attention_scores_follow_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    rows = mil.quality_scores(docs, labels).where("held_out").join(labels, "doc_id").collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in rows)
    assert sum(r["predicted"] == r["quality"] for r in rows) >= 0.9 * len(rows)


def test_attention_edge_rows(spark, edge, empty):
    labels = spark.createDataFrame([(1, 1), (6, 0), (7, 1)], "doc_id long, quality int")
    rows = mil.quality_scores(edge, labels).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(i for i, _, _ in EDGE)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    assert {r["n_passages"] for r in rows if r["doc_id"] in (3, 4, 5)} == {1}
    none = mil.quality_scores(edge, labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.5}
    assert mil.quality_scores(empty, labels).collect() == []


def test_attention_gradients_are_those_of_the_loss():
    draw = np.random.default_rng(1)
    x, first, y = draw.normal(size=(9, 5)), np.array([0, 2, 3, 9]), np.array([1.0, 0.0, 1.0])
    model = {
        "mean": np.zeros(5), "spread": np.ones(5), "W": draw.normal(size=(5, 4)), "b": draw.normal(size=4),
        "V": draw.normal(size=(4, 3)), "U": draw.normal(size=(4, 3)), "w": draw.normal(size=3),
        "c": draw.normal(size=4), "d": np.zeros(1),
    }

    def loss():
        p = mil.forward(model, x, first)["p"]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    slopes = mil.gradients(model, mil.forward(model, x, first), first, y)
    for name, slope in slopes.items():
        place = tuple(0 for _ in model[name].shape)
        kept = model[name][place]
        sides = []
        for step in (1e-5, -1e-5):
            model[name][place] = kept + step
            sides.append(loss())
        model[name][place] = kept
        assert slope[place] == pytest.approx((sides[0] - sides[1]) / 2e-5, abs=1e-6)


def test_attention_forward_pass_as_plain_loops():
    """Passage by passage and number by number, as the formulas read."""
    draw = np.random.default_rng(2)
    x, first = draw.normal(0, 4, size=(9, 5)), [0, 2, 3, 9]
    model = {
        "mean": draw.normal(size=5), "spread": draw.uniform(0.5, 2, size=5), "W": draw.normal(size=(5, 4)),
        "b": draw.normal(size=4), "V": draw.normal(size=(4, 3)), "U": draw.normal(size=(4, 3)),
        "w": draw.normal(size=3), "c": draw.normal(size=4), "d": draw.normal(size=1),
    }
    logistic = lambda v: 1 / (1 + math.exp(-v))
    want = []
    for low, high in zip(first, first[1:], strict=False):
        hidden, votes = [], []
        for passage in x[low:high]:
            inputs = [
                max(-6.0, min(6.0, (v - m) / s)) for v, m, s in zip(passage, model["mean"], model["spread"], strict=True)
            ]
            e = [max(0.0, sum(v * w[j] for v, w in zip(inputs, model["W"], strict=True)) + model["b"][j]) for j in range(4)]
            vote = 0.0
            for a in range(3):
                t = math.tanh(sum(e[j] * model["V"][j, a] for j in range(4)))
                g = logistic(sum(e[j] * model["U"][j, a] for j in range(4)))
                vote += t * g * model["w"][a]
            hidden.append(e)
            votes.append(math.exp(vote))
        z = [sum(v * e[j] for v, e in zip(votes, hidden, strict=True)) / sum(votes) for j in range(4)]
        want.append(logistic(sum(z[j] * model["c"][j] for j in range(4)) + model["d"][0]))
    assert mil.forward(model, x, np.array(first))["p"] == pytest.approx(want, rel=1e-9)


def test_trees_learn_and_stay_monotone():
    draw = np.random.default_rng(3)
    x = draw.uniform(size=(3000, 3))
    y = ((x[:, 0] < 0.5) & (x[:, 1] > 0.3)).astype(float)
    noisy = np.where(draw.uniform(size=3000) < 0.1, 1 - y, y)
    forest = trees.fit(x, noisy, np.array([-1, 0, 0]), trees=40)
    assert ((forest.probabilities(x) >= 0.5) == y).mean() > 0.97
    grid = np.repeat(draw.uniform(size=(200, 3)), 50, axis=0)
    grid[:, 0] = np.tile(np.linspace(0, 1, 50), 200)
    assert (np.diff(forest.scores(grid).reshape(200, 50), axis=1) <= 1e-9).all()


def ppm_by_hand(rows, order=4):
    """Score and base score of each row, context by context."""
    seen, known = defaultdict(Counter), Counter()

    def tokens(t):
        low = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in (t or "").encode())
        return [*words(low.decode()), None]

    for i, t in rows:
        if zlib.crc32(str("" if i is None else i).encode()) % 5 == 1:
            continue
        known.update(tokens(t))
        bytes_ = [254] * order + list((t or "").encode()) + [255]
        for p in range(order, len(bytes_)):
            for k in range(order + 1):
                seen[tuple(bytes_[p - k : p])][bytes_[p]] += 1
    total, distinct = sum(known.values()), len(known)
    for i, t in rows:
        bytes_ = [254] * order + list((t or "").encode()) + [255]
        score = 0.0
        for p in range(order, len(bytes_)):
            gone = set()
            for k in range(order, -1, -1):
                left = {s: c for s, c in seen.get(tuple(bytes_[p - k : p]), {}).items() if s not in gone}
                if not left:
                    continue
                whole = sum(left.values()) + len(left)
                if bytes_[p] in left:
                    score += math.log10(left[bytes_[p]] / whole)
                    break
                score += math.log10(len(left) / whole)
                gone |= set(left)
            else:
                score -= math.log10(257 - len(gone))
        base = sum(math.log10((known[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in tokens(t))
        yield i, len(tokens(t)), sum(known[w] > 0 for w in tokens(t)), total, base, score


def test_ppm_equals_counting_by_hand(spark):
    rows = [(i, t) for i, t, _ in EDGE if t is None or len(t) < 5000]
    rows += [(k, f"A line of text number {k} café {k * k}") for k in range(20, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = ppm.score_texts(docs, block_bytes=300).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    got = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in found), key=key)
    for g, w in zip(got, sorted(ppm_by_hand(rows), key=key), strict=True):
        assert g[:4] == w[:4]
        assert g[4:] == pytest.approx(w[4:])


def test_ppm_edge_tables(edge, empty):
    assert ppm.score_texts(empty).collect() == []
    rows = ppm.score_texts(edge, held_out=F.lit(True)).collect()
    lone = [r for r in rows if r["doc_id"] == 4]
    assert lone[0]["score"] == pytest.approx(-math.log10(257))
    assert {r["train_tokens"] for r in rows} == {0}


@pytest.fixture(scope="module")
def vocabulary():
    if not os.path.exists(sp.MODEL):
        pytest.skip("no model file")
    return sp.load_vocabulary()


def all_paths(vocabulary, marked):
    edges = vocabulary.edges(marked)
    paths = [[(0, b"")]] + [[] for _ in edges[1:]]
    for j in range(1, len(edges)):
        paths[j] = [(s + e[1], ids + e[2]) for e in edges[j] for s, ids in paths[e[0]]]
    return sorted(paths[-1], key=lambda p: -p[0])


def edited(ids, edits):
    found = sp.numbers(ids)
    for begin, end, new in sorted(edits, reverse=True):
        found[begin:end] = sp.numbers(new)
    return array("i", found).tobytes()


@pytest.mark.parametrize("text", ["hello", "the cat", "a  b", "aaa aa", "añ 漢x", "Hi. you", "q"])
@pytest.mark.parametrize("count", [1, 3, 7])
def test_n_best_equal_all_paths(vocabulary, text, count):
    ids, score, more = sp.Encoder(vocabulary, count).encode(text)
    every = all_paths(vocabulary, sp.SPACE + text.replace(" ", sp.SPACE))
    assert [score, *[s for s, _ in more]] == [s for s, _ in every[:count]]
    found = [(score, ids), *[(s, edited(ids, edits)) for s, edits in more]]
    assert len({i for _, i in found}) == len(found) and set(found) <= set(every)


def test_units_analysed_together_as_one_by_one(vocabulary):
    draw = np.random.default_rng(5)
    for n in (1, 2, 3, 7, 12, 20):
        units = ["".join(draw.choice(list("▁aaeéstñ漢the\n#"), n)) for _ in range(60)]
        for unit, found in zip(units, sp.analysed_together(vocabulary, units), strict=True):
            alone = sp.analysed(vocabulary, unit)
            plain = all(c in vocabulary.pieces for c in unit)
            assert found == alone if found is not None or plain else True


def test_units_met_again_are_not_analysed_again(vocabulary, monkeypatch):
    """As in a task whose batches share more words than 150,000."""
    looked_up = []
    plain = vocabulary.table.look_up
    monkeypatch.setattr(vocabulary.table, "look_up", lambda d: looked_up.append(len(d)) or plain(d), raising=False)
    encoder = sp.Encoder(vocabulary, 2)
    texts = [" ".join(f"{k:x}" for k in range(low, low + 40_000)) for low in range(0, 160_000, 40_000)]
    for text in texts:
        encoder.learn([text])
    assert looked_up
    looked_up.clear()
    for text in texts:
        encoder.learn([text])
    assert not looked_up


@pytest.mark.parametrize("pieces", [None, {"a": (0, -100), "b": (1, -200), "a▁": (2, -150), "▁": (3, -10), "\n": (4, -30)}])
def test_texts_together_as_whole_lattices(vocabulary, pieces):
    if pieces:
        vocabulary = sp.Vocabulary(pieces, list(range(100, 356)), [])
    draw = np.random.default_rng(6)
    texts = ["", "\n", " ", "▁ a", "\n\n a\r b", "a" * 60 + " b", "a" * 60 + "\tb"]
    texts += ["".join(draw.choice(list("aabthe  ▁\n\tñ漢"), n)) for n in range(1, 25)] * 2
    encoder = sp.Encoder(vocabulary, 3)
    ids, ends, scores, more = encoder.encode_all(texts)
    for k, text in enumerate(texts):
        own = ids[ends[k] : ends[k + 1]].tobytes()
        assert (own, scores[k], more[k]) == sp.Encoder(vocabulary, 3).encode(text)
        edges = vocabulary.edges(sp.SPACE + text.replace(" ", sp.SPACE)) if text else [[]]
        want = sp.best_paths(edges, 4)
        assert [scores[k], *[s for s, _ in more[k]]] == [s for s, _ in want[:3]]
        if len(want) > 1 and want[0][0] > want[1][0]:
            assert own == b"".join(e[2] for e in want[0][1])
    assert encoder.encode_all([])[3] == []


def test_encoding_edge_rows_round_trip(spark, edge, empty, vocabulary):
    shared = by_value(spark.sparkContext, vocabulary)
    rows = sp.decode(sp.encode(edge, shared), shared).collect()
    assert Counter((r["doc_id"], r["decoded"]) for r in rows) == Counter((i, t or "") for i, t, _ in EDGE)
    assert all(r["ids"] == [] and r["score"] == 0 and r["more"] == [] for r in rows if r["doc_id"] in (3, 4))
    assert sp.encode(empty, shared).collect() == []
