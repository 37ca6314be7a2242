"""Suffix dedup, window dedup and near-duplicates against brute force."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dumpwinnow.llm import suffix_dedup, superminhash
from dumpwinnow.llm.substring import remove_windows
from tests.llm.conftest import EDGE, lower, words


def mutated(seed, n, shared):
    """Texts with copies, shared passages and small changes."""
    draw = random.Random(seed)
    vocabulary = [f"w{i}é" for i in range(60)]
    base = [draw.choice(vocabulary) for _ in range(90)]
    texts = []
    for _ in range(n):
        text = list(base) if draw.random() < 0.6 else [draw.choice(vocabulary) for _ in range(50)]
        for _ in range(draw.choice([0, 1, 2, 5, 20])):
            text[draw.randrange(len(text))] = draw.choice(vocabulary)
        if draw.random() < 0.4:
            text = text[: draw.randrange(1, len(text))] + shared + text
        texts.append(" ".join(text))
    return texts


@pytest.fixture(scope="module")
def texts():
    return mutated(5, 60, ["passage"] * 12 + [f"p{i}" for i in range(30)])


def cut_bytes(texts, size):
    starts = {}
    for k, raw in enumerate(texts):
        for i in range(len(raw) - size + 1):
            starts.setdefault(raw[i : i + size], []).append((k, i))
    gone = [bytearray(len(raw)) for raw in texts]
    for places in starts.values():
        if len(places) > 1:
            for k, i in places:
                gone[k][i : i + size] = b"\x01" * size
    return [bytes(b for b, g in zip(raw, mask, strict=True) if not g) for raw, mask in zip(texts, gone, strict=True)]


@pytest.mark.parametrize("gathered", [2, 256])
def test_suffix_dedup_equals_brute_force(spark, texts, monkeypatch, gathered):
    monkeypatch.setattr(suffix_dedup, "GATHERED", gathered)
    docs = spark.createDataFrame(list(enumerate([*texts, "ab" * 200])), "doc_id long, text string")
    rows = suffix_dedup.remove_repeats(docs, size=60, core=25).collect()
    want = cut_bytes([t.encode() for t in [*texts, "ab" * 200]], 60)
    assert {r["doc_id"]: bytes(r["kept"]) for r in rows} == dict(enumerate(want))
    for r in rows:
        assert sum(s["high"] - s["low"] for s in r["removed"]) == r["n_bytes"] - len(r["kept"])


def test_suffix_dedup_edge_rows(edge, empty):
    rows = suffix_dedup.remove_repeats(edge).collect()
    assert len(rows) == len(EDGE)
    kept = sorted((r["doc_id"] or 0, r["n_bytes"], bytes(r["kept"])) for r in rows)
    want = cut_bytes([(t or "").encode() for _, t, _ in EDGE[:7] + EDGE[8:9]], 400)
    short = [(i or 0, len((t or "").encode()), k) for (i, t, _), k in zip(EDGE[:7] + EDGE[8:9], want, strict=True)]
    assert [k for k in kept if k[0] < 7] == sorted([*short, (0, 0, b"")])
    assert all(k[2] == b"" for k in kept if k[0] >= 7)
    assert suffix_dedup.remove_repeats(empty).collect() == []


def cut_words(rows, size):
    first = {}
    for rank, ws in sorted(rows):
        for i in range(len(ws) - size + 1):
            first.setdefault(tuple(ws[i : i + size]), rank)
    out = []
    for rank, ws in rows:
        gone = [False] * len(ws)
        for i in range(len(ws) - size + 1):
            if first[tuple(ws[i : i + size])] < rank:
                gone[i : i + size] = [True] * size
        out.append(b" ".join(w for w, g in zip(ws, gone, strict=True) if not g))
    return out


def test_window_dedup_equals_brute_force(spark, texts):
    docs = spark.createDataFrame([(100 - k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    rows = remove_windows(docs, size=12, core=5).collect()
    want = cut_words([(100 - k, words(t)) for k, t in enumerate(texts)], 12)
    assert {r["doc_id"]: r["kept"].encode() for r in rows} == {100 - k: w for k, w in enumerate(want)}


def test_window_dedup_edge_rows(edge, empty):
    rows = remove_windows(edge, carry=True).collect()
    want = cut_words([(2**63 - 1 if i is None else i, words(t)) for i, t, _ in EDGE], 50)
    assert sorted((r["doc_id"] or 0, r["kept"].encode()) for r in rows) == sorted(
        (i or 0, w) for (i, _, _), w in zip(EDGE, want, strict=True)
    )
    assert {r["carried"]["node"] for r in rows} == {"k"}
    assert remove_windows(empty).collect() == []


def linked(rows, size, percent):
    """Component of each row by comparing all pairs of sets."""
    sets = []
    for i, t in rows:
        ws = words(lower((t or "").encode()).decode())
        sets.append({tuple(ws[k : k + size]) for k in range(max(1, len(ws) - size + 1))} if ws else set())
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x in range(len(rows)):
        for y in range(x):
            common = len(sets[x] & sets[y])
            if common and 100 * common >= percent * len(sets[x] | sets[y]):
                parent[top(x)] = top(y)
    groups = {}
    for x, (i, _) in enumerate(rows):
        groups.setdefault(top(x), []).append(i)
    least = {g: min((i for i in ids if i is not None), default=None) for g, ids in groups.items()}
    return [(i, len(sets[x]), least[top(x)]) for x, (i, _) in enumerate(rows)]


@pytest.mark.parametrize("block", [3, 1024])
def test_near_duplicates_equal_brute_force(spark, texts, monkeypatch, block):
    monkeypatch.setattr(superminhash, "BLOCK", block)
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = superminhash.near_duplicates(docs, shingle=3, percent=85).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == sorted(linked(rows, 3, 85))
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_near_duplicates_edge_rows(edge, empty):
    found = superminhash.near_duplicates(edge).collect()
    want = linked([(i, t) for i, t, _ in EDGE], 5, 80)
    assert sorted((repr(r["doc_id"]), r["n_shingles"], repr(r["component_id"])) for r in found) == sorted(
        (repr(i), n, repr(c)) for i, n, c in want
    )
    assert superminhash.near_duplicates(empty).collect() == []


@pytest.mark.parametrize("equal", [True, False])
def test_bands_equal_in_low_bytes_alone_do_not_hide_a_pair(equal):
    """Two signatures share band 3; band 1 agrees in all slots, or in their low bytes alone."""
    bands, rows, band = 4, 6, 3
    slots = bands * rows
    signature = np.random.default_rng(5).integers(1 << 63, size=(2, slots)).astype(np.uint64)
    signature[1, band * rows :] = signature[0, band * rows :]
    own = slice(rows, 2 * rows)
    signature[1, own] = signature[0, own] + np.uint64(0 if equal else 256)
    found = superminhash.band_hashes(signature, bands, rows).view(np.int64)
    assert list(found[0] == found[1]) == [False, equal, False, True]
    brief = [bytes(s) for s in (signature & np.uint64(255)).astype(np.uint8)]
    assert brief[0][own] == brief[1][own]
    block = pa.RecordBatch.from_pydict(
        {
            "node": [10, 11],
            "block": [1, 1],
            "band": pa.array([band] * 2, pa.int32()),
            "same": [True, True],
            "side": pa.array([0, 0], pa.int32()),
            "n": [20, 20],
            "root": [10, 11],
            "brief": pa.array(brief, pa.binary()),
            "earlier": found[:, :band].tolist(),
            "members": [list(range(20)), list(range(20))],
        }
    )
    # what an earlier bucket holds as well is compared there
    want = [] if equal else [(10, 11)]
    kept = list(superminhash.open_rows(85, 2 * rows, slots)(iter([block])))
    assert [n for b in kept for n in b["node"].to_pylist()] == [n for w in want for n in w]
    links = superminhash.link_rows(85, 2 * rows, slots)(iter([block]))
    assert [(r["a"], r["b"]) for b in links for r in b.to_pylist()] == want


def test_sha_of_kept_words(spark):
    docs = spark.createDataFrame([(1, " a  b\tc ")], "doc_id long, text string")
    row = remove_windows(docs).select(F.sha2("kept", 256).alias("h")).first()
    assert row["h"] == hashlib.sha256(b"a b c").hexdigest()
