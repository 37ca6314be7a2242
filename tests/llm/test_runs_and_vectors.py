"""Periodic runs, hard negatives and pivot SimHash against brute force."""

import hashlib
import math
import os
import random
import zlib

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from dumpwinnow.llm import hard_negatives as hn
from dumpwinnow.llm import periodic_runs, queries, simhash
from tests.llm.conftest import EDGE, lower, words

SF_DIR = "/root/testdata/sf0.001"


def runs_by_hand(ws, least_words=6, least_exponent=4):
    """(start, length, period), by comparing words at every distance."""
    found = {}
    for p in range(1, len(ws) // least_exponent + 1):
        i = 0
        while i + p < len(ws):
            j = i
            while j + p < len(ws) and ws[j] == ws[j + p]:
                j += 1
            length = j - i + p
            if j > i and length >= max(least_words, least_exponent * p):
                found.setdefault((i, length), p)
            i = max(j, i + 1)
    return sorted((s, n, p) for (s, n), p in found.items())


def collapsed(ws, runs):
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return b" ".join(w for i, w in enumerate(ws) if i not in gone).decode()


def planted(doc, text):
    ws = words(text)
    n, h = len(ws), zlib.crc32(str(doc).encode())
    if doc is None or h % 10 or not n:
        return ws
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [ws[i] if i < a else ws[a + (i - a) % p] for i in range(n)]


def periodic_texts(seed):
    draw = random.Random(seed)
    for k in range(150):
        n, kinds = draw.choice([0, 1, 5, 6, 7, 30, 200]), draw.choice([1, 2, 3, 50])
        ws = [f"w{draw.randrange(kinds)}" for _ in range(n)]
        for _ in range(draw.randrange(3)):
            if n:
                a, p = draw.randrange(n), draw.randint(1, 9)
                ws = [w if i < a else ws[a + (i - a) % p] for i, w in enumerate(ws)]
        yield k, " ".join(ws)


@pytest.mark.parametrize("least", [(6, 4), (2, 2), (9, 3)])
def test_runs_equal_brute_force(spark, least):
    texts = list(periodic_texts(7))
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    rows = periodic_runs.find_runs(docs, least_words=least[0], least_exponent=least[1]).collect()
    for r, (_, text) in zip(sorted(rows, key=lambda r: r["doc_id"]), texts, strict=True):
        want = runs_by_hand(words(text), *least)
        assert [tuple(x) for x in r["runs"]] == want
        assert r["n_words"] == len(words(text)) and r["collapsed"] == collapsed(words(text), want)


def test_runs_of_edge_rows(edge, empty):
    rows = periodic_runs.find_runs(edge).collect()
    want = [(i, runs_by_hand(words(t)) if t and len(t) < 5000 else []) for i, t, _ in EDGE]
    key = lambda r: (repr(r[0]), r[1])
    assert sorted([(r["doc_id"], [tuple(x) for x in r["runs"]]) for r in rows], key=key) == sorted(want, key=key)
    assert (0, 160, 4) in [tuple(x) for r in rows if r["doc_id"] == 1 for x in r["runs"]]
    assert periodic_runs.find_runs(empty).collect() == []


def test_long_periodic_text(spark):
    """A text that is one run of 200,000 words, and one with a run of long words inside."""
    long_run = " ".join(["a", "b", "c"] * 70_000)
    inside = "x y " + "ü" * 3000 + " " + "q " * 9 + "z"
    docs = spark.createDataFrame([(1, long_run), (2, inside)], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in periodic_runs.find_runs(docs).collect()}
    assert [tuple(x) for x in rows[1]["runs"]] == [(0, 210_000, 3)] and rows[1]["collapsed"] == "a b c"
    assert [tuple(x) for x in rows[2]["runs"]] == [(3, 9, 1)]


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_query_of_runs_equals_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = queries.op11_periodic_runs(spark, SF_DIR).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    checked = 0
    for r in rows:
        ws = planted(r["doc_id"], texts[r["doc_id"]])
        if len(ws) > 1500:
            continue  # quadratic by hand
        runs = runs_by_hand(ws)
        top = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None,) * 3)
        milli = None if top[0] is None else 1000 * top[1] // top[2]
        assert (r["n_runs"], r["start"], r["length"], r["period"], r["exponent_milli"]) == (len(runs), *top, milli)
        lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
        assert r["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(collapsed(ws, runs).encode()).hexdigest()
        checked += bool(runs)
    assert checked > 10


def test_planted_runs_of_edge_rows(spark):
    rows = [(k, f"a b{k} c d e f g h i j {k} k l m n o p") for k in range(300)] + [(None, "x y"), (40, None), (41, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r["doc_id"], words(r["text"])) for r in queries.with_planted_runs(docs).collect()]
    key = lambda r: (repr(r[0]), r[1])
    assert sorted(got, key=key) == sorted([(i, planted(i, t)) for i, t in rows], key=key)


def whole(vector):
    return [max(-hn.LIMIT, min(hn.LIMIT, math.floor(256 * x))) for x in vector]


def negatives_by_hand(rows):
    """rows: (id, vector, label); anchors have ids divisible by 50."""
    fit = [
        (i, whole(v), label)
        for i, v, label in rows
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    order = lambda x: (-x[0], x[1] is None, x[1])
    anchors = {(i, tuple(v), label) for i, v, label in fit if i is not None and i % 50 == 0}
    for i, v, label in anchors:
        scored = [(sum(a * b for a, b in zip(v, w)), j, other) for j, w, other in fit]  # noqa: B905
        positives = sorted([s for s in scored if s[2] == label and s[1] != i], key=order)[:5]
        for top, j, _ in positives:
            near = [s for s in scored if s[2] != label and 50 * top <= 100 * s[0] <= 95 * top]
            for rank, (score, other, _) in enumerate(sorted(near, key=order)[:3], 1):
                yield i, j, rank, other, top, score


def vectors(seed, n):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(4, 13))
    for k in range(n):
        yield k, [float(x) for x in centres[draw.integers(4)] + draw.normal(size=13) / 2], int(draw.integers(4))


ODD = [
    (1000, [0.5] * 13, None),
    (1050, None, 2),
    (1100, [0.5] * 12 + [None], 2),
    (1150, [float("nan")] + [0.5] * 12, 2),
    (1200, [float("inf")] + [0.5] * 12, 2),
    (None, [0.9] * 13, 1),
    (None, [0.9] * 13, 2),
    (1250, [], 3),
    (1300, [1.0, -2.0], 3),
    (1350, [1e6] + [0.25] * 12, 1),
    (1350, [1e6] + [0.25] * 12, 1),
    (1400, [0.3] * 13, 1),
    (1400, [0.2] * 13, 1),
]
SCHEMA = "vec_id long, embedding array<double>, label int, id int, anchor string, planes binary"


@pytest.mark.parametrize("block_bytes", [1, 16 << 20])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(hn, "TABLES", 3)
    monkeypatch.setattr(hn, "ROWS", 16)
    rows = [*vectors(3, 400), *[(k, v, label) for k, (_, v, label) in enumerate(vectors(3, 60), 500)], *ODD]
    table = spark.createDataFrame([(*r, 1, "x", b"y") for r in rows], SCHEMA)
    found = hn.hard_negatives(table, anchor=F.col("vec_id") % 50 == 0, block_bytes=block_bytes)
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, negatives_by_hand(rows)))


def test_equal_vectors_come_in_order_of_their_ids(spark):
    """One vector holds most rows: ties go by id, whichever task sees them first."""
    rows = [(k, [1.0, 0.5], 1) for k in range(300)] + [(k, [0.75, 0.25], 2) for k in range(999, 300, -1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label long").repartition(7)
    found = hn.hard_negatives(table, anchor=F.col("vec_id") == 100).collect()
    assert {r["positive_id"] for r in found} == {0, 1, 2, 3, 4}
    assert all([r["negative_id"]] == [300 + r["rank"]] for r in found) and len(found) == 15


def test_hard_negatives_of_empty_tables(spark):
    table = spark.createDataFrame([(1, [0.5], 1)], "vec_id long, embedding array<float>, label int")
    assert hn.hard_negatives(table, anchor=F.lit(False)).collect() == []
    assert hn.hard_negatives(table, anchor=F.lit(True)).collect() == []
    assert hn.hard_negatives(table.limit(0), anchor=F.lit(True)).collect() == []


def test_scores_are_inner_products():
    draw = np.random.default_rng(9)
    for bound, kind in ((200, np.int32), (hn.LIMIT, np.int64)):
        a, b = draw.integers(-bound, bound, size=(2, 40, 21))
        planes = int(bound).bit_length() + 1
        assert (hn.scores(hn.subset_sums(a.astype(kind)), hn.planes_of(b, planes)) == b @ a.T).all()


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
@pytest.mark.parametrize("name", ["op7_suffix_dedup", "op12_hard_negatives"])
def test_query_equals_its_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    result = connection.execute(queries.all_oracles()[name])
    columns = [d[0] for d in result.description]
    rows = queries.all_queries()[name](spark, SF_DIR)
    assert sorted(columns) == sorted(rows.columns)
    assert sorted(map(tuple, rows.select(*columns).collect())) == sorted(map(tuple, result.fetchall()))


def simhash_by_hand(text, size=3):
    ws = words(lower((text or "").encode()).decode())
    grams = [b" ".join(ws[i : i + size]) for i in range(max(1, len(ws) - size + 1))] if ws else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_by_hand(rows):
    """rows: (id, fingerprint) to the smallest id that each reaches."""
    nodes = sorted({f for _, f in rows})
    parent = {f: f for f in nodes}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in nodes:
        for b in nodes:
            if a < b and (a ^ b).bit_count() <= 2:
                parent[top(a)] = top(b)
    least = {}
    for i, f in rows:
        if i is not None:
            least[top(f)] = min(i, least.get(top(f), i))
    return [(i, f"{f:016x}", least.get(top(f))) for i, f in rows]


def test_simhash_equals_brute_force(spark, edge, empty, monkeypatch):
    monkeypatch.setattr(simhash, "HASHED", 50)
    rows = [(i, t) for i, t, _ in EDGE]
    found = simhash.near_duplicates(edge).collect()
    want = components_by_hand([(i, simhash_by_hand(t)) for i, t in rows])
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, want))
    assert simhash.near_duplicates(empty).collect() == []


@pytest.mark.parametrize("group", [4, 60, 1024])
def test_linked_fingerprints_equal_brute_force(spark, monkeypatch, group):
    """Random ones, chains of small steps, and a crowd that differs in a few bits only."""
    monkeypatch.setattr(simhash, "GROUP", group)
    draw = random.Random(3)
    nodes = {draw.getrandbits(64) for _ in range(100)} | {0, 1, (1 << 64) - 1}
    for _ in range(20):
        x = draw.getrandbits(64)
        for _ in range(12):
            for _ in range(draw.randint(1, 3)):
                x ^= 1 << draw.randrange(64)
            nodes.add(x)
    x = draw.getrandbits(64)
    nodes |= {x ^ sum(1 << b for b in draw.sample(range(10, 20), draw.randint(0, 6))) for _ in range(400)}
    table = spark.createDataFrame([(n - (1 << 64) if n >> 63 else n,) for n in sorted(nodes)], "node long")
    got = {tuple(sorted((r["a"] % (1 << 64), r["b"] % (1 << 64)))) for r in simhash.find_links(table).collect()}
    assert got == {(a, b) for a in nodes for b in nodes if a < b and (a ^ b).bit_count() <= 2}


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_query_of_simhash_equals_brute_force(spark):
    texts = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    want = components_by_hand([(r["doc_id"], simhash_by_hand(r["text"])) for r in texts])
    assert sorted(map(tuple, queries.op13_pivot_simhash(spark, SF_DIR).collect())) == sorted(want)
