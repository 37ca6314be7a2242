"""Decontamination, WARC archives, sharding and the pipeline."""

import gzip
import hashlib
import os
import pickle
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from dumpwinnow.llm import decontaminate, scratch, sharding, warc
from tests.llm.conftest import EDGE, lower, words
from tests.llm.test_repeats import cut_words, linked

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contaminated(docs, items, size=13):
    """(words, hit words, items) of each document, window by window."""
    windows = defaultdict(set)
    for item, text in items:
        ws = WORD.findall(lower((text or "").encode()))
        for i in range(max(1, len(ws) - size + 1) if ws else 0):
            windows[tuple(ws[i : i + size])].add("" if item is None else str(item))
    lengths = {len(w) for w in windows}
    for doc, text in docs:
        ws = WORD.findall(lower((text or "").encode()))
        hit, found = [0] * len(ws), set()
        for n in lengths:
            for i in range(len(ws) - n + 1):
                own = windows.get(tuple(ws[i : i + n]))
                if own:
                    found |= own
                    hit[i : i + n] = [1] * n
        yield doc, len(ws), sum(hit), sorted(found)


@pytest.mark.parametrize("block", [3, 200_000])
def test_items_found_equal_brute_force(spark, edge, block):
    items = [
        (1, "one lonely line"),
        (2, "word3 item3 word4 item4 word5 item5 word6 item6 word7 item7 word8 item8 word9 item9 word10"),
        (3, "alpha"),
        (3, "gamma delta alpha"),
        (None, "STRASSE 漢字"),
        (4, None),
        (5, " -- "),
        (6, "word699 item699 word0"),
        (7, "delta delta"),
    ]
    table = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, key int")
    rows = decontaminate.judged(decontaminate.find_items(edge, table, block=block, carry=True)).collect()
    got = Counter((r["doc_id"], r["n_words"], r["n_hit"], *sorted(r["items"])) for r in rows)
    want = list(contaminated([(i, t) for i, t, _ in EDGE], items))
    assert got == Counter((d, n, h, *found) for d, n, h, found in want)
    assert all(r["contaminated"] == (r["n_hit"] > 0 and 20 * r["n_hit"] >= r["n_words"]) for r in rows)
    assert {r["carried"]["key"] for r in rows} == {7}


@pytest.mark.parametrize("block", [3, 200_000])
def test_broadcast_and_driver_hold_no_items(spark, monkeypatch, block):
    """What reaches the driver does not grow with the items that share a passage."""
    passage = " ".join(f"shared{k}" for k in range(16))
    docs_rows = [(1, f"a {passage} b"), (2, "own0 own1 own2"), (3, "nothing"), (4, f"own0 own1 own2 {passage}")]
    docs = spark.createDataFrame(docs_rows, "doc_id long, text string")
    build, sizes = decontaminate.build_index, []

    def watched(rows, *args):
        index = build(rows, *args)
        sizes[-1] += rows.nbytes + len(pickle.dumps(index))
        return index

    monkeypatch.setattr(decontaminate, "build_index", watched)
    for n in (30, 3000):
        sizes.append(0)
        items = [(i, passage) for i in range(n)] + [(n, "own0 own1 own2"), (n + 1, "own0 own1 own2")]
        table = spark.createDataFrame(items, "item_id long, text string")
        rows = decontaminate.judged(decontaminate.find_items(docs, table, block=block)).collect()
        got = sorted((r["doc_id"], r["n_words"], r["n_hit"], sorted(r["items"])) for r in rows)
        assert got == sorted(contaminated(docs_rows, items))
        assert all(r["n_items"] == len(r["items"]) for r in rows)
    assert sizes[1] < 1.5 * sizes[0]


def test_no_items_and_no_documents(spark, edge, empty):
    items = spark.createDataFrame([(1, "alpha")], "item_id long, text string")
    assert decontaminate.find_items(empty, items).collect() == []
    assert {len(r["items"]) for r in decontaminate.find_items(edge, items.limit(0)).collect()} == {0}


PAGES = [
    (None, None, None),
    (1, "http://a/\r\nX: y", "a" * 2000),
    (1, "http://a/", "a" * 2000),
    (0, None, "a" * 2000),
    (None, "http://b/", "a" * 2000),
    (5, "http://c/", "WARC/1.1\r\n\r\nWARC-Type: response\r\n\r\n" * 60),
    (6, "http://d/é", "ü" * 499),
    (7, "http://d/é", "ü" * 499),
    (8, "http://e/", "ü" * 500),
    (9, "http://e/", "ü" * 500),
]


def test_archives_round_trip(spark):
    pages = spark.createDataFrame([(*p, 1) for p in PAGES], "page_id long, url string, html string, digest int")
    rows = warc.archived_pages(pages).collect()
    ids = defaultdict(list)
    for i, _, html in PAGES:
        ids[html or ""].append(-1 if i is None else i)
    want = Counter()
    for i, _, html in PAGES:
        raw, top = (html or "").encode(), max(ids[html or ""])
        revisit = len(raw) >= 1000 and top != (-1 if i is None else i)
        want[(i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", top if revisit else None)] += 1
    assert Counter(map(tuple, rows)) == want
    assert warc.archived_pages(pages.limit(0)).collect() == []


def test_records_are_plain_warc(spark, tmp_path):
    pages = spark.createDataFrame([(3, "http://a/", "x" * 1200), (4, "http://a/", "x" * 1200)], "page_id long, url string, html string")
    _, fresh = warc.archive(pages, str(tmp_path))
    files = sorted((tmp_path / "deduplicated").glob("part-*"))
    text = "".join(gzip.decompress(p.read_bytes()).decode() for p in files)
    assert text.count("WARC/1.1\r\n") == 2 and text.endswith("\r\n\r\n")
    assert text.count("WARC-Refers-To: <urn:uuid:") == 1 and text.count("x" * 1200) == 1
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "a.warc").write_bytes(text.replace("x" * 1200, "y" * 1200).encode())
    with pytest.raises(Exception, match="does not match its digest"):
        warc.read_headers(spark, str(tmp_path / "broken")).collect()


def test_archives_are_read_as_a_stream(monkeypatch):
    """Small pieces, several gzip members, plain files, and files that end too early."""
    monkeypatch.setattr(warc, "READ_BYTES", 7)
    block = "HTTP/1.1 200 OK\r\n\r\n"
    record = lambda body: (
        f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <a>\r\nWARC-Payload-Digest: "
        f"sha1:{hashlib.sha1(body).hexdigest()}\r\nContent-Length: {len(block) + len(body)}\r\n\r\n{block}"
    ).encode() + body + b"\r\n\r\n"
    bodies = [b"", b"WARC/1.1\r\n\r\n" * 9, b"\xff\x00" * 50, b"x" * 300]
    whole = b"".join(map(record, bodies))
    for content in (whole, gzip.compress(whole), b"".join(gzip.compress(record(b)) for b in bodies)):
        archive, found = warc.Archive(content), []
        while not archive.ended():
            found.append(warc.next_record(archive, len(found))["payload"])
        assert found == bodies
    for cut in (len(whole) - 1, len(whole) - 200, 20):
        archive = warc.Archive(gzip.compress(whole[:cut]))
        with pytest.raises(ValueError, match="record"):
            while not archive.ended():
                warc.next_record(archive, 0)


def test_files_hold_so_many_records_as_their_size_allows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 50_000)
    pages = spark.range(120).selectExpr("id AS page_id", "'http://a/' AS url", "repeat(string(id), 4000) AS html")
    _, fresh = warc.archive(pages.coalesce(1), str(tmp_path))
    files = sorted((tmp_path / "deduplicated").glob("part-*"))
    sizes = [len(gzip.decompress(p.read_bytes())) for p in files]
    assert len(files) > 5 and max(sizes) < 100_000
    assert warc.read_headers(spark, fresh).count() == 120


def test_shards_are_even_and_keep_copies_together(spark, edge, empty):
    texts = [f"text {k % 150 if k % 3 else 900 + k}" for k in range(600)] + ["hot"] * 200
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sharding.shard_documents(docs, shards=8).collect()
    held = Counter(r["shard"] for r in rows)
    assert set(held) == set(range(8)) and max(held.values()) - min(held.values()) <= 1
    for s in held:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(held[s]))
    assert all(r["size"] == len(texts[r["doc_id"]].encode()) + 16 for r in rows)
    assert all(r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode()) for r in rows)
    places = defaultdict(set)
    for r in rows:
        places[texts[r["doc_id"]]].add(r["shard"])
    split = sum(len(p) > 1 for t, p in places.items() if t != "hot")
    assert split <= 10 and len(places["hot"]) <= 4
    rows = sharding.shard_documents(edge, shards=4).collect()
    assert sorted(Counter(r["shard"] for r in rows).values()) == [2, 3, 3, 3]
    assert Counter(r["size"] for r in rows) == Counter(len((t or "").encode()) + 16 for _, t, _ in EDGE)
    assert sharding.shard_documents(empty).collect() == []


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_each_stage_keeps_what_it_should(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = [(r["doc_id"], r["text"]) for r in kept.collect()]
        kept = scratch.written(stage(spark, kept, SF_DIR))
        if k < 4:
            assert kept.schema == docs.schema
        after = {r["doc_id"]: r["text"] if k < 4 else r["decoded_sha256"] for r in kept.collect()}
        if k == 0:
            assert 0 < len(after) < len(before) and all(len(words(t)) >= 20 for t in after.values())
        elif k == 1:
            assert sorted(after) == sorted(i for i, _, c in linked(before, 5, 80) if i == c)
        elif k == 2:
            cut = cut_words([(i, words(t)) for i, t in before], 50)
            for (i, t), new in zip(before, cut, strict=True):
                whole = b" ".join(words(t)) == new
                assert after[i] == (t if whole else new.decode())
        elif k == 3:
            items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
            clean = [d for d, n, h, _ in contaminated(before, items) if not (h > 0 and 20 * h >= n)]
            assert sorted(after) == sorted(clean)
        else:
            assert after == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in before}


def test_stages_take_edge_rows(spark, tmp_path):
    rows = [(i, t, "en", s, len(t or "")) for i, t, s in EDGE]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(7, 1), (1, 0)], "doc_id long, quality int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "one lonely line")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for table in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            result = stage(spark, table, str(tmp_path))
            assert result.count() <= table.count()
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).select(F.count("*")).first()[0] <= len(rows)
