import re

import pytest

#: Rows that every operator has to take: nulls, empty and long texts, ties and repeated rows.
LONG = " ".join(f"word{i % 700} item{i}" for i in range(60_000))
EDGE = [
    (1, "alpha beta gamma delta " * 40, "x"),
    (2, "alpha beta gamma delta " * 40, "y"),
    (2, "alpha beta gamma delta " * 40, "y"),
    (3, None, "x"),
    (4, "", None),
    (5, " \t\n ", "x"),
    (None, "one lonely line without an id", "x"),
    (None, None, None),
    (6, "ÄÖÜ straße 漢字 😀 ### $$$", "x"),
    (7, LONG, "x"),
    (8, LONG, "x"),
]


@pytest.fixture(scope="session")
def edge(spark):
    """Edge rows among columns whose names clash with those that operators use themselves."""
    rows = [(i, t, s, 7, "k", [1], 0.5, True) for i, t, s in EDGE]
    return spark.createDataFrame(
        rows,
        "doc_id long, text string, source string, key int, node string, spans array<int>, "
        "score double, kept boolean",
    )


@pytest.fixture(scope="session")
def empty(edge):
    return edge.limit(0)


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def lower(raw):
    return bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in raw)
