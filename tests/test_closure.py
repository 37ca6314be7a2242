import random

import pytest

from dumpwinnow.operators import quality
from dumpwinnow.operators.closure import close_subset
from dumpwinnow.sources.snapshots import Snapshot
from dumpwinnow.sources.specs import LOADED_TABLES, Column, TableSpec
from tests.fixture_rows import FIRST
from tests.test_subset import frames

# People have a boss and a town, towns have a mayor: references in circles and to themselves.
PERSON = TableSpec(
    "person",
    "person",
    (
        Column("id", "int", 0),
        Column("boss", "int", 1, references="person.id"),
        Column("town", "int", 2, references="town.id"),
    ),
    ("id",),
)
TOWN = TableSpec("town", "town", (Column("id", "int", 0), Column("mayor", "int", 1, references="person.id")), ("id",))
VISIT = TableSpec(
    "visit",
    "visit",
    (Column("who", "int", 0, references="person.id"), Column("town", "int", 1, references="town.id")),
    ("who", "town"),
)
REFERENCES = (("person", 1, "person"), ("person", 2, "town"), ("town", 1, "person"), ("visit", 0, "person"), ("visit", 1, "town"))


def closed_by_hand(tables, kept):
    """Add the rows that any row refers to, one reference at a time, until nothing changes."""
    held = {t: list(rows) for t, rows in kept.items()}
    while True:
        before = {t: len(rows) for t, rows in held.items()}
        for child, place, parent in REFERENCES:
            wanted = {r[place] for r in held[child]} - {None} - {r[0] for r in held[parent]}
            held[parent] += [r for r in tables[parent] if r[0] in wanted]
        if before == {t: len(rows) for t, rows in held.items()}:
            return {t: sorted(rows, key=repr) for t, rows in held.items()}


@pytest.mark.parametrize("seed", range(4))
def test_closure_of_circles_equals_brute_force(spark, tmp_path, seed):
    draw = random.Random(seed)
    pick = lambda n: None if draw.random() < 0.2 else draw.randrange(n + 3)  # noqa: E731, some dangle
    rows = {
        "person": [(k, pick(40), pick(15)) for k in range(40)] + [(5, 6, 1)],  # a key that repeats
        "town": [(k, pick(40)) for k in range(15)],
        "visit": [(draw.randrange(40), draw.randrange(15)) for _ in range(5)],
    }
    kept = {"person": rows["person"][:2], "town": [], "visit": rows["visit"] if seed % 2 else []}
    specs = (PERSON, TOWN, VISIT)

    def made(of):
        return {s.table: spark.createDataFrame(of[s.table], s.schema) for s in specs}

    closed = close_subset(made(rows), made(kept), specs, Snapshot(spark, str(tmp_path)))
    got = {t: sorted((tuple(r) for r in df.collect()), key=repr) for t, df in closed.tables.items()}
    want = closed_by_hand(rows, kept)
    assert got == want
    assert sum(sum(r.values()) for r in closed.added) == sum(len(want[t]) - len(kept[t]) for t in want)
    report = quality.integrity_report(closed.tables, specs).filter("check = 'foreign key'")
    lost = {t: {r[0] for r in rows[t]} for t in rows}
    dangling = sum(r[p] is not None and r[p] not in lost[q] for t, p, q in REFERENCES for r in want[t])
    assert sum(r["violations"] for r in report.collect()) == dangling


def test_closed_fixture_has_no_findings(spark, tmp_path):
    """Keeping one track alone pulls in its recording, medium, credit, and nothing else."""
    tables = frames(spark, FIRST)
    kept = {t: rows.limit(0) for t, rows in tables.items()}
    kept["mb_track"] = tables["mb_track"].filter("id = 1")
    kept["mb_artist"] = tables["mb_artist"].filter("id = 100")
    closed = close_subset(tables, kept, LOADED_TABLES, Snapshot(spark, str(tmp_path)))
    counts = {t: rows.count() for t, rows in closed.tables.items() if not rows.isEmpty()}
    assert counts["mb_track"] == counts["mb_recording"] == counts["mb_medium"] == counts["mb_artist"] == 1
    assert counts["mb_artist_credit"] == 1 and "mb_release_group" not in counts
    assert quality.integrity_report(closed.tables, LOADED_TABLES).filter("violations > 0").isEmpty()
    again = close_subset(tables, closed.tables, LOADED_TABLES, Snapshot(spark, str(tmp_path / "again")))
    assert again.added == []
