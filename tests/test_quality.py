import datetime

from pyspark.sql import functions as F

from dumpwinnow.operators import quality
from dumpwinnow.operators.matching import matched_keys
from dumpwinnow.operators.subset import subset
from dumpwinnow.plans.rules import CATALOG_RULES
from dumpwinnow.sources.specs import LOADED_TABLES
from tests.fixture_rows import FIRST, FIRST_LIBRARY
from tests.test_subset import frames, roots


def violations(report):
    return {
        (r["check"], r["table"], r["columns"]): r["violations"]
        for r in report.filter("violations > 0").collect()
    }


def test_loaded_fixture_is_consistent(spark):
    report = quality.integrity_report(frames(spark, FIRST), LOADED_TABLES)
    assert violations(report) == {}
    assert report.count() == sum(
        len(s.required_columns) + bool(s.primary_key) + len(s.foreign_keys) for s in LOADED_TABLES
    )


def test_every_kind_of_violation_is_reported(spark):
    tables = frames(spark, FIRST)
    tag = tables["mb_artist_tag"]
    tables["mb_artist_tag"] = tag.unionAll(tag.limit(2)).unionAll(
        tag.limit(1).withColumn("tag", F.lit(99)).withColumn("count", F.lit(None).cast("int"))
    )
    report = violations(quality.integrity_report(tables, LOADED_TABLES))
    assert report == {
        ("not null", "mb_artist_tag", "count"): 1,
        ("primary key", "mb_artist_tag", "artist, tag"): 2,
        ("foreign key", "mb_artist_tag", "tag"): 1,
    }


def test_parts_of_the_report_have_its_rows(spark):
    tables = frames(spark, FIRST)
    tag, track = tables["mb_artist_tag"], tables["mb_track"]
    tables["mb_artist_tag"] = tag.unionAll(tag.limit(2)).unionAll(
        tag.limit(1).withColumn("tag", F.lit(99)).withColumn("count", F.lit(None).cast("int"))
    )
    tables["mb_track"] = track.unionAll(track.withColumn("id", F.lit(None).cast("int"))).withColumn(
        "medium", F.lit(-1)
    )
    tables["mb_gender"] = tables["mb_gender"].withColumn("id", F.concat(F.lit("g"), "id"))
    rows = {name: table.count() for name, table in tables.items()}
    whole = sorted(map(tuple, quality.integrity_report(tables, LOADED_TABLES).collect()))
    assert sum(violations for *_, violations in whole) > 4
    sizes = []
    for part_values in (0, 20, 1000):
        parts = quality.integrity_parts(tables, LOADED_TABLES, rows, part_values)
        assert sorted(tuple(r) for part in parts for r in part.collect()) == whole
        sizes.append(len(parts))
    assert sizes[0] > sizes[1] > sizes[2] == 3


def test_dropped_credit_of_a_kept_track_is_a_finding(spark):
    tables = frames(spark, FIRST)
    tables["mb_track"] = tables["mb_track"].withColumn("artist_credit", F.lit(400))
    kept = subset(tables, CATALOG_RULES, roots(spark, tables, FIRST_LIBRARY))
    report = violations(quality.integrity_report(kept, LOADED_TABLES))
    assert report == {("foreign key", "mb_track", "artist_credit"): 3}


def test_orphans_and_unused(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,), (9,), (9,)], "p int")
    parent = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    assert [r["p"] for r in quality.orphan_rows(child, "p", parent, "id").collect()] == [9, 9]
    assert [tuple(r) for r in quality.orphan_keys(child, "p", parent, "id").collect()] == [(9, 2)]
    assert [r["id"] for r in quality.unused_rows(parent, "id", child, "p").collect()] == [3]


def test_compare_sizes(spark):
    before = spark.createDataFrame([("a", 1), ("b", 2)], "table string, rows long")
    after = spark.createDataFrame([("a", 1), ("c", 3)], "table string, rows long")
    rows = {tuple(r) for r in quality.compare_sizes(before, after).collect()}
    assert rows == {("a", 1, 1, True), ("b", 2, None, False), ("c", None, 3, False)}


def test_profile(spark):
    day = datetime.date(2020, 1, 2)
    table = spark.createDataFrame(
        [(1, "b", day), (2, None, day), (2, "a", None)], "n int, s string, d date"
    )
    want = {
        ("t", "n", 3, 0, 2, "1", "2"),
        ("t", "s", 3, 1, 2, "a", "b"),
        ("t", "d", 3, 1, 1, "2020-01-02", "2020-01-02"),
    }
    for exact in (False, True):
        assert {tuple(r) for r in quality.profile(table, "t", exact).collect()} == want


def test_root_keys_are_unique(spark):
    tables = frames(spark, FIRST)
    keys = roots(spark, tables, FIRST_LIBRARY)
    assert sorted(r["key"] for r in keys.collect()) == [100, 200, 300]
    assert matched_keys(keys.withColumnRenamed("key", "id")).columns == ["key"]
