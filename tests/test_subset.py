import pytest
from pyspark.sql import functions as F

from dumpwinnow.operators import keyjoin
from dumpwinnow.operators.keyjoin import distinct_keys, drop_by_keys, keep_by_keys
from dumpwinnow.operators.matching import library_keys, match_entities, matched_keys
from dumpwinnow.operators.subset import rules_for, subset, write_subset
from dumpwinnow.plans.rules import CATALOG_RULES
from dumpwinnow.sources.snapshots import scratch_snapshot
from dumpwinnow.sources.specs import LOADED_TABLES
from tests.fixture_rows import (
    FIRST,
    FIRST_KEPT,
    FIRST_LIBRARY,
    SECOND,
    SECOND_KEPT,
    SECOND_LIBRARY,
)


def frames(spark, rows):
    made = {}
    for spec in LOADED_TABLES:
        values = rows[spec.table]
        if spec.table == "mb_artist_alias":
            values = [(*v[:6], bool(v[6])) for v in values]
        made[spec.table] = spark.createDataFrame(values, spec.schema)
    return made


def roots(spark, tables, library):
    """Matched keys, written once so that the plans built on them stay short."""
    keys = library_keys(spark.createDataFrame([(n,) for n in library], "artist string"))
    matched = match_entities(tables["mb_artist"], tables["mb_artist_alias"], keys)
    return scratch_snapshot(spark).write("roots", matched_keys(matched))


@pytest.mark.parametrize(
    ("rows", "library", "kept_rows", "broadcast_rows"),
    [
        (FIRST, FIRST_LIBRARY, FIRST_KEPT, None),
        (FIRST, FIRST_LIBRARY, FIRST_KEPT, 0),
        (SECOND, SECOND_LIBRARY, SECOND_KEPT, 10**6),
    ],
)
def test_golden_subsets(spark, rows, library, kept_rows, broadcast_rows):
    tables = frames(spark, rows)
    keys = roots(spark, tables, library)
    if broadcast_rows is None:
        kept = subset(tables, CATALOG_RULES, keys)
    else:
        snapshot = scratch_snapshot(spark)
        stored = write_subset(
            tables, CATALOG_RULES, keys, keys.count(), snapshot.write, broadcast_rows
        )
        kept = stored.tables
        assert stored.rows == kept_rows
    assert {t: df.count() for t, df in kept.items()} == kept_rows
    if rows is SECOND:
        shared = kept["mb_artist_credit_name"].filter("artist_credit = 5003").collect()
        assert [r["artist"] for r in shared] == [1004]
        assert kept["mb_artist_credit"].filter("id = 5003").first()["artist_count"] == 2
        assert sorted(r["id"] for r in kept["mb_area"].collect()) == [100, 103, 104, 221, 222]
    else:
        names = {r["name"] for r in kept["mb_recording"].collect()}
        assert names == {"Home, Again", "Glasswork", "Third Slow Tide"}
        # Countries stay although no kept artist would need them.
        assert kept["mb_country_area"].count() == 2


def test_null_credit_is_never_kept(spark):
    tables = frames(spark, FIRST)
    spec = next(s for s in LOADED_TABLES if s.table == "mb_recording")
    extra = spark.createDataFrame([(9, "g", "no credit", None, 1)], spec.schema)
    tables["mb_recording"] = tables["mb_recording"].unionAll(extra)
    rules = rules_for(CATALOG_RULES, ["mb_recording"])
    kept = subset(tables, rules, roots(spark, tables, FIRST_LIBRARY))
    assert kept["mb_recording"].filter("id = 9").isEmpty()


def test_kept_track_may_point_at_a_dropped_credit(spark):
    tables = frames(spark, FIRST)
    tables["mb_track"] = tables["mb_track"].withColumn("artist_credit", F.lit(400))
    kept = subset(tables, CATALOG_RULES, roots(spark, tables, FIRST_LIBRARY))
    assert kept["mb_track"].count() == 3
    assert kept["mb_artist_credit"].filter("id = 400").isEmpty()


def skewed(spark):
    """A third of the rows share one key, another is NULL, copies of rows abound."""
    return spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7))
        .when(F.col("id") % 90 == 1, F.lit(None))
        .otherwise((F.col("id") % 1000).cast("int"))
        .alias("k"),
        (F.col("id") % 5).alias("v"),
    )


@pytest.mark.parametrize("wanted", [[7, 8, 500], [8, 500], [7], [], list(range(0, 1000, 3))])
def test_all_forms_of_the_semi_join_agree(spark, monkeypatch, wanted):
    monkeypatch.setattr(keyjoin, "HOT_KEYS", 4)
    rows = skewed(spark)
    keys = distinct_keys(spark.createDataFrame([(w,) for w in wanted + [None]], "w int"), "w")
    want = set(wanted)
    brute = sorted(tuple(r) for r in rows.collect() if r["k"] in want and r["k"] is not None)
    for key_rows, limit in [(None, 0), (5, 10), (1000, 10)]:
        kept = keep_by_keys(rows, "k", keys, key_rows, limit)
        assert sorted(tuple(r) for r in kept.collect()) == brute
    assert keep_by_keys(rows, "k", keys).count() + drop_by_keys(rows, "k", keys).count() == 9000


def test_salted_form_joins_once(spark):
    rows = skewed(spark)
    keys = distinct_keys(rows, "k")
    plan = keep_by_keys(rows, "k", keys, 1000, 10)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftSemi") == 1 and "key_salt" in plan and "Union" not in plan


def test_string_keys_are_not_broadcast_by_count(spark):
    rows = skewed(spark).withColumn("k", F.col("k").cast("string"))
    plan = keep_by_keys(rows, "k", distinct_keys(rows, "k"), 5, 10)
    assert "strategy=broadcast" not in plan._jdf.queryExecution().optimizedPlan().toString()
