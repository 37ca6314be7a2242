import os

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"

CHECKED = (
    "bad_value_rejects",
    "copy_numeric_escapes",
    "load_artist",
    "match_union",
    "subset_area",
    "fk_orphan_keys",
    "ci_lookup",
    "fuzzy_title_lookup",
    "changed_credits",
    "key_lookup_few",
    "catalog_reset",
    "profile_merged",
)

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def plain(rows):
    return sorted(
        (tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows), key=repr
    )


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in os.listdir(SF_DIR):
        table = name.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{name}'")
    return connection


def test_every_query_of_the_library_has_a_counterpart():
    unpaired = set(entry.queries()) - set(entry.oracle_sql())
    assert all(name.startswith("op") or name == "pipeline" for name in unpaired)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_its_counterpart(spark, duck, name):
    rows = entry.queries()[name](spark, SF_DIR)
    result = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert set(columns) == set(rows.columns)
    assert plain(rows.select(*columns).collect()) == plain(result.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_profiled_values_are_counted_without_sorting_them(spark, tmp_path):
    rows = [(k, 1 + k % 3, None if k == 5 else k % 4, "R", 100.0 + k) for k in range(200)]
    columns = "l_orderkey long, l_linenumber int, l_suppkey long, l_returnflag string, l_extendedprice double"
    spark.createDataFrame(rows, columns).write.parquet(f"{tmp_path}/lineitem.parquet")
    found = entry.queries()["profile_merged"](spark, str(tmp_path))
    by_column = {r["column"]: r for r in found.collect()}
    # profiles are of the rows with a medium
    assert [by_column["recording"][k] for k in ("rows", "nulls", "exact", "near")] == [199, 0, 200, True]
    assert [by_column["medium"][k] for k in ("rows", "nulls", "exact", "near")] == [199, 0, 4, True]
    assert [by_column["name"][k] for k in ("exact", "close", "near")] == [3, True, True]
    assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()
