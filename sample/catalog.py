"""A catalog in the loader's layout, derived from whole star-schema tables.

The SELECTs are plain enough to run on Spark and on DuckDB alike, so both sides of a
comparison start from the same rows: artists are customers, credits and recordings are
orders, tracks are line items, tags are parts, media are suppliers, areas are nations.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dumpwinnow.functions.copytext import encode_line
from dumpwinnow.functions.once import once
from dumpwinnow.sources.specs import LOADED_TABLES, TableSpec, spec_for

CATALOG_SQL: dict[str, str] = {
    "mb_area_type": """
        SELECT r_regionkey AS id, r_name AS name FROM {region}""",
    "mb_gender": """
        SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS INT) AS id,
               substr(o_orderpriority, 3) AS name
        FROM {orders}""",
    "mb_tag": """
        SELECT CAST(p_partkey AS INT) AS id, p_name AS name FROM {part}""",
    "mb_area": """
        SELECT n_nationkey AS id, n_name AS name, n_regionkey AS type FROM {nation}""",
    "mb_country_area": """
        SELECT n_nationkey AS area
        FROM {nation} JOIN {region} ON n_regionkey = r_regionkey
        WHERE r_name = 'AFRICA'""",
    "mb_artist": """
        SELECT CAST(c_custkey AS INT) AS id,
               replace(c_name, 'Customer', 'Cüstömer') AS name,
               concat(substr(c_name, 10), ', Customer') AS sort_name,
               CASE WHEN c_acctbal < 0 THEN NULL ELSE 1 + c_nationkey % 5 END AS type,
               CASE WHEN c_acctbal < 0 THEN NULL ELSE c_nationkey END AS area,
               CASE WHEN c_acctbal < 1000 THEN NULL ELSE 1 + c_nationkey % 5 END AS gender,
               CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL
                    ELSE (c_nationkey * 7 + 3) % 25 END AS begin_area,
               CASE WHEN c_acctbal < 0 THEN '' ELSE c_mktsegment END AS comment
        FROM {customer}""",
    "mb_artist_alias": """
        SELECT CAST(c_custkey AS INT) AS id, CAST(c_custkey AS INT) AS artist,
               concat(lower(c_mktsegment), ' Société ', substr(c_name, 10)) AS name,
               concat('Société ', substr(c_name, 10)) AS sort_name,
               CASE WHEN c_nationkey < 10 THEN 'fr' END AS locale,
               CASE WHEN c_acctbal < 0 THEN NULL ELSE 1 END AS type,
               c_acctbal > 5000 AS primary_for_locale
        FROM {customer}""",
    "mb_artist_tag": """
        SELECT CAST(o_custkey AS INT) AS artist, CAST(l_partkey AS INT) AS tag,
               CAST(count(*) AS INT) AS count
        FROM {orders} JOIN {lineitem} ON o_orderkey = l_orderkey
        GROUP BY o_custkey, l_partkey""",
    "mb_artist_credit": """
        SELECT CAST(o_orderkey AS INT) AS id, concat('Credit ', o_orderkey) AS name,
               CAST(CASE WHEN o_orderstatus = 'P' THEN 2 ELSE 1 END AS SMALLINT) AS artist_count
        FROM {orders}""",
    "mb_artist_credit_name": """
        SELECT CAST(o_orderkey AS INT) AS artist_credit, CAST(0 AS SMALLINT) AS position,
               CAST(o_custkey AS INT) AS artist, concat('First of ', o_orderkey) AS name,
               CASE WHEN o_orderstatus = 'P' THEN ' & ' ELSE '' END AS join_phrase
        FROM {orders}
        UNION ALL
        SELECT CAST(o_orderkey AS INT), CAST(1 AS SMALLINT),
               CAST(o_orderkey % 10 AS INT), concat('Second of ', o_orderkey), ''
        FROM {orders} WHERE o_orderstatus = 'P'""",
    "mb_release_group": """
        SELECT CAST(o_orderkey AS INT) AS id, concat(o_orderpriority, ' ', o_orderkey) AS name,
               CAST(o_orderkey AS INT) AS artist_credit,
               CASE WHEN o_orderstatus = 'O' THEN NULL ELSE 1 END AS type
        FROM {orders}""",
    "mb_recording": """
        SELECT CAST(o_orderkey AS INT) AS id,
               concat(substr(h, 1, 8), '-', substr(h, 9, 4), '-', substr(h, 13, 4), '-',
                      substr(h, 17, 4), '-', substr(h, 21)) AS gid,
               concat('Recording ', o_orderkey) AS name,
               CASE WHEN o_totalprice < 20000 THEN NULL
                    ELSE CAST(o_orderkey AS INT) END AS artist_credit,
               CAST(floor(o_totalprice) AS INT) AS length
        FROM (SELECT *, md5(concat('recording ', o_orderkey)) AS h FROM {orders}) o""",
    "mb_medium": """
        SELECT CAST(s_suppkey AS INT) AS id,
               CASE WHEN s_acctbal < 0 THEN NULL ELSE CAST(s_suppkey AS INT) END AS release,
               1 + s_nationkey % 3 AS position, s_nationkey AS format
        FROM {supplier}""",
    "mb_track": """
        SELECT CAST(l_orderkey * 8 + l_linenumber AS INT) AS id,
               CAST(l_orderkey AS INT) AS recording, CAST(l_suppkey AS INT) AS medium,
               l_linenumber AS position,
               concat('Track', chr(9), l_linenumber, chr(92), l_returnflag) AS name,
               CAST(l_orderkey AS INT) AS artist_credit,
               CAST(floor(l_extendedprice) AS INT) AS length
        FROM {lineitem}""",
}

# Names to match: the best customers in other spelling, and the worst under their alias.
LIBRARY_SQL = """
    SELECT concat('  ', upper(c_name), ' ') AS artist FROM {customer}
    WHERE c_acctbal >= 0.998 * (SELECT max(c_acctbal) FROM {customer})
    UNION ALL
    SELECT concat(c_mktsegment, ' societe ', substr(c_name, 10)) FROM {customer}
    WHERE c_acctbal <= 0.99 * (SELECT min(c_acctbal) FROM {customer})
    UNION ALL
    SELECT '' FROM {region}"""


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def run_sql(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run a SELECT whose ``{table}`` marks stand for test tables."""
    tables = set(re.findall(r"{(\w+)}", sql))
    return spark.sql(sql, **{t: read(spark, sf_dir, t) for t in tables})


def catalog_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return run_sql(spark, sf_dir, CATALOG_SQL[table])


def catalog(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {s.table: catalog_table(spark, sf_dir, s.table) for s in LOADED_TABLES}


def library(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(spark, sf_dir, LIBRARY_SQL)


def to_lines(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows as full-width dump lines: a spec's columns at their positions, fillers between."""
    fields: list[Column] = [F.lit("filler")] * (spec.last_position + 2)
    for column in spec.columns:
        value = F.col(column.name)
        if column.type == "boolean":
            value = value.cast("int")
        if column.type == "uuid":
            value = F.concat(F.lit("{"), F.upper(value), F.lit("}"))
        fields[column.position] = value
    return rows.select(once(encode_line(*fields)).alias("value"))


def dump_lines(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A catalog table as lines of its dump file."""
    return to_lines(catalog_table(spark, sf_dir, table), spec_for(table))
