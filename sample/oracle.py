"""DuckDB SQL for every query, on the same test tables."""

from __future__ import annotations

import re

from dumpwinnow.sources.specs import ALL_TABLES, LOADED_TABLES, spec_for
from sample.catalog import CATALOG_SQL, LIBRARY_SQL


def _plain(sql: str) -> str:
    return re.sub(r"{(\w+)}", r"\1", sql).strip()


CATALOG_CTES = ",\n".join(f"{table} AS ({_plain(sql)})" for table, sql in CATALOG_SQL.items())

MATCH_CTES = f"""
library AS ({_plain(LIBRARY_SQL)}),
library_keys AS (
    SELECT DISTINCT lower(trim(strip_accents(artist))) AS key FROM library WHERE artist <> ''),
by_name AS (
    SELECT id FROM mb_artist
    WHERE lower(trim(strip_accents(name))) IN (SELECT key FROM library_keys)),
by_alias AS (
    SELECT artist AS id FROM mb_artist_alias
    WHERE lower(trim(strip_accents(name))) IN (SELECT key FROM library_keys)),
matched AS (SELECT id FROM by_name UNION SELECT id FROM by_alias)"""

KEPT_CTES = """
kept_mb_artist AS (SELECT * FROM mb_artist WHERE id IN (SELECT id FROM matched)),
kept_mb_artist_alias AS (
    SELECT * FROM mb_artist_alias WHERE artist IN (SELECT id FROM matched)),
kept_mb_artist_tag AS (SELECT * FROM mb_artist_tag WHERE artist IN (SELECT id FROM matched)),
kept_mb_artist_credit_name AS (
    SELECT * FROM mb_artist_credit_name WHERE artist IN (SELECT id FROM matched)),
kept_mb_artist_credit AS (
    SELECT * FROM mb_artist_credit
    WHERE id IN (SELECT artist_credit FROM kept_mb_artist_credit_name)),
kept_mb_release_group AS (
    SELECT * FROM mb_release_group
    WHERE artist_credit IN (SELECT id FROM kept_mb_artist_credit)),
kept_mb_recording AS (
    SELECT * FROM mb_recording WHERE artist_credit IN (SELECT id FROM kept_mb_artist_credit)),
kept_mb_track AS (
    SELECT * FROM mb_track WHERE recording IN (SELECT id FROM kept_mb_recording)),
kept_mb_medium AS (SELECT * FROM mb_medium WHERE id IN (SELECT medium FROM kept_mb_track)),
kept_mb_tag AS (SELECT * FROM mb_tag WHERE id IN (SELECT tag FROM kept_mb_artist_tag)),
kept_mb_area AS (
    SELECT * FROM mb_area
    WHERE id IN (SELECT area FROM kept_mb_artist WHERE area IS NOT NULL)
       OR id IN (SELECT begin_area FROM kept_mb_artist WHERE begin_area IS NOT NULL)
       OR id IN (SELECT area FROM mb_country_area)),
kept_mb_country_area AS (
    SELECT * FROM mb_country_area WHERE area IN (SELECT id FROM kept_mb_area)),
kept_mb_area_type AS (SELECT * FROM mb_area_type),
kept_mb_gender AS (SELECT * FROM mb_gender)"""

TRIGRAM_CTES = """
words AS (
    SELECT k, unnest(list_filter(regexp_split_to_array(lower(k), '[^\\p{L}\\p{N}]+'),
                                 lambda w: w <> '')) AS w
    FROM (SELECT DISTINCT k FROM texts)),
grams AS (
    SELECT DISTINCT k, substr('  ' || w || ' ', i, 3) AS g
    FROM (SELECT k, w, unnest(range(1, length(w) + 2)) AS i FROM words)),
sizes AS (SELECT k, count(*) AS n FROM grams GROUP BY k)"""

SIMILAR_CTES = (
    TRIGRAM_CTES
    + """,
shared AS (
    SELECT a.k AS request, b.k AS name, count(*) AS s
    FROM grams a JOIN grams b ON a.g = b.g GROUP BY a.k, b.k),
scored AS (
    SELECT request, name, s / (x.n + y.n - s) AS similarity
    FROM shared JOIN sizes x ON x.k = request JOIN sizes y ON y.k = name)"""
)


def _catalog(select: str) -> str:
    return f"WITH {CATALOG_CTES}\n{select}"


def _matched(select: str) -> str:
    return f"WITH {CATALOG_CTES},{MATCH_CTES}\n{select}"


def _kept(select: str) -> str:
    return f"WITH {CATALOG_CTES},{MATCH_CTES},{KEPT_CTES}\n{select}"


def _sizes(prefix: str) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{s.table}' AS \"table\", count(*) AS rows FROM {prefix}{s.table}"
        for s in LOADED_TABLES
    )


def _integrity(prefix: str) -> str:
    parts = []

    def finding(check: str, table: str, columns: str, count: str) -> None:
        parts.append(
            f"SELECT '{check}' AS \"check\", '{table}' AS \"table\", '{columns}' AS columns, "
            f"CAST(({count}) AS BIGINT) AS violations"
        )

    for spec in LOADED_TABLES:
        table = prefix + spec.table
        for column in spec.required_columns:
            nulls = f'SELECT count(*) FROM {table} WHERE "{column}" IS NULL'
            finding("not null", spec.table, column, nulls)
        if spec.primary_key:
            keys = ", ".join(f'"{c}"' for c in spec.primary_key)
            twice = f"SELECT {keys} FROM {table} GROUP BY {keys} HAVING count(*) > 1"
            finding(
                "primary key",
                spec.table,
                ", ".join(spec.primary_key),
                f"SELECT count(*) FROM ({twice})",
            )
        for column, parent, key in spec.foreign_keys:
            orphans = (
                f"SELECT count(*) FROM {table} c WHERE c.{column} IS NOT NULL "
                f"AND NOT EXISTS (SELECT 1 FROM {prefix}{parent} p WHERE p.{key} = c.{column})"
            )
            finding("foreign key", spec.table, column, orphans)
    return "\nUNION ALL\n".join(parts)


def _build() -> str:
    columns = sum(len(spec.columns) for spec in LOADED_TABLES)
    imported, kept = _sizes(""), _sizes("kept_")
    return f"""
        SELECT 'imported' AS part, "table" AS name, rows FROM ({imported})
        UNION ALL SELECT 'kept', "table", rows FROM ({kept})
        UNION ALL SELECT 'ledger', 'schema', {len(ALL_TABLES)}
        UNION ALL SELECT 'ledger', 'import', CAST(sum(rows) AS BIGINT) FROM ({imported})
        UNION ALL SELECT 'ledger', 'filter', CAST(sum(rows) AS BIGINT) FROM ({kept})
        UNION ALL SELECT 'ledger', 'analyze', {columns}"""


def _groups() -> str:
    listed = " ".join(f"WHEN '{s.table}' THEN '{s.source}'" for s in LOADED_TABLES)
    return f"""
        SELECT CASE "table" {listed} END AS source, count(*) AS tables,
               CAST(sum(rows) AS BIGINT) AS rows, 0 AS shared
        FROM ({_sizes("")}) GROUP BY 1"""


def _reset() -> str:
    parts = []
    for table in ("mb_area", "mb_artist", "mb_tag"):
        parts.append(f"SELECT 'filled' AS part, '{table}' AS name, count(*) AS rows FROM {table}")
        parts.append(f"SELECT 'again', '{table}', 0")
        parts.append(f"SELECT 'held', '{table}', count(*) FROM {table}")
    for spec in ALL_TABLES:
        names = ", ".join(c.name for c in spec.columns)
        parts.append(f"SELECT 'columns', '{spec.table}: {names}', {len(spec.columns)}")
        parts.append(f"SELECT 'dropped', '{spec.table}', 1")
    return "\nUNION ALL\n".join([*parts, "SELECT 'left', 'other', 1"])


def _restarted() -> str:
    """Tables of missing dump files are empty; nothing but themselves depends on them."""

    def sizes(prefix: str) -> str:
        return f"""SELECT "table", CASE WHEN "table" IN ('mb_gender', 'mb_tag') THEN 0 ELSE rows END
                   AS rows FROM ({_sizes(prefix)})"""

    return f"""
        SELECT 'kept' AS part, "table" AS name, rows FROM ({sizes("kept_")})
        UNION ALL SELECT 'published', "table", rows FROM ({sizes("")})
        UNION ALL SELECT 'published first', 'one', 1
        UNION ALL SELECT 'refused', 'one', 1
        UNION ALL SELECT 'published last', 'two/loaded', 1"""


def _reloaded() -> str:
    def loaded(tables: str) -> str:
        return f"""SELECT "table", CASE WHEN "table" IN ({tables}) THEN rows ELSE 0 END AS rows
                   FROM ({_sizes("")})"""

    both, area = loaded("'mb_area', 'mb_artist'"), loaded("'mb_area'")
    return f"""
        SELECT 'first' AS part, "table" AS name, rows FROM ({both})
        UNION ALL SELECT 'again', "table", 0 FROM ({both})
        UNION ALL SELECT 'fresh', "table", rows FROM ({area})
        UNION ALL SELECT 'held', "table", rows FROM ({area})
        UNION ALL SELECT 'rejects', 'mb_area', count(*) FROM region
        UNION ALL SELECT 'rejects', 'mb_artist', 0"""


def _closed() -> str:
    """Tracks name other credits; only credits can be missing, and they refer to nothing."""
    moved = "SELECT * REPLACE (medium + 1 AS artist_credit) FROM kept_mb_track"
    credits = f"""SELECT count(*) FROM mb_artist_credit
                  WHERE id IN (SELECT id FROM kept_mb_artist_credit)
                     OR id IN (SELECT artist_credit FROM ({moved}))"""
    lost = f"""SELECT count(*) FROM ({moved})
               WHERE artist_credit NOT IN (SELECT id FROM mb_artist_credit)"""
    references = "\nUNION ALL\n".join(
        f"SELECT 'dangling', '{spec.table}.{column}', "
        + (f"({lost})" if (spec.table, column) == ("mb_track", "artist_credit") else "0")
        for spec in LOADED_TABLES
        for column, _, _ in spec.foreign_keys
    )
    return f"""
        SELECT 'kept' AS part, "table" AS name, rows FROM ({_sizes("kept_")})
        UNION ALL SELECT 'closed', "table",
            CASE WHEN "table" = 'mb_artist_credit' THEN ({credits}) ELSE rows END
        FROM ({_sizes("kept_")})
        UNION ALL {references}"""


CHANGED = """
, after_all AS (
    SELECT * REPLACE (CASE WHEN artist % 50 = 7 THEN upper(name) ELSE name END AS name)
    FROM mb_artist_credit_name WHERE artist_credit % 97 <> 0
    UNION ALL SELECT * FROM mb_artist_credit_name WHERE artist_credit % 89 = 1
    UNION ALL SELECT * REPLACE (-artist_credit AS artist_credit) FROM mb_artist_credit_name
    WHERE artist_credit % 101 = 3),
b AS (SELECT artist_credit, position, count(*) AS n, list_sort(list(r::VARCHAR)) AS rows
      FROM mb_artist_credit_name r GROUP BY ALL),
a AS (SELECT artist_credit, position, count(*) AS n, list_sort(list(r::VARCHAR)) AS rows
      FROM after_all r GROUP BY ALL)
SELECT artist_credit, position,
       CASE WHEN b.n IS NULL THEN 'added' WHEN a.n IS NULL THEN 'removed' ELSE 'changed' END AS change,
       coalesce(b.n, 0) AS rows_before, coalesce(a.n, 0) AS rows_after
FROM b FULL JOIN a USING (artist_credit, position) WHERE a.rows IS DISTINCT FROM b.rows"""


def _merged(table: str, columns: tuple[str, ...]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", count(*) AS rows, count(*) FILTER (\"{c}\" IS NULL) AS nulls, "
        f'count(DISTINCT "{c}") AS exact, true AS "close", true AS near, '
        f'CAST(min("{c}") AS VARCHAR) AS low, CAST(max("{c}") AS VARCHAR) AS high FROM {table}'
        for c in columns
    )


def _profile(table: str, columns: tuple[str, ...]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{table}' AS \"table\", '{c}' AS \"column\", count(*) AS rows, "
        f'count(*) FILTER ("{c}" IS NULL) AS nulls, count(DISTINCT "{c}") AS "distinct", '
        f'CAST(min("{c}") AS VARCHAR) AS min, CAST(max("{c}") AS VARCHAR) AS max FROM {table}'
        for c in columns
    )


ARTIST_COLUMNS = (
    "id", "name", "sort_name", "type", "area", "gender", "begin_area", "comment",
)

NAME_REQUESTS = """
requests AS (
    SELECT DISTINCT request FROM (
        SELECT upper(replace(c_name, 'Customer', 'CÜstömer')) AS request FROM customer
        WHERE c_mktsegment = 'BUILDING'
        UNION ALL
        SELECT concat(upper(c_mktsegment), ' SOCIÉTÉ ', substr(c_name, 10)) FROM customer
        WHERE c_mktsegment = 'MACHINERY'))"""

BY_NAME = """
SELECT request, id, name, 'name' AS matched_by
FROM requests JOIN mb_artist ON lower(request) = lower(name)"""
BY_ALIAS = """
SELECT request, artist AS id, name, 'alias' AS matched_by
FROM requests JOIN mb_artist_alias ON lower(request) = lower(name)"""


def _requests(select: str) -> str:
    return f"WITH {CATALOG_CTES},{NAME_REQUESTS}\n{select}"


def all_oracles() -> dict[str, str]:
    found = {
        "tsv_positional_load": """
            SELECT c_mktsegment AS segment, CAST(c_custkey AS INTEGER) AS id, c_name AS name
            FROM customer""",
        "tsv_short_rows": """
            SELECT c_mktsegment AS segment, CAST(c_custkey AS INTEGER) AS id, c_name AS name
            FROM customer WHERE c_acctbal >= 0""",
        "tsv_short_row_rejects": """
            SELECT concat(c_custkey, chr(9), 'x', chr(9), c_name) AS line,
                   'short row' AS reason
            FROM customer WHERE c_acctbal < 0""",
        "crlf_lines": "SELECT CAST(doc_id AS INTEGER) AS id, text FROM documents",
        "invalid_utf8_rejects": """
            SELECT 'loaded' AS outcome, count(*) AS n FROM documents
            WHERE NOT contains(text, 'é')
            UNION ALL
            SELECT 'invalid utf-8', count(*) FROM documents WHERE contains(text, 'é')
            HAVING count(*) > 0""",
        "bad_value_rejects": """
            SELECT CASE WHEN c_acctbal < 0 THEN 'bad value: id' ELSE 'missing value: name' END
                   AS reason, count(*) AS n
            FROM customer WHERE c_acctbal < 0 OR c_acctbal >= 9000 GROUP BY 1""",
        "copy_text_decode": "SELECT doc_id, text FROM documents",
        "copy_numeric_escapes": "SELECT doc_id, text FROM documents",
        "null_vs_empty": """
            SELECT doc_id, CASE lang WHEN 'en' THEN NULL WHEN 'fr' THEN ''
                                     WHEN 'de' THEN chr(92) || 'N' ELSE lang END AS value
            FROM documents""",
        "latest_snapshot": "SELECT max(strftime(o_orderdate, '%Y%m%d-%H%M%S')) AS stamp FROM orders",
        "snapshot_list": """
            SELECT strftime(o_orderdate, '%Y%m%d-%H%M%S') AS stamp FROM orders
            UNION
            SELECT strftime(o_orderdate + INTERVAL 1 DAY, '%Y%m%d-120000') FROM orders""",
        "source_completeness": """
            SELECT lang || '/' || source AS name FROM documents
            EXCEPT
            SELECT lang || '/' || source FROM documents JOIN labels USING (doc_id)""",
        "source_overlap": """
            SELECT p_name AS name FROM part WHERE p_brand = 'Brand#1'
            INTERSECT
            SELECT p_name FROM part WHERE p_brand = 'Brand#2'""",
        "normalize_text": """
            SELECT doc_id, lower(trim(strip_accents(text))) AS key FROM documents""",
        "normalize_names": _catalog(
            "SELECT id, lower(trim(strip_accents(name))) AS key FROM mb_artist"
        ),
        "library_keys": _matched("SELECT key FROM library_keys"),
        "match_by_name": _matched("SELECT id FROM by_name"),
        "match_by_alias": _matched("SELECT id FROM by_alias"),
        "match_union": _matched(
            "SELECT id, id IN (SELECT id FROM by_name) AS by_name, "
            "id IN (SELECT id FROM by_alias) AS by_alias FROM matched"
        ),
        "match_stats": _matched(
            "SELECT count(*) FILTER (id IN (SELECT id FROM by_name)) AS by_name, "
            "count(*) FILTER (id NOT IN (SELECT id FROM by_name)) AS by_alias_only, "
            "count(*) AS total FROM matched"
        ),
        "kept_tracks_from_dump": _kept("SELECT * FROM kept_mb_track"),
        "wanted_areas": _kept(
            "SELECT area FROM kept_mb_artist WHERE area IS NOT NULL "
            "UNION SELECT begin_area FROM kept_mb_artist WHERE begin_area IS NOT NULL"
        ),
        "table_sizes": _catalog(_sizes("")),
        "kept_sizes": _kept(_sizes("kept_")),
        "count_compare": _kept(
            f"""SELECT "table", b.rows AS rows_before, a.rows AS rows_after,
                       b.rows IS NOT DISTINCT FROM a.rows AS same
                FROM ({_sizes("")}) b FULL JOIN ({_sizes("kept_")}) a USING ("table")"""
        ),
        "not_null_violations": _catalog(
            "\nUNION ALL\n".join(
                f"SELECT 'mb_artist' AS \"table\", '{c}' AS \"column\", "
                f'count(*) FILTER ("{c}" IS NULL) AS violations FROM mb_artist'
                for c in ARTIST_COLUMNS
            )
        ),
        "pk_duplicates": _catalog(
            "SELECT id, count(*) AS n FROM mb_track GROUP BY id HAVING count(*) > 1"
        ),
        "pk_composite_duplicates": """
            SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
            GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
        "fk_orphans": """
            SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
            WHERE NOT EXISTS (SELECT 1 FROM orders
                              WHERE o_orderkey = l_orderkey AND o_orderstatus = 'O')""",
        "fk_orphan_keys": _kept(
            "SELECT artist AS key, count(*) AS n FROM mb_artist_credit_name "
            "WHERE NOT EXISTS (SELECT 1 FROM kept_mb_artist a WHERE a.id = artist) "
            "GROUP BY artist"
        ),
        "orphans_not_in": _kept(
            "SELECT * FROM mb_tag WHERE id NOT IN (SELECT tag FROM kept_mb_artist_tag)"
        ),
        "uuid_malformed": """
            SELECT o_orderkey AS id,
                   CASE o_orderkey % 6 WHEN 4 THEN '{' || md5(CAST(o_orderkey AS VARCHAR))
                        ELSE 'g' || substr(md5(CAST(o_orderkey AS VARCHAR)), 2) END AS gid
            FROM orders WHERE o_orderkey % 6 >= 4""",
        "decoded_text_rejects": """
            SELECT CAST(doc_id AS INT) AS id,
                   CASE doc_id % 4 WHEN 1 THEN 'zero byte: body' WHEN 2 THEN 'kept'
                        ELSE 'invalid utf-8: body' END AS reason,
                   CASE doc_id % 4 WHEN 2 THEN length(text) + 1 END AS length
            FROM documents""",
        "build_from_files": _kept(_build()),
        "build_restarted": _kept(_restarted()),
        "source_groups": _catalog(_groups()),
        "catalog_reset": _catalog(_reset()),
        "reload_tables": _catalog(_reloaded()),
        "integrity_loaded": _catalog(_integrity("")),
        "integrity_kept": _kept(_integrity("kept_")),
        "column_profile": _catalog(_profile("mb_artist", ARTIST_COLUMNS)),
        "column_profile_sketch": _catalog(
            f"""SELECT * REPLACE (true AS "close") FROM (
                SELECT * RENAME ("distinct" AS exact), true AS "close"
                FROM ({_profile("mb_track", spec_for("mb_track").column_names)}))"""
        ),
        "profile_merged": _catalog(_merged("mb_track", spec_for("mb_track").column_names)),
        "subset_closed": _kept(_closed()),
        "changed_credits": f"WITH {CATALOG_CTES}{CHANGED}",
        "ci_name_lookup": _requests(BY_NAME),
        "ci_alias_lookup": _requests(BY_ALIAS),
        "ci_lookup": _requests(f"{BY_NAME} UNION ALL {BY_ALIAS}"),
        "trigram_sets": (
            f"WITH texts AS (SELECT p_name AS k FROM part),{TRIGRAM_CTES}\n"
            "SELECT p_partkey, g AS trigram FROM part JOIN grams ON k = p_name"
        ),
        "trigram_similarity": f"""
            WITH texts AS (
                SELECT p_name AS k FROM part UNION SELECT p_type || ' ' || p_name FROM part),
            {SIMILAR_CTES}
            SELECT p_partkey, round(similarity, 6) AS similarity
            FROM part JOIN scored ON request = p_name AND name = p_type || ' ' || p_name""",
        "fuzzy_name_lookup": f"""
            WITH texts AS (SELECT p_name AS k FROM part),{SIMILAR_CTES}
            SELECT request, p_partkey AS id, p_name AS name, round(similarity, 6) AS similarity
            FROM scored JOIN part ON p_name = name WHERE similarity >= 0.3""",
        "fuzzy_title_lookup": f"""
            WITH titles AS (
                SELECT page_id AS id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS name
                FROM pages),
            texts AS (SELECT name AS k FROM titles),{SIMILAR_CTES}
            SELECT s.request, t.id, t.name, round(similarity, 6) AS similarity
            FROM scored s JOIN titles t ON t.name = s.name WHERE similarity >= 0.3""",
        "fuzzy_index_lookup": f"""
            WITH requests AS (SELECT DISTINCT p_name || ' ' || p_brand AS k FROM part),
            texts AS (SELECT p_name AS k FROM part UNION ALL SELECT k FROM requests),{SIMILAR_CTES}
            SELECT request, p_partkey AS id, p_name AS name, round(similarity, 6) AS similarity
            FROM scored JOIN requests ON request = requests.k JOIN part ON p_name = name
            WHERE similarity >= 0.5""",
        "key_lookup": _catalog("SELECT * FROM mb_recording WHERE length > 400000"),
        "key_lookup_few": _catalog(
            "SELECT * FROM mb_recording WHERE gid IN "
            "(SELECT gid FROM mb_recording ORDER BY length DESC, id LIMIT 7)"
        ),
        "navigate_credits": _catalog(
            "SELECT n.artist, c.id AS artist_credit, n.position, c.name AS credit_name "
            "FROM mb_artist_credit_name n JOIN mb_artist_credit c ON n.artist_credit = c.id"
        ),
        "navigate_release_groups": _catalog(
            "SELECT n.artist, g.id AS release_group, g.name, g.type "
            "FROM mb_artist_credit_name n JOIN mb_release_group g USING (artist_credit)"
        ),
        "navigate_recordings": _catalog(
            "SELECT n.artist, r.id AS recording, r.gid, r.name, r.length "
            "FROM mb_artist_credit_name n JOIN mb_recording r USING (artist_credit)"
        ),
        "navigate_tracks": _catalog(
            "SELECT r.id AS recording, r.name AS recording_name, t.id AS track, t.position, "
            "m.id AS medium, m.format FROM mb_track t JOIN mb_recording r ON t.recording = r.id "
            "JOIN mb_medium m ON t.medium = m.id"
        ),
        "navigate_tags": _catalog(
            "SELECT a.artist, a.tag, t.name, a.count "
            "FROM mb_artist_tag a JOIN mb_tag t ON a.tag = t.id"
        ),
        "navigate_areas": _catalog(
            "SELECT a.id AS artist, r.id AS area, r.name AS area_name, t.name AS area_type "
            "FROM mb_artist a JOIN mb_area r ON a.area = r.id "
            "LEFT JOIN mb_area_type t ON r.type = t.id"
        ),
        "navigate_aliases": _catalog(
            "SELECT a.id AS artist, a.name, l.name AS alias, l.locale "
            "FROM mb_artist_alias l JOIN mb_artist a ON l.artist = a.id"
        ),
        "sorted_names": _kept("SELECT name, id FROM kept_mb_artist"),
    }
    for spec in LOADED_TABLES:
        found[f"load_{spec.dump_file}"] = _plain(CATALOG_SQL[spec.table])
        found[f"subset_{spec.dump_file}"] = _kept(f"SELECT * FROM kept_{spec.table}")
    return found
