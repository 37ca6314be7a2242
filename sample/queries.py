"""Queries over the test tables, one or more per operator: name -> (spark, sf_dir) -> rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column as Expression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dumpwinnow.functions.copytext import decode_field, encode_field, encode_line
from dumpwinnow.functions.normalize import normalize_name
from dumpwinnow.functions.trigrams import similarity, trigrams
from dumpwinnow.operators import lookup, matching, quality
from dumpwinnow.operators.closure import close_subset
from dumpwinnow.operators.compare import changed_keys
from dumpwinnow.operators.fuzzy import fuzzy_lookup
from dumpwinnow.operators.keyjoin import distinct_keys
from dumpwinnow.operators.subset import rules_for, subset, tables_for, write_subset
from dumpwinnow.plans.build import (
    Ledger,
    build,
    import_checked,
    import_dump,
    read_name_index,
    read_tables,
    write_name_index,
)
from dumpwinnow.plans.rules import CATALOG_RULES
from dumpwinnow.plans.steps import freed_shuffles
from dumpwinnow.sources.dump import TOLERANT, parse_lines
from dumpwinnow.sources.listing import latest_stamp, missing_names, shared_names, snapshot_stamps
from dumpwinnow.sources.snapshots import (
    Snapshot,
    SnapshotStore,
    create_tables,
    drop_tables,
    fill_if_empty,
    scratch_snapshot,
)
from dumpwinnow.sources.specs import (
    ALL_TABLES,
    LOADED_TABLES,
    Column,
    TableSpec,
    sources,
    spec_for,
)
from dumpwinnow.sources.views import publish_views
from sample.catalog import catalog, catalog_table, dump_lines, library, read, run_sql

Query = Callable[[SparkSession, str], DataFrame]


# -- loading ---------------------------------------------------------------------------


def load(table: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return parse_lines(dump_lines(spark, sf_dir, table), spec_for(table)).rows

    return query


CUSTOMER_FILE = TableSpec(
    "customer",
    "customer",
    (
        Column("segment", "text", 4),
        Column("id", "int", 0, required=True),
        Column("name", "text", 2, required=True),
    ),
    ("id",),
)


def tsv_positional_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "customer").select(
        encode_line(
            F.col("c_custkey"),
            F.lit("x"),
            F.col("c_name"),
            F.col("c_acctbal"),
            F.col("c_mktsegment"),
            F.lit(""),
        ).alias("value")
    )
    return parse_lines(lines, CUSTOMER_FILE).rows


def _ragged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer lines of which those with a negative balance lack the last fields."""
    head = [F.col("c_custkey"), F.lit("x"), F.col("c_name")]
    return read(spark, sf_dir, "customer").select(
        F.when(F.col("c_acctbal") < 0, encode_line(*head))
        .otherwise(encode_line(*head, F.col("c_acctbal"), F.col("c_mktsegment")))
        .alias("value")
    )


def tsv_short_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_lines(_ragged(spark, sf_dir), CUSTOMER_FILE).rows


def tsv_short_row_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_lines(_ragged(spark, sf_dir), CUSTOMER_FILE).rejects


DOCUMENT_FILE = TableSpec(
    "document",
    "document",
    (Column("id", "int", 0, required=True), Column("text", "text", 1, required=True)),
    ("id",),
)


def _document_lines(spark: SparkSession, sf_dir: str, ending: str = "") -> DataFrame:
    line = F.concat(encode_line(F.col("doc_id"), F.col("text")), F.lit(ending))
    return read(spark, sf_dir, "documents").select("doc_id", "text", line.alias("value"))


def crlf_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_lines(_document_lines(spark, sf_dir, "\r"), DOCUMENT_FILE).rows


def invalid_utf8_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with an accented e get a stray byte; they must be rejected, the rest kept."""
    stray = F.concat(F.encode("value", "UTF-8"), F.lit(b"\xff")).cast("string")
    lines = _document_lines(spark, sf_dir).select(
        F.when(F.contains("text", F.lit("é")), stray).otherwise(F.col("value")).alias("value")
    )
    parsed = parse_lines(lines, DOCUMENT_FILE, TOLERANT)
    kept = parsed.rows.agg(F.lit("loaded").alias("outcome"), F.count("*").alias("n"))
    return kept.unionAll(
        parsed.rejects.groupBy(F.col("reason").alias("outcome")).agg(F.count("*").alias("n"))
    )


def bad_value_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and names of which some are not loadable, by reason."""
    lines = read(spark, sf_dir, "customer").select(
        encode_line(
            F.when(F.col("c_acctbal") < 0, F.concat(F.lit("c"), "c_custkey")).otherwise(
                F.col("c_custkey").cast("string")
            ),
            F.lit("x"),
            F.when(F.col("c_acctbal") >= 9000, F.lit(None)).otherwise(F.col("c_name")),
            F.lit("y"),
            F.col("c_mktsegment"),
        ).alias("value")
    )
    rejects = parse_lines(lines, CUSTOMER_FILE, TOLERANT).rejects
    return rejects.groupBy("reason").agg(F.count("*").alias("n"))


def copy_text_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select(
        "doc_id", decode_field(encode_field(F.col("text"))).alias("text")
    )


def copy_numeric_escapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accented letters written as octal or hex byte escapes, decoded again."""
    escaped = F.replace(
        F.replace(encode_field(F.col("text")), F.lit("é"), F.lit("\\303\\251")),
        F.lit("ñ"),
        F.lit("\\xC3\\xb1"),
    )
    return read(spark, sf_dir, "documents").select("doc_id", decode_field(escaped).alias("text"))


def null_vs_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = (
        F.when(F.col("lang") == "en", F.lit("\\N"))
        .when(F.col("lang") == "fr", F.lit(""))
        .when(F.col("lang") == "de", F.lit("\\\\N"))
        .otherwise(F.col("lang"))
    )
    return read(spark, sf_dir, "documents").select("doc_id", decode_field(raw).alias("value"))


def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "orders").select(
        F.concat(
            F.lit('<a href="../">up</a> <a href="'),
            F.date_format("o_orderdate", "yyyyMMdd-HHmmss"),
            F.lit('/">dump</a> <a href="LATEST">latest</a>'),
        ).alias("html")
    )
    return latest_stamp(pages, "html")


def snapshot_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stamps that appear in the links of one listing per order status."""
    pages = read(spark, sf_dir, "orders").select(
        F.concat(
            F.lit('<a href="'),
            F.date_format("o_orderdate", "yyyyMMdd-HHmmss"),
            F.lit('/">a</a><a href="'),
            F.date_format(F.date_add("o_orderdate", 1), "yyyyMMdd"),
            F.lit('-120000/">b</a>'),
        ).alias("html")
    )
    return snapshot_stamps(pages, "html").distinct()


def source_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources of documents in each language that lack a labelled document."""
    documents = read(spark, sf_dir, "documents").withColumn(
        "name", F.concat_ws("/", "lang", "source")
    )
    labels = read(spark, sf_dir, "labels")
    present = documents.join(labels, "doc_id", "left_semi")
    return missing_names(documents.select("name"), present.select("name"))


def source_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source, tables, rows, shared) of each part of the dump; no name may be in both."""
    sizes = quality.table_sizes(catalog(spark, sf_dir)).withColumnRenamed("table", "name")
    of = {
        source: spark.createDataFrame([(spec_for(f).table,) for f in sources(source)], "name string")
        for source in ("core", "derived")
    }
    shared = shared_names(*of.values()).count()
    parts = [
        sizes.join(names, "name").agg(
            F.lit(source).alias("source"),
            F.count("*").alias("tables"),
            F.sum("rows").alias("rows"),
            F.lit(shared).cast("long").alias("shared"),
        )
        for source, names in of.items()
    ]
    return reduce(DataFrame.unionAll, parts)


def source_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names sold under two brands: the groups ought not to share a name."""
    part = read(spark, sf_dir, "part")
    first = part.filter(F.col("p_brand") == "Brand#1").select(F.col("p_name").alias("name"))
    second = part.filter(F.col("p_brand") == "Brand#2").select(F.col("p_name").alias("name"))
    return shared_names(first, second)


# -- names and matching ----------------------------------------------------------------


def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", normalize_name("text").alias("key"))


def normalize_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    artists = catalog_table(spark, sf_dir, "mb_artist")
    return artists.select("id", normalize_name("name").alias("key"))


def library_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.library_keys(library(spark, sf_dir))


def match_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    artists = catalog_table(spark, sf_dir, "mb_artist")
    hits = matching.match_rows(artists, "id", library_keys(spark, sf_dir))
    return hits.select(F.col("entity").alias("id"))


def match_by_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    aliases = catalog_table(spark, sf_dir, "mb_artist_alias")
    hits = matching.match_rows(aliases, "artist", library_keys(spark, sf_dir))
    return hits.select(F.col("entity").alias("id"))


def match_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.match_entities(
        catalog_table(spark, sf_dir, "mb_artist"),
        catalog_table(spark, sf_dir, "mb_artist_alias"),
        library_keys(spark, sf_dir),
    )


def match_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.match_statistics(match_union(spark, sf_dir))


# -- subset ----------------------------------------------------------------------------


def _roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.matched_keys(match_union(spark, sf_dir))


def kept_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One kept table as a lazy plan over the tables it depends on."""
    rules = rules_for(CATALOG_RULES, [table])
    tables = {t: catalog_table(spark, sf_dir, t) for t in tables_for(rules)}
    return subset(tables, rules, _roots(spark, sf_dir))[table]


def kept(table: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return kept_table(spark, sf_dir, table)

    return query


def kept_catalog(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All kept tables, each written once: many outputs share the same kept parents."""
    snapshot = scratch_snapshot(spark)
    roots = snapshot.write("roots", _roots(spark, sf_dir))
    stored = write_subset(
        catalog(spark, sf_dir), CATALOG_RULES, roots, roots.count(), snapshot.write
    )
    return stored.tables


def kept_tracks_from_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From dump lines to the kept tracks: every table on the way is parsed first."""

    def parsed(table: str) -> DataFrame:
        return parse_lines(dump_lines(spark, sf_dir, table), spec_for(table)).rows

    matched = matching.match_entities(
        parsed("mb_artist"), parsed("mb_artist_alias"), library_keys(spark, sf_dir)
    )
    rules = rules_for(CATALOG_RULES, ["mb_track"])
    tables = {t: parsed(t) for t in tables_for(rules)}
    return subset(tables, rules, matching.matched_keys(matched))["mb_track"]


def wanted_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    artists = kept_table(spark, sf_dir, "mb_artist")
    return (
        distinct_keys(artists, "area")
        .union(distinct_keys(artists, "begin_area"))
        .distinct()
        .withColumnRenamed("key", "area")
    )


def table_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.table_sizes(catalog(spark, sf_dir))


def kept_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.table_sizes(kept_catalog(spark, sf_dir))


def count_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.compare_sizes(table_sizes(spark, sf_dir), kept_sizes(spark, sf_dir))


# -- checks ----------------------------------------------------------------------------


def not_null_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    artists = catalog_table(spark, sf_dir, "mb_artist")
    return quality.null_violations(artists, artists.columns, "mb_artist")


def pk_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_keys(catalog_table(spark, sf_dir, "mb_track"), ["id"])


def pk_composite_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_keys(read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items of orders that are not open, against the open orders alone."""
    orders = read(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "O")
    return quality.orphan_rows(
        read(spark, sf_dir, "lineitem"), "l_orderkey", orders, "o_orderkey"
    ).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def fk_orphan_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    artists = kept_table(spark, sf_dir, "mb_artist")
    credit_names = catalog_table(spark, sf_dir, "mb_artist_credit_name")
    return quality.orphan_keys(credit_names, "artist", artists, "id")


def orphans_not_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept_tags = kept_table(spark, sf_dir, "mb_artist_tag")
    return quality.unused_rows(catalog_table(spark, sf_dir, "mb_tag"), "id", kept_tags, "tag")


def uuid_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order keys hashed and spelled in six ways, of which two are no UUID."""
    plain = F.md5(F.col("o_orderkey").cast("string"))
    hyphened = F.regexp_replace(
        plain, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"
    )
    spelling = F.col("o_orderkey") % 6
    gid = (
        F.when(spelling == 0, plain)
        .when(spelling == 1, F.upper(plain))
        .when(spelling == 2, hyphened)
        .when(spelling == 3, F.concat(F.lit("{"), plain, F.lit("}")))
        .when(spelling == 4, F.concat(F.lit("{"), plain))
        .otherwise(F.concat(F.lit("g"), F.substring(plain, 2, 31)))
    )
    orders = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), gid.alias("gid"))
    return quality.malformed_uuids(orders, "gid")


def decoded_text_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document texts with escapes that spell broken UTF-8, a zero byte or a letter."""
    spec = TableSpec("d", "d", (Column("id", "int", 0), Column("body", "text", 1)))
    tail = (
        F.when(F.col("doc_id") % 4 == 0, F.lit(r"\377"))
        .when(F.col("doc_id") % 4 == 1, F.lit(r"\000x"))
        .when(F.col("doc_id") % 4 == 2, F.lit(r"\x41"))
        .otherwise(F.lit(r"\303"))
    )
    line = F.concat_ws(
        "\t", F.col("doc_id").cast("string"), F.concat(encode_field(F.col("text")), tail)
    )
    lines = read(spark, sf_dir, "documents").select(line.alias("value"))
    parsed = parse_lines(lines, spec, TOLERANT)
    kept = parsed.rows.select(
        "id", F.lit("kept").alias("reason"), F.length("body").cast("long").alias("length")
    )
    bad = parsed.rejects.select(
        F.split("line", "\t", 2)[0].cast("int").alias("id"),
        "reason",
        F.lit(None).cast("long").alias("length"),
    )
    return kept.unionAll(bad)


def build_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dump files to a published snapshot, in a run that is resumed after its import.

    Rows as (part, name, rows): lines imported and rows kept of each table, and the ledger.
    """
    folder = scratch_snapshot(spark).path
    _write_dump(spark, sf_dir, f"{folder}/dump")
    names = library(spark, sf_dir)
    store = SnapshotStore(spark, f"{folder}/out")
    started = store.snapshot("one")
    loaded = Snapshot(spark, f"{started.path}/loaded")
    ledger = Ledger(started)
    ledger.mark("import", import_checked(spark, f"{folder}/dump", loaded, TOLERANT))
    snapshot = build(spark, f"{folder}/dump", store.root, "one", names, resume=True, mode=TOLERANT)
    imported = loaded.read("_import").select(
        F.lit("imported").alias("part"), F.col("table").alias("name"), "rows"
    )
    kept = quality.table_sizes(read_tables(snapshot)).select(
        F.lit("kept").alias("part"), F.col("table").alias("name"), "rows"
    )
    steps = ledger.entries().filter("step <> 'indexes'").select(
        F.lit("ledger").alias("part"), F.col("step").alias("name"), "rows"
    )
    return imported.unionAll(kept).unionAll(steps)


# Lines are stored zipped, at a third of their size; the fastest level is chosen.  A zipped file
# is read by one task, so that no file is to hold all lines of a large writing task.
DUMP_OPTIONS = {
    "compression": "gzip",
    "zlib.compress.level": "BEST_SPEED",
    "maxRecordsPerFile": 1_000_000,
}


def _write_dump(spark: SparkSession, sf_dir: str, folder: str, but: tuple[str, ...] = ()) -> str:
    with freed_shuffles(spark):
        for spec in LOADED_TABLES:
            if spec.table not in but:
                lines = dump_lines(spark, sf_dir, spec.table)
                lines.write.options(**DUMP_OPTIONS).text(f"{folder}/{spec.dump_file}")
    return folder


def _report(rows: DataFrame, part: str, name: str = "table") -> DataFrame:
    return rows.select(F.lit(part).alias("part"), F.col(name).alias("name"), "rows")


def build_restarted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A build of a library, a second start under its name, and a build that keeps everything.

    Two dump files are missing.  Rows as (part, name, rows): what the first build says it kept,
    the refused start, the name that is published in the end, and its tables read through views.
    """
    folder = scratch_snapshot(spark).path
    dump = _write_dump(spark, sf_dir, f"{folder}/dump", ("mb_gender", "mb_tag"))
    store = SnapshotStore(spark, f"{folder}/out")
    names = library(spark, sf_dir)
    first = build(spark, dump, store.root, "one", names, mode=TOLERANT)
    facts = [("published first", store.current_name(), 1)]
    try:
        build(spark, dump, store.root, "one", names, mode=TOLERANT)
    except FileExistsError:
        facts.append(("refused", "one", 1))
    build(spark, dump, store.root, "two", None, keep_all=True, mode=TOLERANT)
    facts.append(("published last", store.current_name(), 1))
    publish_views(store, "published_catalog")
    views = {s.table: spark.table(f"published_catalog.{s.table}") for s in LOADED_TABLES}
    published = quality.table_sizes(views)
    return (
        _report(first.read("_kept"), "kept")
        .unionAll(_report(published, "published"))
        .unionAll(spark.createDataFrame(facts, "part string, name string, rows long"))
    )


def catalog_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog tables created, filled twice, listed, and dropped by their prefix.

    Rows as (part, name, rows): rows of each filling, rows held, columns, tables dropped and left.
    """
    database = f"reset_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {database}")
    create_tables(spark, database)
    facts = []
    for table in ("mb_area", "mb_artist", "mb_tag"):
        name = f"{database}.{table}"
        for part in ("filled", "again"):
            done = fill_if_empty(name, catalog_table(spark, sf_dir, table))
            facts.append((part, table, spark.table(name).count() if done else 0))
        facts.append(("held", table, spark.table(name).count()))
    for spec in ALL_TABLES:
        columns = [c.name for c in spark.catalog.listColumns(f"{database}.{spec.table}")]
        facts.append(("columns", f"{spec.table}: {', '.join(columns)}", len(columns)))
    spark.sql(f"CREATE TABLE {database}.other (mb_x int) USING parquet")
    facts += [("dropped", name, 1) for name in drop_tables(spark, database)]
    facts += [("left", t.name, 1) for t in spark.catalog.listTables(database)]
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return spark.createDataFrame(facts, "part string, name string, rows long")


def reload_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load, the same load again, and a fresh load of a dump with other and bad lines.

    Rows as (part, name, rows): lines loaded each time, rows and rejects held in the end.
    """
    folder = scratch_snapshot(spark).path
    others = tuple(s.table for s in LOADED_TABLES if s.table not in ("mb_artist", "mb_area"))
    first = _write_dump(spark, sf_dir, f"{folder}/first", others)
    bad = read(spark, sf_dir, "region").select(F.concat(F.lit("x\t"), "r_name").alias("value"))
    area = dump_lines(spark, sf_dir, "mb_area")
    area.unionAll(bad).write.text(f"{folder}/second/{spec_for('mb_area').dump_file}")
    loaded = Snapshot(spark, f"{folder}/loaded")
    counts = [
        (part, table, rows)
        for part, dump, fresh in (
            ("first", first, True),
            ("again", first, False),
            ("fresh", f"{folder}/second", True),
        )
        for table, rows in import_dump(spark, dump, loaded, TOLERANT, fresh).items()
    ]
    rejects = quality.table_sizes({t: loaded.rejects(t) for t in ("mb_area", "mb_artist")})
    return (
        spark.createDataFrame(counts, "part string, name string, rows long")
        .unionAll(_report(quality.table_sizes(read_tables(loaded)), "held"))
        .unionAll(_report(rejects, "rejects"))
    )


def integrity_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.integrity_report(catalog(spark, sf_dir), LOADED_TABLES)


def integrity_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.integrity_report(kept_catalog(spark, sf_dir), LOADED_TABLES)


def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    artists = catalog_table(spark, sf_dir, "mb_artist")
    return quality.profile(artists, "mb_artist", exact_distinct=True)


def column_profile_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the sketched distinct count of each column is within 5 % of the exact one."""
    track = catalog_table(spark, sf_dir, "mb_track")
    exact = track.agg(*[F.count_distinct(c).alias(c) for c in track.columns])
    entries = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).alias("exact")) for c in track.columns]
    )
    close = F.abs(F.col("distinct") - F.col("exact")) * 20 <= F.col("exact")
    return (
        quality.profile(track, "mb_track")
        .join(exact.select(F.inline(entries)), "column")
        .select("table", "column", "rows", "nulls", "exact", close.alias("close"), "min", "max")
    )


def profile_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles of three sets of tracks, stored apart and merged, against the whole table.

    Per column: exact rows and nulls, low and high, and whether the distinct count is within 5 %
    and the quartiles' ranks within 3 % of the exact ones.
    """
    track = catalog_table(spark, sf_dir, "mb_track")
    stored = scratch_snapshot(spark)
    parts = [
        stored.write(f"part{k}", quality.profile_sketches(track.filter(F.col("medium") % 3 == k), "mb_track"))
        for k in range(3)
    ]
    found = stored.write("merged", quality.merge_profiles(reduce(DataFrame.unionAll, parts)))
    found = quality.read_profile(found)
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v"))
            for c in track.columns
        ]
    )
    # values are counted before they are ranked, so that no row carries what is known of its column
    values = track.select(F.inline(entries)).groupBy("column", "v").agg(F.count(F.lit(1)).alias("n"))
    shares = (0.25, 0.5, 0.75)
    quantiles = [F.get("quantiles", F.lit(k)).alias(f"q{k}") for k in range(len(shares))]
    ranked = values.join(F.broadcast(found.select("column", *quantiles)), "column")
    number = F.col("v").try_cast("double")

    def rows_of(condition: Expression) -> Expression:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    counted = ranked.groupBy("column").agg(
        F.count("v").alias("exact"),
        rows_of(F.col("v").isNotNull()).alias("n"),
        *[rows_of(number < F.col(f"q{k}")).alias(f"below{k}") for k in range(len(shares))],
        *[rows_of(number <= F.col(f"q{k}")).alias(f"upto{k}") for k in range(len(shares))],
    )

    def off(k: int, share: float) -> Expression:
        """How far the wanted rank is from the ranks that the quantile has."""
        low, high = (F.col(f"{side}{k}") / F.col("n") for side in ("below", "upto"))
        return F.greatest(F.lit(0.0), low - share, share - high)

    near = [F.col("quantiles").isNull() | (off(k, s) <= 0.03) for k, s in enumerate(shares)]
    return counted.join(F.broadcast(found), "column").select(
        "column",
        "rows",
        "nulls",
        "exact",
        (F.abs(F.col("distinct") - F.col("exact")) * 20 <= F.col("exact")).alias("close"),
        reduce(lambda x, y: x & y, near).alias("near"),
        "low",
        "high",
    )


def subset_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the subset closed over its references, with tracks that name other credits.

    Rows as (part, name, rows): kept rows, rows of the closed tables, references left dangling.
    """
    scratch = scratch_snapshot(spark)
    tables = catalog(spark, sf_dir)
    tables["mb_track"] = tables["mb_track"].withColumn("artist_credit", F.col("medium") + 1)
    roots = scratch.write("roots", _roots(spark, sf_dir))
    kept = write_subset(tables, CATALOG_RULES, roots, roots.count(), scratch.write).tables
    closed = close_subset(tables, kept, LOADED_TABLES, scratch).tables
    report = quality.integrity_report(closed, LOADED_TABLES).filter("check = 'foreign key'")
    dangling = report.select(
        F.concat_ws(".", "table", "columns").alias("name"), F.col("violations").alias("rows")
    )
    return (
        _report(quality.table_sizes(kept), "kept")
        .unionAll(_report(quality.table_sizes(closed), "closed"))
        .unionAll(_report(dangling, "dangling", "name"))
    )


def changed_credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that differ between two stored versions of the credits' members."""
    before = catalog_table(spark, sf_dir, "mb_artist_credit_name")
    after = (
        before.filter(F.col("artist_credit") % 97 != 0)
        .withColumn("name", F.when(F.col("artist") % 50 == 7, F.upper("name")).otherwise(F.col("name")))
        .unionAll(before.filter(F.col("artist_credit") % 89 == 1))
        .unionAll(
            before.filter("artist_credit % 101 = 3").withColumn("artist_credit", -F.col("artist_credit"))
        )
    )
    stored = scratch_snapshot(spark)
    versions = [stored.write(n, rows) for n, rows in (("before", before), ("after", after))]
    return changed_keys(*versions, ["artist_credit", "position"])


# -- lookups ---------------------------------------------------------------------------


def _name_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = """
        SELECT upper(replace(c_name, 'Customer', 'CÜstömer')) AS request FROM {customer}
        WHERE c_mktsegment = 'BUILDING'
        UNION ALL
        SELECT concat(upper(c_mktsegment), ' SOCIÉTÉ ', substr(c_name, 10)) FROM {customer}
        WHERE c_mktsegment = 'MACHINERY'"""
    return run_sql(spark, sf_dir, sql)


def ci_name_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    artists = catalog_table(spark, sf_dir, "mb_artist")
    return lookup.lookup_name(_name_requests(spark, sf_dir), artists)


def ci_alias_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    aliases = catalog_table(spark, sf_dir, "mb_artist_alias")
    return lookup.lookup_alias(_name_requests(spark, sf_dir), aliases)


def ci_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.lookup_name_or_alias(
        _name_requests(spark, sf_dir),
        catalog_table(spark, sf_dir, "mb_artist"),
        catalog_table(spark, sf_dir, "mb_artist_alias"),
    )


def trigram_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select(
        "p_partkey", F.explode(trigrams("p_name")).alias("trigram")
    )


def trigram_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How alike each part's name and type are."""
    score = similarity(trigrams("p_name"), trigrams(F.concat_ws(" ", "p_type", "p_name")))
    return read(spark, sf_dir, "part").select("p_partkey", F.round(score, 6).alias("similarity"))


def fuzzy_name_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All part names asked for against all parts."""
    part = read(spark, sf_dir, "part")
    hits = fuzzy_lookup(
        part.select(F.col("p_name").alias("request")), part, entity="p_partkey", name="p_name"
    )
    return hits.withColumn("similarity", F.round("similarity", 6))


def fuzzy_title_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All page titles against all page titles: many distinct, longer names."""
    titles = read(spark, sf_dir, "pages").select(
        F.col("page_id").alias("id"),
        F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("name"),
    )
    hits = fuzzy_lookup(titles.select(F.col("name").alias("request")), titles)
    return hits.withColumn("similarity", F.round("similarity", 6))


def fuzzy_index_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names with their brand, asked against an index of part names that was stored."""
    part = read(spark, sf_dir, "part")
    stored = scratch_snapshot(spark)
    names = part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    named = stored.write("mb_artist", names)
    write_name_index(stored)
    hits = fuzzy_lookup(
        part.select(F.concat_ws(" ", "p_name", "p_brand").alias("request")),
        named,
        read_name_index(stored),
        threshold=0.5,
    )
    return hits.withColumn("similarity", F.round("similarity", 6))


def key_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recordings by the UUIDs of the long ones."""
    recordings = catalog_table(spark, sf_dir, "mb_recording")
    wanted = recordings.filter(F.col("length") > 400000).select("gid")
    return lookup.lookup_key(wanted, "gid", recordings, "gid")


def key_lookup_few(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The recordings of the seven longest, by UUID, in a table that is stored by UUID."""
    recordings = catalog_table(spark, sf_dir, "mb_recording")
    stored = scratch_snapshot(spark)
    by_gid = stored.write_clustered("recordings", recordings, "gid", ["gid"])
    wanted = recordings.orderBy(F.desc("length"), "id").limit(7).select("gid")
    return lookup.lookup_few_keys(wanted, "gid", by_gid, "gid")


def navigate_credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.credits_of_artists(
        catalog_table(spark, sf_dir, "mb_artist_credit_name"),
        catalog_table(spark, sf_dir, "mb_artist_credit"),
    )


def navigate_release_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.release_groups_of_artists(
        catalog_table(spark, sf_dir, "mb_artist_credit_name"),
        catalog_table(spark, sf_dir, "mb_release_group"),
    )


def navigate_recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.recordings_of_artists(
        catalog_table(spark, sf_dir, "mb_artist_credit_name"),
        catalog_table(spark, sf_dir, "mb_recording"),
    )


def navigate_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.tracks_of_recordings(
        catalog_table(spark, sf_dir, "mb_track"),
        catalog_table(spark, sf_dir, "mb_recording"),
        catalog_table(spark, sf_dir, "mb_medium"),
    )


def navigate_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    tags = lookup.tags_of_artists(
        catalog_table(spark, sf_dir, "mb_artist_tag"), catalog_table(spark, sf_dir, "mb_tag")
    )
    return lookup.ordered(tags, "name", "artist", "tag")


def navigate_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.areas_of_artists(
        catalog_table(spark, sf_dir, "mb_artist"),
        catalog_table(spark, sf_dir, "mb_area"),
        catalog_table(spark, sf_dir, "mb_area_type"),
    )


def navigate_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.aliases_of_artists(
        catalog_table(spark, sf_dir, "mb_artist"), catalog_table(spark, sf_dir, "mb_artist_alias")
    )


def sorted_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.ordered(kept_table(spark, sf_dir, "mb_artist").select("name", "id"), "name", "id")


PLAIN: tuple[Query, ...] = (
    tsv_positional_load,
    tsv_short_rows,
    tsv_short_row_rejects,
    crlf_lines,
    invalid_utf8_rejects,
    bad_value_rejects,
    copy_text_decode,
    copy_numeric_escapes,
    null_vs_empty,
    latest_snapshot,
    snapshot_list,
    source_completeness,
    source_overlap,
    source_groups,
    normalize_text,
    normalize_names,
    library_keys,
    match_by_name,
    match_by_alias,
    match_union,
    match_stats,
    kept_tracks_from_dump,
    wanted_areas,
    table_sizes,
    kept_sizes,
    count_compare,
    not_null_violations,
    pk_duplicates,
    pk_composite_duplicates,
    fk_orphans,
    fk_orphan_keys,
    orphans_not_in,
    uuid_malformed,
    decoded_text_rejects,
    build_from_files,
    build_restarted,
    reload_tables,
    catalog_reset,
    integrity_loaded,
    integrity_kept,
    column_profile,
    column_profile_sketch,
    profile_merged,
    subset_closed,
    changed_credits,
    ci_name_lookup,
    ci_alias_lookup,
    ci_lookup,
    trigram_sets,
    trigram_similarity,
    fuzzy_name_lookup,
    fuzzy_title_lookup,
    fuzzy_index_lookup,
    key_lookup,
    key_lookup_few,
    navigate_credits,
    navigate_release_groups,
    navigate_recordings,
    navigate_tracks,
    navigate_tags,
    navigate_areas,
    navigate_aliases,
    sorted_names,
)


def all_queries() -> dict[str, Query]:
    found = {query.__name__: query for query in PLAIN}
    for spec in LOADED_TABLES:
        found[f"load_{spec.dump_file}"] = load(spec.table)
        found[f"subset_{spec.dump_file}"] = kept(spec.table)
    return found
