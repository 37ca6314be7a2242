"""The build: load a dump, keep what a library needs, index, profile, publish.

Each step writes its tables into one snapshot folder and then an entry into the ledger in
the same folder.  A step that is in the ledger is skipped on resume; a step that died is
run again and replaces what it had written, so running any step twice changes nothing.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from dataclasses import dataclass
from functools import partial
from math import ceil

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dumpwinnow.functions.trigrams import DEFAULT_THRESHOLD
from dumpwinnow.operators.fuzzy import (
    ROWS_PER_TASK,
    NameIndex,
    Postings,
    collect_order,
    distinct_names,
    frequent_trigrams,
    postings,
)
from dumpwinnow.operators.matching import library_keys, match_entities, matched_keys
from dumpwinnow.operators.quality import FINDINGS_SCHEMA, integrity_parts, profile
from dumpwinnow.operators.subset import write_subset
from dumpwinnow.plans.lease import SECONDS, exclusive
from dumpwinnow.plans.rules import CATALOG_RULES
from dumpwinnow.plans.steps import freed_shuffles, run_steps
from dumpwinnow.sources.dump import STRICT, TOLERANT, load_table
from dumpwinnow.sources.files import list_names, path_exists
from dumpwinnow.sources.listing import missing_files
from dumpwinnow.sources.snapshots import Snapshot, SnapshotStore
from dumpwinnow.sources.specs import ALL_TABLES, LOADED_TABLES, TableSpec

log = logging.getLogger(__name__)

SCHEMA, IMPORT, FILTER, INDEXES, ANALYZE = STEPS = (
    "schema",
    "import",
    "filter",
    "indexes",
    "analyze",
)

LEDGER_SCHEMA = "step string, rows long, rejects long, seconds double, completed_at timestamp"
IMPORT_SCHEMA = "table string, rows long, rejects long"
INDEX_SCHEMA = "buckets int, threshold double, rows_per_task long"
# Names whose postings share a bucket: some 20 postings of 130 bytes each.
BUCKET_NAMES = 100_000
KEPT_SCHEMA = "table string, rows long, seconds double"


@dataclass(frozen=True)
class Done:
    """What a step did, for its ledger entry."""

    rows: int
    rejects: int = 0


@dataclass(frozen=True)
class Ledger:
    """Completed steps of one snapshot: a one-row file each, never rewritten."""

    snapshot: Snapshot

    @property
    def path(self) -> str:
        return f"{self.snapshot.path}/_ledger"

    def exists(self) -> bool:
        return path_exists(self.snapshot.spark, self.path)

    def completed(self) -> set[str]:
        """Steps with a finished entry; names that are no step are ignored."""
        spark = self.snapshot.spark
        return {
            name
            for name in list_names(spark, self.path)
            if name in STEPS and path_exists(spark, f"{self.path}/{name}/_SUCCESS")
        }

    def pending(self) -> tuple[str, ...]:
        done = self.completed()
        return tuple(step for step in STEPS if step not in done)

    def mark(self, step: str, done: Done, seconds: float = 0.0) -> None:
        spark = self.snapshot.spark
        entry = spark.range(1).select(
            F.lit(step).alias("step"),
            F.lit(done.rows).cast("long").alias("rows"),
            F.lit(done.rejects).cast("long").alias("rejects"),
            F.lit(seconds).alias("seconds"),
            F.current_timestamp().alias("completed_at"),
        )
        entry.coalesce(1).write.mode("overwrite").json(f"{self.path}/{step}")

    def entries(self) -> DataFrame:
        """(step, rows, rejects, seconds, completed_at) of the completed steps, sorted by step."""
        spark = self.snapshot.spark
        paths = [f"{self.path}/{step}" for step in sorted(self.completed())]
        if not paths:
            return spark.createDataFrame([], LEDGER_SCHEMA)
        return spark.read.schema(LEDGER_SCHEMA).json(paths).orderBy("step")


def open_ledger(snapshot: Snapshot, resume: bool) -> Ledger:
    """The snapshot's ledger under the start policy.

    Progress of an earlier run is continued only when asked to, and never overwritten
    otherwise.
    """
    ledger = Ledger(snapshot)
    if ledger.exists():
        if not resume:
            raise FileExistsError(
                f"{ledger.path} holds the progress of an earlier run: resume it, or build "
                "under another name"
            )
        log.info("resuming, completed: %s", sorted(ledger.completed()))
    elif resume:
        log.warning("nothing to resume at %s, starting fresh", ledger.path)
    return ledger


def _run(ledger: Ledger, step: str, work: Callable[[], Done]) -> None:
    if step in ledger.completed():
        log.info("%s: already complete", step)
        return
    log.info("%s: started", step)
    began = time.monotonic()
    done = work()
    ledger.mark(step, done, time.monotonic() - began)
    log.info("%s: done, %d rows, %d rejects", step, done.rows, done.rejects)


def import_dump(
    spark: SparkSession, dump_dir: str, target: Snapshot, mode: str = STRICT, fresh: bool = True
) -> dict[str, int]:
    """Load every dump file into a snapshot; rows written per table.

    Tables are loaded side by side.  Each is parsed once: rows and rejects are counted while
    they are written by one job, so neither is there without the other.  In strict mode rejects
    are counted only.  ``_import`` holds both counts.  Unless ``fresh``, a loaded table that has
    rows is left alone and counts as 0.
    """
    if not path_exists(spark, dump_dir):
        raise FileNotFoundError(f"no dump folder at {dump_dir}")
    missing = missing_files(spark, dump_dir)
    if missing:
        log.warning("missing dump files: %s", ", ".join(missing))

    def load(spec: TableSpec) -> tuple[int, int]:
        table = spec.table
        if not fresh and target.has(table) and not target.read(table).isEmpty():
            log.info("%s: already loaded", table)
            return 0, target.rejects(table).count()
        seen = Observation(f"import {table}")
        lines = load_table(spark, spec, dump_dir, mode).verdicts(seen)
        target.write_verdicts(table, lines, spec.schema)
        counts = seen.get
        log.info("%s: %d rows, %d rejects", table, counts["rows"], counts["rejects"])
        return counts["rows"], counts["rejects"] if mode == TOLERANT else 0

    counts = run_steps(spark, {spec.table: partial(load, spec) for spec in LOADED_TABLES})
    report = [(table, *both) for table, both in counts.items()]
    target.write("_import", spark.createDataFrame(report, IMPORT_SCHEMA).coalesce(1))
    return {table: rows for table, (rows, _) in counts.items()}


def write_declared(target: Snapshot) -> int:
    """The declared tables that no dump file fills, empty, so that every table is there."""
    loaded = {spec.table for spec in LOADED_TABLES}
    for spec in ALL_TABLES:
        if spec.table not in loaded and not target.has(spec.table):
            target.write(spec.table, target.spark.createDataFrame([], spec.schema))
    return len(ALL_TABLES)


def import_checked(spark: SparkSession, dump_dir: str, loaded: Snapshot, mode: str) -> Done:
    """Load the dump and check its keys, as a load into declared tables would.

    Findings go to ``_findings``; they are a row for each constraint and are gathered part by
    part, so that the disk holds one part's shuffle files at a time.  A duplicate primary key
    stops a strict load.
    """
    written = import_dump(spark, dump_dir, loaded, mode, fresh=False)
    tables = read_tables(loaded)
    held = {table: written.get(table) or rows.count() for table, rows in tables.items()}
    with freed_shuffles(spark):
        parts = integrity_parts(tables, LOADED_TABLES, held)
        found = [row for part in parts for row in part.collect()]
    report = spark.createDataFrame(found, FINDINGS_SCHEMA).coalesce(1)
    findings = loaded.write("_findings", report)
    doubled = findings.filter("check = 'primary key' AND violations > 0").collect()
    for row in doubled:
        log.warning("%s: %d duplicate keys (%s)", row["table"], row["violations"], row["columns"])
    if doubled and mode == STRICT:
        raise ValueError(f"duplicate primary keys in {sorted(r['table'] for r in doubled)}")
    rejects = loaded.read("_import").agg(F.sum("rejects")).first()[0]
    return Done(sum(written.values()), rejects)


def _write_counted(target: Snapshot, table: str, rows: DataFrame) -> int:
    seen = Observation(f"write {table}")
    target.write(table, rows.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


def build(
    spark: SparkSession,
    dump_dir: str,
    root: str,
    name: str,
    library: DataFrame | None,
    library_column: str = "artist",
    keep_all: bool = False,
    resume: bool = False,
    mode: str = STRICT,
    drop_blank: bool = False,
    lease_seconds: float = SECONDS,
) -> Snapshot:
    """Run all steps for the snapshot ``name`` under ``root`` and publish it.

    In tolerant mode bad lines are set aside, duplicate keys are reported only, and NULL
    library names are skipped and counted as the filter step's rejects.  ``drop_blank``
    leaves library names out that are white space alone.

    A second build under the same name is refused while one runs; the lease of one that died
    is taken over ``lease_seconds`` after its last sign of life.

    The published tables are in the returned snapshot; loaded tables before filtering stay
    in its ``loaded`` folder.
    """
    if library is None and not keep_all:
        raise ValueError("a library is required unless everything is kept")
    store = SnapshotStore(spark, root)
    snapshot = store.snapshot(name)
    with exclusive(snapshot, lease_seconds) as held, freed_shuffles(spark):
        ledger = open_ledger(snapshot, resume)
        loaded = Snapshot(spark, f"{snapshot.path}/loaded")
        published = loaded if keep_all else snapshot

        def run(step: str, work: Callable[[], Done]) -> None:
            held()
            _run(ledger, step, work)

        run(SCHEMA, lambda: Done(write_declared(published)))
        run(IMPORT, lambda: import_checked(spark, dump_dir, loaded, mode))
        if keep_all:
            # The step counts as done so that later ones can follow it; the loaded tables are
            # the published ones.
            if FILTER not in ledger.completed():
                ledger.mark(FILTER, Done(0))
        else:
            run(
                FILTER,
                lambda: filter_tables(
                    loaded, published, library, library_column, mode, drop_blank
                ),
            )
        run(INDEXES, lambda: Done(write_indexes(published)))
        run(ANALYZE, lambda: Done(write_profiles(published)))
        held()
        store.publish(name if published is snapshot else f"{name}/loaded")
    return published


def filter_tables(
    loaded: Snapshot,
    target: Snapshot,
    library: DataFrame,
    library_column: str = "artist",
    mode: str = STRICT,
    drop_blank: bool = False,
) -> Done:
    """Match artists and write the kept rows of every table; the rows kept, the names skipped.

    ``_kept`` holds rows and elapsed seconds of each table.
    """
    tables = {spec.table: loaded.read(spec.table) for spec in LOADED_TABLES}
    skipped = library.filter(F.col(library_column).isNull()).count() if mode == TOLERANT else 0
    keys, key_rows = _stored(
        target, "_library_keys", library_keys(library, library_column, mode, drop_blank)
    )
    matched, matched_rows = _stored(
        target,
        "_matched",
        match_entities(tables["mb_artist"], tables["mb_artist_alias"], keys, key_rows),
    )
    log.info("%d artists matched", matched_rows)
    stored = write_subset(
        tables, CATALOG_RULES, matched_keys(matched), matched_rows, target.write
    )
    for table, rows in stored.rows.items():
        log.info("%s: %d rows kept in %.1f s", table, rows, stored.seconds[table])
    kept = [(t, n, stored.seconds[t]) for t, n in stored.rows.items()]
    target.write("_kept", target.spark.createDataFrame(kept, KEPT_SCHEMA).coalesce(1))
    return Done(sum(stored.rows.values()), skipped)


def _stored(target: Snapshot, table: str, rows: DataFrame) -> tuple[DataFrame, int]:
    """Write a small shared result and count it on the way."""
    count = _write_counted(target, table, rows)
    return target.read(table), count


def write_indexes(target: Snapshot) -> int:
    """Tables that speed up lookups; the number of names in the name index.

    ``_by_gid`` and ``_by_name`` hold recordings and artists in the order of what they are looked
    up by.
    """
    artists = target.read("mb_artist").withColumn("name_key", F.lower("name"))
    recordings = target.read("mb_recording")
    done = run_steps(
        target.spark,
        {
            "names": lambda: write_name_index(target),
            "by gid": lambda: target.write_clustered("_by_gid", recordings, "gid", ["gid"]),
            "by name": lambda: target.write_clustered("_by_name", artists, "name_key", ["name_key"]),
        },
    )
    return done["names"]


def write_name_index(target: Snapshot) -> int:
    """Artists' names with their trigrams, the trigram order and the postings; the names' number.

    ``_postings`` is bucketed by trigram; ``_index`` tells how it was made.
    """
    spark = target.spark
    count = _write_counted(target, "_name_grams", distinct_names(target.read("mb_artist"), "name"))
    names = target.read("_name_grams")
    target.write("_frequent_grams", frequent_trigrams(names))
    rows = postings(names, _trigram_order(target))
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), ceil(count / BUCKET_NAMES))
    target.write_buckets("_postings", rows, "slot", buckets)
    made = [(buckets, DEFAULT_THRESHOLD, ROWS_PER_TASK)]
    target.write("_index", spark.createDataFrame(made, INDEX_SCHEMA).coalesce(1))
    return count


def read_name_index(target: Snapshot) -> NameIndex:
    """The written name index, ready for ``fuzzy_lookup``."""
    made = target.read("_index").first()
    rows = target.read_buckets("_postings", "slot", made["buckets"])
    return NameIndex(
        target.read("_name_grams"),
        _trigram_order(target),
        Postings(rows, made["threshold"], made["rows_per_task"]),
    )


def _trigram_order(target: Snapshot) -> tuple[tuple[int, int], ...]:
    return collect_order(target.read("_frequent_grams").orderBy(F.desc("n"), "code"))


def write_profiles(target: Snapshot) -> int:
    """Column statistics of every table, one file of a few rows per table."""

    def work(spec: TableSpec) -> int:
        target.write(f"_profile/{spec.table}", profile(target.read(spec.table), spec.table))
        return len(spec.columns)

    done = run_steps(target.spark, {spec.table: partial(work, spec) for spec in LOADED_TABLES})
    return sum(done.values())


def read_tables(target: Snapshot) -> dict[str, DataFrame]:
    """All published tables."""
    return {spec.table: target.read(spec.table) for spec in LOADED_TABLES}


def read_matched(target: Snapshot) -> DataFrame:
    """(id, by_name, by_alias) of the artists a build matched."""
    return target.read("_matched")

