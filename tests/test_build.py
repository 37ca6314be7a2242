import logging
import os
import threading
import time
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from dumpwinnow.operators.fuzzy import fuzzy_lookup
from dumpwinnow.plans import build as plan
from dumpwinnow.plans.build import (
    STEPS,
    Done,
    Ledger,
    build,
    filter_tables,
    import_dump,
    read_matched,
    read_name_index,
    read_tables,
)
from dumpwinnow.plans.lease import LeaseHeld, exclusive
from dumpwinnow.plans.steps import FREE_SHUFFLES, freed_shuffles, run_steps
from dumpwinnow.sources import dump as dump_source
from dumpwinnow.sources.dump import load_table
from dumpwinnow.sources.files import (
    create_new,
    path_exists,
    read_pointer,
    remove,
    write_pointer,
)
from dumpwinnow.sources.snapshots import (
    Snapshot,
    SnapshotStore,
    analyze_tables,
    create_tables,
    drop_tables,
    fill_if_empty,
)
from dumpwinnow.sources.specs import ALL_TABLES, spec_for
from dumpwinnow.sources.views import publish_views, vacuum
from sample.queries import _write_dump
from tests.fixture_rows import (
    FIRST,
    FIRST_KEPT,
    FIRST_LIBRARY,
    FIRST_LOADED,
    SECOND,
    SECOND_KEPT,
    SECOND_LIBRARY,
    write_dump,
)


def names(spark, values):
    return spark.createDataFrame([(v,) for v in values], "artist string")


def counts(snapshot):
    return {t: df.count() for t, df in read_tables(snapshot).items()}


def test_full_build_and_publish(spark, tmp_path):
    root, dump = str(tmp_path / "out"), write_dump(tmp_path / "dump", FIRST)
    store = SnapshotStore(spark, root)
    assert store.current() is None
    snapshot = build(spark, dump, root, "s1", names(spark, FIRST_LIBRARY))
    assert counts(snapshot) == FIRST_KEPT
    assert store.current().path == snapshot.path
    assert sorted(r["id"] for r in read_matched(snapshot).collect()) == [100, 200, 300]
    assert [r["step"] for r in Ledger(snapshot).entries().collect()] == sorted(STEPS)
    profile = snapshot.read("_profile/mb_artist").filter("column = 'id'").first()
    assert (profile["rows"], profile["min"], profile["max"]) == (3, "100", "300")
    hits = fuzzy_lookup(
        spark.createDataFrame([("ostrevanne",)], "request string"),
        snapshot.read("mb_artist"),
        read_name_index(snapshot),
    )
    assert [r["id"] for r in hits.collect()] == [100]

    second = build(
        spark, write_dump(tmp_path / "dump2", SECOND), root, "s2", names(spark, SECOND_LIBRARY)
    )
    assert store.current().path == second.path
    assert counts(second) == SECOND_KEPT
    assert counts(snapshot) == FIRST_KEPT


def shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    folders = [Path(str(folder)) for folder in manager.localDirs()]
    return {file.name for folder in folders for file in folder.glob("*/shuffle_*")}


def test_build_frees_its_shuffle_files(spark, tmp_path):
    setting = spark.conf.get(FREE_SHUFFLES)
    dump, before = write_dump(tmp_path / "dump", FIRST), shuffle_files(spark)
    build(spark, dump, str(tmp_path / "out"), "s", names(spark, FIRST_LIBRARY))
    until = time.monotonic() + 5
    while shuffle_files(spark) - before and time.monotonic() < until:
        time.sleep(0.2)
    assert shuffle_files(spark) - before == set()
    assert spark.conf.get(FREE_SHUFFLES) == setting


def test_side_by_side_work_puts_the_setting_back(spark):
    setting = spark.conf.get(FREE_SHUFFLES)
    with pytest.raises(RuntimeError), freed_shuffles(spark):
        with freed_shuffles(spark):
            assert spark.conf.get(FREE_SHUFFLES) == "true"
        assert spark.conf.get(FREE_SHUFFLES) == "true"
        raise RuntimeError
    assert spark.conf.get(FREE_SHUFFLES) == setting


def test_stored_tables_and_bloom_filters_are_small(spark, tmp_path):
    target = Snapshot(spark, str(tmp_path))
    rows = spark.range(1000).select(F.md5(F.col("id").cast("string")).alias("gid"))
    target.write("plain", rows)
    target.write_clustered("by_gid", rows, "gid", ["gid"], files=4)
    target.write_buckets("buckets", rows, "gid", 2)
    for table in ("plain", "by_gid", "buckets"):
        files = list((tmp_path / table).glob("part-*"))
        kinds = {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files}
        assert kinds == {"ZSTD"}
    # 250 values a file; a filter for a million values takes 1 MB
    sizes = [file.stat().st_size for file in (tmp_path / "by_gid").glob("part-*")]
    assert len(sizes) == 4 and max(sizes) < 20_000


def test_dump_is_stored_zipped_and_read_as_it_was(spark, tmp_path):
    rows = spark.range(500).select(
        F.col("id").cast("int").alias("r_regionkey"),
        F.concat(F.lit("a\\\tb\r"), "id").alias("r_name"),
    )
    rows.write.parquet(str(tmp_path / "region.parquet"))
    others = tuple(s.table for s in ALL_TABLES if s.table != "mb_area_type")
    dump = _write_dump(spark, str(tmp_path), str(tmp_path / "dump"), others)
    files = list((tmp_path / "dump" / "area_type").glob("part-*"))
    assert files and all(file.suffix == ".gz" for file in files)
    parsed = load_table(spark, spec_for("mb_area_type"), dump, "tolerant")
    assert sorted(map(tuple, parsed.rows.collect())) == sorted(map(tuple, rows.collect()))
    assert parsed.rejects.isEmpty()


def test_build_without_filter(spark, tmp_path):
    root, dump = str(tmp_path / "out"), write_dump(tmp_path / "dump", FIRST)
    with pytest.raises(ValueError, match="library"):
        build(spark, dump, root, "s", None)
    snapshot = build(spark, dump, root, "s", None, keep_all=True)
    assert counts(snapshot) == FIRST_LOADED
    assert SnapshotStore(spark, root).current().path == snapshot.path
    assert Ledger(SnapshotStore(spark, root).snapshot("s")).pending() == ()


def test_resume_runs_only_what_is_left(spark, tmp_path, monkeypatch, caplog):
    root, dump = str(tmp_path / "out"), write_dump(tmp_path / "dump", FIRST)
    library = names(spark, FIRST_LIBRARY)

    def fail(_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(plan, "write_profiles", fail)
        with pytest.raises(RuntimeError, match="lost"):
            build(spark, dump, root, "s", library)
    store = SnapshotStore(spark, root)
    ledger = Ledger(store.snapshot("s"))
    assert ledger.pending() == ("analyze",)
    assert store.current() is None

    with pytest.raises(FileExistsError, match="resume"):
        build(spark, dump, root, "s", library)

    with monkeypatch.context() as patch:
        patch.setattr(plan, "import_dump", fail)
        patch.setattr(plan, "filter_tables", fail)
        snapshot = build(spark, dump, root, "s", library, resume=True)
    assert counts(snapshot) == FIRST_KEPT
    assert ledger.pending() == ()

    with caplog.at_level(logging.WARNING):
        build(spark, dump, root, "fresh", library, resume=True)
    assert "nothing to resume" in caplog.text


def test_one_build_at_a_time_under_a_name(spark, tmp_path, monkeypatch):
    """A second start is refused while the first runs, and takes over after it died."""
    root, dump = str(tmp_path / "out"), write_dump(tmp_path / "dump", FIRST)
    library = names(spark, FIRST_LIBRARY)
    snapshot = SnapshotStore(spark, root).snapshot("s")
    inside, refused = threading.Event(), []
    work = plan.write_profiles

    def slow(target):
        inside.set()
        with pytest.raises(LeaseHeld, match="running build"):
            build(spark, dump, root, "s", library, resume=True)
        refused.append(True)
        return work(target)

    with monkeypatch.context() as patch:
        patch.setattr(plan, "write_profiles", slow)
        build(spark, dump, root, "s", library)
    assert refused and not path_exists(spark, f"{snapshot.path}/_lease")

    # a holder without a heartbeat: refused at first, taken over later
    assert create_new(spark, f"{snapshot.path}/_lease", "dead")
    assert not create_new(spark, f"{snapshot.path}/_lease", "late")
    assert not any("late" in p for p in os.listdir(snapshot.path))
    with pytest.raises(LeaseHeld):
        build(spark, dump, root, "s", library, resume=True)
    time.sleep(0.3)
    build(spark, dump, root, "s", library, resume=True, lease_seconds=0.2)

    # who lost the lease stops before its next step
    with pytest.raises(LeaseHeld, match="taken over"), exclusive(snapshot) as held:
        write_pointer(spark, f"{snapshot.path}/_lease", "other")
        held()
    assert read_pointer(spark, f"{snapshot.path}/_lease") == "other"


def test_a_live_build_keeps_its_lease(spark, tmp_path):
    snapshot = Snapshot(spark, str(tmp_path))
    with exclusive(snapshot, seconds=1.0) as held:
        time.sleep(1.6)
        held()
        with pytest.raises(LeaseHeld), exclusive(snapshot, seconds=1.0):
            pass
    with exclusive(snapshot):
        pass


def test_views_follow_what_is_published(spark, tmp_path):
    """Views over a filtered and an unfiltered build, with rejects beside the rows."""
    root, dump = str(tmp_path / "out"), write_dump(tmp_path / "dump", FIRST)
    with open(f"{dump}/gender", "a", encoding="utf-8") as out:
        out.write("x\tbad\n")
    store = SnapshotStore(spark, root)
    with pytest.raises(ValueError, match="nothing is published"):
        publish_views(store, "views_test")
    view = lambda t: spark.table(f"views_test.{t}")
    one = build(spark, dump, root, "one", names(spark, FIRST_LIBRARY), mode="tolerant")
    assert publish_views(store, "views_test").path == one.path
    assert {t: view(t).count() for t in FIRST_KEPT} == FIRST_KEPT
    build(spark, dump, root, "two", None, keep_all=True, mode="tolerant")
    assert view("mb_artist").count() == FIRST_KEPT["mb_artist"]  # not yet moved
    publish_views(store, "views_test")
    assert {t: view(t).count() for t in FIRST_LOADED} == FIRST_LOADED
    assert view("mb_gender").columns == ["id", "name"]

    # retention: the published one and the newest others stay
    for name in ("three", "four"):
        store.publish("two/loaded")
        Ledger(store.snapshot(name)).mark("schema", Done(1))
        time.sleep(1.1)
    create_new(spark, f"{root}/one/_lease", "busy")
    assert vacuum(store, keep=1, least_age=0) == ["three"]
    assert vacuum(store, keep=0, least_age=3600) == []
    assert vacuum(store, keep=0, least_age=0, dry_run=True) == ["four"]
    remove(spark, f"{root}/one/_lease")
    assert vacuum(store, keep=0, least_age=0) == ["four", "one"]
    assert sorted(n for n in os.listdir(root) if not n.startswith(".")) == ["CURRENT", "two"]
    assert {t: view(t).count() for t in FIRST_LOADED} == FIRST_LOADED


def test_unknown_and_unfinished_entries_are_ignored(spark, tmp_path):
    ledger = Ledger(Snapshot(spark, str(tmp_path)))
    assert (ledger.completed(), ledger.exists()) == (set(), False)
    assert ledger.entries().isEmpty()
    ledger.mark("import", Done(5))
    ledger.mark("no such step", Done(1))
    (tmp_path / "_ledger" / "filter").mkdir()
    assert ledger.completed() == {"import"}
    ledger.mark("import", Done(7, 2), 1.5)
    assert [(r["step"], r["rows"], r["rejects"], r["seconds"]) for r in ledger.entries().collect()] == [
        ("import", 7, 2, 1.5)
    ]


def test_steps_are_idempotent(spark, tmp_path):
    dump = write_dump(tmp_path / "dump", FIRST)
    loaded, kept = Snapshot(spark, str(tmp_path / "l")), Snapshot(spark, str(tmp_path / "k"))
    library = names(spark, FIRST_LIBRARY)
    assert import_dump(spark, dump, loaded) == FIRST_LOADED
    assert import_dump(spark, dump, loaded) == FIRST_LOADED
    assert set(import_dump(spark, dump, loaded, fresh=False).values()) == {0}
    assert counts(loaded) == FIRST_LOADED
    for _ in range(2):
        assert filter_tables(loaded, kept, library) == Done(sum(FIRST_KEPT.values()))
        assert counts(kept) == FIRST_KEPT
        plan.write_indexes(kept)
        plan.write_profiles(kept)
        assert kept.read("_name_grams").count() == 3


def test_import_missing_file_and_rejects(spark, tmp_path):
    dump = write_dump(tmp_path / "dump", FIRST, skip=("mb_tag",))
    with open(f"{dump}/gender", "a", encoding="utf-8") as out:
        out.write("x\tbad\nshort\n")
    target = Snapshot(spark, str(tmp_path / "out"))
    rows = import_dump(spark, dump, target, mode="tolerant")
    assert (rows["mb_tag"], rows["mb_gender"]) == (0, 3)
    rejects = {tuple(r) for r in target.rejects("mb_gender").collect()}
    assert rejects == {("x\tbad", "bad value: id"), ("short", "short row")}
    assert target.rejects("mb_artist").isEmpty() and target.rejects("mb_tag").isEmpty()
    assert target.read("mb_tag").columns == ["id", "name"] and target.read("mb_tag").isEmpty()
    assert {r["table"]: r["rejects"] for r in target.read("_import").collect()}["mb_gender"] == 2
    with pytest.raises(Exception, match="bad value for id"):
        import_dump(spark, dump, target)
    with pytest.raises(FileNotFoundError):
        import_dump(spark, str(tmp_path / "nowhere"), target)


def test_rejects_survive_a_crash_and_are_never_stale(spark, tmp_path, monkeypatch):
    dump = write_dump(tmp_path / "dump", FIRST)
    with open(f"{dump}/gender", "a", encoding="utf-8") as out:
        out.write("x\tbad\n")
    target = Snapshot(spark, str(tmp_path / "out"))
    store = Snapshot.write_verdicts

    def dies(self, table, lines, columns):
        if table == "mb_gender":
            raise RuntimeError("lost")
        return store(self, table, lines, columns)

    with monkeypatch.context() as patch:
        patch.setattr(Snapshot, "write_verdicts", dies)
        with pytest.raises(RuntimeError, match="lost"):
            import_dump(spark, dump, target, mode="tolerant")
    assert not target.has("mb_gender")
    import_dump(spark, dump, target, mode="tolerant", fresh=False)
    assert target.rejects("mb_gender").count() == 1
    assert target.read("mb_gender").count() == FIRST_LOADED["mb_gender"]
    assert import_dump(spark, dump, target, mode="tolerant", fresh=False)["mb_gender"] == 0
    assert {r["table"]: r["rejects"] for r in target.read("_import").collect()}["mb_gender"] == 1
    import_dump(spark, write_dump(tmp_path / "clean", FIRST), target, mode="tolerant")
    assert target.rejects("mb_gender").isEmpty()


def test_a_dirty_dump_is_parsed_once(spark, tmp_path):
    """Rows and rejects come from the same evaluation of every line."""
    dump = write_dump(tmp_path / "dump", FIRST)
    with open(f"{dump}/gender", "a", encoding="utf-8") as out:
        out.write("x\tbad\n")
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(line):
        seen.add(1)
        return line

    read_lines = dump_source.read_lines
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(
            dump_source, "read_lines", lambda s, p: read_lines(s, p).select(counted("value").alias("value"))
        )
        target = Snapshot(spark, str(tmp_path / "out"))
        import_dump(spark, dump, target, mode="tolerant")
    assert seen.value == sum(FIRST_LOADED.values()) + 1
    assert target.rejects("mb_gender").count() == 1


def test_steps_run_after_what_they_need(spark):
    order, at_once, most = [], [], []
    lock = threading.Lock()

    def piece(name, fails=False):
        def run():
            with lock:
                at_once.append(name)
                most.append(len(at_once))
            time.sleep(0.05)
            with lock:
                at_once.remove(name)
                order.append(name)
            if fails:
                raise RuntimeError(name)
            return name.upper()

        return run

    needs = {"c": ("a", "b"), "d": ("c", "elsewhere"), "e": ("a",)}
    found = run_steps(spark, {n: piece(n) for n in "dceab"}, needs, at_once=3)
    assert found == {n: n.upper() for n in "dceab"} and max(most) > 1
    assert all(order.index(n) < order.index(m) for m, ns in needs.items() for n in ns if n in order)
    order.clear()
    with pytest.raises(RuntimeError, match="a"):
        run_steps(spark, {n: piece(n, n == "a") for n in "abcde"}, needs, at_once=2)
    assert not {"c", "d", "e"} & set(order)
    with pytest.raises(ValueError, match="need each other"):
        run_steps(spark, {"a": piece("a"), "b": piece("b")}, {"a": ("b",), "b": ("a",)})


def test_tolerant_build(spark, tmp_path):
    dump = write_dump(tmp_path / "dump", FIRST)
    with open(f"{dump}/gender", "a", encoding="utf-8") as out:
        out.write("1\tagain\n")
    library = names(spark, [*FIRST_LIBRARY, None])
    with pytest.raises(ValueError, match="duplicate primary keys"):
        build(spark, dump, str(tmp_path / "strict"), "s", library)
    snapshot = build(spark, dump, str(tmp_path / "out"), "s", library, mode="tolerant", drop_blank=True)
    ledger = Ledger(SnapshotStore(spark, str(tmp_path / "out")).snapshot("s"))
    entries = {r["step"]: r for r in ledger.entries().collect()}
    assert entries["filter"]["rejects"] == 1
    assert entries["schema"]["rows"] == 20
    assert snapshot.read("mb_artist").count() == FIRST_KEPT["mb_artist"]
    kept = {r["table"]: r for r in snapshot.read("_kept").collect()}
    assert kept["mb_track"]["rows"] == FIRST_KEPT["mb_track"] and kept["mb_track"]["seconds"] > 0
    assert all(snapshot.has(spec.table) for spec in ALL_TABLES)


def test_catalog_tables(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS catalog_test")
    create_tables(spark, "catalog_test")
    rows = spark.createDataFrame([(1, "Male"), (2, "Female")], "id int, name string")
    assert fill_if_empty("catalog_test.mb_gender", rows)
    create_tables(spark, "catalog_test")
    assert not fill_if_empty("catalog_test.mb_gender", rows)
    assert spark.table("catalog_test.mb_gender").count() == 2
    columns = [c.name for c in spark.catalog.listColumns("catalog_test.mb_artist")]
    assert columns == [
        "id", "name", "sort_name", "type", "area", "gender", "begin_area", "comment",
    ]
    analyze_tables(spark, ["catalog_test.mb_gender"])
    described = spark.sql("DESCRIBE EXTENDED catalog_test.mb_gender name").collect()
    assert {r["info_name"]: r["info_value"] for r in described}["distinct_count"] == "2"
    spark.sql("CREATE TABLE catalog_test.other (x int) USING parquet")
    assert len(drop_tables(spark, "catalog_test")) == 20
    assert [t.name for t in spark.catalog.listTables("catalog_test")] == ["other"]
