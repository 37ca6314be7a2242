"""The published snapshot as catalog views, and the removal of old snapshots."""

from __future__ import annotations

import logging
from collections.abc import Iterable

from pyspark.sql import SparkSession

from dumpwinnow.sources.files import age_seconds, list_names, path_exists, remove_tree
from dumpwinnow.sources.snapshots import LINE, REASON, ROWS, VERDICT, Snapshot, SnapshotStore
from dumpwinnow.sources.specs import LOADED_TABLES

log = logging.getLogger(__name__)


def publish_views(
    store: SnapshotStore,
    database: str,
    tables: Iterable[str] = tuple(spec.table for spec in LOADED_TABLES),
) -> Snapshot:
    """Point one view for each table at the published snapshot; returns that snapshot.

    A view is replaced in one step, the set of views one after the other: who needs all tables
    of the same snapshot takes the snapshot.  Views name files, so they stay good as long as
    the snapshot does, in every session of a shared catalog.
    """
    snapshot = store.current()
    if snapshot is None:
        raise ValueError(f"nothing is published at {store.root}")
    spark = store.spark
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for table in tables:
        columns = spark.read.parquet(snapshot.table_path(table)).columns
        own = ", ".join(f"`{c}`" for c in columns if c not in (VERDICT, LINE, REASON))
        only = f" WHERE `{VERDICT}` = '{ROWS}'" if VERDICT in columns else ""
        spark.sql(
            f"CREATE OR REPLACE VIEW {database}.{table} AS "
            f"SELECT {own} FROM parquet.`{snapshot.table_path(table)}`{only}"
        )
    return snapshot


def vacuum(
    store: SnapshotStore, keep: int = 2, least_age: float = 3600.0, dry_run: bool = False
) -> list[str]:
    """Delete old snapshots; returns the names of those deleted, oldest last.

    The published one stays, and so do the ``keep`` newest others, those with a lease, and all
    younger than ``least_age`` seconds.  A snapshot's age is that of its last ledger entry;
    folders without a ledger are none of the store's and are left alone.
    """
    spark = store.spark
    published = (store.current_name() or "").split("/")[0]
    found = []
    for name in list_names(spark, store.root):
        path = f"{store.root}/{name}"
        if name == published or not path_exists(spark, f"{path}/_ledger"):
            continue
        steps = list_names(spark, f"{path}/_ledger")
        ages = [age_seconds(spark, f"{path}/_ledger/{step}") for step in steps]
        found.append((min([a for a in ages if a is not None], default=0.0), name))
    old = [
        name
        for age, name in sorted(found)[keep:]
        if age >= least_age and not path_exists(spark, f"{store.root}/{name}/_lease")
    ]
    for name in old if not dry_run else ():
        remove_tree(spark, f"{store.root}/{name}")
        log.info("removed snapshot %s", name)
    return old


def remove_scratch(spark: SparkSession, root: str, least_age: float = 86_400.0) -> list[str]:
    """Delete folders of intermediate tables that were made some time ago; returns their names.

    They are the ones that scratch_snapshot makes below ``root``.  ``least_age`` must be longer
    than any query that still reads its own takes.
    """
    removed = []
    for name in list_names(spark, root):
        age = age_seconds(spark, f"{root}/{name}") if name.startswith("scratch-") else None
        if age is not None and age >= least_age:
            remove_tree(spark, f"{root}/{name}")
            removed.append(name)
    return removed
