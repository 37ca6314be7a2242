"""Rule-driven referential subset: keep what a set of root keys needs, table by table."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from functools import partial, reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from dumpwinnow.operators.keyjoin import BROADCAST_ROWS, distinct_keys, keep_by_keys
from dumpwinnow.plans.steps import run_steps

# Stands for the root key set in a rule's key sources.
ROOT = "<root>"


@dataclass(frozen=True)
class KeysOf:
    """A column whose values are wanted; ``kept`` False reads the table before the subset."""

    table: str
    column: str = "key"
    kept: bool = True


@dataclass(frozen=True)
class KeepRule:
    """Keep rows of ``table`` whose ``column`` is in any of ``wanted``; no column: keep all."""

    table: str
    column: str | None = None
    wanted: tuple[KeysOf, ...] = ()


@dataclass
class Subset:
    """Kept tables and, when they were written, their row counts."""

    tables: dict[str, DataFrame] = field(default_factory=dict)
    rows: dict[str, int] = field(default_factory=dict)
    seconds: dict[str, float] = field(default_factory=dict)


def check_rules(rules: Iterable[KeepRule]) -> None:
    """A rule may only want kept keys of tables that an earlier rule produced."""
    done = {ROOT}
    for rule in rules:
        missing = {w.table for w in rule.wanted if w.kept} - done
        if missing:
            raise ValueError(f"rule for {rule.table} needs {sorted(missing)} first")
        if rule.table in done:
            raise ValueError(f"two rules for {rule.table}")
        done.add(rule.table)


def rules_for(rules: Iterable[KeepRule], targets: Iterable[str]) -> tuple[KeepRule, ...]:
    """The rules that the given tables depend on, in order."""
    rules = tuple(rules)
    needed = set(targets)
    for rule in reversed(rules):
        if rule.table in needed:
            needed.update(w.table for w in rule.wanted if w.kept)
    return tuple(rule for rule in rules if rule.table in needed)


def tables_for(rules: Iterable[KeepRule]) -> set[str]:
    """The tables that rules read."""
    rules = tuple(rules)
    return {r.table for r in rules} | {w.table for r in rules for w in r.wanted if not w.kept}


def _wanted_keys(
    rule: KeepRule, tables: Mapping[str, DataFrame], kept: Mapping[str, DataFrame]
) -> DataFrame:
    """All key sources of a rule as one set; several sources are one union, not an OR."""
    parts = [
        distinct_keys(kept[w.table] if w.kept else tables[w.table], w.column) for w in rule.wanted
    ]
    return parts[0] if len(parts) == 1 else reduce(DataFrame.unionAll, parts).distinct()


def subset(
    tables: Mapping[str, DataFrame], rules: Iterable[KeepRule], root_keys: DataFrame
) -> dict[str, DataFrame]:
    """Kept tables as lazy plans, in rule order.  Tables without a rule are left out."""
    rules = tuple(rules)
    check_rules(rules)
    kept: dict[str, DataFrame] = {ROOT: root_keys}
    for rule in rules:
        rows = tables[rule.table]
        if rule.column is not None:
            rows = keep_by_keys(rows, rule.column, _wanted_keys(rule, tables, kept))
        kept[rule.table] = rows
    return {rule.table: kept[rule.table] for rule in rules}


def write_subset(
    tables: Mapping[str, DataFrame],
    rules: Iterable[KeepRule],
    root_keys: DataFrame,
    root_rows: int,
    write: Callable[[str, DataFrame], DataFrame],
    broadcast_rows: int = BROADCAST_ROWS,
) -> Subset:
    """Write each kept table once and build later rules on what was written.

    ``write(table, rows)`` stores the rows and returns the stored table.  Rows are counted
    while they are written; the counts bound the next key sets, which decides between a
    broadcast and a shuffled semi-join without another pass.  Rules that need nothing of each
    other run side by side.
    """
    rules = tuple(rules)
    check_rules(rules)
    kept: dict[str, DataFrame] = {ROOT: root_keys}
    counts: dict[str, int | None] = {ROOT: root_rows}
    seconds: dict[str, float] = {}

    def keep(rule: KeepRule) -> None:
        began = time.monotonic()
        rows = tables[rule.table]
        if rule.column is not None:
            bounds = [counts[w.table] if w.kept else None for w in rule.wanted]
            key_rows = None if None in bounds else sum(bounds)
            keys = _wanted_keys(rule, tables, kept)
            rows = keep_by_keys(rows, rule.column, keys, key_rows, broadcast_rows)
        seen = Observation(f"kept {rule.table}")
        counted = rows.observe(seen, F.count(F.lit(1)).alias("rows"))
        kept[rule.table] = write(rule.table, counted)
        counts[rule.table] = seen.get["rows"]
        seconds[rule.table] = time.monotonic() - began

    run_steps(
        root_keys.sparkSession,
        {rule.table: partial(keep, rule) for rule in rules},
        {rule.table: {w.table for w in rule.wanted if w.kept} for rule in rules},
    )
    return Subset(
        {rule.table: kept[rule.table] for rule in rules},
        {rule.table: counts[rule.table] for rule in rules},
        {rule.table: seconds[rule.table] for rule in rules},
    )
