"""Close a subset: add the parents that kept rows refer to, until no reference dangles.

A semi-naive fixpoint over key sets.  A round looks only at rows that the round before added:
the values of their references that no kept key has are looked up in the whole tables, and what
is found is the next round's input.  References may form cycles; a key is looked up once.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from functools import partial, reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from dumpwinnow.operators.keyjoin import KEY, distinct_keys, drop_by_keys, keep_by_keys
from dumpwinnow.plans.steps import run_steps
from dumpwinnow.sources.snapshots import Snapshot
from dumpwinnow.sources.specs import TableSpec


@dataclass
class Closed:
    """Tables with their parents, and how many rows each round added to each table."""

    tables: dict[str, DataFrame] = field(default_factory=dict)
    added: list[dict[str, int]] = field(default_factory=list)


def close_subset(
    tables: Mapping[str, DataFrame],
    kept: Mapping[str, DataFrame],
    specs: Iterable[TableSpec],
    scratch: Snapshot,
) -> Closed:
    """``kept`` with every row of ``tables`` that a reference of it leads to, step by step.

    Only references between tables of both mappings count.  A NULL refers to nothing, and a
    value that no row of the whole parent table has stays dangling, as it did there.  Parent rows
    that share a key come together.  Each round's rows are written to ``scratch`` and counted on
    the way; a parent that nothing new refers to is not read.
    """
    references = [
        (spec.table, column, parent, key)
        for spec in specs
        for column, parent, key in spec.foreign_keys
        if spec.table in kept and parent in kept and parent in tables
    ]
    keys_of = {(parent, key) for _, _, parent, key in references}
    if len(keys_of) > len({parent for parent, _ in keys_of}):
        raise ValueError("a table is referred to by several keys; its rows might come twice")
    result = Closed(dict(kept))
    # keys that were kept or asked for, so that none is asked for again
    known = {
        (parent, key): [scratch.write(f"known/{parent}/{key}/0", distinct_keys(kept[parent], key))]
        for parent, key in sorted(keys_of)
    }
    fresh: dict[str, DataFrame] = dict(kept)
    while fresh:
        number = len(result.added) + 1
        asked = {
            target: _asked([(fresh[t], c) for t, c, *of in references if tuple(of) == target and t in fresh])
            for target in sorted(keys_of)
        }
        work = {
            f"{parent}.{key}": partial(
                _look_up, tables[parent], parent, key, wanted, known[parent, key], scratch, number
            )
            for (parent, key), wanted in asked.items()
            if wanted is not None
        }
        found = run_steps(scratch.spark, work)
        fresh, counts = {}, {}
        for (parent, key), wanted in asked.items():
            if wanted is None:
                continue
            keys, rows, count = found[f"{parent}.{key}"]
            if keys is not None:
                known[parent, key].append(keys)
            if count:
                more = [fresh[parent], rows] if parent in fresh else [rows]
                fresh[parent] = reduce(DataFrame.unionByName, more)
                counts[parent] = counts.get(parent, 0) + count
        for parent, rows in fresh.items():
            result.tables[parent] = result.tables[parent].unionByName(rows)
        if fresh:
            result.added.append(counts)
    return result


def _asked(columns: list[tuple[DataFrame, str]]) -> DataFrame | None:
    """All values of some reference columns as one key set."""
    parts = [distinct_keys(rows, column) for rows, column in columns]
    return reduce(DataFrame.unionByName, parts).distinct() if parts else None


def _look_up(
    table: DataFrame,
    parent: str,
    key: str,
    wanted: DataFrame,
    known: list[DataFrame],
    scratch: Snapshot,
    number: int,
) -> tuple[DataFrame | None, DataFrame | None, int]:
    """New keys among the wanted, the rows that have them, and their number."""
    seen = Observation(f"asked {parent}.{key} {number}")
    new = drop_by_keys(wanted.toDF("asked"), "asked", reduce(DataFrame.unionByName, known))
    new = new.toDF(KEY)
    keys = scratch.write(
        f"known/{parent}/{key}/{number}", new.observe(seen, F.count(F.lit(1)).alias("n"))
    )
    count = seen.get["n"]
    if not count:
        return None, None, 0
    found = Observation(f"found {parent}.{key} {number}")
    rows = keep_by_keys(table, key, keys, count)
    rows = scratch.write(
        f"added/{parent}/{key}/{number}", rows.observe(found, F.count(F.lit(1)).alias("n"))
    )
    return keys, rows, found.get["n"]
