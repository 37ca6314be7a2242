"""Integrity checks, row counts and column profiles."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dumpwinnow.functions.copytext import try_uuid
from dumpwinnow.operators.keyjoin import KEY, distinct_keys, drop_by_keys
from dumpwinnow.sources.specs import TableSpec


def _union(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, parts)


# -- keys and references ---------------------------------------------------------------


def null_violations(table: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """(table, column, violations) of columns that must not be NULL, in one pass."""
    counted = table.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return _melt(counted, columns, "violations", name)


def duplicate_keys(table: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their row count ``n``."""
    return table.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def orphan_rows(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Child rows that refer to no parent row; a NULL reference is no violation.

    Whole rows are shuffled here, so the rows of a parent that many refer to are spread.
    """
    referring = child.filter(F.col(column).isNotNull())
    return drop_by_keys(referring, column, distinct_keys(parent, key), spread=True)


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Referenced values without a parent as (key, n).

    References are counted per value before the join, so a value that a large share of the
    rows refer to is one row per task by the time it is shuffled.
    """
    counted = (
        child.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("reference"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    orphans = drop_by_keys(counted, "reference", distinct_keys(parent, key))
    return orphans.select(F.col("reference").alias(KEY), "n")


def unused_rows(parent: DataFrame, key: str, child: DataFrame, column: str) -> DataFrame:
    """Parent rows that no child row refers to."""
    return drop_by_keys(parent, key, distinct_keys(child, column))


def malformed_uuids(table: DataFrame, column: str) -> DataFrame:
    """Rows whose value is no UUID in any accepted spelling."""
    return table.filter(F.col(column).isNotNull() & try_uuid(F.col(column)).isNull())


def integrity_report(tables: Mapping[str, DataFrame], specs: Iterable[TableSpec]) -> DataFrame:
    """Violations of every declared constraint as (check, table, columns, violations).

    Broken references are findings, not failures: a subset may keep a track whose own
    credit was not kept.  Every table is read twice: once for all its NULL counts, once for
    the values of all its keys and references.  A value is shuffled with a number that stands
    for its key and one for the constraint, as numbers where the key is numeric, and counted
    in its own task before that; so a value that many rows share is one row per task by then.
    """
    specs = [spec for spec in specs if spec.table in tables]
    found = _null_findings(tables, specs)
    domains = _domains(tables, specs)
    for numeric in (True, False):
        own = [d for d in domains if d.numeric == numeric]
        if own:
            found.append(_key_findings(tables, own))
    return _union(found)


FINDINGS_SCHEMA = "check string, table string, columns string, violations long"
# Keys and references whose values are shuffled at once, at some 13 bytes each.
PART_VALUES = 10_000_000


def integrity_parts(
    tables: Mapping[str, DataFrame],
    specs: Iterable[TableSpec],
    rows: Mapping[str, int],
    part_values: int = PART_VALUES,
) -> list[DataFrame]:
    """The rows of :func:`integrity_report` in several results, for stored tables.

    Run one after the other, each shuffles the values of some keys and their references:
    ``part_values`` at most by the tables' ``rows``, or those of one key.  A table is read once
    for each part that has a column of it, and only these columns.
    """
    specs = [spec for spec in specs if spec.table in tables]
    nulls = _null_findings(tables, specs)
    found = [_union(nulls)] if nulls else []
    domains = _domains(tables, specs)
    for numeric in (True, False):
        part, held = [], 0
        for d in (d for d in domains if d.numeric == numeric):
            values = rows[d.table] + sum(rows[table] for table, _ in d.references)
            if part and held + values > part_values:
                found.append(_key_findings(tables, part))
                part, held = [], 0
            part.append(d)
            held += values
        if part:
            found.append(_key_findings(tables, part))
    return found


def _null_findings(
    tables: Mapping[str, DataFrame], specs: Iterable[TableSpec]
) -> list[DataFrame]:
    nulls = [
        null_violations(tables[spec.table], spec.required_columns, spec.table)
        for spec in specs
        if spec.required_columns
    ]
    return [
        n.select(
            F.lit("not null").alias("check"), "table", F.col("column").alias("columns"), "violations"
        )
        for n in nulls
    ]


PRIMARY, FOREIGN = "primary key", "foreign key"
NUMBERS = ("tinyint", "smallint", "int", "bigint")
# Columns of a numeric key that travel as numbers; longer keys go as text.
KEY_COLUMNS = 2


@dataclass
class _Domain:
    """Values that one key defines: the key itself and its references."""

    number: int
    table: str
    columns: tuple[str, ...]
    numeric: bool
    declared: bool = False  # as a primary key, so that duplicates are violations
    references: list[tuple[str, str]] = field(default_factory=list)  # table, column

    def checks(self) -> list[tuple[int, str, str, str]]:
        """(slot, check, table, columns): slot 0 is the key, the others are references."""
        found = [(0, PRIMARY, self.table, ", ".join(self.columns))] if self.declared else []
        return found + [(k, FOREIGN, t, c) for k, (t, c) in enumerate(self.references, 1)]


def _domains(tables: Mapping[str, DataFrame], specs: Sequence[TableSpec]) -> list[_Domain]:
    types = {spec.table: dict(tables[spec.table].dtypes) for spec in specs}
    found: dict[tuple[str, tuple[str, ...]], _Domain] = {}

    def domain(table: str, columns: tuple[str, ...]) -> _Domain:
        numeric = len(columns) <= KEY_COLUMNS and all(types[table][c] in NUMBERS for c in columns)
        return found.setdefault((table, columns), _Domain(len(found), table, columns, numeric))

    for spec in specs:
        if spec.primary_key:
            domain(spec.table, spec.primary_key).declared = True
    for spec in specs:
        for column, parent, key in spec.foreign_keys:
            if parent in tables:
                own = domain(parent, (key,))
                own.numeric &= types[spec.table][column] in NUMBERS
                own.references.append((spec.table, column))
    return list(found.values())


def _key_findings(tables: Mapping[str, DataFrame], domains: Sequence[_Domain]) -> DataFrame:
    """Duplicate keys and references without a key, zero where there is none.

    The entries of one value, its key's and its references', meet in one shuffle and are
    counted by slot in plain sums.
    """
    numeric = domains[0].numeric
    no_value = F.lit(None).cast("bigint" if numeric else "string")

    def entry(number: int, slot: int, columns: Sequence[str]) -> Column:
        if numeric:
            parts = [F.col(c).cast("bigint") for c in columns]
        elif len(columns) == 1:
            parts = [F.col(columns[0]).cast("string")]
        else:
            texts = [F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns]
            parts = [F.concat_ws("\x1f", *texts)]
        parts += [no_value] * (KEY_COLUMNS - len(parts))
        names = [part.alias(f"v{k}") for k, part in enumerate(parts)]
        return F.struct(F.lit(number).alias("domain"), F.lit(slot).alias("slot"), *names)

    entries: dict[str, list[Column]] = {}
    for d in domains:
        entries.setdefault(d.table, []).append(entry(d.number, 0, d.columns))
        for slot, (table, column) in enumerate(d.references, 1):
            entries.setdefault(table, []).append(entry(d.number, slot, [column]))
    values = _union(
        tables[table].select(F.inline(F.array(*own))) for table, own in entries.items()
    ).filter("slot = 0 OR v0 IS NOT NULL")
    slots = range(max(len(d.references) for d in domains) + 1)
    width = max(len(d.columns) for d in domains) if numeric else 1
    by = ["domain"] * (len(domains) > 1) + ["v0", "v1"][:width]
    counted = values.groupBy(*by).agg(
        *[F.count_if(F.col("slot") == k).alias(f"n{k}") for k in slots]
    )
    if len(domains) == 1:
        counted = counted.withColumn("domain", F.lit(domains[0].number))
    wrong = [F.sum((F.col("n0") > 1).cast("long")).alias("w0")]
    wrong += [F.sum(F.when(F.col("n0") == 0, F.col(f"n{k}"))).alias(f"w{k}") for k in slots if k]
    totals = counted.groupBy("domain").agg(F.array(*wrong).alias("wrong"))
    checks = [(d.number, *check) for d in domains for check in d.checks()]
    declared = tables[next(iter(entries))].sparkSession.createDataFrame(
        checks, "domain int, slot int, check string, table string, columns string"
    )
    return declared.join(totals, "domain", "left").select(
        "check",
        "table",
        "columns",
        F.coalesce(F.get("wrong", F.col("slot")), F.lit(0)).cast("long").alias("violations"),
    )


def _melt(one_row: DataFrame, columns: Sequence[str], value: str, name: str) -> DataFrame:
    """One wide row to (table, column, value) rows."""
    entries = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).alias(value)) for c in columns]
    )
    return one_row.select(F.lit(name).alias("table"), F.inline(entries))


# -- sizes -----------------------------------------------------------------------------


def table_sizes(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, rows) of every table."""
    return _union(
        table.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, table in tables.items()
    )


def compare_sizes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Two size reports side by side; a table missing on one side has NULL there."""
    return before.withColumnRenamed("rows", "rows_before").join(
        after.withColumnRenamed("rows", "rows_after"), "table", "full_outer"
    ).withColumn("same", F.col("rows_before").eqNullSafe(F.col("rows_after")))


# -- profile ---------------------------------------------------------------------------


def _distinct_sketch(column: Column, type_name: str) -> Column:
    """Approximate distinct count from a sketch held as one binary buffer per column."""
    if type_name in ("boolean", "tinyint", "smallint"):
        column = column.cast("int")
    elif type_name not in ("int", "bigint", "string"):
        column = column.cast("string")
    return F.hll_sketch_estimate(F.hll_sketch_agg(column))


def profile(table: DataFrame, name: str, exact_distinct: bool = False) -> DataFrame:
    """(table, column, rows, nulls, distinct, min, max) per column; min and max as text.

    Distinct counts are sketches gathered in the same single pass.  ``exact_distinct``
    counts (column, value) pairs with map-side aggregation instead.
    """
    columns, types = table.columns, dict(table.dtypes)

    def statistics(c: str) -> Column:
        column = F.col(c)
        return F.struct(
            F.lit(c).alias("column"),
            F.count(F.lit(1)).alias("rows"),
            F.count_if(column.isNull()).alias("nulls"),
            _distinct_sketch(column, types[c]).alias("distinct"),
            F.min(column).cast("string").alias("min"),
            F.max(column).cast("string").alias("max"),
        )

    summary = table.agg(F.array(*[statistics(c) for c in columns]).alias("s")).select(
        F.lit(name).alias("table"), F.inline("s")
    )
    if not exact_distinct:
        return summary
    entries = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v")) for c in columns]
    )
    pairs = table.select(F.inline(entries)).filter(F.col("v").isNotNull()).distinct()
    exact = pairs.groupBy("column").agg(F.count(F.lit(1)).alias("exact"))
    return summary.join(exact, "column", "left").select(
        "table",
        "column",
        "rows",
        "nulls",
        F.coalesce("exact", F.lit(0)).alias("distinct"),
        "min",
        "max",
    )


# -- profiles that can be merged -------------------------------------------------------

NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")
# A quantile's rank is off by 2 % at most, with 99 % certainty.
QUANTILE_ITEMS = 200


def profile_sketches(table: DataFrame, name: str) -> DataFrame:
    """Statistics of one set of rows, one row per column, for :func:`merge_profiles`.

    (table, column, type, rows, nulls, distinct_sketch, quantile_sketch, low_number, high_number,
    low, high).  Sketches are binary and of bounded size.  Numbers are taken as doubles for
    quantiles and order; other types have neither, their low and high are by text.
    """

    def statistics(column: str, kind: str) -> Column:
        value = F.col(column)
        numeric = kind.split("(")[0] in NUMERIC
        number = value.cast("double") if numeric else F.lit(None).cast("double")
        text = value.cast("string")
        none = F.lit(None).cast("binary")
        # the sketch takes values alone, and one of no values is none
        sketch = F.when(
            F.count(number) > 0, F.kll_sketch_agg_double(number, QUANTILE_ITEMS)
        ).otherwise(none)
        return F.struct(
            F.lit(column).alias("column"),
            F.lit(kind).alias("type"),
            F.count(F.lit(1)).alias("rows"),
            F.count_if(value.isNull()).alias("nulls"),
            F.hll_sketch_agg(text).alias("distinct_sketch"),
            (sketch if numeric else none).alias("quantile_sketch"),
            F.min(number).alias("low_number"),
            F.max(number).alias("high_number"),
            (F.min_by(text, number) if numeric else F.min(text)).alias("low"),
            (F.max_by(text, number) if numeric else F.max(text)).alias("high"),
        )

    found = table.agg(F.array(*[statistics(c, k) for c, k in table.dtypes]).alias("s"))
    return found.select(F.lit(name).alias("table"), F.inline("s"))


def merge_profiles(parts: DataFrame) -> DataFrame:
    """Rows of :func:`profile_sketches` of several sets of rows as those of all of them."""
    numeric = F.col("low_number").isNotNull()
    return parts.groupBy("table", "column", "type").agg(
        F.sum("rows").alias("rows"),
        F.sum("nulls").alias("nulls"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.when(F.count("quantile_sketch") > 0, F.kll_merge_agg_double("quantile_sketch")).alias(
            "quantile_sketch"
        ),
        F.min("low_number").alias("low_number"),
        F.max("high_number").alias("high_number"),
        F.coalesce(F.min_by(F.when(numeric, F.col("low")), "low_number"), F.min("low")).alias("low"),
        F.coalesce(F.max_by(F.when(numeric, F.col("high")), "high_number"), F.max("high")).alias("high"),
    )


def read_profile(sketches: DataFrame, ranks: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """(table, column, rows, nulls, distinct, low, high, quantiles) of stored or merged sketches."""
    quantiles = F.array(
        *[F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(float(r))) for r in ranks]
    )
    return sketches.select(
        "table",
        "column",
        "rows",
        "nulls",
        F.hll_sketch_estimate("distinct_sketch").alias("distinct"),
        "low",
        "high",
        F.when(F.col("quantile_sketch").isNotNull(), quantiles).alias("quantiles"),
    )
