"""Headerless tab-separated dump tables to typed DataFrames."""

from __future__ import annotations

import logging
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dumpwinnow.functions.copytext import (
    NUL,
    decode_checked,
    decode_together,
    escaped_fields,
    text_of,
    try_typed,
)
from dumpwinnow.functions.once import once
from dumpwinnow.sources.files import path_exists
from dumpwinnow.sources.snapshots import LINE, REASON, REJECTS, ROWS, VERDICT
from dumpwinnow.sources.specs import LOADED_TABLES, TableSpec

log = logging.getLogger(__name__)

STRICT = "strict"
TOLERANT = "tolerant"

SHORT_ROW = "short row"


@dataclass(frozen=True)
class ParsedTable:
    """Lines of a dump as (value, reason, typed), and the table they make.

    ``reason`` is NULL where a line can be loaded; ``typed`` is a struct of the spec's columns.
    """

    lines: DataFrame
    spec: TableSpec
    mode: str

    @property
    def rows(self) -> DataFrame:
        """Loadable lines in the spec's schema."""
        return self._rows(self.lines)

    @property
    def rejects(self) -> DataFrame:
        """The other lines as (line, reason)."""
        return self.lines.filter("reason IS NOT NULL").select(
            F.col("value").alias("line"), "reason"
        )

    def verdicts(self, seen: Observation) -> DataFrame:
        """All lines in one pass: typed columns, the line and reason of rejects, the verdict.

        Lines of both kinds are counted as ``rows`` and ``rejects`` on the way.  In strict mode
        rejects are counted only.
        """
        lines = self.lines.observe(
            seen,
            F.count_if(F.col("reason").isNull()).alias("rows"),
            F.count_if(F.col("reason").isNotNull()).alias("rejects"),
        )
        if self.mode == STRICT:
            lines = lines.filter("reason IS NULL")
        good = F.col("reason").isNull()
        return lines.select(
            *[F.when(good, F.col("typed")[c.name]).alias(c.name) for c in self.spec.columns],
            F.when(~good, F.col("value")).alias(LINE),
            F.col("reason").alias(REASON),
            F.when(good, F.lit(ROWS)).otherwise(F.lit(REJECTS)).alias(VERDICT),
        )

    def _rows(self, lines: DataFrame) -> DataFrame:
        return lines.filter("reason IS NULL").select(
            *[F.col("typed")[c.name].alias(c.name) for c in self.spec.columns]
        )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines that end at a newline only; a bare carriage return stays inside the line.

    Compressed files are read as what they hold, by the endings of their names.
    """
    return spark.read.option("lineSep", "\n").text(path)


def _without_carriage_return(value: Column) -> Column:
    return F.when(
        value.endswith("\r"), F.substring(value, F.lit(1), F.length(value) - 1)
    ).otherwise(value)


def parse_lines(lines: DataFrame, spec: TableSpec, mode: str = STRICT) -> ParsedTable:
    """Project, decode and type the fields a spec selects from a ``value`` column.

    Lines with too few fields are dropped in both modes.  Everything else that cannot be
    loaded (broken UTF-8, also where escapes spell it, a zero byte, a bad value, a missing
    required value) stops the job in strict mode and goes to ``rejects`` in tolerant mode.
    """
    if mode not in (STRICT, TOLERANT):
        raise ValueError(f"unknown mode {mode!r}")
    value = F.col("value")
    if mode == STRICT:
        zero = _fail(spec, "zero byte in line").cast("string")
        value = F.when(F.contains("value", F.lit(NUL)), zero).otherwise(F.validate_utf8("value"))
    fields = lines.select(
        F.col("value"),
        once(F.split(_without_carriage_return(value), "\t", -1)).alias("fields"),
    )
    short = F.size("fields") <= spec.last_position
    # Fields with escapes are decoded as one text wherever these allow it; only lines with others
    # take the way field by field, which is interpreted and has a step of its own, so that the
    # others stay compiled.  Generators keep null tests inferred from joins, and the decoding
    # with them, from moving below it.
    selected = [F.get("fields", F.lit(p)) for p in spec.positions]
    escaped = fields.select(
        "value",
        "fields",
        short.alias("short"),
        once(F.when(~short, escaped_fields(selected))).alias("escaped"),
    )
    together = escaped.select(
        "value", "fields", "short", once(decode_together(F.col("escaped"))).alias("held")
    )
    texts = [text_of(raw, F.col("held"), i) for i, raw in enumerate(selected)]
    together = together.select(
        "value",
        "fields",
        "short",
        once(F.when(F.col("held").isNotNull(), F.array(*texts))).alias("texts"),
    )
    decode = decode_checked if mode == TOLERANT else lambda raw: _decode_or_fail(spec, raw)
    odd = ~F.col("short") & F.col("texts").isNull()
    alone = together.select(
        "value",
        "short",
        "texts",
        once(F.when(odd, F.transform(F.array(*selected), decode))).alias("alone"),
    )
    decoded = alone.select(
        "value",
        "short",
        "alone",
        once(F.coalesce(F.col("texts"), F.col("alone")["text"])).alias("values"),
    )
    field = _strict if mode == STRICT else _typed
    typed = F.struct(*[field(spec, i).alias(c.name) for i, c in enumerate(spec.columns)])
    decoded = decoded.select(
        "value", "short", "alone", "values", once(F.when(~F.col("short"), typed)).alias("typed")
    )
    reason = F.when(F.col("short"), F.lit(SHORT_ROW))
    if mode == TOLERANT:
        # What is wrong is worked out for lines with a problem alone, interpreted and outside of
        # the compiled stage: with all its texts, the stage's method gets too long to be compiled.
        problems = F.array(*[_problem(spec, i) for i in range(len(spec.columns))])
        reason = (
            reason.when(~F.is_valid_utf8("value"), F.lit("invalid utf-8"))
            .when(F.contains("value", F.lit(NUL)), F.lit("zero byte"))
            .when(_suspect(spec), F.get(F.filter(problems, lambda p: p.isNotNull()), F.lit(0)))
        )
    return ParsedTable(decoded.select("value", reason.alias("reason"), "typed"), spec, mode)


def _text(i: int) -> Column:
    return F.get("values", F.lit(i))


def _typed(spec: TableSpec, i: int) -> Column:
    return try_typed(_text(i), spec.columns[i].type)


def _fail(spec: TableSpec, what: str, shown: Column | None = None) -> Column:
    message = F.lit(f"{spec.table}: {what}")
    return F.raise_error(message if shown is None else F.concat(message, F.lit(": "), shown))


def _decode_or_fail(spec: TableSpec, raw: Column) -> Column:
    """The decoded field; the task fails where it cannot be loaded."""

    def checked(field: Column) -> Column:
        bad = _fail(spec, "bad field", F.concat(field["problem"], F.lit(": "), raw))
        text = F.when(field["problem"].isNull(), field["text"]).otherwise(bad.cast("string"))
        return F.struct(text.alias("text"), field["problem"].alias("problem"))

    return F.get(F.transform(F.array(decode_checked(raw)), checked), F.lit(0))


def _strict(spec: TableSpec, i: int) -> Column:
    """The field's value, or an expression that fails the task with what was wrong."""
    column = spec.columns[i]
    value, text = _typed(spec, i), _text(i)
    spark_type = spec.schema[column.name].dataType
    attempts = [value]
    if column.type != "text":
        bad = _fail(spec, f"bad value for {column.name}", text).cast(spark_type)
        attempts.append(F.when(text.isNotNull(), bad))
    if column.name in spec.required_columns:
        attempts.append(_fail(spec, f"missing value for {column.name}").cast(spark_type))
    return F.coalesce(*attempts) if len(attempts) > 1 else value


def _problem(spec: TableSpec, i: int) -> Column:
    """Reason text when the field cannot be loaded, else NULL."""
    column = spec.columns[i]
    text = _text(i)
    found = F.get("alone", F.lit(i))["problem"]
    problem = F.when(found.isNotNull(), F.concat(found, F.lit(f": {column.name}")))
    if column.name in spec.required_columns:
        problem = problem.when(text.isNull(), F.lit(f"missing value: {column.name}"))
    if column.type != "text":
        problem = problem.when(
            text.isNotNull() & F.col("typed")[column.name].isNull(),
            F.lit(f"bad value: {column.name}"),
        )
    return problem


def _suspect(spec: TableSpec) -> Column:
    """Whether a line may have a :func:`_problem`: it was judged by field, or a value is absent."""
    found = F.col("alone").isNotNull()
    for i, column in enumerate(spec.columns):
        absent = F.col("typed")[column.name].isNull()
        if column.name in spec.required_columns:
            found = found | absent
        elif column.type != "text":
            found = found | (absent & _text(i).isNotNull())
    return found


def _empty(spark: SparkSession, spec: TableSpec, mode: str) -> ParsedTable:
    return parse_lines(spark.createDataFrame([], "value string"), spec, mode)


def load_table(
    spark: SparkSession, spec: TableSpec, dump_dir: str, mode: str = STRICT
) -> ParsedTable:
    """A table from its dump file; a missing file gives an empty table and a warning."""
    path = f"{dump_dir.rstrip('/')}/{spec.dump_file}"
    if not path_exists(spark, path):
        log.warning("%s: no dump file at %s, table is empty", spec.table, path)
        return _empty(spark, spec, mode)
    return parse_lines(read_lines(spark, path), spec, mode)


def load_all(
    spark: SparkSession,
    dump_dir: str,
    specs: Iterable[TableSpec] = LOADED_TABLES,
    mode: str = STRICT,
) -> dict[str, ParsedTable]:
    """Every table of the registry, parents before children."""
    return {spec.table: load_table(spark, spec, dump_dir, mode) for spec in specs}
