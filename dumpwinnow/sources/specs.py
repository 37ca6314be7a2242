"""Table registry: source positions, types and constraints of every catalog table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

TABLE_PREFIX = "mb_"

SPARK_TYPES: dict[str, T.DataType] = {
    "int": T.IntegerType(),
    "smallint": T.ShortType(),
    "text": T.StringType(),
    "boolean": T.BooleanType(),
    "uuid": T.StringType(),
}


@dataclass(frozen=True)
class Column:
    """One target column; ``references`` is ``"table.column"`` of a foreign key."""

    name: str
    type: str
    position: int | None = None
    required: bool = False
    references: str | None = None
    default: str | None = None
    cascade: bool = False


@dataclass(frozen=True)
class TableSpec:
    """A table and the dump file it is read from (``source`` None: declared, not loaded)."""

    dump_file: str
    table: str
    columns: tuple[Column, ...]
    primary_key: tuple[str, ...] = ()
    source: str | None = "core"

    @property
    def schema(self) -> T.StructType:
        """Spark schema in target column order; keys are checked by operators, not here."""
        return T.StructType([T.StructField(c.name, SPARK_TYPES[c.type]) for c in self.columns])

    @property
    def column_names(self) -> tuple[str, ...]:
        return tuple(c.name for c in self.columns)

    @property
    def positions(self) -> tuple[int, ...]:
        return tuple(c.position for c in self.columns if c.position is not None)

    @property
    def last_position(self) -> int:
        return max(self.positions)

    @property
    def required_columns(self) -> tuple[str, ...]:
        return tuple(c.name for c in self.columns if c.required or c.name in self.primary_key)

    @property
    def foreign_keys(self) -> tuple[tuple[str, str, str], ...]:
        """(column, parent table, parent column) triples."""
        return tuple(
            (c.name, *c.references.split(".")) for c in self.columns if c.references is not None
        )


def _spec(dump_file: str, *columns: Column, key: tuple[str, ...] = ("id",), source="core"):
    return TableSpec(dump_file, TABLE_PREFIX + dump_file, columns, key, source)


def _to(table: str, column: str = "id") -> str:
    return f"{TABLE_PREFIX}{table}.{column}"


# File names, source positions, column names, types and constraints.
LOADED_TABLES: tuple[TableSpec, ...] = (
    _spec(
        "area_type",
        Column("id", "int", 0),
        Column("name", "text", 1, required=True),
    ),
    _spec(
        "gender",
        Column("id", "int", 0),
        Column("name", "text", 1, required=True),
    ),
    _spec(
        "tag",
        Column("id", "int", 0),
        Column("name", "text", 1, required=True),
        source="derived",
    ),
    _spec(
        "area",
        Column("id", "int", 0),
        Column("name", "text", 2, required=True),
        Column("type", "int", 3, references=_to("area_type")),
    ),
    _spec(
        "country_area",
        Column("area", "int", 0, references=_to("area")),
        key=("area",),
    ),
    _spec(
        "artist",
        Column("id", "int", 0),
        Column("name", "text", 2, required=True),
        Column("sort_name", "text", 3, required=True),
        Column("type", "int", 10),
        Column("area", "int", 11, references=_to("area")),
        Column("gender", "int", 12, references=_to("gender")),
        Column("begin_area", "int", 17, references=_to("area")),
        Column("comment", "text", 13, required=True, default=""),
    ),
    _spec(
        "artist_alias",
        Column("id", "int", 0),
        Column("artist", "int", 1, required=True, references=_to("artist"), cascade=True),
        Column("name", "text", 2, required=True),
        Column("sort_name", "text", 7, required=True),
        Column("locale", "text", 3),
        Column("type", "int", 6),
        Column("primary_for_locale", "boolean", 14, required=True, default="false"),
    ),
    _spec(
        "artist_tag",
        Column("artist", "int", 0, required=True, references=_to("artist"), cascade=True),
        Column("tag", "int", 1, required=True, references=_to("tag")),
        Column("count", "int", 2, required=True),
        key=("artist", "tag"),
        source="derived",
    ),
    _spec(
        "artist_credit",
        Column("id", "int", 0),
        Column("name", "text", 1, required=True),
        Column("artist_count", "smallint", 2, required=True),
    ),
    _spec(
        "artist_credit_name",
        Column(
            "artist_credit", "int", 0, required=True, references=_to("artist_credit"), cascade=True
        ),
        Column("position", "smallint", 1, required=True),
        Column("artist", "int", 2, required=True, references=_to("artist"), cascade=True),
        Column("name", "text", 3, required=True),
        Column("join_phrase", "text", 4, required=True, default=""),
        key=(),
    ),
    _spec(
        "release_group",
        Column("id", "int", 0),
        Column("name", "text", 2, required=True),
        Column("artist_credit", "int", 3, required=True, references=_to("artist_credit")),
        Column("type", "int", 4),
    ),
    _spec(
        "recording",
        Column("id", "int", 0),
        Column("gid", "uuid", 1, required=True),
        Column("name", "text", 2, required=True),
        Column("artist_credit", "int", 3, references=_to("artist_credit")),
        Column("length", "int", 4),
    ),
    _spec(
        "medium",
        Column("id", "int", 0),
        Column("release", "int", 1),
        Column("position", "int", 2),
        Column("format", "int", 3),
    ),
    _spec(
        "track",
        Column("id", "int", 0),
        Column("recording", "int", 2, required=True, references=_to("recording")),
        Column("medium", "int", 3, required=True, references=_to("medium")),
        Column("position", "int", 4, required=True),
        Column("name", "text", 6, required=True),
        Column("artist_credit", "int", 7, references=_to("artist_credit")),
        Column("length", "int", 8),
    ),
)

# Tables that have a schema but no dump file is read into them.
DECLARED_TABLES: tuple[TableSpec, ...] = (
    _spec(
        "url",
        Column("id", "int"),
        Column("gid", "uuid", required=True),
        Column("url", "text", required=True),
        source=None,
    ),
    _spec(
        "link_type",
        Column("id", "int"),
        Column("name", "text", required=True),
        Column("entity_type0", "text", required=True),
        Column("entity_type1", "text", required=True),
        source=None,
    ),
    _spec(
        "link",
        Column("id", "int"),
        Column("link_type", "int", required=True, references=_to("link_type")),
        source=None,
    ),
    _spec(
        "release",
        Column("id", "int"),
        Column("gid", "uuid", required=True),
        Column("name", "text", required=True),
        Column("artist_credit", "int", required=True, references=_to("artist_credit")),
        Column("release_group", "int", required=True, references=_to("release_group")),
        source=None,
    ),
    _spec(
        "l_release_group_url",
        Column("id", "int"),
        Column("link", "int", required=True, references=_to("link")),
        Column("release_group", "int", required=True, references=_to("release_group")),
        Column("url", "int", required=True, references=_to("url")),
        source=None,
    ),
    _spec(
        "l_release_url",
        Column("id", "int"),
        Column("link", "int", required=True, references=_to("link")),
        Column("release", "int", required=True, references=_to("release")),
        Column("url", "int", required=True, references=_to("url")),
        source=None,
    ),
)

ALL_TABLES: tuple[TableSpec, ...] = LOADED_TABLES + DECLARED_TABLES


def spec_for(name: str) -> TableSpec:
    """Look a spec up by table name, with or without the prefix."""
    for spec in ALL_TABLES:
        if name in (spec.table, spec.dump_file):
            return spec
    raise KeyError(f"no table spec named {name!r}")


def sources(group: str | None = None) -> tuple[str, ...]:
    """Dump file names that make up one source group ("core", "derived"), or all of them."""
    return tuple(s.dump_file for s in LOADED_TABLES if group is None or s.source == group)
