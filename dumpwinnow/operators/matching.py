"""Match catalog entities against a list of names, by primary name or alias."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dumpwinnow.functions.normalize import normalize_name
from dumpwinnow.functions.once import once
from dumpwinnow.operators.keyjoin import KEY, keep_by_keys

STRICT = "strict"
TOLERANT = "tolerant"


def library_keys(
    library: DataFrame,
    column: str = "artist",
    mode: str = STRICT,
    drop_blank: bool = False,
) -> DataFrame:
    """Distinct normalized names of a library as a key set.

    Only empty names are dropped before normalizing, so a name of white space alone gives
    the empty key, which matches every catalog name that folds to nothing; ``drop_blank``
    leaves that key out.  A NULL name stops the job in strict mode, and is skipped in
    tolerant mode.
    """
    name = F.col(column)
    if mode == STRICT:
        name = F.coalesce(name, F.raise_error(F.lit("library name is NULL")).cast("string"))
    names = library.select(name.alias(column)).filter(F.col(column) != "").distinct()
    keys = names.select(once(normalize_name(column)).alias(KEY)).distinct()
    return keys.filter(F.col(KEY) != "") if drop_blank else keys


def name_candidates(table: DataFrame, entity: str, name: str = "name") -> DataFrame:
    """(entity, normalized name) of every row; the scan reads these two columns."""
    return table.select(F.col(entity).alias("entity"), once(normalize_name(name)).alias("name_key"))


def match_rows(
    table: DataFrame, entity: str, keys: DataFrame, key_rows: int | None = None
) -> DataFrame:
    """Entities of the rows whose normalized name is a library key, one row per hit."""
    hits = keep_by_keys(name_candidates(table, entity), "name_key", keys, key_rows)
    return hits.select("entity")


def match_entities(
    artists: DataFrame,
    aliases: DataFrame,
    keys: DataFrame,
    key_rows: int | None = None,
) -> DataFrame:
    """Matched entities as (id, by_name, by_alias), one row each.

    Names and aliases are tagged and tested in one semi-join, then reduced to one row per
    entity with map-side aggregation.
    """
    candidates = name_candidates(artists, "id").withColumn("by_name", F.lit(True)).unionAll(
        name_candidates(aliases, "artist").withColumn("by_name", F.lit(False))
    )
    hits = keep_by_keys(candidates, "name_key", keys, key_rows)
    return hits.groupBy(F.col("entity").alias("id")).agg(
        F.bool_or("by_name").alias("by_name"),
        F.bool_or(~F.col("by_name")).alias("by_alias"),
    )


def matched_keys(matched: DataFrame) -> DataFrame:
    """The matched ids as a key set for the subset rules."""
    return matched.select(F.col("id").alias(KEY))


def match_statistics(matched: DataFrame) -> DataFrame:
    """One row: matches by name, further matches by alias only, and their total."""
    return matched.agg(
        F.count_if("by_name").alias("by_name"),
        F.count_if(~F.col("by_name")).alias("by_alias_only"),
        F.count("*").alias("total"),
    )
