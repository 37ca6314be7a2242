"""Batch lookups: a table of requests against a catalog, as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dumpwinnow.operators.keyjoin import spread_join

BY_NAME = "name"
BY_ALIAS = "alias"


def requested(requests: DataFrame, column: str) -> DataFrame:
    """Distinct non-null requests with their lower-cased form.

    Asking the same thing many times costs one probe; join the answer back on ``request``
    where one row per asking row is wanted.
    """
    return (
        requests.select(F.col(column).alias("request"))
        .filter(F.col("request").isNotNull())
        .distinct()
        .withColumn("request_key", F.lower("request"))
    )


def _hits(requests: DataFrame, table: DataFrame, entity: str, name: str, by: str) -> DataFrame:
    named = table.select(
        F.col(entity).alias("id"), F.col(name).alias("name"), F.lower(name).alias("name_key")
    )
    return requests.join(named, F.col("request_key") == F.col("name_key")).select(
        "request", "id", "name", F.lit(by).alias("matched_by")
    )


def lookup_name(
    requests: DataFrame, artists: DataFrame, column: str = "request"
) -> DataFrame:
    """Artists whose name equals the request but for case: (request, id, name, matched_by)."""
    return _hits(requested(requests, column), artists, "id", "name", BY_NAME)


def lookup_alias(
    requests: DataFrame, aliases: DataFrame, column: str = "request"
) -> DataFrame:
    """Owners of aliases equal to the request but for case."""
    return _hits(requested(requests, column), aliases, "artist", "name", BY_ALIAS)


def lookup_name_or_alias(
    requests: DataFrame, artists: DataFrame, aliases: DataFrame, column: str = "request"
) -> DataFrame:
    """Both lookups; ``matched_by`` says which one a row comes from."""
    return lookup_name(requests, artists, column).unionAll(
        lookup_alias(requests, aliases, column)
    )


def lookup_key(requests: DataFrame, column: str, table: DataFrame, key: str) -> DataFrame:
    """Whole rows by exact key, such as recordings by their UUID."""
    wanted = requests.select(F.col(column).alias("request")).distinct()
    return table.join(wanted, table[key] == wanted["request"], "left_semi")


# Spark hands single values to the file reader up to this many, and beyond it only their range.
FEW = 10


def lookup_few_keys(
    requests: DataFrame, column: str, table: DataFrame, key: str, few: int = FEW
) -> DataFrame:
    """:func:`lookup_key` for a handful of requests against a table stored by the key.

    The requests become a filter, with which the reader skips row groups by their range and
    their bloom filters.  More than ``few`` distinct requests are joined as usual.
    """
    wanted = requests.select(F.col(column).alias("request")).filter("request IS NOT NULL").distinct()
    values = [r["request"] for r in wanted.limit(few + 1).collect()]
    if len(values) > few:
        return lookup_key(requests, column, table, key)
    return table.filter(F.col(key).isin(values) if values else F.lit(False))


# -- navigation along the catalog's references -----------------------------------------
#
# A credit, a medium or a tag may be what a large share of the rows refer to, so these joins
# spread the rows of frequent keys.


def credits_of_artists(credit_names: DataFrame, credits: DataFrame) -> DataFrame:
    """(artist, artist_credit, position, credit_name) of every artist's credits."""
    named = credits.select(F.col("id").alias("artist_credit"), F.col("name").alias("credit_name"))
    members = credit_names.select("artist", F.col("artist_credit").alias("credit"), "position")
    return spread_join(members, named, "credit", "artist_credit", right_unique=True).select(
        "artist", "artist_credit", "position", "credit_name"
    )


def release_groups_of_artists(credit_names: DataFrame, release_groups: DataFrame) -> DataFrame:
    """(artist, release_group, name, type); joined on the credit both carry."""
    members = credit_names.select("artist", F.col("artist_credit").alias("credit"))
    groups = release_groups.select(
        "artist_credit", F.col("id").alias("release_group"), "name", "type"
    )
    return spread_join(members, groups, "credit", "artist_credit").select(
        "artist", "release_group", "name", "type"
    )


def recordings_of_artists(credit_names: DataFrame, recordings: DataFrame) -> DataFrame:
    """(artist, recording, gid, name, length); joined on the credit both carry."""
    members = credit_names.select("artist", F.col("artist_credit").alias("credit"))
    made = recordings.select(
        "artist_credit", F.col("id").alias("recording"), "gid", "name", "length"
    )
    return spread_join(members, made, "credit", "artist_credit").select(
        "artist", "recording", "gid", "name", "length"
    )


def tracks_of_recordings(tracks: DataFrame, recordings: DataFrame, media: DataFrame) -> DataFrame:
    """(recording, recording_name, track, position, medium, format) along track's references."""
    placed = tracks.select(
        F.col("id").alias("track"), "position", F.col("recording").alias("of"), F.col("medium").alias("on")
    )
    named = recordings.select(F.col("id").alias("recording"), F.col("name").alias("recording_name"))
    carriers = media.select(F.col("id").alias("medium"), "format")
    found = spread_join(placed, named, "of", "recording", right_unique=True)
    return spread_join(found, carriers, "on", "medium", right_unique=True).select(
        "recording", "recording_name", "track", "position", "medium", "format"
    )


def tags_of_artists(artist_tags: DataFrame, tags: DataFrame) -> DataFrame:
    """(artist, tag, name, count) of every artist's tags."""
    named = tags.select(F.col("id").alias("tag"), "name")
    given = artist_tags.select("artist", F.col("tag").alias("given"), "count")
    return spread_join(given, named, "given", "tag", right_unique=True).select(
        "artist", "tag", "name", "count"
    )


def areas_of_artists(artists: DataFrame, areas: DataFrame, area_types: DataFrame) -> DataFrame:
    """(artist, area, area_name, area_type); artists without an area have no row, an area
    without a type has a NULL type."""
    return (
        artists.join(areas, artists["area"] == areas["id"])
        .join(area_types, areas["type"] == area_types["id"], "left")
        .select(
            artists["id"].alias("artist"),
            areas["id"].alias("area"),
            areas["name"].alias("area_name"),
            area_types["name"].alias("area_type"),
        )
    )


def aliases_of_artists(artists: DataFrame, aliases: DataFrame) -> DataFrame:
    """(artist, name, alias, locale) of every artist's aliases."""
    return aliases.join(artists, aliases["artist"] == artists["id"]).select(
        artists["id"].alias("artist"), artists["name"], aliases["name"].alias("alias"), "locale"
    )


def ordered(table: DataFrame, column: str, *tie_breaks: str) -> DataFrame:
    """Sorted by a column, then by the tie breaks: with a unique last one, rows that share
    the leading value still spread over several range partitions."""
    return table.orderBy(column, *tie_breaks)
