"""What a dump offers: snapshot stamps in listing pages, complete and distinct sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dumpwinnow.sources.files import list_names
from dumpwinnow.sources.specs import sources

# Fixed value: links to date-stamped folders.
STAMP_LINK = r'href="(\d{8}-\d{6})/"'


def snapshot_stamps(pages: DataFrame, column: str) -> DataFrame:
    """Every snapshot stamp linked from the pages."""
    return pages.select(
        F.explode(F.regexp_extract_all(column, F.lit(STAMP_LINK), F.lit(1))).alias("stamp")
    )


def latest_stamp(pages: DataFrame, column: str) -> DataFrame:
    """One row with the latest stamp; fails when no page links to a snapshot.

    Stamps have fixed width, so the greatest text is the latest time.
    """
    latest = F.max("stamp")
    return snapshot_stamps(pages, column).agg(
        F.coalesce(latest, F.raise_error(F.lit("no snapshot in the listing")).cast("string")).alias(
            "stamp"
        )
    )


def missing_names(required: DataFrame, present: DataFrame) -> DataFrame:
    """Required names that are not present."""
    return required.distinct().join(present.distinct(), "name", "left_anti")


def shared_names(left: DataFrame, right: DataFrame) -> DataFrame:
    """Names in both groups; the groups of a registry should share none."""
    return left.intersect(right)


def missing_files(spark: SparkSession, dump_dir: str, group: str | None = None) -> list[str]:
    """Dump files of a source group that are not in the folder."""
    found = set(list_names(spark, dump_dir))
    return [name for name in sources(group) if name not in found]
