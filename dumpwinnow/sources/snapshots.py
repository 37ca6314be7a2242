"""Snapshots: folders of Parquet tables, published by moving one pointer."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dumpwinnow.sources.files import list_names, path_exists, read_pointer, write_pointer
from dumpwinnow.sources.specs import ALL_TABLES, TABLE_PREFIX, TableSpec

POINTER = "CURRENT"

# Smaller than Spark's own choice, by nearly half for UUIDs, and as fast to write.
CODEC = "zstd"
# Sizes tried for a bloom filter, from 1 MB down by halves; the smallest that serves is stored.
BLOOM_SIZES = 10

# Columns beside a table's own where rows and rejects were written in one pass.
VERDICT, LINE, REASON = "_verdict", "_line", "_reason"
ROWS, REJECTS = "rows", "rejects"


@dataclass(frozen=True)
class Snapshot:
    """One folder with a Parquet folder per table."""

    spark: SparkSession
    path: str

    def table_path(self, table: str) -> str:
        return f"{self.path}/{table}"

    def has(self, table: str) -> bool:
        """Whether a table was written completely; a half-written one does not count."""
        return path_exists(self.spark, f"{self.table_path(table)}/_SUCCESS")

    def write(self, table: str, rows: DataFrame) -> DataFrame:
        """Store rows, replacing an earlier attempt, and return the stored table."""
        rows.write.mode("overwrite").parquet(self.table_path(table), compression=CODEC)
        return self.spark.read.schema(rows.schema).parquet(self.table_path(table))

    def write_verdicts(self, table: str, lines: DataFrame, columns: StructType) -> None:
        """Store rows and rejects of one pass over a dump, a folder for each verdict.

        Both are there or neither, as they are one job's output.  A table without any line is
        written as an empty one.
        """
        path = self.table_path(table)
        lines.write.partitionBy(VERDICT).mode("overwrite").parquet(path, compression=CODEC)
        if not any(n.startswith(VERDICT) for n in list_names(self.spark, path)):
            self.write(table, self.spark.createDataFrame([], columns))

    def read(self, table: str) -> DataFrame:
        rows = self.spark.read.parquet(self.table_path(table))
        if VERDICT not in rows.columns:
            return rows
        return rows.where(F.col(VERDICT) == ROWS).drop(VERDICT, LINE, REASON)

    def rejects(self, table: str) -> DataFrame:
        """(line, reason) of the lines that were set aside when the table was loaded."""
        rows = self.spark.read.parquet(self.table_path(table))
        if VERDICT not in rows.columns:
            return self.spark.createDataFrame([], "line string, reason string")
        rejected = rows.where(F.col(VERDICT) == REJECTS)
        return rejected.select(F.col(LINE).alias("line"), F.col(REASON).alias("reason"))


    def write_clustered(
        self,
        table: str,
        rows: DataFrame,
        by: str,
        blooms: Sequence[str] = (),
        files: int | None = None,
    ) -> DataFrame:
        """Store rows in files that each hold a range of a key, sorted by it, with bloom filters.

        A filter on the key then reads the row groups of its range alone; one on a column of
        ``blooms`` skips the row groups that cannot hold a value.  A filter takes room for the
        values that its row group has, 1 MB at most.  Rows that share a key may fill several files.
        """
        files = files or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        ordered = rows.repartitionByRange(files, F.col(by), F.xxhash64(*rows.columns))
        writer = ordered.sortWithinPartitions(by).write.mode("overwrite")
        writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
        for column in blooms:
            writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true").option(
                f"parquet.bloom.filter.candidates.number#{column}", str(BLOOM_SIZES)
            )
        writer.parquet(self.table_path(table), compression=CODEC)
        return self.spark.read.schema(rows.schema).parquet(self.table_path(table))

    def write_buckets(self, table: str, rows: DataFrame, key: str, buckets: int) -> DataFrame:
        """Store rows in buckets of a key, sorted by it, so that joins on it need no shuffle."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self._bucketed_name(table)}")
        (
            rows.repartition(buckets, key)
            .write.mode("overwrite")
            .format("parquet")
            .bucketBy(buckets, key)
            .sortBy(key)
            .option("path", self.table_path(table))
            .option("compression", CODEC)
            .saveAsTable(self._bucketed_name(table))
        )
        return self.spark.table(self._bucketed_name(table))

    def read_buckets(self, table: str, key: str, buckets: int) -> DataFrame:
        """A table of :meth:`write_buckets`, made known to this session's catalog."""
        name, path = self._bucketed_name(table), self.table_path(table)
        columns = self.spark.read.parquet(path).schema.toDDL()
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
            f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
        return self.spark.table(name)

    def _bucketed_name(self, table: str) -> str:
        """A catalog name that belongs to this folder alone."""
        return f"{TABLE_PREFIX}b{hashlib.sha256(self.table_path(table).encode()).hexdigest()[:24]}"


@dataclass(frozen=True)
class SnapshotStore:
    """A folder of snapshots and the pointer to the published one.

    Nothing is overwritten in place, so readers of an older snapshot are not disturbed and
    a build that dies leaves the published snapshot as it was.
    """

    spark: SparkSession
    root: str

    def snapshot(self, name: str) -> Snapshot:
        return Snapshot(self.spark, f"{self.root}/{name}")

    def publish(self, name: str) -> None:
        write_pointer(self.spark, f"{self.root}/{POINTER}", name)

    def current_name(self) -> str | None:
        """Name of the published snapshot, None before the first one."""
        return read_pointer(self.spark, f"{self.root}/{POINTER}")

    def current(self) -> Snapshot | None:
        name = self.current_name()
        return None if name is None else self.snapshot(name)


def scratch_snapshot(spark: SparkSession) -> Snapshot:
    """A new folder for intermediate tables, in the shared folder of the session.

    That is spark.checkpoint.dir, or else the warehouse, which all executors share as well.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.sql.warehouse.dir"
    )
    return Snapshot(spark, f"{shared.rstrip('/')}/scratch-{uuid.uuid4().hex}")


# -- catalog tables --------------------------------------------------------------------


def create_tables(
    spark: SparkSession, database: str, specs: Iterable[TableSpec] = ALL_TABLES
) -> None:
    """Create the tables that do not exist yet; existing ones keep their rows."""
    for spec in specs:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spec.schema)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{spec.table} ({columns}) USING parquet")


def drop_tables(spark: SparkSession, database: str, prefix: str = TABLE_PREFIX) -> list[str]:
    """Drop every table of the database that has the prefix; returns their names."""
    names = [
        t.name for t in spark.catalog.listTables(database) if t.name.startswith(prefix)
    ]
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
    return names


def fill_if_empty(table: str, rows: DataFrame) -> bool:
    """Insert into an empty table; a filled one is left alone.  True when rows were written."""
    spark = rows.sparkSession
    if not spark.table(table).isEmpty():
        return False
    rows.write.mode("append").insertInto(table)
    return True


def analyze_tables(spark: SparkSession, tables: Iterable[str]) -> None:
    """Refresh the column statistics that the optimizer plans with."""
    for table in tables:
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")
