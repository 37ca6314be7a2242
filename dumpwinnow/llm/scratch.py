"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder name below spark.checkpoint.dir.

    Only a local session without that setting, as in a test, gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def written(rows: DataFrame) -> DataFrame:
    """The rows, written once as Parquet and read back: no lineage, nothing computed twice."""
    spark = rows.sparkSession
    path = shared_folder(spark)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)
