"""Path checks and small pointer files on whatever file system the session uses."""

from __future__ import annotations

import time

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder; empty when the folder does not exist."""
    fs, target = _file_system(spark, path)
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target))


def read_pointer(spark: SparkSession, path: str) -> str | None:
    """First line of a one-line file, None when it is absent."""
    fs, target = _file_system(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()


def write_pointer(spark: SparkSession, path: str, text: str) -> None:
    """Replace a one-line file by a rename; readers see the old line or the new one."""
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    fs, pending = _file_system(spark, path + ".pending")
    stream = fs.create(pending, True)
    stream.write(bytearray(f"{text}\n".encode()))
    stream.close()
    _, target = _file_system(spark, path)
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark._jsc.hadoopConfiguration()
    )
    overwrite = spark.sparkContext._gateway.new_array(rename, 1)
    overwrite[0] = rename.OVERWRITE
    context.rename(pending, target, overwrite)


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a one-line file unless there is one; False where there is.

    The line is written aside and linked into place by a rename that refuses to replace, so no
    reader sees an empty file.
    """
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    fs, pending = _file_system(spark, f"{path}.{text}")
    stream = fs.create(pending, True)
    stream.write(bytearray(f"{text}\n".encode()))
    stream.close()
    _, target = _file_system(spark, path)
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark._jsc.hadoopConfiguration()
    )
    try:
        context.rename(pending, target, spark.sparkContext._gateway.new_array(rename, 0))
    except Py4JJavaError as error:
        fs.delete(pending, False)
        if "FileAlreadyExists" in str(error.java_exception):
            return False
        raise
    return True


def age_seconds(spark: SparkSession, path: str) -> float | None:
    """Seconds since a file was written or touched, None when it is absent."""
    fs, target = _file_system(spark, path)
    if not fs.exists(target):
        return None
    return time.time() - fs.getFileStatus(target).getModificationTime() / 1000


def touch(spark: SparkSession, path: str) -> None:
    """Set a file's time to now; nothing where it is gone."""
    fs, target = _file_system(spark, path)
    if fs.exists(target):
        fs.setTimes(target, int(time.time() * 1000), -1)


def remove(spark: SparkSession, path: str) -> None:
    """Delete one file, if it is there."""
    fs, target = _file_system(spark, path)
    fs.delete(target, False)


def remove_tree(spark: SparkSession, path: str) -> None:
    """Delete a folder with all that is in it."""
    fs, target = _file_system(spark, path)
    fs.delete(target, True)
