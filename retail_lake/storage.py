"""The few filesystem questions a DataFrame cannot answer, on any Hadoop filesystem."""

from __future__ import annotations

import os

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _open(spark, path)
    return fs.exists(target)


def total_bytes(spark: SparkSession, path: str) -> int:
    """Size of a file or of everything under a folder; 0 where there is nothing."""
    fs, target = _open(spark, path)
    return fs.getContentSummary(target).getLength() if fs.exists(target) else 0


def matching_names(spark: SparkSession, pattern: str) -> list[str]:
    """Last path parts of what a glob pattern matches."""
    fs, target = _open(spark, pattern)
    return sorted(found.getPath().getName() for found in fs.globStatus(target) or [])


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether there is a file at or below a path; empty folders don't count."""
    fs, target = _open(spark, path)
    return fs.exists(target) and fs.listFiles(target, True).hasNext()


def create_new(spark: SparkSession, path: str, content: str) -> bool:
    """Create a file with all folders above it; False, and nothing changed, if it exists.

    Of several callers exactly one succeeds, wherever the filesystem creates files in one
    step: HDFS and the stores whose Hadoop connectors put objects conditionally do. For
    local and mounted paths the operating system does it, as Hadoop's local files don't.
    """
    fs, target = _open(spark, path)
    fs.mkdirs(target.getParent())
    data = content.encode()
    if fs.getScheme() == "file":
        place = target.toUri().getPath()
        try:
            handle = os.open(place, os.O_CREAT | os.O_EXCL | os.O_WRONLY, 0o644)
        except FileExistsError:
            return False
        with os.fdopen(handle, "wb") as file:
            file.write(data)
        return True
    try:
        made = fs.createFile(target).overwrite(False)
        # Object stores look again when the file is closed.
        stream = made.opt("fs.option.create.conditional.overwrite", True).build()
        stream.write(data, 0, len(data))
        stream.close()
    except Py4JJavaError:
        if fs.exists(target):
            return False
        raise
    return True


def age_seconds(spark: SparkSession, path: str) -> float:
    """Seconds since a file was written, by the driver's clock."""
    fs, target = _open(spark, path)
    now = spark.sparkContext._jvm.java.lang.System.currentTimeMillis()
    return (now - fs.getFileStatus(target).getModificationTime()) / 1000


def copy_file(spark: SparkSession, source: str, path: str) -> None:
    """Copy one file, also to another filesystem."""
    from_fs, source = _open(spark, source)
    to_fs, target = _open(spark, path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    copied = spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil.copy(
        from_fs, source, to_fs, target, False, conf
    )
    if not copied:
        raise OSError(f"{source} was not copied")


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, target = _open(spark, path)
    fs.delete(target, True)
