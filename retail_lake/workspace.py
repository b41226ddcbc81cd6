"""Shared working folder: staged tables that cut lineage and outlive executors."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from retail_lake.storage import delete_folder


@functools.lru_cache(maxsize=1)
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="retail-lake-")


def work_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    A temporary folder is used only in local mode, where the driver and the
    executors are one process. On a cluster an unset folder is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None and re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        folder = _local_folder()
    if folder is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return f"{folder.rstrip('/')}/retail_lake"


def new_path(spark: SparkSession, label: str) -> str:
    """A path under the working folder that nothing has used yet."""
    return f"{work_dir(spark)}/{label}-{uuid.uuid4().hex}"


@dataclass(frozen=True)
class Staged:
    """A table written under the working folder."""

    path: str
    rows: DataFrame

    def discard(self) -> None:
        """Delete the files. Only a folder that ``new_path`` named can be meant."""
        spark = self.rows.sparkSession
        folder, _, name = self.path.rpartition("/")
        if folder != work_dir(spark) or not re.fullmatch(r"[\w-]+-[0-9a-f]{32}", name):
            raise ValueError(f"not a staged table: {self.path}")
        delete_folder(spark, self.path)


def stage(df: DataFrame, label: str) -> Staged:
    """Write ``df`` once and read the written rows from then on.

    Unlike ``persist`` the result survives lost executors, and unlike a lazy
    frame it does not change when a table it was computed from is appended to.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return Staged(path, spark.read.schema(df.schema).parquet(path))
