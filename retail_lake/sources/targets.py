"""Gold targets on shared storage. ``JdbcTarget`` in ``jdbc`` has the same methods:
``keys`` (None where the target does not exist yet), ``count`` and ``append``."""

from __future__ import annotations

import datetime as dt
import logging
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_lake.contracts import Contract
from retail_lake.sources.claims import Claims
from retail_lake.sources.files import read_if_present
from retail_lake.storage import has_files, total_bytes

log = logging.getLogger(__name__)

#: Bytes that a file of a bucketed table's first load should have at least.
FILE_BYTES = 32 * 1024 * 1024
#: Table property with the folders of a bucketed table: ``month``, ``year`` or ``none``.
FOLDERS = "retail_lake.folders"


class Days(NamedTuple):
    """First and last day of a batch and the months it has, as Spark writes dates."""

    first: str
    last: str
    months: tuple[str, ...]

    @property
    def years(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys(m[:-3] for m in self.months))


class Span(NamedTuple):
    """Least and greatest value of a key column in a batch, as Spark writes them."""

    column: str
    low: str
    high: str


def month_of(day: Column) -> Column:
    """``yyyy-MM`` of a day's text."""
    return F.left(day, F.length(day) - 3)


def year_of(day: Column) -> Column:
    return F.left(day, F.length(day) - 6)


def _month_column(contract: Contract) -> str:
    return f"{contract.day}_month"


def _in_folders(
    rows: DataFrame | None, contract: Contract, days: Days | None, folders: str = "month"
) -> DataFrame | None:
    """Only the folders of the batch's months or years, which one odd date doesn't widen."""
    if rows is None or days is None or folders == "none":
        return rows
    wanted = days.months if folders == "month" else days.years
    return rows.where(F.col(f"{contract.day}_{folders}").isin(*wanted))


def near_keys(
    rows: DataFrame | None, contract: Contract, days: Days | None, span: Span | None
) -> DataFrame | None:
    """The keys of rows that can have a partner in the batch: within its days, or, where
    the key has no day, within its span of values. Both reach the scan."""
    if rows is None:
        return None
    column, low, high = (contract.day, *days[:2]) if days is not None else span or (None,) * 3
    if column is not None:
        kind = contract.schema[column].dataType
        rows = rows.where(F.col(column).between(F.lit(low).cast(kind), F.lit(high).cast(kind)))
    return rows.select(*contract.key)


@dataclass(frozen=True)
class ParquetTarget:
    """A Parquet folder, partitioned by the month of the contract's day if it has one.

    Months keep years of history to a few dozen folders. Inside a month files
    are ordered by day, so a range of days skips folders by partition and row
    groups by statistics.
    """

    contract: Contract
    path: str
    stale_after: dt.timedelta | None = None

    @property
    def claims(self) -> Claims:
        return Claims.beside(self.path, self.stale_after)

    def _files(self, spark: SparkSession) -> DataFrame | None:
        schema = self.contract.schema
        if self.contract.day is not None:
            schema = schema.add(_month_column(self.contract), "string")
        return read_if_present(spark, self.path, schema)

    def read(self, spark: SparkSession) -> DataFrame | None:
        rows = self._files(spark)
        return None if rows is None else rows.select(*self.contract.schema.names)

    def keys(
        self, spark: SparkSession, days: Days | None = None, span: Span | None = None
    ) -> DataFrame | None:
        return near_keys(
            _in_folders(self._files(spark), self.contract, days), self.contract, days, span
        )

    def count(self, spark: SparkSession) -> int:
        rows = self.read(spark)
        return 0 if rows is None else rows.count()

    def n_bytes(self, spark: SparkSession) -> int:
        return total_bytes(spark, self.path)

    def append(
        self, rows: DataFrame, n_rows: int, n_bytes: int = 0, days: Days | None = None
    ) -> None:
        day = self.contract.day
        if day is None:
            rows.write.mode("append").parquet(self.path)
            return
        # Few files per month; adaptive execution splits a heavy month over tasks.
        month = _month_column(self.contract)
        (
            rows.withColumn(month, month_of(F.col(day).cast("string")))
            .hint("rebalance", month)
            .sortWithinPartitions(month, day)
            .write.mode("append")
            .partitionBy(month)
            .parquet(self.path)
        )


def folders_for(n_bytes: int, days: Days | None, buckets: int, file_bytes: int) -> str:
    """The finest folders whose files, one for each bucket and folder, have ``file_bytes``."""
    if days is not None:
        for folders, n in (("month", len(days.months)), ("year", len(days.years))):
            if n_bytes >= n * buckets * file_bytes:
                return folders
    return "none"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


@dataclass(frozen=True)
class BucketedTarget:
    """A catalog table bucketed by its key, inside folders if it has a day and is large.

    A merge then moves only the batch, straight into as many partitions as there
    are buckets: the table's rows already lie where the join needs them. Choose
    ``buckets`` at or above ``spark.sql.shuffle.partitions`` and by the rows the
    table will have, so that a bucket of keys fits in a task (``sizing.buckets_for``). The
    catalog must outlive the session.

    A load writes a file for each bucket and folder. Whether folders are months, years or
    left out follows from the bytes of the first load, so that its files have
    ``file_bytes`` or there is one for each bucket; the choice is kept in the table's
    properties. Give ``folders`` to choose for yourself, where loads to come are much
    larger. Without folders a load's days are skipped by the statistics of its files.
    """

    contract: Contract
    table: str
    path: str
    buckets: int
    folders: str | None = None
    file_bytes: int = FILE_BYTES
    stale_after: dt.timedelta | None = None

    def __post_init__(self):
        if self.folders not in (None, "month", "year", "none"):
            raise ValueError(f"folders: {self.folders!r}")

    @property
    def claims(self) -> Claims:
        return Claims.beside(self.path, self.stale_after)

    def _table(self, spark: SparkSession) -> DataFrame | None:
        if spark.catalog.tableExists(self.table):
            return spark.table(self.table)
        if has_files(spark, self.path):
            # Taking the table for new would insert every row again.
            raise RuntimeError(f"files at {self.path}, but the catalog lost {self.table}")
        return None

    def stored_folders(self, spark: SparkSession) -> str | None:
        """The folders of the table, None where there is no table yet."""
        if not spark.catalog.tableExists(self.table):
            return None
        found = spark.sql(f"SHOW TBLPROPERTIES {self.table}").where(F.col("key") == FOLDERS).first()
        if found is not None:
            return found["value"]
        # A table from before there was a choice.
        parts = [c.name for c in spark.catalog.listColumns(self.table) if c.isPartition]
        return parts[0].rpartition("_")[2] if parts else "none"

    def read(self, spark: SparkSession) -> DataFrame | None:
        rows = self._table(spark)
        return None if rows is None else rows.select(*self.contract.schema.names)

    def keys(
        self, spark: SparkSession, days: Days | None = None, span: Span | None = None
    ) -> DataFrame | None:
        rows = self._table(spark)
        if rows is not None and days is not None:
            rows = _in_folders(rows, self.contract, days, self.stored_folders(spark))
        return near_keys(rows, self.contract, days, span)

    def count(self, spark: SparkSession) -> int:
        rows = self.read(spark)
        return 0 if rows is None else rows.count()

    def n_bytes(self, spark: SparkSession) -> int:
        return total_bytes(spark, self.path)

    def _create(self, spark: SparkSession, folders: str) -> None:
        columns = [f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in self.contract.schema]
        parted = ""
        if folders != "none":
            column = _quoted(f"{self.contract.day}_{folders}")
            columns.append(f"{column} string")
            parted = f"PARTITIONED BY ({column})"
        keys = ", ".join(map(_quoted, self.contract.key))
        location = self.path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {self.table} ({', '.join(columns)}) USING parquet {parted} "
            f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.buckets} BUCKETS "
            f"LOCATION '{location}' TBLPROPERTIES ('{FOLDERS}' = '{folders}')"
        )

    def append(
        self, rows: DataFrame, n_rows: int, n_bytes: int = 0, days: Days | None = None
    ) -> None:
        """``n_bytes`` and ``days`` of the rows decide the folders of a new table."""
        spark, keys = rows.sparkSession, list(self.contract.key)
        folders = self.stored_folders(spark)
        if folders is None:
            folders = self.folders or folders_for(n_bytes, days, self.buckets, self.file_bytes)
            if self.contract.day is None:
                folders = "none"
            self._create(spark, folders)
            log.info("%s: folders by %s for %d bytes", self.table, folders, n_bytes)
        # Tasks that each hold whole buckets write one file per bucket and folder.
        rows = rows.select(*self.contract.schema.names).repartition(self.buckets, *keys)
        if folders != "none":
            day = F.col(self.contract.day).cast("string")
            part = f"{self.contract.day}_{folders}"
            rows = rows.withColumn(part, month_of(day) if folders == "month" else year_of(day))
        writer = rows.write.mode("append")
        if folders != "none":
            writer = writer.partitionBy(part)
        writer.bucketBy(self.buckets, *keys).sortBy(*keys).saveAsTable(self.table)
