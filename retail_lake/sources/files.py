"""Dated file tables on any Hadoop filesystem: ``<root>/ds=<day>/``."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retail_lake.storage import copy_file, delete_folder, exists, has_files, matching_names
from retail_lake.workspace import new_path

DAY = "ds"
#: Folder of a store with the ledger of the days that its source has answered. Spark reads
#: no folder with such a name as data.
LEDGER = "_answered"
LEDGER_SCHEMA = T.StructType(
    [T.StructField(DAY, T.DateType()), T.StructField("answered_at", T.TimestampType())]
)

#: Options of each supported format. CSV quotes are doubled and values may hold
#: line breaks, as relational exports write them; blanks around a text belong to
#: it. JSON keeps NULL fields, so that a column of NULLs is still a column.
_CSV = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
READ_OPTIONS = {"parquet": {}, "json": {}, "csv": {**_CSV, "multiLine": True}}
WRITE_OPTIONS = {"parquet": {}, "json": {"ignoreNullFields": False}, "csv": _CSV}

#: A CSV file that may hold line breaks inside values is read by one task, so
#: such files are kept short enough for many tasks to share a table.
ROWS_PER_CSV_FILE = 1_000_000


def _known(fmt: str) -> str:
    if fmt not in READ_OPTIONS:
        raise TypeError(f"unsupported format {fmt!r}; use one of {sorted(READ_OPTIONS)}")
    return fmt


def _extension(path: str) -> str:
    return _known(PurePosixPath(str(path)).suffix[1:])


def _reader(spark: SparkSession, fmt: str, schema: T.StructType | None):
    reader = spark.read.format(_known(fmt)).options(**READ_OPTIONS[fmt])
    return reader if schema is None else reader.schema(schema)


def _writer(df: DataFrame, fmt: str):
    writer = df.write.format(_known(fmt)).options(**WRITE_OPTIONS[fmt])
    return writer.option("maxRecordsPerFile", ROWS_PER_CSV_FILE) if fmt == "csv" else writer


def open_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    line_breaks: bool = True,
) -> DataFrame:
    """Read a file or folder by its extension.

    CSV columns are strings unless a schema is given. Pass
    ``line_breaks=False`` for a large CSV file whose values hold none: it is
    then split over tasks.
    """
    fmt = _extension(path)
    reader = _reader(spark, fmt, schema)
    if fmt == "csv":
        reader = reader.option("multiLine", line_breaks)
    return reader.load(str(path))


def save_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a folder in the format of its extension."""
    _writer(df, _extension(path)).mode(mode).save(str(path))


def dated_name(
    root: str, extension: str, day: dt.date | None = None, name: str | None = None
) -> str:
    """``<root>/<day>/<name>.<extension>``, the layout of earlier lakes, for
    ``open_table`` and ``save_table``. The day defaults to today, the name to the day."""
    text = (day or dt.date.today()).isoformat()
    return f"{str(root).rstrip('/')}/{text}/{name or text}.{extension}"


def day_path(root: str, day: dt.date) -> str:
    return f"{str(root).rstrip('/')}/{DAY}={day.isoformat()}"


def write_day(
    df: DataFrame, root: str, day: dt.date, fmt: str = "parquet", mode: str = "overwrite"
) -> None:
    """Store one day. By default it replaces that day and only that day, even
    by nothing, so that a rerun gives the same store.

    The stored day is replaced when the new one has been written whole: after a failed
    write it is still there. The folder gives ``ds``; such a column of ``df`` is left out.
    """
    if mode != "overwrite":
        _writer(df, fmt).mode(mode).save(day_path(root, day))
        return
    before = matching_names(spark := df.sparkSession, f"{day_path(root, day)}/part-*")
    (
        _writer(df.withColumn(DAY, F.lit(day).cast("date")), fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY)
        .save(str(root))
    )
    if matching_names(spark, f"{day_path(root, day)}/part-*") == before:
        # No new file: the day has no rows now, and nothing is left to fail.
        empty = spark.createDataFrame([], df.drop(DAY).schema)
        _writer(empty, fmt).mode("overwrite").save(day_path(root, day))


def read_day(
    spark: SparkSession,
    root: str,
    day: dt.date,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
) -> DataFrame:
    """One day's rows. Only that day's folder is listed, however long the history."""
    return _reader(spark, fmt, schema).load(day_path(root, day))


def read_days(
    spark: SparkSession,
    root: str,
    first: dt.date,
    last: dt.date,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
) -> DataFrame:
    """Rows of a range of days with their day in ``ds``; other days are pruned.

    A given ``schema`` describes the files, without ``ds``.
    """
    if schema is not None:
        schema = T.StructType([*schema.fields, T.StructField(DAY, T.DateType())])
    return _reader(spark, fmt, schema).load(str(root)).where(F.col(DAY).between(first, last))


def write_days(
    df: DataFrame, root: str, fmt: str = "parquet", gather: bool = True
) -> dict[dt.date, int]:
    """Replace the days present in column ``ds`` and leave every other day alone.

    Returns the days written and their rows; a row without a day fails the write.
    ``gather`` brings a day's rows together first, so that a day is few files;
    adaptive execution splits a heavy day into several tasks. Leave it off where
    each task already holds one day.
    """
    no_day = F.raise_error(F.lit(f"row without {DAY}")).cast("date")
    df = df.withColumn(DAY, F.coalesce(F.col(DAY), no_day))
    if gather:
        df = df.hint("rebalance", DAY)
    seen = Observation()
    days = F.collect_set(DAY).alias("days")
    # Observed after the last shuffle, where a task's rows count exactly once.
    df = df.observe(seen, days, F.count(F.lit(1)).alias("n_rows"))
    (
        _writer(df, fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY)
        .save(str(root))
    )
    return seen.get


def folder_days(spark: SparkSession, root: str) -> list[dt.date]:
    """Days that have a folder in a store, from the folders' names alone."""
    names = matching_names(spark, f"{str(root).rstrip('/')}/{DAY}=*")
    return [dt.date.fromisoformat(name.partition("=")[2]) for name in names]


def _ledger(root: str) -> str:
    return f"{str(root).rstrip('/')}/{LEDGER}"


def record_answers(spark: SparkSession, root: str, days: Iterable[dt.date]) -> None:
    """Enter days in the store's ledger: one small write, however many days."""
    rows = [(day,) for day in sorted(set(days))]
    if rows:
        entered = spark.createDataFrame(rows, T.StructType(LEDGER_SCHEMA.fields[:1]))
        entered = entered.coalesce(1).withColumn("answered_at", F.current_timestamp())
        entered.write.mode("append").parquet(_ledger(root))


def answered_days(spark: SparkSession, root: str) -> DataFrame:
    """Distinct ``ds`` that the store's source has answered, by its ledger and by the
    folders of days that were stored otherwise."""
    schema = T.StructType(LEDGER_SCHEMA.fields[:1])
    days = spark.createDataFrame([(day,) for day in folder_days(spark, root)], schema)
    if has_files(spark, _ledger(root)):
        ledger = spark.read.schema(LEDGER_SCHEMA).parquet(_ledger(root))
        days = days.unionByName(ledger.select(DAY))
    return days.distinct()


def stored_days(spark: SparkSession, root: str) -> list[dt.date]:
    """Days a store holds, those that were answered without rows included. At most the days
    of a calendar; without a ledger only folder names are read."""
    if not has_files(spark, _ledger(root)):
        return folder_days(spark, root)
    return sorted(row[DAY] for row in answered_days(spark, root).collect())


def empty_days(
    spark: SparkSession, root: str, days: Iterable[dt.date], schema: T.StructType, fmt: str
) -> None:
    """Replace stored days by nothing: one empty table is written, and its file takes the
    place of those in each day's folder. A day keeps its rows until the file is there."""
    days = sorted(set(days))
    if not days:
        return
    blank = new_path(spark, "blank")
    _writer(spark.createDataFrame([], schema), fmt).save(blank)
    (name,) = matching_names(spark, f"{blank}/part-*")
    for day in days:
        folder = day_path(root, day)
        before = matching_names(spark, f"{folder}/part-*")
        copy_file(spark, f"{blank}/{name}", f"{folder}/{name}")
        for old in before:
            delete_folder(spark, f"{folder}/{old}")
    delete_folder(spark, blank)


def clear(spark: SparkSession, root: str, schema: T.StructType, fmt: str = "parquet") -> bool:
    """Drop every stored day and the ledger; says whether there was a day.

    Writes an empty table over the store, so nothing outside it can go.
    """
    if not stored_days(spark, root):
        return False
    if DAY not in schema.names:
        schema = T.StructType([*schema.fields, T.StructField(DAY, T.DateType())])
    (
        _writer(spark.createDataFrame([], schema), fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(DAY)
        .save(str(root))
    )
    return True


def read_if_present(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """A Parquet table, or None where nothing was written yet."""
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else None
