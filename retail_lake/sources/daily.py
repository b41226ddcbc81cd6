"""A source that is asked for one date at a time, and its dated store.

Transport and tokens stay in the caller's functions; Spark decides where and
how often they run. Each date is one input partition with its own retries.
"""

from __future__ import annotations

import datetime as dt
import itertools
import sys
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from retail_lake.operators.joins import new_rows
from retail_lake.sources.files import (
    DAY,
    answered_days,
    empty_days,
    folder_days,
    read_days,
    record_answers,
    stored_days,
    write_days,
)

# Workers get this module with the pickled source, installed there or not.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROWS_PER_BATCH = 10_000
#: Column that is true in the one row that says that a day was answered.
ANSWERED = "_answered"
_NOTHING = object()


class Unauthorized(Exception):
    """Raised by ``fetch`` when its token is no longer accepted.

    Told apart by its mark, since a worker may know the class from its own
    installation as well as from the pickled source.
    """

    token_refused = True


class NoData(RuntimeError):
    """The source had nothing for the days asked."""


@dataclass
class OneDay(InputPartition):
    day: dt.date
    token: object = None


def days_between(first: dt.date, last: dt.date | None = None) -> list[dt.date]:
    """Every day of an inclusive range; without ``last``, the one day."""
    last = first if last is None else last
    if first > last:
        raise ValueError(f"{first} is after {last}")
    return [first + dt.timedelta(days=n) for n in range((last - first).days + 1)]


def fetch_day(day, fetch, authenticate, renewals, token=None):
    """An iterator over the day's rows, or None where there is no such day.

    ``token`` is kept until it is refused, and then renewed at most ``renewals`` times. A
    refusal before the first row is met by asking again; later it is an error, since
    asking again would repeat rows.
    """
    for left in range(renewals, -1, -1):
        try:
            if authenticate is None:
                rows = fetch(day)
            else:
                token = authenticate() if token is None else token
                rows = fetch(day, token)
            if rows is None:
                return None
            rows = iter(rows)
            first = next(rows, _NOTHING)
            return iter(()) if first is _NOTHING else itertools.chain([first], rows)
        except Exception as error:
            refused = getattr(error, "token_refused", False)
            if not refused or authenticate is None or left == 0:
                raise
            token = None


def _batches(rows: Iterable, schema: pa.Schema, more: Mapping) -> Iterator[pa.RecordBatch]:
    rows = iter(rows)
    while chunk := list(itertools.islice(rows, ROWS_PER_BATCH)):
        yield pa.RecordBatch.from_pylist([{**row, **more} for row in chunk], schema=schema)


def daily_source(
    name: str,
    fetch: Callable[..., Iterable[Mapping] | None],
    schema: T.StructType,
    authenticate: Callable[[], object] | None = None,
    renewals: int = 5,
) -> type[DataSource]:
    """A data source class to pass to ``spark.dataSource.register``.

    ``fetch(day)``, or ``fetch(day, token)`` with ``authenticate``, returns the
    day's rows as mappings (any iterable, so that a long day streams; an empty one is
    a day without rows), or None when there is no such day. Any error but
    ``Unauthorized`` fails the task. Rows carry the day asked for in ``ds``.
    One token is drawn for a read and used by all its tasks until it is refused.

    Options of the reader: ``start`` and ``end`` (inclusive; ``end`` defaults to
    ``start``), or ``days``, a comma-separated list. Dates are ISO. With
    ``answers=true`` every day that is answered, also by no rows, has a row more
    with nothing but ``ds`` and a true ``_answered``.
    """
    full = T.StructType([*schema.fields, T.StructField(DAY, T.DateType())])
    with_answers = T.StructType([*full.fields, T.StructField(ANSWERED, T.BooleanType())])

    class Reader(DataSourceReader):
        def __init__(self, days, answers):
            self.days, self.answers = days, answers

        def partitions(self):
            token = None
            if authenticate is not None and self.days:
                try:
                    token = authenticate()
                except Exception as error:
                    if not getattr(error, "token_refused", False):
                        raise
            return [OneDay(day, token) for day in self.days]

        def read(self, partition):
            rows = fetch_day(partition.day, fetch, authenticate, renewals, partition.token)
            if rows is None:
                return
            more = {DAY: partition.day}
            if not self.answers:
                yield from _batches(rows, to_arrow_schema(full), more)
                return
            yield from _batches(rows, to_arrow_schema(with_answers), {**more, ANSWERED: False})
            yield from _batches([{}], to_arrow_schema(with_answers), {**more, ANSWERED: True})

    class Daily(DataSource):
        @classmethod
        def name(cls):
            return name

        def _answers(self):
            return str(self.options.get("answers", "false")).lower() == "true"

        def schema(self):
            return with_answers if self._answers() else full

        def reader(self, schema):
            if "days" in self.options:
                days = [dt.date.fromisoformat(d) for d in self.options["days"].split(",")]
            else:
                start = dt.date.fromisoformat(self.options["start"])
                end = self.options.get("end")
                days = days_between(start, end and dt.date.fromisoformat(end))
            return Reader(days, self._answers())

    return Daily


def read_source(spark: SparkSession, name: str, days: list[dt.date]) -> DataFrame:
    """The registered source's rows for ``days``, one task per day."""
    listed = ",".join(day.isoformat() for day in days)
    return spark.read.format(name).option("days", listed).load()


def missing_days(requested: DataFrame, stored: DataFrame) -> DataFrame:
    """Distinct ``ds`` of ``requested`` that ``stored`` lacks."""
    return new_rows(requested.select(DAY).distinct(), stored.select(DAY).distinct(), [DAY])


def update_days(
    spark: SparkSession, name: str, days: list[dt.date], root: str, fmt: str = "json"
) -> list[dt.date]:
    """Fetch ``days`` again and replace them in the store; returns those that were
    answered. An answer without rows is a stored day without rows; a day that the
    source does not have keeps what was stored for it.

    Days are entered in the store's ledger by one write, after their rows. A run that dies
    before leaves its days out of the ledger, and a backfill asks for the empty ones again.
    """
    listed = ",".join(day.isoformat() for day in days)
    rows = spark.read.format(name).options(days=listed, answers="true").load()
    seen = Observation()
    # At most the days the caller listed.
    marked = rows.observe(seen, F.collect_set(F.when(F.col(ANSWERED), F.col(DAY))).alias("days"))
    answers = marked.where(~F.col(ANSWERED)).drop(ANSWERED)
    stored = write_days(answers, root, fmt, gather=False)
    answered = sorted(seen.get["days"])
    without_rows = set(answered) - set(stored["days"])
    if without_rows:
        # Only days that had rows before have anything to lose.
        emptied = without_rows.intersection(folder_days(spark, root))
        empty_days(spark, root, emptied, rows.drop(DAY, ANSWERED).schema, fmt)
    record_answers(spark, root, answered)
    return answered


def backfill(
    spark: SparkSession, name: str, days: list[dt.date], root: str, fmt: str = "json"
) -> list[dt.date]:
    """Fetch only those ``days`` the store lacks; returns the days added."""
    schema = T.StructType([T.StructField(DAY, T.DateType())])
    requested = spark.createDataFrame([(day,) for day in days], schema)
    # At most the days the caller listed come back.
    missing = missing_days(requested, answered_days(spark, root))
    missing = sorted(row[DAY] for row in missing.collect())
    return update_days(spark, name, missing, root, fmt) if missing else []


def get_days(
    spark: SparkSession,
    name: str,
    days: list[dt.date],
    root: str,
    fmt: str = "json",
    schema: T.StructType | None = None,
) -> DataFrame | None:
    """The stored rows of ``days``, fetched and stored first where they are missing;
    None if neither the store nor the source has any of the days."""
    backfill(spark, name, days, root, fmt)
    if not set(days) & set(stored_days(spark, root)):
        return None
    if not folder_days(spark, root):
        # Answers without rows alone: there is nothing to read a schema from.
        fields = [] if schema is None else schema.fields
        return spark.createDataFrame([], T.StructType([*fields, T.StructField(DAY, T.DateType())]))
    rows = read_days(spark, root, min(days), max(days), fmt, schema)
    return rows.where(F.col(DAY).isin(days))
