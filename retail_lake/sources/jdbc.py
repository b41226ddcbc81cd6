"""Relational tables: whole-table snapshots and a warehouse target."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from retail_lake.contracts import Contract
from retail_lake.sources.targets import Days, Span, near_keys

FETCH_ROWS = 10_000


def _reader(spark: SparkSession, url: str, properties: Mapping[str, str]):
    return spark.read.format("jdbc").options(
        **{"url": url, "fetchsize": str(FETCH_ROWS), **properties}
    )


def bounds_query(table: str, column: str) -> str:
    return f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}"


def stride_options(column: str, lo, hi, partitions: int) -> dict[str, str]:
    """Reader options for a range-split parallel read."""
    return {
        "partitionColumn": column,
        "lowerBound": str(lo),
        "upperBound": str(hi),
        "numPartitions": str(partitions),
    }


def snapshot(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    split: str | None = None,
    partitions: int = 32,
    predicates: Sequence[str] | None = None,
    bounds: tuple | None = None,
) -> DataFrame:
    """A whole table, read in parallel.

    ``split`` is an indexed number or date column: its range, ``bounds`` or else
    what the database says, is cut evenly. Where values bunch, pass your own
    ``predicates``, one per task; together they must cover every row once,
    NULLs included. With neither, one task reads the table: for small tables.

    Each task reads over its own connection at its own moment, so a parallel read is one
    consistent snapshot only of a table that nothing changes meanwhile: rows that move
    between ranges may be missed or read twice. Read a replica or a frozen view, or have
    changes noticed by ``unchanged``.
    """
    if predicates is not None:
        properties = {"fetchsize": str(FETCH_ROWS), **properties}
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=properties)
    reader = _reader(spark, url, properties).option("dbtable", table)
    if split is not None:
        if bounds is None:
            query = bounds_query(table, split)
            bounds = _reader(spark, url, properties).option("query", query).load().first()
        lo, hi = bounds
        if lo is not None and lo != hi:
            reader = reader.options(**stride_options(split, lo, hi, partitions))
    return reader.load()


class ChangedMeanwhile(RuntimeError):
    """A table changed while it was read, so what was read is no one state of it."""


@contextlib.contextmanager
def unchanged(
    spark: SparkSession, url: str, properties: Mapping[str, str], *fences: str
) -> Iterator[None]:
    """Fail if what the ``fences`` ask for differs before and after the reads inside.

    A fence is a query whose one row changes whenever a table does, such as ``SELECT COUNT(*),
    MAX(changed_at) FROM public.orders`` or a database's own count of changes. Write the
    snapshots inside: frames are read when they are written. A run that fails here is run
    again, and replaces the day it stored.
    """

    def look() -> list[tuple]:
        return [
            tuple(_reader(spark, url, properties).option("query", fence).load().first())
            for fence in fences
        ]

    before = look()
    yield
    for fence, old, new in zip(fences, before, look(), strict=True):
        if old != new:
            raise ChangedMeanwhile(f"{fence}: {old} became {new}")


@dataclass(frozen=True)
class JdbcTarget:
    """A warehouse table that is read for its keys and appended to.

    ``split`` and ``partitions`` set how the keys are read in parallel; without
    ``split`` a dated table is cut by day, so name another column where one day
    holds a large share of the rows.
    An ``atomic`` append goes through one connection and is all or nothing, whatever
    its size. Otherwise it is parallel and atomic per task only, and a rerun after a
    failure inserts just the rows still missing.
    """

    contract: Contract
    url: str
    table: str
    properties: Mapping[str, str] = field(default_factory=dict)
    split: str | None = None
    partitions: int = 32
    atomic: bool = False

    def keys(
        self, spark: SparkSession, days: Days | None = None, span: Span | None = None
    ) -> DataFrame:
        contract = self.contract
        if days is None:
            rows = snapshot(
                spark, self.url, self.table, self.properties, self.split, self.partitions
            )
        else:
            # Only the batch's days are asked of the database, as is a span of keys.
            rows = snapshot(
                spark,
                self.url,
                self.table,
                self.properties,
                self.split or contract.day,
                self.partitions,
                bounds=days[:2] if self.split in (None, contract.day) else None,
            )
        return near_keys(rows, contract, days, span)

    def count(self, spark: SparkSession) -> int:
        query = f"SELECT COUNT(*) AS n FROM {self.table}"
        found = _reader(spark, self.url, self.properties).option("query", query).load()
        return int(found.first()[0])

    def append(
        self, rows: DataFrame, n_rows: int, n_bytes: int = 0, days: Days | None = None
    ) -> None:
        if self.atomic:
            rows = rows.coalesce(1)
        (
            rows.write.format("jdbc")
            .options(**self.properties)
            .option("url", self.url)
            .option("dbtable", self.table)
            .option("numPartitions", str(self.partitions))
            .mode("append")
            .save()
        )
