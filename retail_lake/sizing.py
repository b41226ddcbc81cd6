"""Fit the number of shuffle partitions to the bytes a job reads."""

from __future__ import annotations

import contextlib
import logging
import math
import threading
from collections.abc import Iterator

from pyspark.sql import SparkSession

from retail_lake.storage import total_bytes

#: Input bytes per shuffle partition. Only key and payload columns of the
#: (compressed) input are shuffled, so a partition stays well within memory.
BYTES_PER_PARTITION = 256 * 1024 * 1024
#: Default limit of reducers. More of them burden the driver; past the limit
#: partitions grow, and sorts and hash tables spill.
MOST_PARTITIONS = 100_000
#: Rows for each bucket of a table. The task that merges a bucket holds its keys, some
#: 260 bytes a row, however well the files they came from are packed.
ROWS_PER_BUCKET = 2_000_000

log = logging.getLogger(__name__)
_changing = threading.RLock()

INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def input_bytes(spark: SparkSession, *paths: str) -> int:
    """Total size of the files under ``paths`` on any Hadoop filesystem."""
    return sum(total_bytes(spark, path) for path in paths)


def partitions_for(
    n_bytes: int,
    bytes_per_partition: int = BYTES_PER_PARTITION,
    most_partitions: int = MOST_PARTITIONS,
) -> int:
    wanted = math.ceil(n_bytes / bytes_per_partition)
    if wanted > most_partitions:
        log.warning(
            "%d bytes ask for %d shuffle partitions; the limit is %d, so each holds %d bytes",
            n_bytes, wanted, most_partitions, n_bytes // most_partitions,
        )
    return min(most_partitions, wanted)


def buckets_for(n_rows: int, least: int = 1) -> int:
    """Buckets for a table of ``n_rows``, so that a bucket's keys fit in a task."""
    wanted = max(least, math.ceil(n_rows / ROWS_PER_BUCKET))
    if wanted > MOST_PARTITIONS:
        log.warning("%d rows ask for %d buckets; the limit is %d", n_rows, wanted, MOST_PARTITIONS)
    return min(wanted, MOST_PARTITIONS)


@contextlib.contextmanager
def shuffles_at(spark: SparkSession, partitions: int | None) -> Iterator[None]:
    """Shuffles of the jobs started inside begin with ``partitions``; afterwards the
    session is as it was. With None nothing changes."""
    if partitions is None:
        yield
        return
    with _changing:
        before = spark.conf.get(INITIAL, None)
        spark.conf.set(INITIAL, str(partitions))
        try:
            yield
        finally:
            if before is None:
                spark.conf.unset(INITIAL)
            else:
                spark.conf.set(INITIAL, before)


def fit_shuffle(
    spark: SparkSession,
    n_bytes: int,
    bytes_per_partition: int = BYTES_PER_PARTITION,
    most_partitions: int = MOST_PARTITIONS,
) -> int:
    """Start shuffles with enough partitions for ``n_bytes``, and never with fewer
    than ``spark.sql.shuffle.partitions``. A limit that is reached is logged.

    Adaptive execution merges small partitions again, but it cannot make
    ordinary partitions smaller.
    """
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    partitions = max(least, partitions_for(n_bytes, bytes_per_partition, most_partitions))
    spark.conf.set(INITIAL, str(partitions))
    return partitions
