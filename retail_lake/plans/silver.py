"""Bronze to silver: read, validate, clean, save, with a count after each stage."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

Hook = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class StageCounts:
    """Rows read, left after validation and left after cleaning.

    They are taken while the one write runs, and by task partition: where a partition was
    counted twice, as a map task that runs again after a lost executor is, or where a hook
    reads its input twice, the rows are counted again by a job of their own.
    """

    n_read: int
    n_valid: int
    n_clean: int


def as_is(df: DataFrame) -> DataFrame:
    return df


def to_silver(
    read: Callable[[], DataFrame],
    save: Callable[[DataFrame], object],
    validate: Hook = as_is,
    clean: Hook = as_is,
) -> StageCounts:
    """Run the stages as one Spark job; the counts need no jobs of their own."""
    raw = _counted(read())
    valid = _counted(validate(raw.rows), raw)
    cleaned = _counted(clean(valid.rows), valid)
    save(cleaned.rows)
    counts = StageCounts(raw.count(), valid.count(), cleaned.count())
    log.info("silver: %s", counts)
    return counts


_ROW = "_row_of_partition"


@dataclass(frozen=True)
class _Counted:
    source: DataFrame
    rows: DataFrame
    seen: Observation

    def count(self) -> int:
        try:
            seen = self.seen.get
        except Py4JJavaError as error:
            # Nothing was left to write, and adaptive execution dropped the finished
            # stages from its plan together with what they observed.
            if "toPyRow" not in str(error):
                raise
            return self.source.count()
        if seen["n_begun"] == len(seen["partitions"]):
            return seen["n"]
        log.info("silver: partitions counted twice, %d rows are counted anew", seen["n"])
        return self.source.count()


def _counted(df: DataFrame, before: _Counted | None = None) -> _Counted:
    """Count ``df``, or reuse the count before it if the stage changed nothing.

    Every task partition that has rows says so with its first one: if there are more of these
    than partitions, some were counted more than once.
    """
    if before is not None and df is before.rows:
        return before
    seen = Observation()
    row = F.col(_ROW)
    first = row.bitwiseAND((1 << 33) - 1) == 0
    numbered = df.withColumn(_ROW, F.monotonically_increasing_id())
    observed = numbered.observe(
        seen,
        F.count(F.lit(1)).alias("n"),
        F.count_if(first).alias("n_begun"),
        F.collect_set(F.when(first, F.shiftright(row, 33).cast("int"))).alias("partitions"),
    )
    return _Counted(df, observed.drop(_ROW), seen)
