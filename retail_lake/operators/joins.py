"""Joins whose strategy follows from measured sizes."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A dimension is broadcast only when it was measured below both bounds.
BROADCAST_BYTES = 64 * 1024 * 1024
BROADCAST_ROWS = 1_000_000
#: Files are packed: an estimate from their bytes is taken as it is only where it is so many
#: times below or above a bound.
ESTIMATE_FACTOR = 16
#: Bits of a key filter: for each key of the batch, and at most (64 MB, broadcast).
BITS_PER_KEY = 16
MOST_BITS = 1 << 29
_BITMAP = 32_768  # bits of one bitmap of bitmap_construct_agg


def _size(df: DataFrame, position: int) -> DataFrame:
    width = F.lit(0).cast("long")
    for field in df.schema:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(F.col(field.name)), F.lit(0))
        width = width + F.lit(16)
    return df.agg(
        F.lit(position).alias("position"),
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum(width), F.lit(0)).alias("n_bytes"),
    )


def measured_sizes(frames: Sequence[DataFrame]) -> list[tuple[int, int]]:
    """``(rows, bytes)`` of each frame, all by one distributed job."""
    sizes = reduce(DataFrame.unionAll, [_size(df, n) for n, df in enumerate(frames)])
    return [(r.n_rows, r.n_bytes) for r in sorted(sizes.collect())]


def estimated_bytes(df: DataFrame) -> int | None:
    """What the optimizer expects of a frame's size, None where it only guesses: for joins,
    generated rows and sources that do not know their size."""
    plan = df._jdf.queryExecution().optimizedPlan()
    text = plan.toString()
    if any(word in text for word in ("Join", "Generate", "MapIn", "FlatMap", "LogicalRDD")):
        return None
    n_bytes = int(str(plan.stats().sizeInBytes()))
    unknown = int(df.sparkSession.conf.get("spark.sql.defaultSizeInBytes", str(2**63 - 1)))
    return None if n_bytes >= unknown else n_bytes


def join_dimensions(
    fact: DataFrame, dimensions: Mapping[str, DataFrame], max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Inner join with each dimension on its key; rows without a partner or with a
    NULL key drop out.

    A dimension is asked to be broadcast only if it is within the bounds; then the fact side
    is not shuffled for it, so a hot key costs nothing. Beyond them the join shuffles both
    sides, and adaptive execution splits a hot key's fact rows over several tasks
    (``spark.sql.adaptive.skewJoin``, on by default).

    Sizes are measured, in one job, only where the optimizer's estimate doesn't settle it.
    Far below the bound and within ``spark.sql.autoBroadcastJoinThreshold`` Spark
    broadcasts by itself, and far above it shuffles.
    """
    automatic = _bytes_of(fact, "spark.sql.autoBroadcastJoinThreshold")
    asked = {}
    for key, dimension in dimensions.items():
        n_bytes = estimated_bytes(dimension)
        far_below = n_bytes is not None and n_bytes <= min(automatic, max_bytes // ESTIMATE_FACTOR)
        far_above = n_bytes is not None and n_bytes >= max_bytes * ESTIMATE_FACTOR
        if not far_below and not far_above:
            asked[key] = dimension
    sizes = dict(zip(asked, measured_sizes(list(asked.values())))) if asked else {}
    for key, dimension in dimensions.items():
        n_rows, n_bytes = sizes.get(key, (BROADCAST_ROWS + 1, max_bytes + 1))
        if n_rows <= BROADCAST_ROWS and n_bytes <= max_bytes:
            dimension = F.broadcast(dimension)
        fact = fact.join(dimension, on=key, how="inner")
    return fact


def _bytes_of(df: DataFrame, setting: str) -> int:
    """A size setting of the session in bytes."""
    text = df.sparkSession.conf.get(setting, "10MB").strip().lower()
    found = re.fullmatch(r"(-?\d+)\s*([kmgt]?)i?b?", text)
    if found is None:
        raise ValueError(f"{setting}: {text!r}")
    return int(found[1]) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[found[2]]


def possible_partners(
    existing: DataFrame, batch: DataFrame, keys: list[str], most_bits: int = MOST_BITS
) -> DataFrame:
    """Rows of ``existing`` whose key may be in ``batch``: all that are, and few others.

    A Bloom filter with one hash. Each key of the batch sets a bit; the bits are gathered in
    bitmaps of 4 KB by a shuffle of one number a key, and broadcast, ``most_bits`` / 8 bytes
    at most whatever the batch has. With more keys than ``most_bits`` / 16 more rows pass, and
    none is lost. Only what passes is shuffled for the join that follows.
    """
    hashed = F.xxhash64(*keys)
    n_keys = batch.agg(F.approx_count_distinct(hashed)).first()[0]
    bits = min(most_bits, max(_BITMAP, 1 << max(1, n_keys * BITS_PER_KEY - 1).bit_length()))
    place = F.pmod(hashed, F.lit(bits))
    # Copies of a key are one place before any of them moves.
    places = batch.select(place.alias("_place")).distinct()
    number, position = F.floor(F.col("_place") / _BITMAP), F.col("_place") % _BITMAP
    bitmaps = (
        places.select(number.alias("_number"), position.alias("_position"))
        .repartition("_number")
        .groupBy("_number")
        .agg(F.bitmap_construct_agg("_position").alias("_bits"))
    )
    found = existing.withColumn("_place", place).withColumn("_number", number)
    found = found.join(F.broadcast(bitmaps), "_number", "inner")
    byte = "conv(hex(substring(_bits, cast(_place % 32768 div 8 AS int) + 1, 1)), 16, 10)"
    is_set = F.expr(f"shiftright(cast({byte} AS int), cast(_place % 8 AS int)) & 1")
    return found.where(is_set == 1).select(*existing.columns)


def new_rows(batch: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Batch rows whose key is absent from ``existing``; copies and NULL keys stay.

    No broadcast is asked for: Spark takes it where file sizes or a finished
    shuffle show that the keys are few. Otherwise both sides are shuffled once,
    ``existing`` with its keys only. Rows of one hot key, or all rows with a
    NULL key, land in one partition of the batch side, which adaptive execution
    splits over several tasks; the keys of ``existing`` are unique, so that
    side has no hot partition.
    """
    known = existing.select(*keys)
    return batch.join(known, on=keys, how="left_anti").select(*batch.columns)
