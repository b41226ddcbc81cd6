"""Cleaning and key checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retail_lake.contracts import Contract
from retail_lake.operators.conform import cast_once, conform, row_rules


def drop_unknown(df: DataFrame) -> DataFrame:
    """Drop rows with a NULL in any column."""
    return df.dropna(how="any")


def clean_stock(df: DataFrame) -> DataFrame:
    """Complete, distinct rows.

    Copies collapse in the map-side half of the aggregate, so a group of
    copies reaches its reducer as at most one row per map task.
    """
    return drop_unknown(df).dropDuplicates()


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row, with ``n_rows``. Counts before shuffling."""
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)
    )


def first_per_key(
    df: DataFrame,
    keys: list[str],
    order_by: list[str],
    values: list[str] | None = None,
    also: Sequence[Column] = (),
) -> DataFrame:
    """The least row of each key by ``order_by``, NULLs last, ties settled by the
    other columns.

    A minimum is an ordinary aggregate: copies of a key collapse on the map
    side, where a window would move a whole hot group into one task. ``values``
    limits the columns kept beside the key; ``also`` adds aggregates over all of
    a key's rows.
    """
    values = [c for c in df.columns if c not in keys] if values is None else values
    unknown = set(order_by) - {*keys, *values}
    if unknown:
        raise ValueError(f"unknown order columns {sorted(unknown)}")
    grouped = df.groupBy(*keys)
    if len(values) < 2:
        # A plain minimum of fixed width stays a hash aggregate.
        least = [F.min(c).alias(c) for c in values]
        return grouped.agg(*least, *also) if least or also else df.select(*keys).distinct()
    first = [c for c in order_by if c in values]
    ranked = [
        part
        for c in [*first, *(c for c in values if c not in first)]
        for part in (F.col(c).isNull().alias(f"_no_{c}"), F.col(c))
    ]
    found = grouped.agg(F.min(F.struct(*ranked)).alias("_row"), *also)
    row = [F.col("_row")[c].alias(c) for c in values]
    return found.select(*keys, *row, *found.columns[len(keys) + 1 :])


def contract_report(df: DataFrame, contract: Contract) -> DataFrame:
    """``rule, column_name, n_rows`` for every broken rule of the contract.

    Row rules are counted in one pass whatever their number. ``duplicate_key``
    counts the rows that share their whole (cast) key with another row.
    """
    rules = list(row_rules(df, contract))
    counts = cast_once(df, contract).agg(
        F.array(
            *[
                F.struct(
                    F.lit(rule).alias("rule"),
                    F.lit(column).alias("column_name"),
                    F.count_if(condition).alias("n_rows"),
                )
                for rule, column, condition in rules
            ]
        ).alias("findings")
    ).select(F.inline("findings"))
    keys = list(contract.key)
    # Rows without a key are no copies of each other; rule null counts them.
    keyed = conform(df, contract).select(*keys).dropna(how="any")
    repeated = duplicate_keys(keyed, keys).agg(
        F.lit("duplicate_key").alias("rule"),
        F.lit(",".join(keys)).alias("column_name"),
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
    )
    return counts.unionByName(repeated).where(F.col("n_rows") > 0)
