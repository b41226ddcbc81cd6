"""Bring a frame to a contract's types and say what does not fit."""

from __future__ import annotations

import logging
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retail_lake.contracts import Contract, ContractViolation

log = logging.getLogger(__name__)

#: First column that carries a row's broken rules through a merge: bit n is rule n of
#: ``row_rules``, and every ``RULES_PER_COLUMN`` rules there is a column more. Numbers
#: of fixed width keep the merge's aggregate in hash form.
BROKEN = "_broken"
RULES_PER_COLUMN = 62

_REAL = (T.FloatType, T.DoubleType)
_MOMENT = (T.TimestampType, T.TimestampNTZType)
#: A text that is a day or a part of one, without a time of day.
_DAY_ALONE = r"^\s*[+-]?\d+(-\d{1,2}(-\d{1,2})?)?\s*$"


def broken_column(rule: int) -> tuple[str, int]:
    """The column and the bit of a rule."""
    number, bit = divmod(rule, RULES_PER_COLUMN)
    return (f"{BROKEN}_{number}" if number else BROKEN), bit


def broken_columns(n_rules: int) -> list[str]:
    return list(dict.fromkeys(broken_column(n)[0] for n in range(max(1, n_rules))))


def _kept(given: Column, source: T.DataType, target: T.DataType) -> Column | None:
    """Whether a cast that succeeds keeps the whole value; None where it cannot lose any.

    The value must survive the way back to its own type. A text has no one spelling, so it
    is compared in a wider type instead. Rounding to a binary fraction is what such a type
    is for: only an overflow to infinity counts there, and digits of a whole number.
    """
    typed = given.try_cast(target)
    back = typed.try_cast(source) == given
    text = isinstance(source, T.StringType)
    whole = isinstance(source, T.IntegralType)
    if isinstance(target, T.DateType):
        if isinstance(source, _MOMENT):
            return back
        if text:
            moment = given.try_cast("timestamp_ntz")
            return F.coalesce(moment == typed.cast("timestamp_ntz"), given.rlike(_DAY_ALONE))
    if isinstance(target, T.IntegralType):
        return back if isinstance(source, (*_REAL, T.DecimalType, *_MOMENT)) else None
    if isinstance(target, T.DecimalType):
        if text:
            wide = given.try_cast(T.DecimalType(38, min(38, max(18, target.scale))))
            return F.coalesce(wide == typed, F.lit(True))
        return back if isinstance(source, (*_REAL, T.DecimalType)) else None
    if isinstance(target, _REAL):
        if whole:
            return back
        if isinstance(source, (*_REAL, T.DecimalType, T.StringType)):
            endless = F.lit(float("inf"))
            wide = F.abs(given.try_cast("double"))
            return F.isnan(typed) | (F.abs(typed) < endless) | (wide == endless)
    if isinstance(target, T.BooleanType) and isinstance(source, T.NumericType):
        return back
    return None


def exact(given: Column, source: T.DataType, target: T.DataType) -> Column:
    """A value in another type, NULL where the cast fails or drops a part of it: a fraction,
    a time of day, digits."""
    typed = given.try_cast(target)
    kept = None if source == target else _kept(given, source, target)
    return typed if kept is None else F.when(kept, typed)


def exact_cast(df: DataFrame, field: T.StructField) -> Column:
    """A column in the contract's type, NULL where the cast fails or drops a part."""
    source = df.schema[field.name].dataType
    return exact(F.col(field.name), source, field.dataType).alias(field.name)


def conform(df: DataFrame, contract: Contract) -> DataFrame:
    """Contract columns in contract order; a value that cannot be cast, or only with
    loss of a part, is NULL."""
    return df.select([exact_cast(df, f) for f in contract.schema])


def _given(name: str) -> str:
    return f"_given_{name}"


def cast_once(df: DataFrame, contract: Contract) -> DataFrame:
    """``conform`` plus, per column, whether the source gave a value.

    Rules look at these columns, so that a cast runs once however many rules
    ask about it.
    """
    given = [F.col(f.name).isNotNull().alias(_given(f.name)) for f in contract.schema]
    return df.select(*[exact_cast(df, f) for f in contract.schema], *given)


def row_rules(df: DataFrame, contract: Contract) -> Iterator[tuple[str, str, Column]]:
    """``(rule, column, condition on a row of cast_once)`` for every row-level rule.

    ``df`` is the frame before the cast; columns that already have the
    contract's type cannot hold a bad value.
    """
    for field in contract.schema:
        typed, given = F.col(field.name), F.col(_given(field.name))
        if df.schema[field.name].dataType != field.dataType:
            yield "bad_value", field.name, given & typed.isNull()
        if not field.nullable:
            yield "null", field.name, ~given
        if field.name in contract.lengths:
            yield "too_long", field.name, F.char_length(typed) > contract.lengths[field.name]


def conform_marked(df: DataFrame, contract: Contract) -> DataFrame:
    """``conform`` plus the columns of ``broken_columns``, all 0 for a row that keeps
    every rule."""
    rules = list(row_rules(df, contract))
    marks = dict.fromkeys(broken_columns(len(rules)), F.lit(0).cast("long"))
    for n, (_, _, condition) in enumerate(rules):
        column, bit = broken_column(n)
        marks[column] = marks[column] + F.when(condition, F.lit(1 << bit)).otherwise(F.lit(0))
    return cast_once(df, contract).select(
        *contract.schema.names, *[mark.alias(column) for column, mark in marks.items()]
    )


def bad_rows(df: DataFrame, contract: Contract) -> DataFrame:
    """The rows, as given, with a value that is no value of the contract's type."""
    bad = F.lit(False)
    for field in contract.schema:
        if df.schema[field.name].dataType != field.dataType:
            bad = bad | (F.col(field.name).isNotNull() & exact_cast(df, field).isNull())
    return df.where(bad)


def schema_differences(df: DataFrame, expected: T.StructType | Contract) -> list[str]:
    """Missing, extra and mistyped columns, compared by name; no job runs."""
    if isinstance(expected, Contract):
        expected = expected.schema
    have = {f.name: f.dataType for f in df.schema}
    want = {f.name: f.dataType for f in expected}
    return (
        [f"missing {name}" for name in want if name not in have]
        + [f"extra {name}" for name in have if name not in want]
        + [
            f"{name} is {have[name].simpleString()}, not {want[name].simpleString()}"
            for name in want
            if name in have and have[name] != want[name]
        ]
    )


def validate(expected: T.StructType | Contract | Sequence[str], strict: bool = False):
    """A ``df.transform`` hook: rows pass through, schema differences are logged.

    Given column names only, it looks for missing ones. With ``strict`` a
    difference raises instead.
    """

    def check(df: DataFrame) -> DataFrame:
        if isinstance(expected, (T.StructType, Contract)):
            differences = schema_differences(df, expected)
        else:
            differences = [f"missing {name}" for name in expected if name not in df.columns]
        log.info("schema %s, differences: %s", df.schema.simpleString(), differences or "none")
        if differences and strict:
            raise ContractViolation(getattr(expected, "name", "schema"), differences)
        return df

    return check
