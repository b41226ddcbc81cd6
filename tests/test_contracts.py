import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from retail_lake.contracts import CLIENTS, GOLD, ORDERS, OUT_OF_STOCK, Contract, ContractViolation
from retail_lake.operators import (
    bad_rows,
    conform,
    conform_marked,
    contract_report,
    schema_differences,
    validate,
)
from retail_lake.operators.conform import BROKEN


def test_gold_tables_and_keys():
    assert {name: c.key for name, c in GOLD.items()} == {
        "clients": ("client_id",),
        "location_areas": ("area_id",),
        "orders": ("product_id", "client_id", "order_date", "store_id"),
        "products": ("product_id",),
        "stores": ("store_id",),
        "dates": ("order_date",),
        "out_of_stock": ("product_id", "order_date"),
    }
    for contract in GOLD.values():
        assert not any(contract.schema[k].nullable for k in contract.key)
    assert not any(f.nullable for f in GOLD["dates"].schema)
    assert isinstance(GOLD["stores"].schema["location_area_id"].dataType, T.ShortType)
    assert GOLD["products"].lengths == {"product_name": 255, "aisle": 127, "department": 127}


def test_contract_refuses_loose_key_and_foreign_day():
    loose = T.StructType([T.StructField("id", T.IntegerType(), True)])
    with pytest.raises(ValueError, match="NOT NULL"):
        Contract("t", loose, ("id",))
    tight = T.StructType([T.StructField("id", T.IntegerType(), False)])
    with pytest.raises(ValueError, match="not part of the key"):
        Contract("t", tight, ("id",), day="d")


def test_conform_casts_strings_and_turns_bad_values_to_null(spark, rows):
    df = spark.createDataFrame(
        [("1", "2", "2021-1-3", "4", "5"), ("3000000000", "x", "nope", None, " 7 ")],
        "product_id string, client_id string, order_date string, store_id string, quantity string",
    )
    typed = conform(df.withColumn("extra", df.quantity), ORDERS)
    assert typed.dtypes == [(f.name, f.dataType.simpleString()) for f in ORDERS.schema]
    first, second = typed.orderBy("client_id").collect()[::-1]
    assert str(first.order_date) == "2021-01-03" and first.quantity == 5
    assert tuple(second) == (None, None, None, None, 7)


def test_marks_name_each_broken_rule(spark):
    df = spark.createDataFrame(
        [("1", "a" * 63, 1), ("1", "a" * 64, 1), (None, "b", 1), ("x", "c", 1)],
        "client_id string, fullname string, location_area_id int",
    )
    marked = conform_marked(df, CLIENTS)
    marks = [r[BROKEN] for r in marked.collect()]
    assert marks[0] == 0
    assert len(set(marks)) == 4


def test_schema_differences(spark):
    df = spark.createDataFrame([], "client_id bigint, name string, location_area_id int")
    assert schema_differences(df, CLIENTS) == [
        "missing fullname",
        "extra name",
        "client_id is bigint, not int",
    ]


def test_validate_passes_rows_through_unless_strict(spark, rows):
    df = spark.createDataFrame([(1, "a")], "client_id bigint, fullname string")
    assert rows(df.transform(validate(CLIENTS))) == [(1, "a")]
    with pytest.raises(ContractViolation, match="missing location_area_id"):
        df.transform(validate(CLIENTS, strict=True))
    assert rows(df.transform(validate(["client_id"], strict=True))) == [(1, "a")]
    with pytest.raises(ContractViolation, match="missing area"):
        df.transform(validate(["client_id", "area"], strict=True))


def test_contract_report(spark, rows):
    df = spark.createDataFrame(
        [
            ("1", "2021-01-03", None),
            ("1", "2021-1-3", None),
            ("x", "2021-01-04", None),
            (None, "nope", "9"),
        ],
        "product_id string, order_date string, store_id string",
    )
    assert rows(contract_report(df, OUT_OF_STOCK)) == [
        ("bad_value", "order_date", 1),
        ("bad_value", "product_id", 1),
        ("duplicate_key", "product_id,order_date", 2),
        ("null", "product_id", 1),
    ]


def test_contract_report_of_clean_rows_is_empty(spark):
    columns = "client_id int, fullname string, location_area_id int"
    df = spark.createDataFrame([(1, "a", 2)], columns)
    assert contract_report(df, CLIENTS).isEmpty()


def test_fractions_are_no_whole_numbers(spark):
    schema = T.StructType(
        [T.StructField("id", T.IntegerType(), False), T.StructField("n", T.ShortType())]
    )
    contract = Contract("whole", schema, ("id",))
    given = "id double, n decimal(6,2)"
    values = [(1.0, Decimal("2.00")), (12.7, None), (3.0, Decimal("1.90")), (float("nan"), None)]
    frame = spark.createDataFrame(values, given)
    assert [tuple(r) for r in conform(frame, contract).collect()] == [
        (1, 2), (None, None), (3, None), (None, None)
    ]
    found = {(r.rule, r.column_name): r.n_rows for r in contract_report(frame, contract).collect()}
    assert found[("bad_value", "id")] == 2 and found[("bad_value", "n")] == 1
    assert bad_rows(frame, contract).count() == 3


def _casts(spark, source, target, values):
    """Values as Spark casts them under a contract; None for those that are refused."""
    schema = T.StructType([T.StructField("id", T.IntegerType(), False), T.StructField("v", target)])
    frame = spark.createDataFrame(
        list(enumerate(values)),
        T.StructType([T.StructField("id", T.IntegerType()), T.StructField("v", source)]),
    )
    contract = Contract("casts", schema, ("id",))
    found = [r.v for r in conform(frame, contract).orderBy("id").collect()]
    given = sum(v is not None for v in values)
    assert bad_rows(frame, contract).count() == given - sum(v is not None for v in found)
    return found


DAY = dt.date(2021, 1, 3)


def test_a_time_of_day_is_lost_in_a_day_and_midnight_is_not(spark):
    for kind in (T.TimestampType(), T.TimestampNTZType()):
        moments = [dt.datetime(2021, 1, 3), dt.datetime(2021, 1, 3, 10), None]
        moments += [dt.datetime(2021, 1, 3, 0, 0, 0, 1)]
        assert _casts(spark, kind, T.DateType(), moments) == [DAY, None, None, None]
    texts = ["2021-01-03", " 2021-1-3 ", "2021-01-03 00:00:00", "2021-01-03T00:00", "2021-01-03 00:00:00.000"]
    assert _casts(spark, T.StringType(), T.DateType(), texts) == [DAY] * 5
    texts = ["2021-01-03 10:00", "2021-01-03T00:00:01", "2021-01-03 lunch", "2021-13-01", "", "10:00"]
    assert _casts(spark, T.StringType(), T.DateType(), texts) == [None] * 6
    assert _casts(spark, T.StringType(), T.DateType(), ["2021", "2021-02"]) == [
        dt.date(2021, 1, 1), dt.date(2021, 2, 1)
    ]


def test_digits_are_kept_or_refused(spark):
    big = 2**53 + 1
    cases = [
        (T.LongType(), T.DoubleType(), [2**53, big, None], [2.0**53, None, None]),
        (T.IntegerType(), T.FloatType(), [2**24, 2**24 + 1], [2.0**24, None]),
        (T.LongType(), T.IntegerType(), [5, 2**31], [5, None]),
        (T.DecimalType(8, 3), T.DecimalType(8, 1), [Decimal("1.500"), Decimal("1.250")], [Decimal("1.5"), None]),
        (T.StringType(), T.DecimalType(6, 2), ["1.50", "1.505", "x", " 7 "], [Decimal("1.50"), None, None, Decimal("7.00")]),
        (T.DoubleType(), T.DecimalType(6, 2), [1.5, 1.505], [Decimal("1.50"), None]),
        (T.IntegerType(), T.BooleanType(), [0, 1, 2], [False, True, None]),
        (T.StringType(), T.IntegerType(), ["12", "12.7", " 3 "], [12, None, 3]),
        (T.DoubleType(), T.FloatType(), [0.5, 1e300, float("inf")], [0.5, None, float("inf")]),
        (T.DateType(), T.TimestampType(), [DAY], [dt.datetime(2021, 1, 3)]),
        (T.IntegerType(), T.StringType(), [7], ["7"]),
    ]
    for source, target, values, expected in cases:
        assert _casts(spark, source, target, values) == expected, (source, target)
    assert str(_casts(spark, T.DoubleType(), T.FloatType(), [float("nan")])) == "[nan]"


def test_moments_as_numbers(spark):
    moments = [dt.datetime(1970, 1, 2), dt.datetime(1970, 1, 1, 0, 0, 0, 500_000)]
    assert _casts(spark, T.TimestampType(), T.LongType(), moments) == [86_400, None]
