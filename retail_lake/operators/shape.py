"""Shaping of gold tables from silver ones. Every function is frames in, frame out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retail_lake.functions.calendar import calendar_parts
from retail_lake.operators.conform import exact
from retail_lake.operators.joins import join_dimensions


def name_aisle_columns(aisles: DataFrame) -> DataFrame:
    """Name positional columns of a headerless file; a no-op where names exist."""
    return aisles.withColumnsRenamed({"_c0": "aisle_id", "_c1": "aisle"})


def products(products: DataFrame, aisles: DataFrame, departments: DataFrame) -> DataFrame:
    dimensions = {
        "aisle_id": name_aisle_columns(aisles).select("aisle_id", "aisle"),
        "department_id": departments.select("department_id", "department"),
    }
    return join_dimensions(products, dimensions).select(
        "product_id", "product_name", "department", "aisle"
    )


def location_areas(location_areas: DataFrame) -> DataFrame:
    return location_areas.select("area_id", "area")


def clients(clients: DataFrame) -> DataFrame:
    return clients.select("client_id", "fullname", "location_area_id")


def stores(stores: DataFrame, store_types: DataFrame) -> DataFrame:
    types = store_types.select("store_type_id", F.col("type").alias("store_type"))
    return join_dimensions(stores, {"store_type_id": types}).select(
        "store_id", "location_area_id", "store_type"
    )


def dates(df: DataFrame, column: str) -> DataFrame:
    """One row per day of ``column``, from orders or from stock rows.

    Days are made distinct before their parts are derived: the shuffle carries
    one date per map task and day, and nothing is sorted. What is no whole day, or a
    moment within one, becomes a NULL that a merge refuses.
    """
    day = exact(F.col(column), df.schema[column].dataType, T.DateType())
    days = df.select(day.alias("order_date")).distinct()
    return days.select("order_date", *calendar_parts(F.col("order_date")))


def orders(orders: DataFrame) -> DataFrame:
    return orders.select("product_id", "client_id", "order_date", "store_id", "quantity")


def out_of_stock(stock: DataFrame) -> DataFrame:
    """One row per product and day; the source does not know the store.

    Rows are made distinct after the cast, so two spellings of a day are one.
    """
    kinds = {f.name: f.dataType for f in stock.schema}
    typed = stock.select(
        exact(F.col("product_id"), kinds["product_id"], T.IntegerType()).alias("product_id"),
        exact(F.col("date"), kinds["date"], T.DateType()).alias("order_date"),
    )
    return typed.distinct().withColumn("store_id", F.lit(None).cast("int"))
