"""The shop's source tables and stock documents, drawn from the tables in TESTDATA.md."""

from __future__ import annotations

import datetime as dt
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_lake.contracts import STOCK_SCHEMA
from retail_lake.operators.joins import join_dimensions
from retail_lake.sources import files
from retail_lake.sources.daily import daily_source
from retail_lake.workspace import new_path

#: Events below the first value lack their product, above the second
#: their date, so that the stock documents have something to clean.
LEAST_VALUE, MOST_VALUE = 5.0, 150.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _department_id():
    return F.substring_index("p_brand", "#", -1).cast("int")


def aisles(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return part.select(
        F.crc32("p_type").alias("aisle_id"), F.col("p_type").alias("aisle")
    ).distinct()


def departments(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return part.select(
        _department_id().alias("department_id"), F.col("p_brand").alias("department")
    ).distinct()


def products(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.crc32("p_type").alias("aisle_id"),
        _department_id().alias("department_id"),
    )


def clients(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("client_id"),
        F.col("c_name").alias("fullname"),
        F.col("c_nationkey").alias("location_area_id"),
    )


def location_areas(spark, sf_dir):
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("area_id"), F.col("n_name").alias("area")
    )


def stores(spark, sf_dir):
    """A store's type is the region of its nation."""
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("store_id"), F.col("s_nationkey").alias("location_area_id")
    )
    nations = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("location_area_id"),
        F.col("n_regionkey").alias("store_type_id"),
    )
    return join_dimensions(suppliers, {"location_area_id": nations}).select(
        "store_id", "location_area_id", "store_type_id"
    )


def store_types(spark, sf_dir):
    return table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("store_type_id"), F.col("r_name").alias("type")
    )


def orders(spark, sf_dir):
    """One row per order line. Spark broadcasts the order heads only if their
    files are small; otherwise both sides meet by shuffle, and adaptive
    execution splits an order that holds very many lines."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("store_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
    )
    heads = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("client_id"),
        F.to_date("o_orderdate").alias("order_date"),
    )
    return lines.join(heads, "order_id").select(
        "product_id", "client_id", "order_date", "store_id", "quantity"
    )


SHOP = {
    "orders": orders,
    "products": products,
    "departments": departments,
    "aisles": aisles,
    "clients": clients,
    "stores": stores,
    "store_types": store_types,
    "location_areas": location_areas,
}


def stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw stock rows with the day ``ds`` of the document they would come in."""
    events = table(spark, sf_dir, "events")
    day = F.to_date("ts")
    return events.select(
        F.when(F.col("value") >= LEAST_VALUE, F.col("user_id")).alias("product_id"),
        F.when(F.col("value") <= MOST_VALUE, day.cast("string")).alias("date"),
        day.alias("ds"),
    )


def stock_days(spark: SparkSession, sf_dir: str) -> tuple[dt.date, dt.date]:
    return tuple(stock(spark, sf_dir).agg(F.min("ds"), F.max("ds")).first())


def register_stock_source(spark: SparkSession, sf_dir: str) -> str:
    """Register a daily source over the same events and return its name.

    The days' documents are laid out once, a folder per day, and ``fetch``
    stands for the remote API that serves them: a task asks for one day, and
    that day's rows come as they are read.
    """
    documents = new_path(spark, "documents")
    files.write_days(stock(spark, sf_dir), documents)

    def fetch(day):
        import pyarrow.dataset
        import pyarrow.fs

        # Hadoop and Arrow name the same object store by different schemes.
        place = re.sub(r"^s3[an]:", "s3:", f"{documents}/ds={day.isoformat()}")
        filesystem, folder = pyarrow.fs.FileSystem.from_uri(place)
        if filesystem.get_file_info(folder).type == pyarrow.fs.FileType.NotFound:
            return None
        document = pyarrow.dataset.dataset(folder, format="parquet", filesystem=filesystem)
        batches = document.scanner(columns=["product_id", "date"], use_threads=False).to_batches()
        return (row for batch in batches for row in batch.to_pylist())

    name = f"stock_{uuid.uuid4().hex}"
    spark.dataSource.register(daily_source(name, fetch, STOCK_SCHEMA))
    return name
