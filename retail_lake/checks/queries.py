"""One query per operator over the tables in TESTDATA.md."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retail_lake.contracts import GOLD, ORDERS, STOCK_SCHEMA, Contract
from retail_lake.operators import (
    bad_rows,
    clean_stock,
    conform,
    contract_report,
    drop_unknown,
    duplicate_keys,
    first_per_key,
    insert_new,
    new_rows,
    shape,
)
from retail_lake.plans import run_shop_day, run_stock_days, to_silver
from retail_lake.plans import sample_shop as shop
from retail_lake.sizing import buckets_for, fit_shuffle, input_bytes
from retail_lake.sources import (
    BucketedTarget,
    ConcurrentLoad,
    ParquetTarget,
    answered_days,
    backfill,
    clear,
    daily,
    files,
    get_days,
    missing_days,
    open_table,
    read_day,
    read_days,
    read_source,
    update_days,
    write_day,
    write_days,
)
from retail_lake.workspace import new_path, stage

#: History that is already in the warehouse when a merge starts.
LOADED_UNTIL = dt.date(1998, 1, 1)
#: Run date of the shop queries, and the days the stock store begins with.
RUN_DAY = dt.date(2021, 6, 2)
STORED_UNTIL = dt.date(2024, 1, 15)
#: Two order lines of one client, day, store and product: the smaller one stays.
MERGE_OPTIONS = {"orders": {"on_duplicate": "first", "order_by": ["quantity"]}}


# --- shaping -------------------------------------------------------------

def products_gold(spark, sf):
    return shape.products(
        shop.products(spark, sf), shop.aisles(spark, sf), shop.departments(spark, sf)
    )


def products_positional(spark, sf):
    """Aisles from a headerless file, whose columns arrive as ``_c0, _c1``."""
    path = new_path(spark, "aisles")
    shop.aisles(spark, sf).write.option("escape", '"').csv(path)
    unnamed = spark.read.option("escape", '"').csv(path)
    typed = shape.name_aisle_columns(unnamed).withColumn(
        "aisle_id", F.col("aisle_id").try_cast("long")
    )
    return shape.products(shop.products(spark, sf), typed, shop.departments(spark, sf))


def stores_gold(spark, sf):
    return shape.stores(shop.stores(spark, sf), shop.store_types(spark, sf))


def location_areas_gold(spark, sf):
    return shape.location_areas(shop.location_areas(spark, sf))


def clients_gold(spark, sf):
    return shape.clients(shop.clients(spark, sf))


def dates_from_orders(spark, sf):
    heads = shop.table(spark, sf, "orders").select(F.col("o_orderdate").alias("order_date"))
    return shape.dates(heads, "order_date")


def orders_gold(spark, sf):
    return shape.orders(shop.orders(spark, sf))


def orders_conformed(spark, sf):
    return conform(shop.orders(spark, sf), ORDERS)


def _stock(spark, sf):
    return shop.stock(spark, sf).select("product_id", "date")


def oos_clean(spark, sf):
    return clean_stock(_stock(spark, sf))


def out_of_stock_gold(spark, sf):
    return shape.out_of_stock(drop_unknown(_stock(spark, sf)))


def dates_from_stock(spark, sf):
    return shape.dates(drop_unknown(_stock(spark, sf)), "date")


# --- anti-joins, keys and counts -----------------------------------------

def merge_single_key(spark, sf):
    loaded = shop.table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'")
    return new_rows(
        shop.clients(spark, sf), loaded.select(F.col("c_custkey").alias("client_id")), ["client_id"]
    )


def merge_composite_key(spark, sf):
    fact = shop.orders(spark, sf)
    return new_rows(fact, fact.where(F.col("order_date") < LOADED_UNTIL), list(ORDERS.key))


def merge_null_key(spark, sf):
    customers = shop.table(spark, sf, "customer")
    client = F.when(F.col("c_acctbal") >= 0, F.col("c_custkey")).alias("client_id")
    loaded = customers.where("c_mktsegment = 'BUILDING'").select(
        F.col("c_custkey").alias("client_id")
    )
    return new_rows(customers.select(client), loaded, ["client_id"])


def key_violations(spark, sf):
    return duplicate_keys(shop.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def first_line(spark, sf):
    lines = shop.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey"
    )
    return first_per_key(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey"])


def stock_contract_report(spark, sf):
    """What the warehouse would refuse in uncleaned stock rows."""
    raw = _stock(spark, sf).select(
        "product_id", F.col("date").alias("order_date"), F.lit(None).cast("int").alias("store_id")
    )
    return contract_report(raw, GOLD["out_of_stock"])


def lossy_casts(spark, sf):
    """Events whose value is no whole number, under a contract that wants one."""
    schema = T.StructType(
        [T.StructField("event_id", T.LongType(), False), T.StructField("value", T.IntegerType())]
    )
    events = shop.table(spark, sf, "events").select("event_id", "value")
    return bad_rows(events, Contract("counts", schema, ("event_id",)))


def lossy_days(spark, sf):
    """Events whose moment is no whole day, under a contract that wants days."""
    schema = T.StructType(
        [T.StructField("event_id", T.LongType(), False), T.StructField("ts", T.DateType())]
    )
    events = shop.table(spark, sf, "events").select("event_id", "ts")
    return bad_rows(events, Contract("days", schema, ("event_id",)))


def stage_counts(spark, sf):
    out = new_path(spark, "silver")
    counts = to_silver(
        lambda: _stock(spark, sf),
        lambda df: df.write.parquet(out),
        validate=drop_unknown,
        clean=clean_stock,
    )
    return spark.createDataFrame(
        [(counts.n_read, counts.n_valid, counts.n_clean)],
        "n_read bigint, n_valid bigint, n_clean bigint",
    )


# --- sources and sinks ---------------------------------------------------

def csv_roundtrip(spark, sf):
    """Whole texts with quotes and line breaks through a day's CSV and back."""
    root, source = new_path(spark, "csv"), shop.table(spark, sf, "documents")
    write_day(source, root, RUN_DAY, "csv")
    back = read_day(spark, root, RUN_DAY, "csv")
    return back.select([F.col(f.name).try_cast(f.dataType).alias(f.name) for f in source.schema])


def json_roundtrip(spark, sf):
    path = new_path(spark, "json") + ".json"
    _stock(spark, sf).write.options(**files.WRITE_OPTIONS["json"]).json(path)
    return open_table(spark, path).select("product_id", "date")


def silver_rerun(spark, sf):
    """The same day saved twice is the day once."""
    root = new_path(spark, "silver")
    lines = shop.table(spark, sf, "lineitem")
    for _ in range(2):
        to_silver(lambda: lines, lambda df: write_day(df, root, RUN_DAY))
    return read_day(spark, root, RUN_DAY)


def silver_days(spark, sf):
    root = new_path(spark, "days")
    write_days(shop.stock(spark, sf), root)
    first, last = shop.stock_days(spark, sf)
    return read_days(spark, root, STORED_UNTIL, last)


def _requested(df: DataFrame, column: str) -> DataFrame:
    """Every calendar day between the first and the last one of a column."""
    ends = df.agg(F.to_date(F.min(column)).alias("first"), F.to_date(F.max(column)).alias("last"))
    return ends.select(F.explode(F.sequence("first", "last")).alias("ds"))


def missing_dates(spark, sf):
    requested = _requested(shop.table(spark, sf, "lineitem"), "l_shipdate")
    stored = shop.table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("ds"))
    return missing_days(requested, stored)


def stock_source(spark, sf):
    """All days from the daily source, one task per day."""
    days = daily.days_between(*shop.stock_days(spark, sf))
    return read_source(spark, shop.register_stock_source(spark, sf), days)


def stock_backfill(spark, sf):
    """A store that holds the first days is filled up with the rest."""
    root, name = new_path(spark, "store"), shop.register_stock_source(spark, sf)
    first, last = shop.stock_days(spark, sf)
    backfill(spark, name, daily.days_between(first, STORED_UNTIL), root)
    backfill(spark, name, daily.days_between(first, last), root)
    return read_days(spark, root, first, last, "json", STOCK_SCHEMA)


def _register(spark, fetch):
    name = f"stock_{uuid.uuid4().hex}"
    spark.dataSource.register(daily.daily_source(name, fetch, STOCK_SCHEMA))
    return name


def stock_update(spark, sf):
    """All days are stored, then one is replaced, one has no rows any more, and one is
    unknown to the source and stays."""
    root, name = new_path(spark, "store"), shop.register_stock_source(spark, sf)
    first, last = shop.stock_days(spark, sf)
    update_days(spark, name, daily.days_between(first, last), root)
    answers = {first: [{"product_id": 1, "date": "replaced"}], STORED_UNTIL: []}
    days = sorted({first, STORED_UNTIL, last})
    update_days(spark, _register(spark, answers.get), days, root)
    return read_days(spark, root, first, last, "json", STOCK_SCHEMA)


def stock_get(spark, sf):
    """Days that are partly stored already, and fetched where they are not."""
    root, name = new_path(spark, "store"), shop.register_stock_source(spark, sf)
    first, last = shop.stock_days(spark, sf)
    update_days(spark, name, daily.days_between(first, STORED_UNTIL), root)
    return get_days(spark, name, daily.days_between(first, last), root, schema=STOCK_SCHEMA)


def stock_answers(spark, sf):
    """The ledger of a store whose source answers every other day without rows."""
    root, name = new_path(spark, "store"), shop.register_stock_source(spark, sf)
    first, last = shop.stock_days(spark, sf)
    days = daily.days_between(first, last)
    update_days(spark, name, days, root)
    empty = [day for day in days if day.day % 2]
    update_days(spark, _register(spark, dict.fromkeys(empty, []).get), empty, root)
    with_rows = read_days(spark, root, first, last, "json", STOCK_SCHEMA)
    with_rows = with_rows.groupBy("ds").agg(F.count(F.lit(1)).alias("n_rows"))
    answered = answered_days(spark, root).join(with_rows, "ds", "left")
    return answered.select("ds", F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows"))


def store_cleared(spark, sf):
    """A full store is cleared and filled again with the first days only."""
    root = new_path(spark, "store")
    rows = shop.stock(spark, sf)
    write_days(rows, root)
    clear(spark, root, rows.schema)
    write_days(rows.where(F.col("ds") < STORED_UNTIL), root)
    return read_days(spark, root, *shop.stock_days(spark, sf))


# --- merges and daily runs -----------------------------------------------

def _two_loads(target_for, fact):
    """Load the history, then everything. The joined fact is written once, as the
    silver table it would come from. ``target_for`` makes the target from its rows' number."""
    options, fact = MERGE_OPTIONS["orders"], stage(fact, "silver-orders").rows
    target = target_for(fact.count())
    insert_new(fact.where(F.col("order_date") < LOADED_UNTIL), target, **options)
    insert_new(fact, target, **options)
    return target.read(fact.sparkSession)


def orders_merged(spark, sf):
    target = ParquetTarget(ORDERS, new_path(spark, "gold"))
    return _two_loads(lambda _: target, shop.orders(spark, sf))


def orders_merged_bucketed(spark, sf):
    path = new_path(spark, "gold")
    table = "orders_" + path[-32:]
    least = fit_shuffle(
        spark, input_bytes(spark, f"{sf}/lineitem.parquet", f"{sf}/orders.parquet")
    )

    def target_for(n_rows):
        return BucketedTarget(ORDERS, table, path, buckets_for(n_rows, least))

    return _two_loads(target_for, shop.orders(spark, sf)).select(*ORDERS.schema.names)


def orders_merged_yearly(spark, sf):
    """As ``orders_merged_bucketed``, in folders by year."""
    path = new_path(spark, "gold")
    table = "orders_" + path[-32:]

    def target_for(n_rows):
        return BucketedTarget(ORDERS, table, path, buckets_for(n_rows, 4), folders="year")

    return _two_loads(target_for, shop.orders(spark, sf)).select(*ORDERS.schema.names)


def clients_merged(spark, sf):
    """A loaded segment, then all customers, those of one nation twice: wide rows, keys
    without a day, and the target's keys filtered by the batch's."""
    target = ParquetTarget(GOLD["clients"], new_path(spark, "gold"))
    clients = shop.clients(spark, sf)
    first = clients.join(
        shop.table(spark, sf, "customer")
        .where("c_mktsegment = 'BUILDING'")
        .select(F.col("c_custkey").alias("client_id")),
        "client_id",
        "left_semi",
    )
    insert_new(first, target)
    renamed = clients.where("location_area_id = 7").withColumn("fullname", F.lit("a copy"))
    batch = clients.withColumn("fullname", F.concat(F.lit("later "), "fullname"))
    insert_new(
        batch.unionByName(renamed),
        target,
        on_duplicate="first",
        order_by=["fullname"],
        prefilter=True,
    )
    return target.read(spark)


def refused_load(spark, sf):
    """Two loads of one target read its keys at the same time. The second to append is
    refused, so the target holds the first one's rows alone."""
    target = ParquetTarget(GOLD["clients"], new_path(spark, "gold"))
    clients = shop.clients(spark, sf)

    class Overtaken(ParquetTarget):
        """Another load comes in between reading the keys and appending."""

        def keys(self, spark, days=None, span=None):
            found = super().keys(spark, days, span)
            insert_new(clients.where("location_area_id < 10"), target)
            return found

    try:
        insert_new(clients, Overtaken(target.contract, target.path))
    except ConcurrentLoad:
        return target.read(spark)
    raise AssertionError("both loads were let in")


def _as_text(rows: DataFrame, name: str) -> DataFrame:
    """Rows of any gold table as ``table_name, row_key, attributes``."""
    contract = GOLD[name]
    text = {
        c: F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in contract.schema.names
    }
    return rows.select(
        F.lit(name).alias("table_name"),
        F.concat_ws("|", *[text[c] for c in contract.key]).alias("row_key"),
        F.concat_ws("|", *[text[c] for c in contract.schema.names if c not in contract.key]).alias(
            "attributes"
        ),
    )


def _gold_rows(spark, targets):
    tables = [_as_text(t.read(spark), name) for name, t in targets.items()]
    union = tables[0]
    for rows in tables[1:]:
        union = union.unionByName(rows)
    return union


def shop_day(spark, sf):
    """A whole shop run through CSV bronze; every row of the six gold tables."""
    root = new_path(spark, "shop")
    names = ("products", "location_areas", "clients", "stores", "dates", "orders")
    targets = {n: ParquetTarget(GOLD[n], f"{root}/gold/{n}") for n in names}
    run_shop_day(
        spark,
        lambda name: shop.SHOP[name](spark, sf),
        root,
        targets,
        RUN_DAY,
        bronze_format="csv",
        options=MERGE_OPTIONS,
    )
    return _gold_rows(spark, targets)


def stock_days(spark, sf):
    """A stock run over all days from the daily source; both gold tables."""
    root = new_path(spark, "stock")
    targets = {n: ParquetTarget(GOLD[n], f"{root}/gold/{n}") for n in ("dates", "out_of_stock")}
    first, last = shop.stock_days(spark, sf)
    source = shop.register_stock_source(spark, sf)
    run_stock_days(spark, source, root, targets, first, last, on_empty="skip")
    return _gold_rows(spark, targets)


# --- registration --------------------------------------------------------

#: Each query, with the tables whose bytes its shuffles are sized by.
_QUERIES = {
    products_gold: ["part"],
    products_positional: ["part"],
    stores_gold: ["supplier"],
    location_areas_gold: ["nation"],
    clients_gold: ["customer"],
    dates_from_orders: ["orders"],
    orders_gold: ["lineitem", "orders"],
    orders_conformed: ["lineitem", "orders"],
    oos_clean: ["events"],
    out_of_stock_gold: ["events"],
    dates_from_stock: ["events"],
    merge_single_key: ["customer"],
    merge_composite_key: ["lineitem", "orders"],
    merge_null_key: ["customer"],
    key_violations: ["lineitem"],
    first_line: ["lineitem"],
    stock_contract_report: ["events"],
    lossy_casts: ["events"],
    lossy_days: ["events"],
    stage_counts: ["events"],
    csv_roundtrip: ["documents"],
    json_roundtrip: ["events"],
    silver_rerun: ["lineitem"],
    silver_days: ["events"],
    missing_dates: ["lineitem", "orders"],
    stock_source: ["events"],
    stock_backfill: ["events"],
    stock_update: ["events"],
    stock_get: ["events"],
    stock_answers: ["events"],
    store_cleared: ["events"],
    orders_merged: ["lineitem", "orders"],
    orders_merged_bucketed: ["lineitem", "orders"],
    orders_merged_yearly: ["lineitem", "orders"],
    clients_merged: ["customer"],
    refused_load: ["customer"],
    shop_day: ["lineitem", "orders", "part", "customer", "supplier"],
    stock_days: ["events"],
}


def _sized(query, tables):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        sf_dir = sf_dir.rstrip("/")
        fit_shuffle(spark, input_bytes(spark, *[f"{sf_dir}/{t}.parquet" for t in tables]))
        return query(spark, sf_dir)

    return run


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: _sized(query, tables) for query, tables in _QUERIES.items()}
