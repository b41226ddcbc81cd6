"""The two daily runs: shop tables and out-of-stock documents, source to gold."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from retail_lake.contracts import SHOP_COLUMNS, STOCK_SCHEMA
from retail_lake.operators import shape
from retail_lake.operators.conform import validate
from retail_lake.operators.merge import Inserted, insert_new, key_facts
from retail_lake.operators.quality import clean_stock
from retail_lake.plans.silver import Hook, StageCounts, as_is, to_silver
from retail_lake.sizing import fit_shuffle, input_bytes
from retail_lake.sources import daily, files
from retail_lake.workspace import stage

#: Options of ``insert_new`` per gold table, such as
#: ``{"orders": {"on_duplicate": "first", "order_by": ["quantity"]}}``.
MergeOptions = Mapping[str, Mapping[str, object]]


def _side_by_side(spark: SparkSession, step: Callable[[str], object], names) -> dict:
    """Start the jobs of independent tables together, so small ones fill idle cores."""
    with ThreadPoolExecutor(len(names)) as pool:
        running = {n: pool.submit(inheritable_thread_target(spark)(step), n) for n in names}
        return {name: job.result() for name, job in running.items()}


def extract_shop(
    spark: SparkSession,
    extract: Callable[[str], DataFrame],
    root: str,
    day: dt.date,
    fmt: str = "parquet",
) -> None:
    """Snapshot all eight tables into the day's bronze folders."""
    _side_by_side(
        spark,
        lambda name: files.write_day(extract(name), f"{root}/bronze/{name}", day, fmt),
        SHOP_COLUMNS,
    )


def transform_shop(
    spark: SparkSession,
    root: str,
    day: dt.date,
    fmt: str = "parquet",
    clean: Mapping[str, Hook] = {},
) -> dict[str, StageCounts]:
    """The day's bronze tables to silver Parquet. Rows stay as they are, but for
    tables with a ``clean`` hook."""
    return _side_by_side(
        spark,
        lambda name: to_silver(
            lambda: files.read_day(spark, f"{root}/bronze/{name}", day, fmt),
            lambda df: files.write_day(df, f"{root}/silver/{name}", day),
            validate=validate(SHOP_COLUMNS[name]),
            clean=clean.get(name, as_is),
        ),
        SHOP_COLUMNS,
    )


def load_shop(
    spark: SparkSession,
    root: str,
    day: dt.date,
    targets: Mapping,
    options: MergeOptions = {},
    keep_staged: bool = False,
) -> dict[str, Inserted]:
    """The day's silver tables into the six shop gold tables.

    The five dimensions do not depend on each other and load side by side, but for
    bucketed ones, which set the shuffles for themselves; the orders follow once all of
    them are in. The orders are read once for their days, which also give the dates, and
    once to be merged. Staged rows are deleted after a good load unless ``keep_staged``;
    those of a refused one stay.
    """
    fit_shuffle(spark, input_bytes(spark, files.day_path(f"{root}/silver/orders", day)))
    silver = {n: files.read_day(spark, f"{root}/silver/{n}", day) for n in SHOP_COLUMNS}
    shaped = {
        "products": lambda: shape.products(
            silver["products"], silver["aisles"], silver["departments"]
        ),
        "location_areas": lambda: shape.location_areas(silver["location_areas"]),
        "clients": lambda: shape.clients(silver["clients"]),
        "stores": lambda: shape.stores(silver["stores"], silver["store_types"]),
        "dates": lambda: shape.dates(facts.rows, "order_date"),
        "orders": lambda: shape.orders(silver["orders"]),
    }
    orders = shape.orders(silver["orders"])
    facts = stage(key_facts(orders, targets["orders"].contract), "days")

    def load(name, **more):
        done = insert_new(shaped[name](), targets[name], **more, **options.get(name, {}))
        return done if keep_staged else done.discard()

    bucketed = [n for n in shaped if n != "orders" and hasattr(targets[n], "buckets")]
    plain = [n for n in shaped if n != "orders" and n not in bucketed]
    done = _side_by_side(spark, load, plain) if plain else {}
    done |= {name: load(name) for name in bucketed}
    done["orders"] = load("orders", facts=facts.rows)
    facts.discard()
    return done


def run_shop_day(
    spark: SparkSession,
    extract: Callable[[str], DataFrame],
    root: str,
    targets: Mapping,
    day: dt.date,
    bronze_format: str = "parquet",
    options: MergeOptions = {},
    clean: Mapping[str, Hook] = {},
    keep_staged: bool = False,
) -> dict[str, Inserted]:
    """All extracts, then all transforms, then the load. A rerun changes nothing.

    ``extract(table)`` gives a source table, for example
    ``lambda t: jdbc.snapshot(spark, url, t, properties, split=...)``.
    """
    extract_shop(spark, extract, root, day, bronze_format)
    transform_shop(spark, root, day, bronze_format, clean)
    return load_shop(spark, root, day, targets, options, keep_staged)


def transform_stock(
    spark: SparkSession,
    root: str,
    first: dt.date,
    last: dt.date,
    fmt: str = "json",
    schema=STOCK_SCHEMA,
) -> StageCounts:
    """Complete, distinct rows of each day to silver."""
    bronze, silver = f"{root}/bronze/stock", f"{root}/silver/stock"
    paths = [files.day_path(bronze, day) for day in daily.days_between(first, last)]
    fit_shuffle(spark, input_bytes(spark, *paths))
    written = set()

    def save(df):
        written.update(files.write_days(df, silver, gather=first != last)["days"])

    counts = to_silver(
        lambda: files.read_days(spark, bronze, first, last, fmt, schema),
        save,
        validate=validate(schema.names),
        clean=clean_stock,
    )
    # An earlier run left rows for days that now have none.
    stored = files.folder_days(spark, silver)
    emptied = [day for day in stored if first <= day <= last and day not in written]
    files.empty_days(spark, silver, emptied, schema, "parquet")
    return counts


def load_stock(
    spark: SparkSession,
    root: str,
    first: dt.date,
    last: dt.date,
    targets: Mapping,
    options: MergeOptions = {},
    schema=STOCK_SCHEMA,
    keep_staged: bool = False,
) -> dict[str, Inserted]:
    """Silver days into ``dates`` and then ``out_of_stock``. Staged rows are deleted after
    a good load unless ``keep_staged``."""
    stock = files.read_days(spark, f"{root}/silver/stock", first, last, schema=schema)
    shaped = {"dates": shape.dates(stock, "date"), "out_of_stock": shape.out_of_stock(stock)}
    done = {}
    for name, rows in shaped.items():
        loaded = insert_new(rows, targets[name], **options.get(name, {}))
        done[name] = loaded if keep_staged else loaded.discard()
    return done


def run_stock_days(
    spark: SparkSession,
    source: str,
    root: str,
    targets: Mapping,
    first: dt.date,
    last: dt.date | None = None,
    on_empty: str = "error",
    options: MergeOptions = {},
    schema=STOCK_SCHEMA,
) -> dict[str, Inserted]:
    """Fetch, clean and load one day or a range of them, one job per step.

    ``source`` is a registered ``daily_source``. Days that it does not have fail the run
    (``on_empty="error"``) or are passed over (``"skip"``); an answer without rows
    is a day like any other.
    """
    if on_empty not in ("error", "skip"):
        raise ValueError(f"on_empty: {on_empty!r}")
    days = daily.days_between(first, last)
    stored = daily.update_days(spark, source, days, f"{root}/bronze/stock")
    empty = sorted(set(days) - set(stored))
    if empty and on_empty == "error":
        raise daily.NoData(f"no data for {', '.join(map(str, empty))}")
    if not stored:
        return {}
    transform_stock(spark, root, days[0], days[-1], schema=schema)
    return load_stock(spark, root, days[0], days[-1], targets, options, schema)
