import datetime as dt

from retail_lake.operators import shape


def test_calendar_parts(spark):
    df = spark.createDataFrame(
        [("2021-01-03",), ("2020-12-31",), ("2021-01-01",), ("2021-01-03",), ("2021-1-3",)],
        "order_date string",
    )
    found = {str(r[0]): tuple(r)[1:] for r in shape.dates(df, "order_date").collect()}
    assert found == {
        "2021-01-03": (53, 1, 2021, 1),
        "2020-12-31": (53, 12, 2020, 5),
        "2021-01-01": (53, 1, 2021, 6),
    }
    assert shape.dates(df, "order_date").count() == 3


def test_dates_need_no_sort(spark):
    df = spark.range(100).selectExpr("date_add(date'2021-01-01', cast(id as int)) AS d")
    text = shape.dates(df, "d")._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in text and "Sort" not in text


def test_products_drop_unknown_aisles(spark, rows):
    products = spark.createDataFrame(
        [(1, "milk", 1, 1), (2, "nail", 9, 1), (3, "bun", None, 1)],
        "product_id int, product_name string, aisle_id int, department_id int",
    )
    aisles = spark.createDataFrame([(1, "dairy")], "_c0 int, _c1 string")
    departments = spark.createDataFrame([(1, "food")], "department_id int, department string")
    shaped = shape.products(products, aisles, departments)
    assert shaped.columns == ["product_id", "product_name", "department", "aisle"]
    assert rows(shaped) == [(1, "milk", "food", "dairy")]
    named = shape.name_aisle_columns(aisles)
    assert shape.name_aisle_columns(named).columns == ["aisle_id", "aisle"]


def test_stores_and_projections(spark, rows):
    stores = spark.createDataFrame(
        [(1, 5, 2, "x"), (2, 6, 9, "x")],
        "store_id int, location_area_id int, store_type_id int, extra string",
    )
    types = spark.createDataFrame([(2, "kiosk")], "store_type_id int, type string")
    assert rows(shape.stores(stores, types)) == [(1, 5, "kiosk")]
    clients = spark.createDataFrame(
        [("a", 3, 1)], "fullname string, location_area_id int, client_id int"
    )
    assert rows(shape.clients(clients)) == [(1, "a", 3)]


def test_out_of_stock_is_distinct_after_the_cast(spark, rows):
    stock = spark.createDataFrame(
        [("1", "2021-01-03"), ("1", "2021-1-3"), ("2", "2021-01-03")],
        "product_id string, date string",
    )
    shaped = shape.out_of_stock(stock)
    assert shaped.dtypes == [("product_id", "int"), ("order_date", "date"), ("store_id", "int")]
    day = dt.date(2021, 1, 3)
    assert rows(shaped) == [(1, day, None), (2, day, None)]
