import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import types as T

from retail_lake.plans import StageCounts, to_silver
from retail_lake.operators import clean_stock
from retail_lake.sources import (
    clear,
    dated_name,
    open_table,
    read_day,
    read_days,
    save_table,
    stored_days,
    write_day,
    write_days,
)
from retail_lake.sizing import INITIAL, fit_shuffle, input_bytes, partitions_for

NEXT = dt.date(2021, 6, 3)
TEXT = [
    (1, 'say "hi"', "plain"),
    (2, "two\nlines", "a, b"),
    (3, "", None),
    (4, "back\\slash", "tab\there"),
    (5, "  blanks around \t", "\r\nbreaks\r"),
    (6, '"', '",\n"'),
]


def test_csv_keeps_quotes_commas_and_line_breaks(spark, root, day, rows):
    write_day(spark.createDataFrame(TEXT, "id int, a string, b string"), root, day, "csv")
    back = read_day(spark, root, day, "csv")
    assert back.dtypes == [("id", "string"), ("a", "string"), ("b", "string")]
    # An empty text and a missing one are both NULL, as in the exports.
    assert rows(back) == [(str(i), a or None, b) for i, a, b in TEXT]


def test_csv_keeps_random_text(spark, root, day):
    rng = random.Random(7)
    letters = ["a", '"', ",", "\n", "\r\n", "\r", " ", "\\", "\t", "#", "é", "'", ";", "\u2028"]
    texts = ["".join(rng.choices(letters, k=rng.randrange(8))) for _ in range(2_000)]
    write_day(spark.createDataFrame(list(enumerate(texts)), "id int, a string"), root, day, "csv")
    back = {int(r.id): r.a for r in read_day(spark, root, day, "csv").collect()}
    assert back == {n: text or None for n, text in enumerate(texts)}


def test_json_keeps_a_column_of_nulls(spark, root, day, rows):
    write_day(spark.createDataFrame([(1, None)], "a int, b string"), root, day, "json")
    assert rows(read_day(spark, root, day, "json")) == [(1, None)]


def test_an_export_written_elsewhere_is_read(spark, tmp_path, rows):
    path = tmp_path / "aisles.csv"
    path.write_text('aisle_id,aisle\n1,"say ""hi"""\n2,"two\nlines"\n3,\n4,""\n')
    assert rows(open_table(spark, path)) == [
        ("1", 'say "hi"'),
        ("2", "two\nlines"),
        ("3", None),
        ("4", None),
    ]


def test_a_csv_without_line_breaks_is_split(spark, tmp_path):
    path = tmp_path / "ids.csv"
    path.write_text("id,text\n" + "".join(f'{n},"a ""quoted"" text"\n' for n in range(20_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64KB")
    try:
        whole, split = open_table(spark, path), open_table(spark, path, line_breaks=False)
        assert whole.rdd.getNumPartitions() == 1 and split.rdd.getNumPartitions() > 1
        assert split.exceptAll(whole).isEmpty() and split.count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_one_line_json_array_is_a_row_per_element(spark, tmp_path, rows):
    path = tmp_path / "2021-01-03.json"
    document = [{"product_id": n, "date": "2021-01-03"} for n in (1, None)]
    path.write_text(json.dumps(document))
    df = open_table(spark, path)
    assert df.schema.simpleString() == "struct<date:string,product_id:bigint>"
    assert rows(df) == [("2021-01-03", 1), ("2021-01-03", None)]


def test_layout_of_earlier_lakes(spark, root, day, rows):
    assert dated_name(root, "json", day) == f"{root}/2021-06-02/2021-06-02.json"
    assert dated_name(root, "csv", name="orders").endswith(f"/{dt.date.today()}/orders.csv")
    for extension in ("csv", "json", "parquet"):
        path = dated_name(root, extension, day, "orders")
        for _ in range(2):
            save_table(spark.createDataFrame([("1",)], "id string"), path)
        assert rows(open_table(spark, path)) == [("1",)]


@pytest.mark.parametrize("name", ["x.orc", "noextension", "x.", "csv"])
def test_other_extensions_are_refused(spark, name):
    with pytest.raises(TypeError, match="csv.*json.*parquet"):
        open_table(spark, f"/nowhere.csv/{name}")


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json"])
def test_a_rerun_replaces_its_day_only(spark, root, day, rows, fmt):
    frame = lambda *ids: spark.createDataFrame([(str(i),) for i in ids], "id string")
    write_day(frame(1, 2), root, day, fmt)
    write_day(frame(9), root, NEXT, fmt)
    write_day(frame(3), root, day, fmt)
    schema = T.StructType([T.StructField("id", T.StringType())])
    assert rows(read_day(spark, root, day, fmt, schema)) == [("3",)]
    assert rows(read_day(spark, root, NEXT, fmt, schema)) == [("9",)]
    write_day(frame().limit(0), root, day, fmt)
    assert rows(read_day(spark, root, day, fmt, schema)) == []
    assert rows(read_days(spark, root, day, NEXT, fmt, schema)) == [("9", NEXT)]


def test_append_is_possible(spark, root, day):
    for _ in range(2):
        write_day(spark.range(2), root, day, mode="append")
    assert read_day(spark, root, day).count() == 4


def test_write_days_replaces_the_days_it_holds(spark, root, day, rows):
    first = spark.createDataFrame([(1, day), (2, NEXT)], "id int, ds date")
    assert sorted(write_days(first, root)["days"]) == [day, NEXT]
    found = write_days(spark.createDataFrame([(3, NEXT), (4, NEXT)], "id int, ds date"), root)
    assert found == {"days": [NEXT], "n_rows": 2}
    assert rows(read_days(spark, root, day, NEXT)) == [(1, day), (3, NEXT), (4, NEXT)]
    assert write_days(first.limit(0), root) == {"days": [], "n_rows": 0}
    assert stored_days(spark, root) == [day, NEXT]


def test_a_heavy_day_is_written_by_several_tasks(spark, root, day, settings):
    settings(adaptive__advisoryPartitionSizeInBytes="20KB")
    other = f"date_add(date'{NEXT}', cast(id % 9 as int))"
    heavy = spark.range(0, 60_000, 1, 8).selectExpr(
        "id", "id * 7 AS v", f"if(id % 3 = 0, date'{day}', {other}) AS ds"
    )
    assert write_days(heavy, root)["n_rows"] == 60_000
    files = [f for f in os.listdir(f"{root}/ds={day}") if f.endswith(".parquet")]
    assert len(files) > 1
    assert read_day(spark, root, day).count() == 20_000


def test_a_row_without_a_day_fails_the_write(spark, root, day):
    with pytest.raises(Exception, match="row without ds"):
        write_days(spark.createDataFrame([(1, day), (2, None)], "id int, ds date"), root)
    assert stored_days(spark, root) == []


def test_other_days_are_not_read(spark, root, day):
    write_days(spark.createDataFrame([(1, day), (2, NEXT)], "id int, ds date"), root)
    one = read_day(spark, root, day)
    assert all(f"ds={day}" in f for f in one.inputFiles())
    several = read_days(spark, root, NEXT, NEXT)
    filters = several._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1]
    assert "ds" in filters.split("]")[0]


def test_clear_says_whether_there_was_data(spark, root, day):
    schema = T.StructType([T.StructField("id", T.LongType())])
    assert clear(spark, root, schema) is False
    write_day(spark.range(3), root, day)
    assert clear(spark, root, schema) is True
    assert stored_days(spark, root) == []
    assert clear(spark, root, schema) is False


def test_clear_leaves_other_stores_alone(spark, root, day):
    schema = T.StructType([T.StructField("id", T.LongType())])
    write_day(spark.range(3), f"{root}/a", day)
    write_day(spark.range(3), f"{root}/b", day)
    clear(spark, f"{root}/a", schema)
    assert read_day(spark, f"{root}/b", day).count() == 3


def test_to_silver_counts_each_stage_in_one_write(spark, root, day, rows):
    raw = [(1, "d"), (1, "d"), (None, "d"), (2, "d")]
    df = spark.createDataFrame(raw, "product_id int, date string")
    counts = to_silver(
        lambda: df,
        lambda out: write_day(out, root, day),
        validate=lambda x: x.where("product_id <> 2 OR product_id IS NULL"),
        clean=clean_stock,
    )
    assert counts == StageCounts(4, 3, 1)
    assert rows(read_day(spark, root, day)) == [(1, "d")]


def test_to_silver_counts_when_nothing_is_left(spark, root, day):
    df = spark.createDataFrame([(None, "d"), (None, "e")], "product_id int, date string")
    counts = to_silver(lambda: df, lambda out: write_day(out, root, day), clean=clean_stock)
    assert counts == StageCounts(2, 2, 0)
    assert read_day(spark, root, day).count() == 0


def test_to_silver_of_nothing(spark, root, day):
    counts = to_silver(lambda: spark.range(0), lambda out: write_day(out, root, day))
    assert counts == StageCounts(0, 0, 0)


def test_shuffle_sizing(spark, tmp_path):
    assert partitions_for(1) == 1
    assert partitions_for(10 * 2**40) == 40960
    assert partitions_for(10**16) == 100_000
    (tmp_path / "x").write_bytes(b"12345")
    assert input_bytes(spark, str(tmp_path / "x"), str(tmp_path / "none")) == 5
    assert fit_shuffle(spark, 5) == 8
    try:
        assert fit_shuffle(spark, 2**32) == 16
        assert spark.conf.get(INITIAL) == "16"
        assert fit_shuffle(spark, 5) == 8
    finally:
        spark.conf.unset(INITIAL)
    assert os.path.exists(tmp_path / "x")


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_a_failed_rewrite_leaves_the_stored_day(spark, root, day, fmt):
    write_day(spark.range(5), root, day, fmt)
    bad = spark.range(9).selectExpr("if(id = 7, raise_error('broken'), id) AS id")
    with pytest.raises(Exception, match="broken"):
        write_day(bad, root, day, fmt)
    assert read_day(spark, root, day, fmt).count() == 5
    write_day(spark.range(0), root, day, fmt)
    assert read_day(spark, root, day, fmt).count() == 0


def test_the_limit_of_partitions_is_a_parameter_and_logged(caplog):
    assert partitions_for(1000, bytes_per_partition=10, most_partitions=50) == 50
    assert "limit is 50" in caplog.text
    assert partitions_for(1000, bytes_per_partition=10) == 100
