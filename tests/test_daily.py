import datetime as dt
import os

import pytest
from pyspark.sql import types as T

from retail_lake.contracts import STOCK_SCHEMA
from retail_lake.sources import (
    Unauthorized,
    answered_days,
    backfill,
    clear,
    daily,
    daily_source,
    files,
    get_days,
    missing_days,
    read_days,
    read_source,
    stored_days,
    update_days,
)
from retail_lake.sources.daily import days_between, fetch_day

FIRST = dt.date(2021, 1, 1)
DAYS = days_between(FIRST, dt.date(2021, 1, 3))


def document(day):
    return [
        {"product_id": day.day, "date": day.isoformat()},
        {"product_id": None, "date": day.isoformat()},
    ]


@pytest.fixture
def api(spark, source_name, tmp_path):
    """A source without data on the second; each call leaves a file behind."""
    calls = str(tmp_path / "calls")
    os.mkdir(calls)

    def fetch(day):
        import uuid

        open(f"{calls}/{day}.{uuid.uuid4().hex}", "w").close()
        return None if day.day == 2 else iter(document(day))

    spark.dataSource.register(daily_source(source_name, fetch, STOCK_SCHEMA))
    return source_name, lambda: sorted(f.split(".")[0] for f in os.listdir(calls))


def test_range_of_days():
    assert days_between(FIRST) == [FIRST]
    assert len(DAYS) == 3
    with pytest.raises(ValueError, match="after"):
        days_between(dt.date(2021, 1, 2), FIRST)


def test_one_partition_per_day_and_none_means_no_rows(spark, api, rows):
    name, _ = api
    df = spark.read.format(name).options(start="2021-01-01", end="2021-01-03").load()
    assert df.rdd.getNumPartitions() == 3
    assert df.schema.names == ["product_id", "date", "ds"]
    assert rows(df) == [
        (1, "2021-01-01", DAYS[0]),
        (3, "2021-01-03", DAYS[2]),
        (None, "2021-01-01", DAYS[0]),
        (None, "2021-01-03", DAYS[2]),
    ]
    assert spark.read.format(name).options(start="2021-01-01").load().count() == 2
    assert read_source(spark, name, [DAYS[2]]).count() == 2


def test_long_day_streams_in_batches(spark, source_name):
    schema = T.StructType([T.StructField("n", T.LongType())])
    source = daily_source(source_name, lambda day: ({"n": n} for n in range(25_001)), schema)
    spark.dataSource.register(source)
    assert spark.read.format(source_name).options(start="2021-01-01").load().count() == 25_001


def test_refused_token_is_renewed_for_each_day_anew():
    tokens = []

    def authenticate():
        tokens.append(len(tokens))
        return tokens[-1]

    def fetch(day, token):
        if token % 6 < 5:
            raise Unauthorized
        return [token]

    for _ in DAYS:
        assert list(fetch_day(FIRST, fetch, authenticate, renewals=5)) == [tokens[-1]]
    assert len(tokens) == 18
    with pytest.raises(Unauthorized):
        fetch_day(FIRST, fetch, authenticate, renewals=4)


def test_other_errors_fail_at_once(spark, source_name):
    calls = []

    def fetch(day):
        calls.append(day)
        raise OSError("503")

    with pytest.raises(OSError):
        fetch_day(FIRST, fetch, None, renewals=5)
    assert len(calls) == 1

    def unreachable(day):
        raise OSError("503")

    spark.dataSource.register(daily_source(source_name, unreachable, STOCK_SCHEMA))
    with pytest.raises(Exception, match="503"):
        spark.read.format(source_name).options(start="2021-01-01").load().collect()


def test_authenticated_source_runs_on_workers(spark, source_name):
    def fetch(day, token):
        return [{"product_id": 1, "date": token}]

    source = daily_source(source_name, fetch, STOCK_SCHEMA, authenticate=lambda: "t")
    spark.dataSource.register(source)
    df = spark.read.format(source_name).options(start="2021-01-01").load()
    assert df.first()["date"] == "t"


def test_missing_days(spark, rows):
    frame = lambda days: spark.createDataFrame([(d,) for d in days], "ds date")
    assert rows(missing_days(frame(DAYS + DAYS), frame(DAYS[1:2]))) == [(DAYS[0],), (DAYS[2],)]


def test_backfill_fetches_what_is_missing(spark, api, root):
    name, calls = api
    assert update_days(spark, name, DAYS[:1], root) == DAYS[:1]
    assert calls() == ["2021-01-01"]
    assert backfill(spark, name, DAYS, root) == [DAYS[2]]
    assert calls() == ["2021-01-01", "2021-01-02", "2021-01-03"]
    assert stored_days(spark, root) == [DAYS[0], DAYS[2]]
    assert backfill(spark, name, [DAYS[0], DAYS[2]], root) == []
    assert len(calls()) == 3


def test_update_replaces_a_day_and_keeps_one_without_data(spark, api, source_name, root):
    name, _ = api
    update_days(spark, name, DAYS, root)
    other = source_name + "_later"
    later = lambda day: None if day.day == 3 else [{"product_id": 7, "date": "x"}]
    spark.dataSource.register(daily_source(other, later, STOCK_SCHEMA))
    assert update_days(spark, other, DAYS, root) == DAYS[:2]
    stored = read_days(spark, root, DAYS[0], DAYS[2], "json", STOCK_SCHEMA)
    found = sorted((r.ds.day, r.product_id or 0) for r in stored.collect())
    assert found == [(1, 7), (2, 7), (3, 0), (3, 3)]


def test_get_days_fetches_once(spark, api, root, rows):
    name, calls = api
    wanted = [DAYS[0], DAYS[1]]
    for _ in range(2):
        found = get_days(spark, name, wanted, root, schema=STOCK_SCHEMA)
        assert rows(found) == [(1, "2021-01-01", DAYS[0]), (None, "2021-01-01", DAYS[0])]
    # The day without data is asked for again, as it may have some by now.
    assert calls() == ["2021-01-01", "2021-01-02", "2021-01-02"]
    assert get_days(spark, name, [DAYS[1]], root, schema=STOCK_SCHEMA) is None


def test_a_generators_refusal_before_its_first_row_is_renewed():
    tokens = []

    def authenticate():
        tokens.append(len(tokens))
        return tokens[-1]

    def fetch(day, token):
        if token < 2:
            raise Unauthorized
        yield from ({"product_id": n} for n in range(3))

    assert len(list(fetch_day(FIRST, fetch, authenticate, 5))) == 3
    assert tokens == [0, 1, 2]


def test_a_refusal_after_rows_is_an_error():
    def fetch(day, token):
        yield {"product_id": 1}
        raise Unauthorized

    with pytest.raises(Unauthorized):
        list(fetch_day(FIRST, fetch, lambda: "t", 5))


def test_a_token_is_kept_until_it_is_refused(spark, source_name, tmp_path):
    log = tmp_path / "logins"

    def authenticate():
        with open(log, "a") as file:
            file.write("x")
        return "t"

    fetch = lambda day, token: [{"product_id": 1, "date": token}]
    spark.dataSource.register(daily_source(source_name, fetch, STOCK_SCHEMA, authenticate))
    days = ",".join(d.isoformat() for d in days_between(FIRST, FIRST + dt.timedelta(days=30)))
    frame = spark.read.format(source_name).option("days", days).load()
    assert frame.count() == 31
    # Spark may plan a read more than once; the days do not log in.
    assert len(log.read_text()) <= 3


def test_an_answer_without_rows_is_stored_and_told_from_no_answer(spark, api, source_name, root):
    name, _ = api
    update_days(spark, name, DAYS, root)
    other = source_name + "_later"
    answers = {DAYS[0]: [], DAYS[1]: None}
    spark.dataSource.register(daily_source(other, answers.get, STOCK_SCHEMA))
    assert update_days(spark, other, DAYS, root) == [DAYS[0]]
    stored = read_days(spark, root, DAYS[0], DAYS[2], "json", STOCK_SCHEMA)
    assert {r.ds for r in stored.collect()} == {DAYS[2]}
    assert DAYS[0] in stored_days(spark, root)
    assert backfill(spark, other, [DAYS[0]], root) == []


def test_a_thousand_empty_days_cost_one_write(spark, source_name, root, monkeypatch):
    from pyspark.sql import DataFrameWriter

    days = days_between(FIRST, FIRST + dt.timedelta(days=999))
    fetch = lambda day: [] if day != FIRST else document(day)
    spark.dataSource.register(daily_source(source_name, fetch, STOCK_SCHEMA))
    writes = []
    for name in ("save", "parquet", "json"):
        plain = getattr(DataFrameWriter, name)

        def counted(self, path=None, *args, plain=plain, **more):
            writes.append(path)
            return plain(self, path, *args, **more)

        monkeypatch.setattr(DataFrameWriter, name, counted)
    assert update_days(spark, source_name, days, root) == days
    assert writes == [root, f"{root}/_answered"]
    assert stored_days(spark, root) == days
    assert os.listdir(root).count("ds=2021-01-01") == 1 and len(os.listdir(root)) <= 4
    assert backfill(spark, source_name, days, root) == [] and len(writes) == 2


def test_days_in_the_ledger_are_not_missing(spark, api, root, rows):
    name, calls = api
    files.record_answers(spark, root, DAYS[:2])
    files.record_answers(spark, root, DAYS[:1])
    assert rows(answered_days(spark, root)) == [(DAYS[0],), (DAYS[1],)]
    assert backfill(spark, name, DAYS, root) == [DAYS[2]]
    assert calls() == ["2021-01-03"]
    assert stored_days(spark, root) == DAYS


def test_a_run_that_dies_before_the_ledger_asks_again(spark, source_name, root, monkeypatch):
    answers = {DAYS[0]: [], DAYS[1]: document(DAYS[1])}
    spark.dataSource.register(daily_source(source_name, answers.get, STOCK_SCHEMA))

    def dies(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(daily, "record_answers", dies)
        with pytest.raises(OSError):
            update_days(spark, source_name, DAYS, root)
    assert stored_days(spark, root) == [DAYS[1]]
    assert backfill(spark, source_name, DAYS, root) == [DAYS[0]]


def test_a_store_of_answers_without_rows(spark, source_name, root):
    spark.dataSource.register(daily_source(source_name, lambda day: [], STOCK_SCHEMA))
    for schema in (STOCK_SCHEMA, None):
        found = get_days(spark, source_name, DAYS, root, schema=schema)
        assert found.count() == 0 and found.columns[-1] == "ds"
    assert clear(spark, root, STOCK_SCHEMA) and stored_days(spark, root) == []
    assert not clear(spark, root, STOCK_SCHEMA)


@pytest.mark.parametrize("fmt", ["json", "parquet", "csv"])
def test_days_are_emptied_by_one_write(spark, root, fmt):
    frame = spark.createDataFrame([(n, d) for d in DAYS for n in range(9)], "n int, ds date")
    files.write_days(frame, root, fmt)
    files.empty_days(spark, root, DAYS[:2], frame.drop("ds").schema, fmt)
    left = read_days(spark, root, DAYS[0], DAYS[2], fmt, frame.drop("ds").schema)
    assert {r.ds for r in left.collect()} == {DAYS[2]} and left.count() == 9
    assert stored_days(spark, root) == DAYS
    files.empty_days(spark, root, [], frame.schema, fmt)
