"""What is asked of a database. No database is started: nothing here connects."""

import pytest

from retail_lake.contracts import CLIENTS, ORDERS
from retail_lake.sources import JdbcTarget, jdbc
from retail_lake.sources.targets import Days, Span


class FakeReader:
    """Stands for ``spark.read`` and keeps the options of every load."""

    def __init__(self, loads, answer=None, options=None):
        self.loads, self.answer, self.asked = loads, answer, options or {}

    def format(self, name):
        return self.options(format=name)

    def options(self, **more):
        return FakeReader(self.loads, self.answer, {**self.asked, **more})

    def option(self, name, value):
        return self.options(**{name: value})

    def load(self):
        self.loads.append(self.asked)
        return self

    def jdbc(self, url, table, predicates, properties):
        self.loads.append({"url": url, "dbtable": table, "predicates": predicates, **properties})
        return self

    def first(self):
        return self.answer


class FakeSession:
    def __init__(self, answer=None):
        self.loads = []
        self.read = FakeReader(self.loads, answer)


URL, PROPERTIES = "jdbc:postgresql://host/shop", {"user": "u", "driver": "d"}


def test_small_table_is_one_read():
    session = FakeSession()
    jdbc.snapshot(session, URL, "public.aisles", PROPERTIES)
    (asked,) = session.loads
    assert asked["dbtable"] == "public.aisles" and asked["user"] == "u"
    assert asked["fetchsize"] == "10000" and "numPartitions" not in asked


def test_split_table_asks_for_bounds_and_reads_in_parallel():
    session = FakeSession((3, 900))
    jdbc.snapshot(session, URL, "public.orders", PROPERTIES, split="client_id", partitions=4)
    bounds, read = session.loads
    assert bounds["query"] == "SELECT MIN(client_id) AS lo, MAX(client_id) AS hi FROM public.orders"
    assert read.items() >= {
        "partitionColumn": "client_id",
        "lowerBound": "3",
        "upperBound": "900",
        "numPartitions": "4",
    }.items()


@pytest.mark.parametrize("answer", [(None, None), (5, 5)])
def test_nothing_to_split(answer):
    session = FakeSession(answer)
    jdbc.snapshot(session, URL, "t", PROPERTIES, split="id")
    assert "numPartitions" not in session.loads[-1]


def test_own_predicates_win():
    session = FakeSession()
    jdbc.snapshot(session, URL, "t", PROPERTIES, split="id", predicates=["id < 5", "id >= 5"])
    (asked,) = session.loads
    assert asked["predicates"] == ["id < 5", "id >= 5"] and asked["fetchsize"] == "10000"


def test_a_table_that_changes_while_it_is_read_is_noticed():
    session = FakeSession((10, "2021-01-03"))
    fences = ("SELECT COUNT(*), MAX(changed_at) FROM a", "SELECT COUNT(*), MAX(changed_at) FROM b")
    with jdbc.unchanged(session, URL, PROPERTIES, *fences):
        jdbc.snapshot(session, URL, "a", PROPERTIES, split="id", bounds=(1, 9))
    asked = [load.get("query") for load in session.loads]
    assert asked == [*fences, None, *fences]
    assert all(load["user"] == "u" for load in session.loads)
    with pytest.raises(jdbc.ChangedMeanwhile, match="FROM a: .10, .* became .11"):
        with jdbc.unchanged(session, URL, PROPERTIES, *fences):
            session.read.answer = (11, "2021-01-04")


def test_an_error_inside_is_not_hidden_by_the_fence():
    session = FakeSession((1,))
    with pytest.raises(OSError):
        with jdbc.unchanged(session, URL, PROPERTIES, "SELECT COUNT(*) FROM a"):
            raise OSError("connection lost")
    assert len(session.loads) == 1


class FakeRows(FakeReader):
    """Adds what ``keys`` does to the loaded rows."""

    def options(self, **more):
        return FakeRows(self.loads, self.answer, {**self.asked, **more})

    def where(self, condition):
        self.loads.append({"where": str(condition)})
        return self

    def select(self, *columns):
        self.loads.append({"select": columns})
        return self

    def __getitem__(self, name):
        from pyspark.sql import functions as F

        return F.col(name)


def test_keys_of_the_batch_days_only(spark):
    session = FakeSession()
    session.read = FakeRows(session.loads)
    days = Days("2021-01-01", "2021-02-01", ("2021-01", "2021-02"))
    JdbcTarget(ORDERS, URL, "public.orders", PROPERTIES, partitions=6).keys(session, days)
    read, where, select = session.loads
    assert read["partitionColumn"] == "order_date" and read["numPartitions"] == "6"
    assert (read["lowerBound"], read["upperBound"]) == ("2021-01-01", "2021-02-01")
    assert "order_date" in where["where"] and select["select"] == ORDERS.key


def test_the_span_of_a_batch_is_asked_of_the_database(spark):
    session = FakeSession()
    session.read = FakeRows(session.loads)
    span = Span("client_id", "3", "900")
    JdbcTarget(CLIENTS, URL, "public.clients", PROPERTIES).keys(session, None, span)
    _, where, select = session.loads
    assert "client_id, CAST('3' AS INT)" in where["where"] and "'900'" in where["where"]
    assert select["select"] == ("client_id",)


def test_keys_of_an_undated_table(spark):
    session = FakeSession()
    session.read = FakeRows(session.loads)
    JdbcTarget(CLIENTS, URL, "public.clients", PROPERTIES).keys(session)
    read, select = session.loads
    assert "partitionColumn" not in read and select["select"] == ("client_id",)


@pytest.mark.parametrize("n_rows", [10, 10**9])
@pytest.mark.parametrize("atomic, parts", [(True, 1), (False, 3)])
def test_an_append_is_one_transaction_if_asked_for_at_any_size(n_rows, atomic, parts):
    seen = {}

    class Rows:
        write = property(lambda self: self)
        parts = 3

        def coalesce(self, n):
            self.parts = n
            return self

        def __getattr__(self, name):
            def step(*args, **more):
                seen.setdefault(name, []).append((args, more))
                return self

            return step

    rows = Rows()
    JdbcTarget(CLIENTS, URL, "public.clients", PROPERTIES, atomic=atomic).append(rows, n_rows)
    assert rows.parts == parts
    assert (("dbtable", "public.clients"), {}) in seen["option"]
    assert seen["mode"] == [(("append",), {})] and "save" in seen
