"""One load at a time on targets that have no key of their own."""

import datetime as dt
import glob
import os
import threading
import time
import uuid

import pytest

from retail_lake import storage
from retail_lake.contracts import CLIENTS, ORDERS
from retail_lake.operators import insert_new
from retail_lake.sources import BucketedTarget, Claims, ConcurrentLoad, ParquetTarget, claims

CLIENT = "client_id int, fullname string, location_area_id int"


def bucketed(path):
    return BucketedTarget(CLIENTS, f"clients_{uuid.uuid4().hex}", path, 4)


def parquet(path):
    return ParquetTarget(CLIENTS, path)


@pytest.mark.parametrize("make", [parquet, bucketed])
def test_of_two_loads_started_together_one_fails_and_no_key_is_twice(spark, root, rows, make):
    target = make(f"{root}/clients")
    insert_new(spark.createDataFrame([(0, "before", 1)], CLIENT), target)
    both = threading.Barrier(2)
    kind = type(target)

    class Together(kind):
        """Both loads have read their keys before either goes on."""

        def keys(self, *args):
            found = super().keys(*args)
            both.wait(timeout=60)
            return found

    together = Together(**{f: getattr(target, f) for f in target.__dataclass_fields__})
    ended = {}

    def load(name):
        batch = spark.createDataFrame([(n, name, 1) for n in range(5)], CLIENT)
        try:
            ended[name] = insert_new(batch, together).n_new
        except ConcurrentLoad as refused:
            ended[name] = refused

    threads = [threading.Thread(target=load, args=(name,)) for name in ("a", "b")]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    (good,) = [name for name, end in ended.items() if end == 4]
    (bad,) = [name for name, end in ended.items() if isinstance(end, ConcurrentLoad)]
    assert {good, bad} == {"a", "b"}
    assert rows(target.read(spark).select("client_id", "fullname")) == [
        (0, "before"), *((n, good) for n in range(1, 5))
    ]
    again = spark.createDataFrame([(n, bad, 1) for n in range(6)], CLIENT)
    assert insert_new(again, target).n_new == 1, "the refused load may run again"


def test_a_load_waits_for_nobody_that_still_runs(spark, root):
    target = parquet(f"{root}/clients")
    seen = target.claims.begin(spark)
    target.claims.take(spark, seen)
    batch = spark.createDataFrame([(1, "ann", 1)], CLIENT)
    with pytest.raises(ConcurrentLoad, match="not finished"):
        insert_new(batch, target)
    assert target.read(spark) is None
    assert target.claims.release(spark) and not target.claims.release(spark)
    assert insert_new(batch, target).n_new == 1


def test_a_claim_may_be_given_an_age(spark, root):
    target = ParquetTarget(CLIENTS, f"{root}/clients", stale_after=dt.timedelta(seconds=1))
    target.claims.take(spark, 0)
    batch = spark.createDataFrame([(1, "ann", 1)], CLIENT)
    with pytest.raises(ConcurrentLoad):
        target.claims.begin(spark)
    time.sleep(1.5)
    assert insert_new(batch, target).n_new == 1


def test_a_failed_append_lets_the_next_load_in(spark, root):
    class Broken(ParquetTarget):
        def append(self, *args):
            raise OSError("disk full")

    batch = spark.createDataFrame([(1, "ann", 1)], CLIENT)
    with pytest.raises(OSError, match="disk full"):
        insert_new(batch, Broken(CLIENTS, f"{root}/clients"))
    assert insert_new(batch, parquet(f"{root}/clients")).n_new == 1


def test_an_interrupt_keeps_the_claim(spark, root):
    class Interrupted(ParquetTarget):
        def append(self, *args):
            raise KeyboardInterrupt

    batch = spark.createDataFrame([(1, "ann", 1)], CLIENT)
    with pytest.raises(KeyboardInterrupt):
        insert_new(batch, Interrupted(CLIENTS, f"{root}/clients"))
    with pytest.raises(ConcurrentLoad):
        insert_new(batch, parquet(f"{root}/clients"))


def test_refused_and_empty_loads_claim_nothing(spark, root):
    target = parquet(f"{root}/clients")
    insert_new(spark.createDataFrame([], CLIENT), target)
    with pytest.raises(ValueError):
        insert_new(spark.createDataFrame([(1, "x" * 64, 1)], CLIENT), target)
    assert target.claims.begin(spark) == 0 and not glob.glob(f"{root}/_claims_clients/*")


def test_old_claims_are_deleted_and_not_taken_again(spark, root, monkeypatch):
    monkeypatch.setattr(claims, "KEPT", 3)
    own = Claims.beside(f"{root}/t")
    for number in range(8):
        assert own.begin(spark) == number
        own.finish(spark, own.take(spark, number))
    assert sorted(os.listdir(f"{root}/_claims_t"))[0] == "000000006.claim"
    with pytest.raises(ConcurrentLoad, match="went past"):
        own.take(spark, 1)
    assert own.begin(spark) == 8


def test_many_callers_create_a_file_once(spark, root):
    made = []
    path = f"{root}/x/claim"
    threads = [
        threading.Thread(target=lambda n=n: made.append(storage.create_new(spark, path, str(n))))
        for n in range(12)
    ]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert sorted(made) == [False] * 11 + [True]


def test_a_store_that_is_no_local_one(spark, root):
    """Through a mount table, as the file is then created by Hadoop."""
    os.makedirs(root)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.claims.link./in", f"file://{root}")
    assert storage.create_new(spark, "viewfs://claims/in/a/claim", "mine")
    assert not storage.create_new(spark, "viewfs://claims/in/a/claim", "yours")
    with open(f"{root}/a/claim") as file:
        assert file.read() == "mine"


def test_a_bucketed_target_claims_beside_its_folder(root):
    target = BucketedTarget(ORDERS, "t", f"{root}/gold/orders/", 4)
    assert target.claims.folder == f"{root}/gold/_claims_orders"
