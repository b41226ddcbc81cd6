import datetime as dt
import glob
import os
import random
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retail_lake import sizing
from retail_lake.checks import queries
from retail_lake.contracts import CLIENTS, ORDERS, OUT_OF_STOCK, Contract, ContractViolation
from retail_lake.operators import insert_new, merge
from retail_lake.operators.joins import possible_partners
from retail_lake.sizing import INITIAL
from retail_lake.sources import BucketedTarget, ParquetTarget
from retail_lake.workspace import Staged, stage, work_dir

CLIENT = "client_id bigint, fullname string, location_area_id int"
ORDER = "product_id bigint, client_id bigint, order_date string, store_id bigint, quantity int"


@pytest.fixture
def clients(root):
    return ParquetTarget(CLIENTS, f"{root}/clients")


@pytest.fixture(params=["parquet", "bucketed"])
def orders(request, root):
    if request.param == "parquet":
        return ParquetTarget(ORDERS, f"{root}/orders")
    return BucketedTarget(ORDERS, f"orders_{uuid.uuid4().hex}", f"{root}/orders", 16)


def test_only_new_keys_are_inserted_and_the_result_stays(spark, clients, rows):
    first = insert_new(spark.createDataFrame([(1, "ann", 5)], CLIENT), clients)
    assert (first.n_new, rows(first.rows)) == (1, [(1, "ann", 5)])
    batch = spark.createDataFrame([(1, "renamed", 9), (2, "bob", None)], CLIENT)
    second = insert_new(batch, clients, count_existing=True)
    assert (second.n_new, second.n_existing) == (1, 1)
    assert rows(second.rows) == [(2, "bob", None)]
    assert rows(clients.read(spark)) == [(1, "ann", 5), (2, "bob", None)]
    typed = [(f.name, f.dataType.simpleString()) for f in CLIENTS.schema]
    assert clients.read(spark).dtypes == typed
    again = insert_new(batch, clients)
    assert again.n_new == 0 and rows(again.rows) == []
    assert rows(first.rows) == [(1, "ann", 5)]


@pytest.mark.parametrize(
    "bad, finding",
    [
        ((None, "x", 1), "NULL or bad key: 1"),
        ((3_000_000_000, "x", 1), "NULL or bad key: 1"),
        ((7, "x" * 64, 1), "too_long:fullname: 1"),
    ],
)
def test_a_row_that_breaks_a_rule_stops_the_load(spark, clients, rows, bad, finding):
    insert_new(spark.createDataFrame([(1, "ann", 5)], CLIENT), clients)
    with pytest.raises(ContractViolation, match=finding):
        insert_new(spark.createDataFrame([(2, "bob", 1), bad], CLIENT), clients)
    assert rows(clients.read(spark)) == [(1, "ann", 5)]


def test_bad_value_in_a_nullable_column_does_not_vanish(spark, clients):
    columns = "client_id string, fullname string, location_area_id string"
    batch = spark.createDataFrame([("1", "ann", "here")], columns)
    with pytest.raises(ContractViolation, match="bad_value:location_area_id: 1"):
        insert_new(batch, clients)
    assert clients.read(spark) is None


def test_broken_row_of_an_existing_key_is_not_inserted_and_not_an_error(spark, clients, rows):
    insert_new(spark.createDataFrame([(1, "ann", 5)], CLIENT), clients)
    assert insert_new(spark.createDataFrame([(1, "x" * 64, 5)], CLIENT), clients).n_new == 0


def test_repeated_new_key(spark, orders, rows):
    day = dt.date(2021, 1, 3)
    batch = spark.createDataFrame(
        [(1, 1, "2021-01-03", 1, 9), (1, 1, "2021-1-3", 1, 4), (2, 1, "2021-01-03", 1, None)], ORDER
    )
    with pytest.raises(ContractViolation, match="repeated new keys: 1, such as .*2021-01-03"):
        insert_new(batch, orders)
    assert orders.read(spark) is None
    done = insert_new(batch, orders, on_duplicate="first", order_by=["quantity"])
    expected = [(1, 1, day, 1, 4), (2, 1, day, 1, None)]
    assert done.n_new == 2 and rows(done.rows) == expected
    assert rows(orders.read(spark).select(*ORDERS.schema.names)) == expected
    assert insert_new(batch, orders).n_new == 0, "copies of an existing key are no error"


def test_arguments(spark, clients):
    batch = spark.createDataFrame([], CLIENT)
    with pytest.raises(ValueError, match="needs order_by"):
        insert_new(batch, clients, on_duplicate="first")
    with pytest.raises(ValueError, match="on_duplicate"):
        insert_new(batch, clients, on_duplicate="last")
    assert insert_new(batch, clients).n_new == 0
    assert clients.read(spark) is None and clients.count(spark) == 0


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_merges_match_brute_force(spark, orders, rows, seed):
    rng = random.Random(seed)
    days = [dt.date(2020, 12, 30) + dt.timedelta(days=n) for n in range(5)]
    gold = {}
    for _ in range(3):
        n = rng.randrange
        data = [(n(4), n(3), str(rng.choice(days)), n(2), n(9)) for _ in range(40)]
        first = {}
        for p, c, d, s, q in data:
            key = (p, c, dt.date.fromisoformat(d), s)
            first[key] = min(q, first.get(key, q))
        expected = {k: q for k, q in first.items() if k not in gold}
        done = insert_new(
            spark.createDataFrame(data, ORDER), orders, on_duplicate="first", order_by=["quantity"]
        )
        assert rows(done.rows) == sorted(((*k, q) for k, q in expected.items()), key=repr)
        gold.update(expected)
        assert rows(orders.read(spark).select(*ORDERS.schema.names)) == sorted(
            ((*k, q) for k, q in gold.items()), key=repr
        )


def _explain(spark, target, batch, monkeypatch):
    plans = []

    def explained(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stage(df, label)

    monkeypatch.setattr("retail_lake.operators.merge.stage", explained)
    insert_new(batch, target)
    return plans[0]


def test_merge_moves_the_batch_once_and_reads_only_keys_of_its_days(
    spark, orders, monkeypatch
):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        data = [(n, n, f"2021-0{1 + n % 4}-15", 1, 1) for n in range(40)]
        insert_new(spark.createDataFrame(data, ORDER), orders)
        batch = spark.createDataFrame(data, ORDER).where("order_date >= '2021-03-01'")
        plan = _explain(spark, orders, batch, monkeypatch)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    bucketed = isinstance(orders, BucketedTarget)
    assert plan.count("Exchange hashpartitioning") == (1 if bucketed else 2)
    assert "Bucketed: true" in plan if bucketed else "2021-03" in plan.split("PartitionFilters")[1]
    assert "quantity" not in plan.split("ReadSchema")[-1]


def test_files_of_a_target(spark, root, monkeypatch):
    data = [(n, n, f"2021-0{1 + n % 4}-15", 1, 1) for n in range(40)]
    batch = spark.createDataFrame(data, ORDER)
    insert_new(batch, ParquetTarget(ORDERS, f"{root}/p"))
    folders = sorted(f.rsplit("/", 1)[1] for f in glob.glob(f"{root}/p/*_month=*"))
    assert folders == [f"order_date_month=2021-0{m}" for m in (1, 2, 3, 4)]
    assert len(glob.glob(f"{root}/p/*/*.parquet")) == 4
    insert_new(batch, BucketedTarget(ORDERS, f"b_{uuid.uuid4().hex}", f"{root}/b", 8))
    assert len(glob.glob(f"{root}/b/*.parquet")) <= 8


def test_months_of_any_century(spark, root, rows):
    target = ParquetTarget(ORDERS, f"{root}/p")
    days = ("-0001-02-03", "0999-12-31", "1970-01-01", "9999-12-31", "20210-01-01")
    data = [(1, 1, day, 1, 1) for day in days]
    assert insert_new(spark.createDataFrame(data, ORDER), target).n_new == 5
    assert insert_new(spark.createDataFrame(data, ORDER), target).n_new == 0
    for row in data:
        assert insert_new(spark.createDataFrame([row], ORDER), target).n_new == 0
    assert target.count(spark) == 5


def test_a_heavy_month_is_written_by_several_tasks(spark, root, settings):
    settings(
        adaptive__advisoryPartitionSizeInBytes="20KB",
        adaptive__coalescePartitions__minPartitionSize="1KB",
    )
    data = spark.range(0, 60_000, 1, 8).selectExpr(
        "id AS product_id",
        "id AS client_id",
        "if(id % 3 = 0, date'2021-01-01', date_add(date'2021-02-01', cast(id % 28 as int)))"
        " AS order_date",
        "1 AS store_id",
        "1 AS quantity",
    )
    target = ParquetTarget(ORDERS, f"{root}/heavy")
    assert insert_new(data, target).n_new == 60_000
    assert len(glob.glob(f"{root}/heavy/order_date_month=2021-01/*.parquet")) > 1
    assert target.read(spark).count() == 60_000


def test_key_without_value_columns_and_typed_null(spark, root, rows):
    target = ParquetTarget(OUT_OF_STOCK, f"{root}/oos")
    batch = spark.createDataFrame([(1, "2021-01-03")], "product_id int, order_date string")
    batch = batch.withColumn("store_id", F.lit(None).cast("int"))
    assert rows(insert_new(batch, target).rows) == [(1, dt.date(2021, 1, 3), None)]


def test_working_folder_is_the_one_the_session_names(spark):
    assert work_dir(spark) == spark.conf.get("spark.checkpoint.dir") + "/retail_lake"


def test_refused_rows_can_be_looked_at(spark, clients, rows):
    batch = spark.createDataFrame([(1, "x" * 64, 1), (2, "fine", 1)], CLIENT)
    with pytest.raises(ContractViolation) as refused:
        insert_new(batch, clients)
    staged = refused.value.staged
    assert refused.value.findings == ["too_long:fullname: 1 keys"]
    assert rows(staged.rows.where("_broken <> 0").select("client_id")) == [(1,)]


def test_only_a_staged_table_can_be_discarded(spark, clients, root):
    done = insert_new(spark.createDataFrame([(1, "ann", 5)], CLIENT), clients)
    done.staged.discard()
    assert not glob.glob(f"{done.staged.path}*")
    assert clients.count(spark) == 1
    with pytest.raises(ValueError, match="not a staged table"):
        Staged(clients.path, done.rows).discard()
    with pytest.raises(ValueError, match="not a staged table"):
        Staged(work_dir(spark), done.rows).discard()


def test_a_bucketed_table_lost_by_the_catalog_is_not_taken_for_new(spark, root):
    batch = spark.createDataFrame([(1, 1, "2021-01-03", 1, 9)], ORDER)
    insert_new(batch, BucketedTarget(ORDERS, f"a_{uuid.uuid4().hex}", f"{root}/b", 8))
    lost = BucketedTarget(ORDERS, f"b_{uuid.uuid4().hex}", f"{root}/b", 8)
    with pytest.raises(RuntimeError, match="catalog lost"):
        insert_new(batch, lost)


@pytest.mark.parametrize("master", ["local[4]", "yarn"])
def test_a_cluster_must_name_its_shared_folder(master):
    class Session:
        conf = type("Conf", (), {"get": staticmethod(lambda name, default: default)})
        sparkContext = type("Context", (), {"master": master})

    if master == "yarn":
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            work_dir(Session)
    else:
        assert work_dir(Session) == work_dir(Session)


def test_a_contract_of_many_rules(spark, root):
    """Seventy rules: a mark for each, also past the first number's bits."""
    names = [f"c{n}" for n in range(35)]
    columns = [T.StructField("id", T.IntegerType(), False)]
    columns += [T.StructField(n, T.VarcharType(3), False) for n in names]
    contract = Contract("wide", T.StructType(columns), ("id",))
    text = "id int, " + ", ".join(f"{n} string" for n in names)
    good = (1, *["x"] * 35)
    bad = (2, *["x"] * 33, "long text", None)
    target = ParquetTarget(contract, f"{root}/wide")
    with pytest.raises(ContractViolation) as refused:
        insert_new(spark.createDataFrame([good, bad], text), target)
    assert set(refused.value.findings) == {"too_long:c33: 1 keys", "null:c34: 1 keys"}
    assert insert_new(spark.createDataFrame([good], text), target).n_new == 1


def test_a_lossy_key_is_refused(spark, root):
    contract = Contract("k", T.StructType([T.StructField("id", T.IntegerType(), False)]), ("id",))
    frame = spark.createDataFrame([(12.7,), (1.0,)], "id double")
    with pytest.raises(ContractViolation, match="NULL or bad key: 1 rows"):
        insert_new(frame, ParquetTarget(contract, f"{root}/k"))


def test_months_between_are_not_read(spark, root):
    """One odd date does not open the months before it."""
    target = ParquetTarget(ORDERS, f"{root}/orders")
    rows = [(1, 1, dt.date(2021, m, 1), 1, 1) for m in range(1, 13)]
    schema = "product_id int, client_id int, order_date date, store_id int, quantity int"
    frame = spark.createDataFrame(rows, schema)
    insert_new(frame, target)
    some = frame.where("month(order_date) in (1, 12)")
    days, span = merge._check_keys(merge.key_facts(some, ORDERS), ORDERS)
    assert days == ("2021-01-01", "2021-12-01", ("2021-01", "2021-12")) and span is None
    plan = target.keys(spark, days)._jdf.queryExecution().executedPlan().toString()
    assert "order_date_month" in plan.partition("PartitionFilters")[2][:120]
    assert target.keys(spark, days).count() == 2


def test_a_bucketed_target_is_pruned_and_leaves_the_session_alone(spark, root):
    table = f"orders_{uuid.uuid4().hex}"
    target = BucketedTarget(ORDERS, table, f"{root}/orders", 4, folders="month")
    schema = "product_id int, client_id int, order_date date, store_id int, quantity int"
    frame = spark.createDataFrame([(1, 1, dt.date(2021, m, 1), 1, 1) for m in (1, 2, 3)], schema)
    os.makedirs(f"{root}/orders/empty")
    before = spark.conf.get(INITIAL, None)
    assert insert_new(frame, target).n_new == 3
    assert insert_new(frame, target).n_new == 0
    assert spark.conf.get(INITIAL, None) == before
    days, _ = merge._check_keys(merge.key_facts(frame.limit(1), ORDERS), ORDERS)
    plan = target.keys(spark, days)._jdf.queryExecution().executedPlan().toString()
    assert "order_date_month" in plan.partition("PartitionFilters")[2][:120]


@pytest.mark.parametrize(
    "file_bytes, folders, files", [(1, "month", 5 * 4), (1500, "year", 2 * 4), (10**9, "none", 4)]
)
def test_a_tables_folders_follow_the_bytes_of_its_first_load(spark, root, file_bytes, folders, files):
    """Five months of two years in four buckets."""
    path = f"{root}/{folders}"
    table = f"orders_{uuid.uuid4().hex}"
    data = spark.range(4000).selectExpr(
        "id AS product_id",
        "id AS client_id",
        "element_at(array('2020-11-05', '2020-12-05', '2021-01-05', '2021-02-05', '2021-03-05'),"
        " cast(id % 5 + 1 AS int)) AS order_date",
        "1 AS store_id",
        "1 AS quantity",
    )
    target = BucketedTarget(ORDERS, table, path, 4, file_bytes=file_bytes)
    assert target.stored_folders(spark) is None
    assert insert_new(data.where("id < 3000"), target).n_new == 3000
    assert target.stored_folders(spark) == folders
    assert len(glob.glob(f"{path}/**/part-*", recursive=True)) == files
    # Another object for the same table, with another mind, keeps to what is stored.
    later = BucketedTarget(ORDERS, table, path, 4, folders="month" if folders != "month" else "year")
    assert insert_new(data, later).n_new == 1000
    assert insert_new(data, target).n_new == 0
    assert sorted(r[0] for r in later.read(spark).collect()) == list(range(4000))
    one = data.where("order_date = '2021-02-05'")
    days, _ = merge._check_keys(merge.key_facts(one, ORDERS), ORDERS)
    plan = target.keys(spark, days)._jdf.queryExecution().executedPlan().toString()
    assert target.keys(spark, days).count() == 800
    if folders != "none":
        assert f"order_date_{folders}" in plan.partition("PartitionFilters")[2][:120]


def test_a_table_from_before_there_was_a_choice_is_one_by_months(spark, root):
    path, table = f"{root}/old", f"orders_{uuid.uuid4().hex}"
    target = BucketedTarget(ORDERS, table, path, 4)
    old = spark.createDataFrame([(1, 1, dt.date(2021, 1, 1), 1, 1, "2021-01")], ", ".join(
        [*(f"{f.name} {f.dataType.simpleString()}" for f in ORDERS.schema), "order_date_month string"]
    ))
    keys = list(ORDERS.key)
    writer = old.write.option("path", path).partitionBy("order_date_month")
    writer.bucketBy(4, *keys).sortBy(*keys).saveAsTable(table)
    assert target.stored_folders(spark) == "month"
    batch = spark.createDataFrame([(1, 1, "2021-01-01", 1, 1), (2, 1, "2021-02-01", 1, 1)], ORDER)
    assert insert_new(batch, target).n_new == 1
    assert os.path.isdir(f"{path}/order_date_month=2021-02")


def test_days_and_years():
    assert merge.Days("x", "y", ("-0001-02", "2020-12", "2021-01", "2021-03")).years == (
        "-0001", "2020", "2021"
    )


def test_facts_are_one_row_a_day_however_finely_times_are_told(spark):
    moments = [dt.datetime(2021, 1, 3, 0), dt.datetime(2021, 1, 3, 10), dt.datetime(2021, 1, 3, 11)]
    batch = spark.createDataFrame(
        [(n, n, m, 1, 1) for n, m in enumerate(moments)],
        "product_id int, client_id int, order_date timestamp, store_id int, quantity int",
    )
    facts = merge.key_facts(batch, ORDERS)
    assert "ObjectHashAggregate" not in facts._jdf.queryExecution().executedPlan().toString()
    facts = {r.order_date: (r.n_rows, r.n_keyless) for r in facts.collect()}
    assert facts == {dt.date(2021, 1, 3): (1, 0), None: (2, 2)}


def test_a_moment_within_a_day_is_no_key(spark, orders):
    columns = "product_id int, client_id int, order_date timestamp, store_id int, quantity int"
    whole = spark.createDataFrame([(1, 1, dt.datetime(2021, 1, 3), 1, 1)], columns)
    part = spark.createDataFrame([(1, 1, dt.datetime(2021, 1, 3, 10), 1, 1)], columns)
    text = spark.createDataFrame([(1, 1, "2021-01-03 10:00", 1, 1)], ORDER)
    for batch in (part, text, whole.union(part)):
        with pytest.raises(ContractViolation, match="NULL or bad key: 1 rows"):
            insert_new(batch, orders)
    assert insert_new(whole, orders).n_new == 1


def _staged_plans(batch, target, monkeypatch, **options):
    plans = {}

    def explained(df, label):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return stage(df, label)

    monkeypatch.setattr("retail_lake.operators.merge.stage", explained)
    done = insert_new(batch, target, **options)
    return plans, done


def test_a_wide_snapshot_whose_keys_exist_is_neither_sorted_nor_moved(spark, root, clients, monkeypatch):
    given = spark.createDataFrame([(n, f"client {n}", n) for n in range(500)], CLIENT)
    given.write.parquet(f"{root}/snapshot")
    snapshot = spark.read.parquet(f"{root}/snapshot")
    plans, done = _staged_plans(snapshot, clients, monkeypatch)
    assert done.n_new == 500 and "SortAggregate" not in "".join(plans.values())
    assert "Exchange" not in plans["new-clients"]
    renamed = snapshot.withColumn("fullname", F.lit("other"))
    plans, done = _staged_plans(renamed, clients, monkeypatch)
    assert done.n_new == 0 and set(plans) == {"new-keys-clients"}
    assert "SortAggregate" not in plans["new-keys-clients"] and "fullname" not in plans["new-keys-clients"]
    more = renamed.unionByName(spark.createDataFrame([(900, "new", 1)], CLIENT))
    plans, done = _staged_plans(more, clients, monkeypatch)
    assert done.n_new == 1 and "SortAggregate" not in "".join(plans.values())


def test_only_new_keys_that_repeat_are_collapsed(spark, clients, rows, monkeypatch):
    insert_new(spark.createDataFrame([(1, "ann", 5)], CLIENT), clients)
    batch = spark.createDataFrame(
        [(1, "z", 1), (1, "a", 1), (2, "bob", 2), (3, "cy", 9), (3, "cy", 8), (3, None, 1)], CLIENT
    )
    with pytest.raises(ContractViolation, match="repeated new keys: 1, such as .*3"):
        insert_new(batch, clients)
    options = {"on_duplicate": "first", "order_by": ["fullname"]}
    plans, done = _staged_plans(batch, clients, monkeypatch, **options)
    assert plans["new-clients"].count("SortAggregate") == 2
    assert rows(done.rows) == [(2, "bob", 2), (3, "cy", 8)]
    bad = spark.createDataFrame([(4, "x", 1), (4, "y" * 64, 1)], CLIENT)
    with pytest.raises(ContractViolation, match="too_long:fullname: 1 keys"):
        insert_new(bad, clients, **options)


@pytest.mark.parametrize("prefilter", [None, True])
@pytest.mark.parametrize("seed", [1, 2])
def test_random_wide_merges_match_brute_force(spark, clients, rows, seed, prefilter):
    rng, gold = random.Random(seed), {}
    for _ in range(3):
        data = [(rng.randrange(30), rng.choice("abc"), rng.randrange(3)) for _ in range(40)]
        first = {}
        for row in data:
            first[row[0]] = min(row, first.get(row[0], row))
        expected = {k: row for k, row in first.items() if k not in gold}
        done = insert_new(
            spark.createDataFrame(data, CLIENT),
            clients,
            on_duplicate="first",
            order_by=["fullname", "location_area_id"],
            prefilter=prefilter,
        )
        assert rows(done.rows) == sorted(expected.values(), key=repr)
        gold |= expected
        assert rows(clients.read(spark)) == sorted(gold.values(), key=repr)


def test_a_batch_that_changes_between_its_passes_is_refused(spark, clients, monkeypatch):
    insert_new(spark.createDataFrame([(0, "x", 1)], CLIENT), clients)
    passes = iter([[(1, "a", 1), (2, "b", 1)], [(1, "a", 1)]])
    staging = merge.stage

    def changing(df, label):
        rows = spark.createDataFrame(next(passes), CLIENT)
        if label.startswith("new-keys"):
            return staging(rows.select(F.col("client_id").cast("int")).withColumn("_copies", F.lit(1)), label)
        return staging(rows.withColumn("_copies", F.lit(1)).withColumn("_broken", F.lit(0)), label)

    monkeypatch.setattr(merge, "stage", changing)
    with pytest.raises(ContractViolation, match="2 new keys became 1 rows: the batch changed"):
        insert_new(spark.createDataFrame([(5, "a", 1)], CLIENT), clients)
    assert clients.count(spark) == 1


def test_keys_without_a_day_are_read_by_the_batchs_span_and_filter(spark, clients, monkeypatch):
    insert_new(spark.createDataFrame([(n, "x", 1) for n in range(2000)], CLIENT), clients)
    batch = spark.createDataFrame([(n, "y", 1) for n in range(1900, 2100, 2)], CLIENT)
    plans, done = _staged_plans(batch, clients, monkeypatch, prefilter=True)
    assert done.n_new == 50
    pushed = plans["new-keys-clients"].partition("PushedFilters")[2].partition("]")[0]
    assert "GreaterThanOrEqual(client_id,1900)" in pushed and "(client_id,2098)" in pushed
    assert "bitmap_construct_agg" in plans["new-keys-clients"]
    existing = clients.keys(spark, None, merge.Span("client_id", "1900", "2098"))
    assert existing.count() == 100 + 50
    passed = possible_partners(existing, batch.selectExpr("cast(client_id AS int)"), ["client_id"])
    assert 100 <= passed.count() < 110


def test_a_filter_that_is_too_small_lets_more_pass_and_loses_none(spark):
    batch = spark.range(0, 200_000, 2)
    existing = spark.range(0, 200_000)
    for bits, most in ((1 << 15, 200_000), (1 << 22, 105_000)):
        passed = possible_partners(existing, batch, ["id"], most_bits=bits)
        assert passed.join(batch, "id", "left_semi").count() == 100_000
        assert passed.count() <= most
    assert possible_partners(existing, batch.limit(0), ["id"]).count() == 0


@pytest.mark.parametrize("name", ["orders_merged_yearly", "orders_merged_bucketed"])
def test_buckets_follow_the_rows(spark, root, monkeypatch, name):
    """A bucket's keys meet in one task, so more rows need more buckets."""
    spark.range(300).selectExpr(
        "id % 60 AS l_orderkey", "id AS l_partkey", "id % 7 AS l_suppkey", "1 AS l_quantity"
    ).write.parquet(f"{root}/lineitem.parquet")
    spark.range(60).selectExpr(
        "id AS o_orderkey", "id AS o_custkey",
        "timestamp'1994-01-01' + make_interval(0, 0, 0, 30 * CAST(id AS int)) AS o_orderdate",
    ).write.parquet(f"{root}/orders.parquet")
    monkeypatch.setattr(sizing, "ROWS_PER_BUCKET", 10)
    found = queries.registered()[name](spark, root)
    assert found.count() == 300
    buckets = {int(f.rpartition("_")[2].partition(".")[0]) for f in found.inputFiles()}
    assert 20 <= len(buckets) <= 30
