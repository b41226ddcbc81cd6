"""Shards of even size by balanced label propagation.

Documents with equal texts are linked. Every document starts in a shard drawn from its
hash. In each round the shard in which most of a group is calls the others of the group;
as many come as the shard's quota has room for, by the share of room to calls and a
hash, so no order over all documents is needed. At the end the shards that are above their
quota give up the documents that have the fewest neighbours there, and these fill the
shards below theirs: counts differ by one at most, the law ``rows``.

Everything is built-in expressions. What reaches the driver are counts by shard and
class. A group that holds a third of all rows is counted before it is shuffled, and joins
read written tables, so that its rows can be split; numbers within a shard are drawn in
parts and offset.

Results, by case: NULL and empty texts are one group, of 8 bytes each; repeated rows and
rows with a NULL ``doc_id`` are documents of their own with a slot each; with fewer
documents than shards some shards are empty; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retail_lake.workspace import Staged, stage

SHARDS = 24
ROUNDS = 4
#: How far above its quota a shard may be between rounds.
SLACK = 0.1
#: Bytes that a document takes besides its text.
OVERHEAD = 8
#: Classes of loss that the last step tells apart; dearer documents share the last one.
CLASSES = 64

GROUP = ["group1", "group2"]


def _uniform(*parts) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 30)) / float(1 << 30)


def _pick(values: dict[int, float], key: Column, count: int, default: float = 0.0) -> Column:
    """The value of a small table at ``key``."""
    return F.get(F.array(*[F.lit(values.get(i, default)) for i in range(count)]), key)


def numbered(rows: DataFrame, key: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with a number from 0 without gaps within ``key``, drawn in parallel.

    A key is cut into parts by a hash of ``order``. Rows are numbered within a part and
    moved by the sizes of the parts before: a table of keys times parts.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(parts)).cast("int"))
    sizes = dealt.groupBy(key, "_part").count()
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col(key).alias("_key"),
        F.col("_part").alias("_at"),
        F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"),
    )
    within = F.row_number().over(Window.partitionBy(key, "_part").orderBy(*order)) - 1
    placed = dealt.withColumn("_within", within).join(
        F.broadcast(offsets), (F.col(key) == F.col("_key")) & (F.col("_part") == F.col("_at"))
    )
    return placed.withColumn(name, (F.col("_offset") + F.col("_within")).cast("long")).drop(
        "_part", "_key", "_at", "_offset", "_within"
    )


def nodes_of(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32`` and the group of each document."""
    text = F.coalesce("text", F.lit(""))
    return documents.select("doc_id", text.alias("text")).select(
        "doc_id",
        (F.octet_length("text") + OVERHEAD).cast("long").alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        F.xxhash64("text").alias("group1"),
        F.xxhash64(F.lit(1), "text").alias("group2"),
    )


def _replace(old: Staged, rows: DataFrame) -> Staged:
    new = stage(rows, "shards")
    old.discard()
    return new


def _sizes(rows: DataFrame, column: str = "shard") -> dict[int, int]:
    return {r[0]: r[1] for r in rows.groupBy(column).count().collect()}  # one row a shard


def _round(nodes: Staged, quota: dict[int, int], number: int) -> Staged:
    """One round of calls and moves."""
    shards = len(quota)
    held = nodes.rows.where("linked").groupBy(*GROUP, "shard").count()
    # The largest part, then a draw between equal ones, and the shard, in one long.
    draw = F.pmod(F.xxhash64("group1", "shard"), F.lit(1 << 16))
    calls = held.groupBy(*GROUP).agg(
        F.max((F.col("count") * (1 << 16) + draw) * shards + F.col("shard")).alias("best")
    )
    calls = stage(
        calls.select(
            F.col("group1").alias("call1"),
            F.col("group2").alias("call2"),
            F.pmod("best", F.lit(shards)).cast("int").alias("called"),
        ),
        "calls",
    )
    joined = nodes.rows.where("linked").join(
        calls.rows, (F.col("group1") == F.col("call1")) & (F.col("group2") == F.col("call2"))
    )
    movers = joined.withColumn("moves", F.col("called") != F.col("shard"))
    demand = _sizes(movers.where("moves"), "called")
    leaving = _sizes(movers.where("moves"))
    sizes = _sizes(nodes.rows)
    room = {
        s: max(0.0, quota[s] * (1 + SLACK) - sizes.get(s, 0) + leaving.get(s, 0))
        / max(1, demand.get(s, 0))
        for s in range(shards)
    }
    # A small group comes together; of a large one as many as there is room for.
    large = F.col("group_rows") * shards > F.lit(sum(quota.values()) // 4)
    by_group = _uniform("group1", "group2", F.lit(number))
    by_row = _uniform("doc_id", "group1", F.lit(number))
    comes = F.when(large, by_row).otherwise(by_group) < _pick(room, F.col("called"), shards)
    moved = movers.withColumn(
        "shard", F.when(F.col("moves") & comes, F.col("called")).otherwise(F.col("shard"))
    ).select(*nodes.rows.columns)
    out = _replace(nodes, moved.unionByName(nodes.rows.where("NOT linked")))
    calls.discard()
    return out


def _level(nodes: Staged, quota: dict[int, int]) -> Staged:
    """Shards at exactly their quotas; the rows that lose least have moved."""
    shards = len(quota)
    held = stage(
        nodes.rows.where("linked")
        .groupBy(*GROUP, "shard")
        .count()
        .select(
            F.col("group1").alias("held1"),
            F.col("group2").alias("held2"),
            F.col("shard").alias("held_in"),
            F.least(F.col("count") - 1, F.lit(CLASSES - 1)).cast("int").alias("loss"),
        ),
        "held",
    )
    linked = nodes.rows.where("linked").join(
        held.rows,
        (F.col("group1") == F.col("held1"))
        & (F.col("group2") == F.col("held2"))
        & (F.col("shard") == F.col("held_in")),
    )
    priced = linked.select(*nodes.rows.columns, "loss").unionByName(
        nodes.rows.where("NOT linked").withColumn("loss", F.lit(0))
    )
    written = stage(
        priced.withColumn("class", F.col("shard") * CLASSES + F.col("loss")), "priced"
    )
    priced = written.rows
    held.discard()
    nodes.discard()
    by_class = _sizes(priced, "class")  # shards times classes
    sizes = {s: sum(by_class.get(s * CLASSES + k, 0) for k in range(CLASSES)) for s in range(shards)}
    # From each class above the quota: how many leave, the cheapest classes first.
    leave: dict[int, int] = {}
    for s in range(shards):
        over = sizes[s] - quota[s]
        for k in range(CLASSES):
            if over > 0 and (n := min(over, by_class.get(s * CLASSES + k, 0))):
                leave[s * CLASSES + k] = n
                over -= n
    gaps = [(s, quota[s] - sizes[s]) for s in range(shards) if sizes[s] < quota[s]]
    if not leave:
        return written
    asked = priced.where(F.col("class").isin(list(leave)))
    order = ["group1", "doc_id"]
    asked = numbered(asked, "class", order, "turn").withColumn(
        "goes", F.col("turn") < _pick(leave, F.col("class"), shards * CLASSES)
    )
    # Those that go are numbered over all classes, in the order of the classes.
    base, total = {}, 0
    for c in sorted(leave):
        base[c] = total
        total += leave[c]
    seat = F.col("turn") + _pick(base, F.col("class"), shards * CLASSES)
    target, filled = F.lit(None).cast("int"), 0
    for s, gap in gaps:
        inside = (seat >= filled) & (seat < filled + gap)
        target = F.coalesce(target, F.when(inside, F.lit(s)))
        filled += gap
    moved = asked.withColumn("shard", F.when(F.col("goes"), target).otherwise(F.col("shard")))
    rest = priced.where(~F.col("class").isin(list(leave)))
    return _replace(written, moved.select(*priced.columns).unionByName(rest))


def assign(documents: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot`` and ``grown_shard``
    of every document, and ``group_rows``, how many have its text."""
    written = stage(nodes_of(documents), "nodes")
    nodes = written.rows
    groups = stage(
        nodes.groupBy(*GROUP)
        .count()
        .where("count > 1")
        .select(
            F.col("group1").alias("of1"),
            F.col("group2").alias("of2"),
            F.col("count").alias("group_rows"),
        ),
        "groups",
    )
    rows = nodes.join(
        groups.rows, (F.col("group1") == F.col("of1")) & (F.col("group2") == F.col("of2")), "left"
    ).select(
        *nodes.columns,
        F.coalesce("group_rows", F.lit(1)).alias("group_rows"),
        F.col("group_rows").isNotNull().alias("linked"),
        F.pmod(F.xxhash64("doc_id", "group1"), F.lit(shards)).cast("int").alias("shard"),
    )
    labelled = stage(rows, "shards")
    groups.discard()
    written.discard()
    total = sum(_sizes(labelled.rows).values())
    quota = {s: total // shards + (s < total % shards) for s in range(shards)}
    for number in range(rounds):
        labelled = _round(labelled, quota, number)
    placed = numbered(_level(labelled, quota).rows, "shard", ["doc_id", "group1"], "slot")
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "group_rows",
    )
