"""Insert-only merge into a gold target."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_lake.contracts import Contract, ContractViolation
from retail_lake.operators.conform import (
    broken_column,
    broken_columns,
    conform_marked,
    exact_cast,
    row_rules,
)
from retail_lake.operators.joins import new_rows, possible_partners
from retail_lake.operators.quality import first_per_key
from retail_lake.sizing import shuffles_at
from retail_lake.sources.targets import Days, Span, month_of
from retail_lake.storage import total_bytes
from retail_lake.workspace import Staged, stage

log = logging.getLogger(__name__)

#: How many batch rows a merged row stands for.
COPIES = "_copies"
#: Stored bytes from which an undated target's keys are filtered by those of the batch.
FILTER_BYTES = 1024 * 1024 * 1024


@dataclass(frozen=True)
class Inserted:
    """What a merge appended.

    ``rows`` are read from the staged table, so they stay the same after the
    target changed, until ``staged.discard()``. ``n_existing`` counts the target
    before the merge and is None unless asked for.
    """

    rows: DataFrame | None
    n_new: int
    staged: Staged | None
    n_existing: int | None = None

    def discard(self) -> Inserted:
        """The counts alone; the staged table is deleted."""
        if self.staged is not None:
            self.staged.discard()
        return Inserted(None, self.n_new, None, self.n_existing)


def key_facts(batch: DataFrame, contract: Contract) -> DataFrame:
    """``n_rows`` and ``n_keyless``, how many of them have a NULL or bad key: for each day
    that the batch gives, or, where the key has no day, in one row with ``low`` and ``high``,
    the span of the first key column as text.

    One narrow pass; one row for each day of the calendar however finely the batch's own
    column tells times, and one for all that is no day.
    """
    typed = [exact_cast(batch, contract.schema[k]) for k in contract.key]
    keyless = reduce(lambda a, b: a | b, [k.isNull() for k in typed])
    counts = [F.count(F.lit(1)).alias("n_rows"), F.count_if(keyless).alias("n_keyless")]
    if contract.day:
        return batch.groupBy(exact_cast(batch, contract.schema[contract.day])).agg(*counts)
    low, high = (edge(typed[0]).cast("string") for edge in (F.min, F.max))
    return batch.agg(*counts, low.alias("low"), high.alias("high"))


def _check_keys(facts: DataFrame, contract: Contract) -> tuple[Days | None, Span | None]:
    """Refuse NULL keys; give the batch's days, or the span of its keys if they have no day.
    Both are text, so that they hold years Python's dates do not know.

    This comes before the merge's shuffle, which would otherwise send all rows with a
    NULL key to the same task.
    """
    if contract.day is None:
        found = facts.first()
        n_keyless, days = found["n_keyless"], None
        span = Span(contract.key[0], found["low"], found["high"])
        span = None if found["low"] is None else span
    else:
        day = F.col(contract.day)
        n_keyless, first, last, months = facts.agg(
            F.coalesce(F.sum("n_keyless"), F.lit(0)),
            F.min(day).cast("string"),
            F.max(day).cast("string"),
            F.collect_set(month_of(day.cast("string"))),  # as many as the calendar has
        ).first()
        days, span = None if first is None else Days(first, last, tuple(sorted(months))), None
    if n_keyless:
        raise ContractViolation(contract.name, [f"NULL or bad key: {n_keyless} rows"])
    return days, span


def _check_staged(
    batch: DataFrame, staged: Staged, contract: Contract, on_duplicate: str
) -> int:
    """Refuse staged rows that break a rule; otherwise say how many there are."""
    rules = [f"{rule}:{column}" for rule, column, _ in row_rules(batch, contract)]
    places = [broken_column(n) for n in range(len(rules))]
    marks = [F.count_if(F.col(c).bitwiseAND(1 << bit) != 0) for c, bit in places]
    repeated = F.count_if(F.col(COPIES) > 1)
    n_new, n_repeated, *broken = staged.rows.agg(F.count(F.lit(1)), repeated, *marks).first()
    # A staged row stands for all rows of its key.
    findings = [f"{rule}: {n} keys" for rule, n in zip(rules, broken) if n]
    if n_repeated and on_duplicate == "error":
        examples = staged.rows.where(F.col(COPIES) > 1).select(*contract.key).take(3)
        shown = ", ".join(str(tuple(str(v) for v in e)) for e in examples)
        findings.append(f"repeated new keys: {n_repeated}, such as {shown}")
    if findings:
        raise ContractViolation(contract.name, findings, staged)
    return n_new


def _at_once(
    marked: DataFrame, existing: DataFrame | None, contract: Contract, order_by: list[str], marks
) -> Staged:
    """New rows of a batch with one value column or none: a hash aggregate by key, and the
    anti-join in the same partitioning."""
    rows = _first_of_copies(marked, contract, order_by, marks)
    if existing is not None:
        rows = new_rows(rows, existing, list(contract.key))
    return stage(rows, f"new-{contract.name}")


def _first_of_copies(marked: DataFrame, contract: Contract, order_by: list[str], marks):
    keys = list(contract.key)
    return first_per_key(
        marked,
        keys,
        order_by,
        values=[c for c in contract.schema.names if c not in keys],
        also=[F.count(F.lit(1)).alias(COPIES), *[F.bit_or(c).alias(c) for c in marks]],
    )


def _keys_first(
    marked: DataFrame, existing: DataFrame | None, contract: Contract, order_by: list[str], marks
) -> Staged:
    """New rows of a batch with several value columns, whose least row only a sort can find.

    The keys go first: counted, joined against the target's and staged. The wide rows are
    then read for new keys only, and sorted only for new keys that repeat. A snapshot
    whose keys all exist is neither moved nor sorted, and the staged keys, none, are all
    that is given.
    """
    keys = list(contract.key)
    counted = marked.groupBy(*keys).agg(F.count(F.lit(1)).alias(COPIES))
    if existing is not None:
        counted = new_rows(counted, existing, keys)
    staged_keys = stage(counted, f"new-keys-{contract.name}")
    fresh = staged_keys.rows
    n_new, n_repeated = fresh.agg(F.count(F.lit(1)), F.count_if(F.col(COPIES) > 1)).first()
    if not n_new:
        return staged_keys
    many = fresh.where(F.col(COPIES) > 1).select(*keys)
    if existing is not None:
        rows = marked.join(fresh.where(F.col(COPIES) == 1).select(*keys), keys, "left_semi")
    elif n_repeated:
        rows = marked.join(many, keys, "left_anti")
    else:
        rows = marked
    rows = rows.withColumn(COPIES, F.lit(1).cast("long"))
    if n_repeated:
        repeated = marked.join(many, keys, "left_semi")
        rows = rows.unionByName(_first_of_copies(repeated, contract, order_by, marks))
    staged = stage(rows.select(*contract.schema.names, COPIES, *marks), f"new-{contract.name}")
    staged_keys.discard()
    n_rows = staged.rows.count()
    if n_rows != n_new:
        finding = f"{n_new} new keys became {n_rows} rows: the batch changed while it was read"
        raise ContractViolation(contract.name, [finding], staged)
    return staged


def _append(target, rows: DataFrame, n_new: int, n_bytes: int, days: Days | None, seen) -> None:
    """Append behind a claim, where the target has them."""
    spark = rows.sparkSession
    if seen is None:
        target.append(rows, n_new, n_bytes, days)
        return
    number = target.claims.take(spark, seen)
    try:
        target.append(rows, n_new, n_bytes, days)
    except Exception:
        # The write is over; what it may have left is there for the next load to see. An
        # interrupt is no such end, and leaves the claim.
        target.claims.finish(spark, number)
        raise
    target.claims.finish(spark, number)


def insert_new(
    batch: DataFrame,
    target,
    on_duplicate: str = "error",
    order_by: Sequence[str] = (),
    count_existing: bool = False,
    facts: DataFrame | None = None,
    prefilter: bool | None = None,
) -> Inserted:
    """Append the batch rows whose key the target lacks.

    Rows already in the target stay as they are, even where the batch has other
    attributes for them. ``on_duplicate="error"`` refuses a key that is new and
    repeated in the batch; ``"first"`` keeps its least row by ``order_by``, and still
    refuses a key of which any row breaks a rule. ``facts`` are the ``key_facts`` of the
    batch, where the caller has them.

    ``prefilter`` says whether keys of an undated target pass a filter made of the batch's
    before they are shuffled; by default that depends on the bytes that are stored.

    Keys are shuffled once: copies of a key collapse into one counted row before they move,
    and the anti-join uses the same partitioning. New rows are staged, so they are computed
    once. All rules are checked on the staged rows, and the target is touched last: a
    refused load leaves nothing behind, and a load that died halfway is completed by
    running it again. Of two loads of a file target at the same time the later one ends
    in ``ConcurrentLoad`` before it appends.
    """
    if on_duplicate not in ("error", "first"):
        raise ValueError(f"on_duplicate: {on_duplicate!r}")
    if on_duplicate == "first" and not order_by:
        raise ValueError("on_duplicate='first' needs order_by")
    spark, contract = batch.sparkSession, target.contract
    keys, columns = list(contract.key), contract.schema.names

    claims = getattr(target, "claims", None)
    seen = None if claims is None else claims.begin(spark)
    facts = key_facts(batch, contract) if facts is None else facts
    days, span = _check_keys(facts, contract)
    n_existing = target.count(spark) if count_existing else None
    marks = broken_columns(len(list(row_rules(batch, contract))))
    marked = conform_marked(batch, contract)
    existing = target.keys(spark, days, span)
    if existing is not None and days is None:
        if prefilter is None:
            prefilter = hasattr(target, "n_bytes") and target.n_bytes(spark) >= FILTER_BYTES
        if prefilter:
            existing = possible_partners(existing, marked.select(*keys), keys)
    new = _at_once if len(columns) - len(keys) < 2 else _keys_first
    # A bucketed target's rows stay where they are if the batch meets them in as many parts.
    with shuffles_at(spark, getattr(target, "buckets", None)):
        staged = new(marked, existing, contract, list(order_by), marks)
    if not set(columns) <= set(staged.rows.columns):
        log.info("%s: no new rows, %s before", contract.name, n_existing)
        return Inserted(spark.createDataFrame([], contract.schema), 0, staged, n_existing)

    n_new = _check_staged(batch, staged, contract, on_duplicate)
    log.info("%s: %d new rows, %s before", contract.name, n_new, n_existing)
    inserted = staged.rows.select(*columns)
    if n_new:
        _append(target, inserted, n_new, total_bytes(spark, staged.path), days, seen)
    return Inserted(inserted, n_new, staged, n_existing)
