import zlib
from collections import Counter

import pytest

from retail_lake.llm import sharding


def check(rows, texts, shards):
    sizes = Counter(r.shard for r in rows)
    counts = [sizes.get(s, 0) for s in range(shards)]
    assert max(counts) - min(counts) <= 1 and len(rows) == len(texts)
    for shard, count in sizes.items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(count))
    want = sorted((len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for t in texts)
    assert sorted((r.size, r.text_crc32) for r in rows) == want
    assert all(r.law == "rows" and r.grown_shard is None for r in rows)


def test_odd_rows(odd, empty):
    rows = sharding.assign(odd).collect()
    check(rows, [r.text for r in odd.collect()], 24)
    assert sharding.assign(empty).count() == 0


@pytest.mark.parametrize("shards", [1, 5])
def test_copies_stay_together_where_there_is_room(spark, shards):
    """A third of the rows are one text; the others are pairs and single ones."""
    texts = ["hot"] * 200 + [f"pair {i // 2}" for i in range(200)] + [f"one {i}" for i in range(203)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sharding.assign(frame, shards).collect()
    check(rows, texts, shards)
    of = {r.doc_id: r.shard for r in rows}
    together = sum(of[200 + i] == of[201 + i] for i in range(0, 200, 2))
    assert together >= 85
    hot = Counter(of[i] for i in range(200))
    # Dealt by hash each shard would have 40 of them.
    assert hot.most_common(1)[0][1] >= 60


def test_numbers_have_no_gaps(spark):
    frame = spark.range(1000).selectExpr("id", "cast(id % 3 = 0 as int) as kind")
    rows = sharding.numbered(frame, "kind", ["id"], "n").collect()
    for kind in (0, 1):
        own = sorted(r.n for r in rows if r.kind == kind)
        assert own == list(range(len(own)))
