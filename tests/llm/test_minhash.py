import random
import re
from itertools import combinations

import numpy as np

from retail_lake.llm import minhash, shingles
from retail_lake.llm.components import components

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def plain_set(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(texts):
    """Number of shingles and component of each document, from all pairs."""
    sets = {i: plain_set(t) for i, t in texts.items()}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        shared = len(sets[a] & sets[b])
        if shared and 100 * shared >= 75 * (len(sets[a]) + len(sets[b]) - shared):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_shingle_sets_tell_the_same_apart_as_words_do():
    rng = random.Random(2)
    texts = ["", " ", "a", "A  b", "a b", "a b c d e", "é É x y z q", "ab c", "a bc"]
    texts += [" ".join(rng.choices("abcd", k=rng.randrange(30))) for _ in range(200)]
    hashes, first = shingles.shingle_sets([t.encode() for t in texts], 5)
    names = {}
    for i, text in enumerate(texts):
        own, want = frozenset(hashes[first[i] : first[i + 1]].tolist()), plain_set(text)
        assert len(own) == len(want) == first[i + 1] - first[i]
        assert names.setdefault(own, want) == want
    for (i, a), (j, b) in combinations(enumerate(texts), 2):
        own = np.intersect1d(hashes[first[i] : first[i + 1]], hashes[first[j] : first[j + 1]])
        assert len(own) == len(plain_set(a) & plain_set(b))


def test_equals_all_pairs(odd, by_id):
    rows = by_id(minhash.cluster(odd))
    texts = {r.doc_id: r.text for r in odd.collect() if r.doc_id is not None}
    for doc_id, (size, component) in brute(texts).items():
        row = rows[doc_id]
        assert (row.n_shingles, row.component_id, row.kept) == (size, component, doc_id == component)


def test_nameless_rows_are_kept(odd, empty):
    rows = minhash.cluster(odd).where("doc_id IS NULL").collect()
    assert len(rows) == 2 and all(r.kept and r.component_id is None for r in rows)
    assert minhash.cluster(odd).count() == odd.count()
    assert minhash.cluster(empty).count() == 0


def test_similarity_at_the_threshold(spark, by_id):
    """Sets of 7 with 6 shared are 6 of 8; with one shingle less they fall below."""
    words = [f"v{i}" for i in range(40)]
    rows = [
        (1, " ".join(words[:11])),
        (2, " ".join([*words[:10], "other"])),
        (3, " ".join(words[20:30])),
        (4, " ".join([*words[20:29], "other"])),
    ]
    found = by_id(minhash.cluster(spark.createDataFrame(rows, "doc_id long, text string")))
    assert found[2].component_id == 1 and found[4].component_id == 4


def test_recall_on_random_near_copies(spark, by_id):
    rng = random.Random(6)
    rows = []
    for group in range(120):
        base = [f"g{group}w{rng.randrange(500)}" for _ in range(100)]
        rows.append((10 * group, " ".join(base)))
        for k in range(1, 4):
            own = list(base)
            for _ in range(rng.randrange(1, 4)):
                own[rng.randrange(100)] = f"new{rng.randrange(10**6)}"
            rows.append((10 * group + k, " ".join(own)))
    found = by_id(minhash.cluster(spark.createDataFrame(rows, "doc_id long, text string")))
    want = brute(dict(rows))
    assert all(found[i].component_id == component for i, (_, component) in want.items())


def test_components_of_long_chains(spark):
    rng = random.Random(9)
    order = list(range(300))
    rng.shuffle(order)
    links = [(min(a, b), max(a, b)) for a, b in zip(order, order[1:], strict=False)]
    links += [(1000, 1001), (1001, 1002)]
    rows = components(spark.createDataFrame(links, "a long, b long")).rows.collect()
    labels = {r.node: r.label for r in rows}
    assert {labels[i] for i in range(300)} == {0} and {labels[i] for i in (1000, 1001, 1002)} == {1000}
    assert components(spark.createDataFrame([], "a long, b long")).rows.count() == 0


def test_loose_groups_are_joined_by_the_second_round(spark, by_id):
    """Members like many of their group, but not like its first."""
    rng = random.Random(12)
    rows = []
    for group in range(6):
        base = [f"g{group}w{i}" for i in range(120)]
        for k in range(40):
            own = list(base)
            for _ in range(3):
                at = rng.randrange(116)
                own[at] = f"x{rng.randrange(10**6)}"
            rows.append((100 * group + k, " ".join(own)))
    found = by_id(minhash.cluster(spark.createDataFrame(rows, "doc_id long, text string")))
    want = brute(dict(rows))
    assert all(found[i].component_id == component for i, (_, component) in want.items())


def test_crossing_pairs_differ_in_component():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 40, 600).astype(np.uint64)
    docs, parts = rng.integers(0, 90, 600), None
    parts = docs % 7
    order, pairs = minhash._crossing(keys, docs, parts, 3)
    assert sorted(order) == list(range(600)) and len(pairs)
    assert all(a < b and a % 7 != b % 7 for a, b in pairs)
    together = {(a, b) for k in set(keys) for a in docs[keys == k] for b in docs[keys == k]}
    assert all((a, b) in together for a, b in pairs)
    assert len(minhash._crossing(keys[:0], docs[:0], parts[:0], 3)[1]) == 0


def family(rng, members, template=86, own=14, linked=()):
    """Documents of one template, below the threshold to each other, but for ``linked`` pairs."""
    base = [f"t{i}" for i in range(template)]
    texts = {k: [*base, *(f"o{k}x{i}" for i in range(own))] for k in range(members)}
    for a, b in linked:
        texts[b] = [*texts[a][:-3], "p", "q", f"r{b}"]
    return [(k, " ".join(words)) for k, words in texts.items()]


def test_links_within_a_large_bucket_of_unlinked_documents(spark, by_id):
    rng = random.Random(3)
    linked = [(i, 399 - i) for i in range(5, 45)]
    rows = family(rng, 400, template=82, own=18, linked=linked)
    want = brute(dict(rows))
    assert sum(i != component for i, (_, component) in want.items()) == len(linked)
    found = by_id(minhash.cluster(spark.createDataFrame(rows, "doc_id long, text string")))
    assert {i: r.component_id for i, r in found.items()} == {i: c for i, (_, c) in want.items()}


def test_first_of_a_bucket_does_not_depend_on_batches(spark):
    rows = family(random.Random(4), 60)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    sets = minhash.signatures(frame).selectExpr("doc_id", "bands", "doc_id AS component")
    found = []
    for size, chunk in ((10000, 5000), (3, 7)):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        known, minhash.CHUNK = minhash.CHUNK, chunk
        try:
            found.append([sorted(minhash.meetings(sets, turn).collect()) for turn in (0, 1)])
        finally:
            minhash.CHUNK = known
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert found[0] == found[1] and (0, 59) in found[0][0]


def test_exact_join_finds_all_similar_pairs(spark):
    rng = random.Random(8)
    rows = [(k, " ".join(rng.choices("abc", k=rng.randrange(4, 14)))) for k in range(150)]
    sets = {k: plain_set(text) for k, text in rows}
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    own = frame.selectExpr("doc_id", "doc_id % 40 AS component")
    found = {tuple(r) for r in minhash.close_pairs(own, frame).collect()}
    for a, b in combinations(range(150), 2):
        similar = 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
        assert a % 40 != b % 40 or (a, b) not in found
        assert not similar or a % 40 == b % 40 or (a, b) in found
