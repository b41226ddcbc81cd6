import hashlib
import random

import numpy as np
import pytest

from retail_lake.llm import suffix_dedup
from retail_lake.llm.suffixes import blind_trie, deep_shallow_sort


def brute(texts):
    """Kept bytes and removed runs by document, from all windows."""
    first, out = {}, {}
    for doc_id in sorted(texts):
        text = texts[doc_id]
        gone = np.zeros(len(text), bool)
        for at in range(len(text) - 49):
            if first.setdefault(text[at : at + 50], doc_id) < doc_id:
                gone[at : at + 50] = True
        runs = int(np.diff(np.concatenate([[0], gone.astype(int)])).clip(0).sum())
        out[doc_id] = (bytes(np.frombuffer(text, np.uint8)[~gone]), runs)
    return out


@pytest.mark.parametrize("letters", [1, 2, 5])
def test_sort_order_and_runs_of_equal_rows(letters):
    rng = np.random.default_rng(letters)
    for n, width in ((0, 56), (1, 56), (700, 88), (400, 24), (300, 30)):
        matrix = rng.integers(0, letters, (n, width)).astype(np.uint8)
        if n:
            matrix[: n // 2, : width - 8] = matrix[0, : width - 8]
        order, begin = deep_shallow_sort(matrix)
        rows = [matrix[i].tobytes() for i in order]
        assert rows == sorted(m.tobytes() for m in matrix)
        for at, row in enumerate(rows):
            assert (begin[at] == at) == (at == 0 or row != rows[at - 1])
            assert rows[begin[at]] == row


def test_blind_trie():
    assert blind_trie([5, 3, 5, 0, 9, 3]) == [[3], [1, 5], [0, 2], [4]]


def test_equal_windows_have_their_anchor_at_one_place():
    rng = random.Random(1)
    texts = ["".join(rng.choices("abc", k=rng.randrange(300))).encode() for _ in range(40)]
    texts += [b"a" * 500, b"ab" * 200, b"", b"x" * 49, b"y" * 50]
    found = suffix_dedup.Stretches(texts)
    windows, places = 0, {}
    raw = found.raw.tobytes()
    for start, length, anchor in zip(
        found.start.tolist(), found.length.tolist(), found.anchor.tolist(), strict=True
    ):
        for at in range(start, start + length - 49):
            windows += 1
            assert places.setdefault(raw[at : at + 50], anchor - at) == anchor - at
    assert windows == sum(max(0, len(t) - 49) for t in texts)


def test_equals_brute_force(odd, corpus, by_id):
    rows = by_id(suffix_dedup.find_repeats(odd))
    texts = {r.doc_id: (r.text or "").encode() for r in odd.collect() if r.doc_id is not None}
    for doc_id, (kept, runs) in brute(texts).items():
        row = rows[doc_id]
        assert (bytes(row.kept), len(row.spans), row.n_bytes) == (kept, runs, len(texts[doc_id]))
    nameless = sorted(r.n_bytes for r in suffix_dedup.find_repeats(odd).where("doc_id IS NULL").collect())
    assert nameless == [0, len(corpus[3].encode())]


def test_random_texts_equal_brute_force(spark, by_id):
    rng = random.Random(5)
    parts = ["".join(rng.choices("ab ", k=rng.randrange(20, 90))) for _ in range(12)]
    texts = {i: "".join(rng.choices(parts, k=rng.randrange(1, 6))) + str(i) for i in range(150)}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    rows = by_id(suffix_dedup.digests(suffix_dedup.find_repeats(frame)))
    for doc_id, (kept, runs) in brute({i: t.encode() for i, t in texts.items()}).items():
        row = rows[doc_id]
        assert (row.kept_sha256, row.n_spans) == (hashlib.sha256(kept).hexdigest(), runs)
        assert row.n_removed == len(texts[doc_id]) - len(kept)


def test_documents_keep_their_columns(odd, empty, corpus):
    clean = suffix_dedup.without_repeats(odd)
    assert clean.schema.names == odd.schema.names
    before = {(r.doc_id, r.lang, r.part, r.kept) for r in odd.collect()}
    rows = clean.collect()
    assert len(rows) == odd.count() and {(r.doc_id, r.lang, r.part, r.kept) for r in rows} == before
    texts = {r.doc_id: r.text for r in rows if r.doc_id is not None}
    assert texts[105] == "" and texts[5] == corpus[5] and texts[200] is None
    assert suffix_dedup.without_repeats(empty).count() == 0
    assert suffix_dedup.find_repeats(empty).count() == 0


def test_long_texts_come_in_pieces_without_losing_a_window():
    rng = random.Random(3)
    texts = ["".join(rng.choices("abcd", k=n)).encode() for n in (10, 49, 50, 130, 149, 500, 0)]
    docs = np.arange(7)
    own, first, pieces = suffix_dedup._pieces(docs, texts, most=100)
    windows = {(d, f + at) for d, f, p in zip(own, first, pieces, strict=True) for at in range(len(p) - 49)}
    assert windows == {(d, at) for d, t in enumerate(texts) for at in range(len(t) - 49)}
    assert all(texts[d][f : f + len(p)] == p for d, f, p in zip(own, first, pieces, strict=True))
    assert sum(max(0, len(p) - 49) for p in pieces) == len(windows)


def test_columns_with_the_names_of_inner_ones(spark):
    passage = "a passage of more than fifty bytes that two documents share"
    schema = "_id long, text string, _text string, doc_id long, _others string, part int, kind int, block binary"
    rows = [(7, f"{i} {passage} {i}", "t", i, None, 1, 2, b"x") for i in (1, 2)]
    rows += [(None, None, None, None, "o", None, None, None)]
    clean = suffix_dedup.without_repeats(spark.createDataFrame(rows, schema))
    assert clean.columns == ["_id", "text", "_text", "doc_id", "_others", "part", "kind", "block"]
    found = {r.doc_id: r for r in clean.collect()}
    assert found[1].text == f"1 {passage} 1" and passage not in found[2].text
    assert found[2][0] == 7 and found[2]["_text"] == "t" and bytes(found[2]["block"]) == b"x"
    assert found[None]["_others"] == "o"
