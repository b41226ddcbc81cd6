import hashlib
import re
import statistics
from collections import Counter

from pyspark.sql import functions as F

from retail_lake.llm import fingerprint


def similarity(a, b):
    """Generalised Jaccard similarity of word counts."""
    a, b = (Counter(re.findall(r"[^\x20\x09-\x0D]+", t)) for t in (a, b))
    union = sum((a | b).values())
    return sum((a & b).values()) / union if union else 1.0


def edits(texts):
    """Edited text and next text by position in falling order of ``doc_id``."""
    out = []
    for at, (doc_id, text) in enumerate(texts):
        following = texts[(at + 1) % len(texts)][1]
        half = len(text) // 2
        out.append((doc_id, text, text[: len(text) - half] + following[:half], following))
    return out


def test_edits_and_estimates(spark, corpus):
    frame = spark.createDataFrame(list(corpus.items()), "doc_id long, text string").repartition(4)
    rows = {r.doc_id: r for r in fingerprint.compare(frame).collect()}
    errors, prints = [], {}
    for doc_id, text, edited, following in edits(sorted(corpus.items(), reverse=True)):
        row = rows[doc_id]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert prints.setdefault(text, row.fingerprint) == row.fingerprint
        errors.append(row.near_edited - similarity(text, edited))
        errors.append(row.near_next - similarity(text, following))
        if edited == text:
            assert row.near_edited == 1.0
    # Near copies err alike, so the mean is of few independent errors.
    assert abs(statistics.mean(errors)) < 0.04 and statistics.pstdev(errors) < 0.0625


def test_weights_count(spark):
    """One word more often is another document, by the right amount."""
    rows = [(i, f"a{i} " * 3 + f"b{i} ") for i in range(300)]
    rows += [(1000 + i, f"a{i} " + f"b{i} ") for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "0 as range_no", "doc_id as place", "text"
    )
    found = fingerprint.fingerprints(frame, ["range_no", "place"], ["text"], 8).collect()
    of = {r.place: [r[f"s{i}"] % (1 << 32) for i in range(8)] for r in found}
    same = [of[i][k] == of[1000 + i][k] for i in range(300) for k in range(8)]
    assert abs(statistics.mean(same) - 0.5) < 0.05


def test_far_terms_take_no_logarithms(spark, corpus, monkeypatch):
    """Most values are ruled out before their logarithms, and none of them was the least."""
    far = ((1 << 31) - 1) << 32
    terms = spark.range(2000).selectExpr("xxhash64(id) AS term")
    drawn = fingerprint.sample(
        F.col("term"), F.lit(0.0), 3, F.lit(fingerprint._NEAR / 2000)
    )
    assert terms.where(drawn >= far).count() > 1600
    frame = spark.createDataFrame(list(corpus.items()), "doc_id long, text string").selectExpr(
        "0 as range_no", "doc_id as place", "text"
    )
    call = frame, ["range_no", "place"], ["text"], fingerprint.SAMPLES
    found = sorted(fingerprint.fingerprints(*call).collect())
    monkeypatch.setattr(fingerprint, "_NEAR", float("inf"))
    assert sorted(fingerprint.fingerprints(*call).collect()) == found


def test_odd_rows(spark, odd, empty):
    rows = fingerprint.compare(odd).collect()
    assert len(rows) == odd.count()
    blank = {r.fingerprint for r in rows if r.doc_id in (114, 200, 201)}
    assert len(blank) == 1
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert fingerprint.compare(empty).count() == 0
    single = spark.createDataFrame([(1, "a b c d")], "doc_id long, text string")
    (row,) = fingerprint.compare(single).collect()
    assert row.near_next == 1.0 and row.edited_sha256 == hashlib.sha256(b"a b a b").hexdigest()
