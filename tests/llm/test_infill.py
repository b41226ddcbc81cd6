import hashlib
import random

import pytest
from pyspark.sql import functions as F

from retail_lake.llm import infill

RULES = infill.Rules()


def brute(doc_id, text):
    """Form, cuts and output by slices of the text."""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_every_row_equals_brute_force_and_comes_back(spark, odd):
    hostile = ["<", "<<>>", "P>x<S", "a<P>b", "<P><S><M>", "é<Sß>M>", "x<", ">x", "<P" * 40, "😀" * 50]
    more = spark.createDataFrame(
        [(1000 + i, hostile[i % len(hostile)]) for i in range(200)], "doc_id long, text string"
    )
    frame = odd.select("doc_id", "text").unionByName(more)
    rows = infill.restored(infill.transform(frame)).collect()
    want = [(r.doc_id, *brute(r.doc_id, r.text or ""), r.text or "") for r in frame.collect()]
    got = [
        (r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.restored) for r in rows
    ]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert {r.form for r in rows} == {"plain", "psm", "spm"}


def test_digests_and_clashing_columns(spark, odd, empty):
    frame = odd
    for name in ("n", "form", "first", "second", "digest", "row", "output", "restored"):
        frame = frame.withColumn(name, F.lit("clash"))
    rows = infill.digests(infill.restored(infill.transform(frame))).collect()
    assert len(rows) == odd.count()
    texts = {r.doc_id: r.text or "" for r in odd.where("doc_id IS NOT NULL").collect()}
    for row in rows:
        if row.doc_id is not None:
            text = texts[row.doc_id]
            output = brute(row.doc_id, text)[-1]
            assert row.output_sha256 == hashlib.sha256(output.encode()).hexdigest()
            assert row.restored_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert infill.digests(infill.restored(infill.transform(empty))).count() == 0


@pytest.mark.parametrize("form", ["psm", "spm"])
def test_long_blocks_are_rotated_through_a_small_buffer(form, monkeypatch):
    monkeypatch.setattr(infill, "BUFFER", 7)
    rng = random.Random(3)
    for _ in range(300):
        text = "".join(rng.choices("abé漢😀<>PSM", k=rng.randrange(80)))
        if any(m in text for m in RULES.sentinels):
            continue
        a, b = sorted((rng.randrange(len(text) + 1), rng.randrange(len(text) + 1)))
        output = infill.arrange(text.encode(), form, a, b, RULES)
        parts = {"P": text[:a], "M": text[a:b], "S": text[b:]}
        order = "PSM" if form == "psm" else "SPM"
        assert output.decode() == "".join(f"<{x}>{parts[x]}" for x in order)
        assert infill.restore(output, form, RULES) == text.encode()


def test_rotation_exchanges_blocks_of_any_length():
    for size in range(12):
        for begin in range(size + 1):
            for middle in range(begin, size + 1):
                for end in range(middle, size + 1):
                    data = bytearray(range(size))
                    infill.rotate(data, begin, middle, end)
                    plain = bytes(range(size))
                    want = plain[:begin] + plain[middle:end] + plain[begin:middle] + plain[end:]
                    assert data == want


def test_bytes_that_are_no_text_come_back(spark):
    raw = bytes([0xFF, 0x80, 0x41, 0xC3]) * 30
    frame = spark.createDataFrame([(i, raw) for i in range(40)], "doc_id long, raw binary")
    frame = frame.select("doc_id", F.col("raw").cast("string").alias("text"))
    rows = infill.restored(infill.transform(frame)).select(F.col("restored").cast("binary")).collect()
    assert [bytes(r[0]) for r in rows] == [raw] * 40


def test_other_sentinels(odd):
    rules = infill.Rules(seed="x", prefix="[pre]", suffix="[suf]", middle="[mid]", plain_percent=0)
    rows = infill.restored(infill.transform(odd, rules), rules).where("form <> 'plain'").collect()
    assert rows and all("[pre]" in r.output and "[pre]" not in r.restored for r in rows)
    for wrong in (("<P>", "<P>", "<M>"), ("<P>", "P><", "<M>"), ("<P>", "x<P>x", "<M>"), ("", "a", "b")):
        with pytest.raises(ValueError):
            infill.Rules(prefix=wrong[0], suffix=wrong[1], middle=wrong[2])


def test_a_broken_output_is_refused():
    for output in (b"no sentinels", b"<S>x<P>y<M>z"):
        with pytest.raises(ValueError):
            infill.restore(output, "psm", RULES)
