import base64
import gzip
import hashlib
import io
import random
import struct
import zipfile

import pytest
from pyspark.sql import functions as F

from retail_lake.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, payload string, owner long, mark string"


def page(page_id, html, url="http://a.example/x?y=1"):
    return page_id, url, html, "d", "p", 7, "m"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    found = [page(i, f"<p>{'é' * rng.randrange(200)}{i}</p>", f"http://h{i % 3}.example/{i}") for i in range(300)]
    found += [page(i, "<html>same</html>") for i in range(400, 600)]
    found += [page(700, None), page(701, ""), page(702, None, None)]
    found += [page(None, "<html>same</html>"), page(None, "alone", "http://x/\r\n WARC-Type: y"), page(None, "alone")]
    found += [page(5, found[5][2]), page(599, "<html>same</html>"), page(800, "x\r\n\r\ny" * 9000)]
    return found


def expected(rows):
    largest = {}
    for i, _, html, *_ in rows:
        if i is not None:
            largest[html or ""] = max(i, largest.get(html or "", i))
    for i, _, html, *_ in rows:
        payload = (html or "").encode()
        owner = largest.get(html or "")
        revisit = owner is not None and i != owner
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        yield i, len(payload), digest, "revisit" if revisit else "response", owner if revisit else None


def test_types_lengths_and_digests_equal_brute_force(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = warc.packed_and_read(frame).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(expected(rows), key=repr)
    assert warc.packed_and_read(frame.limit(0)).count() == 0


def test_payloads_come_back_also_those_of_revisits(spark, rows, monkeypatch):
    frame = spark.createDataFrame(rows, SCHEMA)
    written = warc.write_archives(frame)
    records = warc.read_records(written.manifest.rows)
    assert records.where("record_type = 'revisit' AND payload IS NOT NULL").count() == 0
    found = warc.resolved(records).select("record_id", "payload").collect()
    want = [(warc.record_id(i), (html or "").encode()) for i, _, html, *_ in rows]
    assert sorted((r.record_id, bytes(r.payload)) for r in found) == sorted(want)
    urls = {r.record_id: r.target_uri for r in records.select("record_id", "target_uri").collect()}
    assert urls["<urn:x-page:17>"] == "http://h2.example/17" and urls["<urn:x-page:702>"] == "urn:x-page:702"
    written.discard()


def test_small_payloads_are_all_responses(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA)
    written = warc.write_archives(frame, least_bytes=1)
    records = warc.digests(warc.read_records(written.manifest.rows)).where("payload_bytes = 0")
    assert [r.record_type for r in records.collect()] == ["response"] * 3


def entries(count, size=50):
    pages = [(i, f"http://a/{i}", b"x%d" % i * size) for i in range(count)]
    return [(warc.record_bytes(i, u, p, warc.digest_of(p), None, warc.WRITE_DATE), i, u, p) for i, u, p in pages]


def write(folder, records):
    writer = warc.ArchiveWriter(str(folder))
    for record, i, url, payload in records:
        writer.add(record, i, url, warc.digest_of(payload), warc.WRITE_DATE, 6)
    return writer.close()[0]


def read(place, size=None):
    """All records of an archive, by ranges of its index."""
    source, found = warc._opened(place)
    out = []
    for part in warc._index_ranges(place):
        lines = warc._lines(source, found[part["index"]], part["begin"])
        out += [warc.parse_record(warc._unpacked(d)) for d in warc._ranged(source, warc._places(found, lines))]
    return out


@pytest.mark.parametrize("size", [1, 7, 100, 241, 242, 243, 5000, 1 << 20])
def test_every_line_of_an_index_is_in_one_range(tmp_path, monkeypatch, size):
    monkeypatch.setattr(warc, "INDEX_RANGE", size)
    monkeypatch.setattr(warc, "READ_BYTES", 300)
    records = entries(30)
    place = write(tmp_path, records)
    assert [(r.record_id, r.payload) for r in read(place)] == [(warc.record_id(i), p) for _, i, _, p in records]


def test_a_task_closes_full_archives_and_reads_them_in_parts(spark, rows, monkeypatch):
    frame = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    written = warc.write_archives(frame)
    assert written.manifest.rows.count() == 1
    monkeypatch.setattr(warc, "INDEX_RANGE", 1000)
    located = list(warc._index_ranges(written.manifest.rows.first().archive))
    assert len(located) > 50


def zip64(place, records, monkeypatch, comment=b""):
    """The records in an archive whose sizes, offsets and counts are all in ZIP64 fields."""
    with monkeypatch.context() as patch:
        patch.setattr(zipfile, "ZIP64_LIMIT", 10)
        patch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
        place = write(place, records)
    with open(place, "rb") as file:
        data = file.read()
    assert warc.END64 in data and warc.END64_PLACE in data
    return place


def test_zip64_directories(tmp_path, monkeypatch):
    records = entries(20)
    place = zip64(tmp_path, records, monkeypatch)
    assert [r.payload for r in read(place)] == [p for *_, p in records]


def source_of(data):
    import pyarrow as pa

    return warc.Range(pa.BufferReader(data))


def archive(comment=b"", method=zipfile.ZIP_STORED, before=b""):
    out = io.BytesIO()
    out.write(before)
    with zipfile.ZipFile(out, "a", method) as file:
        file.comment = comment
        file.writestr("archive/ä.warc", b"stored here")
        file.writestr(zipfile.ZipInfo("packed"), b"z" * 100, zipfile.ZIP_DEFLATED)
    return out.getvalue()


def test_members_are_found_behind_comments_and_packed_ones_left_out():
    for comment in (b"", b"a comment", b"x" * 60_000, warc.END + b"\0" * 30, warc.END * 20):
        source = source_of(archive(comment))
        (member,) = warc.members(source).values()
        assert member.name == "archive/ä.warc" and source.read(member.begin, member.size) == b"stored here"


def test_broken_archives_are_refused():
    whole = archive()
    for data in (b"", b"PK", whole[:-1], whole[:60], whole[:-22] + whole[-22:-4] + b"\xff\xff\0\0"):
        with pytest.raises(warc.BadArchive):
            warc.members(source_of(data))
    at = whole.rfind(warc.END)
    two = bytearray(whole)
    struct.pack_into("<H", two, at + 4, 1)
    entry = bytearray(whole)
    entry[whole.find(warc.ENTRY)] = 0
    local = bytearray(whole)
    local[0] = 0
    for data in (two, entry, local):
        with pytest.raises(warc.BadArchive):
            warc.members(source_of(bytes(data)))


def test_broken_records_are_refused():
    payload = b"some payload"
    record = warc.record_bytes(1, "http://a/", payload, warc.digest_of(payload), None, warc.WRITE_DATE)
    assert warc.parse_record(record).payload == payload
    for data in (record.replace(b"some", b"same"), record[:-1], record + b"x", b"", b"GET / HTTP/1.1\r\n\r\n"):
        with pytest.raises(warc.BadArchive):
            warc.parse_record(data)
    with pytest.raises(warc.BadArchive):
        warc._unpacked(gzip.compress(record)[:-9])


def test_records_without_an_index_are_an_error(tmp_path):
    place = tmp_path / "a.zip"
    place.write_bytes(archive())
    with pytest.raises(warc.BadArchive, match="without an index"):
        list(warc._index_ranges(str(place)))


def test_files_of_a_failed_attempt_are_not_read(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA)
    written = warc.write_archives(frame)
    folder = written.folder.removeprefix("file://")
    write(folder, entries(3))
    assert warc.read_records(written.manifest.rows).count() == len(rows)


def test_a_hot_payload_is_counted_before_it_is_shuffled(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA)
    plan = warc.owners(frame)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2 and plan.count("hashpartitioning") == 1
    assert warc.owners(frame).where(F.col("owner") == 599).count() == 1
