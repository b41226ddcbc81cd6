"""WARC records in ZIP-packaged archives: written by Spark tasks, read in place.

An archive is a ZIP file of stored members: ``archive/data.warc.gz``, one gzip member per
record, and ``indexes/index.cdxj``, one line per record with its offset and length. Nothing
is ever extracted: a reader parses the ZIP's own directory (ZIP64 included) to learn where
a member's bytes lie, splits the index into ranges of bytes that Spark deals over tasks,
and each task reads just the records that its lines name. So one archive that holds a third
of all records is read by as many tasks as many small ones.

A payload that occurs more than once is stored once: the record of its largest id is the
``response``, the others are ``revisit`` records that name it and keep its digest and length.

Results, by case: a NULL payload is an empty one; equal payloads of fewer than
``least_bytes`` bytes are all responses; rows that repeat an id have a record each and the
same type; a row with a NULL id revisits the largest id of its payload, and is a response
where all of its payload's rows have none; a NULL url becomes the record's own id; an empty
table gives no archive and an empty result; other columns are ignored. A payload of any
length is held whole by one task.

A task's files are named anew in each attempt, and only those that a finished attempt reports
are in the manifest: an executor that is lost leaves files behind that nothing reads.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_lake.workspace import Staged, new_path, stage

DATA = "archive/data.warc.gz"
INDEX = "indexes/index.cdxj"
#: An archive is closed when it has so many bytes or records.
ARCHIVE_BYTES = 256 << 20
ARCHIVE_RECORDS = 200_000
#: Bytes of index that one task reads, of records that it reads at once, and of payloads in
#: an Arrow batch. One record may be longer.
INDEX_RANGE = 64 << 10
READ_BYTES = 4 << 20
BATCH_BYTES = 8 << 20
WRITE_DATE = "2000-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# Signatures and marks of the ZIP format.
END = b"PK\x05\x06"
END64 = b"PK\x06\x06"
END64_PLACE = b"PK\x06\x07"
ENTRY = b"PK\x01\x02"
LOCAL = b"PK\x03\x04"
LONGEST_COMMENT = 0xFFFF
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF


def open_store(place: str) -> tuple[pa.fs.FileSystem, str]:
    """The Arrow filesystem of a path or URI, and the path in it."""
    return pa.fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", place))


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- the ZIP directory ------------------------------------------------------


class BadArchive(ValueError):
    """A file that is no whole ZIP archive of stored members."""


@dataclass(frozen=True)
class Member:
    """A stored file of an archive; ``begin`` is where its bytes start."""

    name: str
    begin: int
    size: int


class Range:
    """Byte ranges of an open file; every read must be whole."""

    def __init__(self, file):
        self.file, self.size = file, file.size()

    def read(self, begin: int, size: int) -> bytes:
        if begin < 0 or begin + size > self.size:
            raise BadArchive(f"bytes {begin} to {begin + size} of {self.size}")
        data = self.file.read_at(size, begin)
        if len(data) != size:
            raise BadArchive(f"{len(data)} bytes at {begin}, not {size}")
        return data


def _central(source: Range) -> tuple[int, int, int]:
    """Entries, size and offset of the central directory."""
    tail_begin = max(0, source.size - 22)
    tail = source.read(tail_begin, source.size - tail_begin)
    if tail[:4] != END or tail[-2:] != b"\0\0":
        # There is a comment behind it, or this is no archive.
        tail_begin = max(0, tail_begin - LONGEST_COMMENT)
        tail = source.read(tail_begin, source.size - tail_begin)
    at = len(tail) - 21
    while (at := tail.rfind(END, 0, at + 3)) >= 0:
        # A comment may hold the signature too; its own length must fit the file's end.
        if at + 22 + struct.unpack_from("<H", tail, at + 20)[0] == len(tail):
            break
    if at < 0:
        raise BadArchive("no end of a central directory")
    disk, first_disk, here, entries, size, offset = struct.unpack_from("<4H2L", tail, at + 4)
    place = tail_begin + at - 20
    if place >= 0 and (locator := source.read(place, 20))[:4] == END64_PLACE:
        record = source.read(struct.unpack_from("<Q", locator, 8)[0], 56)
        if record[:4] != END64:
            raise BadArchive("no ZIP64 end of a central directory")
        disk, first_disk, here, entries, size, offset = struct.unpack_from("<2L4Q", record, 16)
    if disk or first_disk or here != entries:
        raise BadArchive("an archive of several files")
    return entries, size, offset


def _wide(extra: bytes, values: list[int]) -> list[int]:
    """Sizes and offset of an entry, those that are full taken from its ZIP64 field."""
    at = 0
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<2H", extra, at)
        if kind == 1:
            field = iter(struct.iter_unpack("<Q", extra[at + 4 : at + 4 + size // 8 * 8]))
            try:
                return [next(field)[0] if v == FULL32 else v for v in values]
            except StopIteration:
                raise BadArchive("a ZIP64 field that is too short") from None
        at += 4 + size
    return values


def members(source: Range) -> dict[str, Member]:
    """The stored members of an archive by name, from its central directory. Compressed or
    encrypted ones are left out: their bytes cannot be read in place."""
    entries, size, offset = _central(source)
    directory, found, at = source.read(offset, size), {}, 0
    for _ in range(entries):
        if directory[at : at + 4] != ENTRY or at + 46 > len(directory):
            raise BadArchive(f"no entry at {at} of the central directory")
        flags, method = struct.unpack_from("<2H", directory, at + 8)
        packed, full, n_name, n_extra, n_comment, _, _, _, local = struct.unpack_from(
            "<2L5H2L", directory, at + 20
        )
        name = directory[at + 46 : at + 46 + n_name]
        extra = directory[at + 46 + n_name : at + 46 + n_name + n_extra]
        at += 46 + n_name + n_extra + n_comment
        if method == 0 and not flags & 1:
            full, packed, local = _wide(extra, [full, packed, local])
            if packed != full:
                raise BadArchive(f"{name!r} is stored, but its sizes differ")
            text = name.decode("utf-8" if flags & 0x800 else "cp437")
            found[text] = (local, full)
    return {name: _located(source, name, *place) for name, place in found.items()}


def _located(source: Range, name: str, local: int, size: int) -> Member:
    head = source.read(local, 30)
    if head[:4] != LOCAL:
        raise BadArchive(f"no header of {name!r} at {local}")
    n_name, n_extra = struct.unpack_from("<2H", head, 26)
    begin = local + 30 + n_name + n_extra
    if begin + size > source.size:
        raise BadArchive(f"{name!r} reaches beyond the file")
    return Member(name, begin, size)


# --- records ----------------------------------------------------------------


def _field(value: str) -> str:
    """A header value on one line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record_id(page: int | str | None) -> str:
    return f"<urn:x-page:{'' if page is None else _field(str(page))}>"


def page_of(record: str) -> str | None:
    """The page's id, as text, in a record's id."""
    found = re.fullmatch(r"<urn:x-page:(.*)>", record)
    return (found[1] or None) if found else None


def record_bytes(page, url: str | None, payload: bytes, digest: str, owner, date: str) -> bytes:
    """A whole WARC record. It revisits the response of page ``owner`` if that is another."""
    revisit = owner is not None and owner != page
    http = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    own = record_id(page)
    uri = _field(own[1:-1] if url is None else url)
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {own}",
        f"WARC-Target-URI: {uri}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        lines += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {record_id(owner)}"]
    return "\r\n".join([*lines, "", ""]).encode() + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    pairs = (line.partition(":") for line in lines[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


@dataclass(frozen=True)
class Record:
    """A parsed record; a revisit has no ``payload``, but its length and digest."""

    record_id: str
    record_type: str
    target_uri: str
    date: str
    payload: bytes | None
    payload_bytes: int
    payload_digest: str
    refers_to: str | None


def parse_record(data: bytes) -> Record:
    """A record from its bytes. Lengths must fit, and a payload its digest."""
    head, mark, rest = data.partition(b"\r\n\r\n")
    if not mark or not head.startswith(b"WARC/1."):
        raise BadArchive(f"no record: {data[:40]!r}")
    fields = _fields(head)
    length = int(fields["content-length"])
    if rest[length:] != b"\r\n\r\n":
        raise BadArchive(f"{fields.get('warc-record-id')}: not {length} bytes long")
    http, _, payload = rest[:length].partition(b"\r\n\r\n")
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    kind = fields["warc-type"]
    n_bytes = int(_fields(http)["content-length"])
    if kind != "revisit" and (len(payload) != n_bytes or digest_of(payload) != digest):
        raise BadArchive(f"{fields['warc-record-id']}: the payload is not the one written")
    return Record(
        fields["warc-record-id"],
        kind,
        fields["warc-target-uri"],
        fields["warc-date"],
        None if kind == "revisit" else payload,
        n_bytes,
        digest,
        fields.get("warc-refers-to"),
    )


# --- writing ----------------------------------------------------------------


class ArchiveWriter:
    """One archive, written from front to back; its index is kept until it is closed."""

    def __init__(self, folder: str):
        self.place = f"{folder.rstrip('/')}/{uuid.uuid4().hex}.zip"
        filesystem, path = open_store(self.place)
        filesystem.create_dir(path.rpartition("/")[0], recursive=True)
        self.file = filesystem.open_output_stream(path)
        self.zip = zipfile.ZipFile(self.file, "w", zipfile.ZIP_STORED)
        self.data = self.zip.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)
        self.lines: list[str] = []
        self.offset = 0

    def add(self, record: bytes, page, url: str | None, digest: str, date: str, level: int) -> None:
        pack = zlib.compressobj(level, wbits=31)
        packed = pack.compress(record) + pack.flush()
        self.data.write(packed)
        entry = {
            "url": url,
            "id": record_id(page),
            "digest": f"sha1:{digest}",
            "filename": DATA.rpartition("/")[2],
            "offset": str(self.offset),
            "length": str(len(packed)),
        }
        key = _field("" if url is None else url)
        self.lines.append(f"{key} {re.sub('[^0-9]', '', date)} {json.dumps(entry)}\n")
        self.offset += len(packed)

    @property
    def full(self) -> bool:
        return self.offset >= ARCHIVE_BYTES or len(self.lines) >= ARCHIVE_RECORDS

    def close(self) -> tuple[str, int]:
        self.data.close()
        with self.zip.open(zipfile.ZipInfo(INDEX), "w", force_zip64=True) as index:
            for line in self.lines:
                index.write(line.encode())
        self.zip.close()
        self.file.close()
        return self.place, len(self.lines)


def owners(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``mark``, ``owner``: the largest id of each payload that occurs more than once.

    Counted on the map side, so a payload that a third of all rows share is one row a task.
    """
    marked = _marked(pages).where(F.octet_length("payload") >= least_bytes)
    return (
        marked.groupBy("mark")
        .agg(F.max("id").alias("owner"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("mark", "owner")
    )


def _marked(pages: DataFrame, ids: str = "page_id", payloads: str = "html") -> DataFrame:
    payload = F.coalesce(F.col(payloads).cast("binary"), F.lit(b""))
    url = F.col("url") if "url" in pages.columns else F.lit(None).cast("string")
    rows = pages.select(F.col(ids).alias("id"), url.alias("url"), payload.alias("payload"))
    return rows.withColumn("mark", F.unhex(F.sha2("payload", 256)))


@dataclass(frozen=True)
class Written:
    """Archives in a folder; ``manifest`` has their paths and numbers of records."""

    folder: str
    manifest: Staged

    def discard(self) -> None:
        """Delete the archives and their manifest."""
        self.manifest.discard()
        Staged(self.folder, self.manifest.rows).discard()


def write_archives(
    pages: DataFrame,
    folder: str | None = None,
    least_bytes: int = 0,
    date: str = WRITE_DATE,
    level: int = 6,
) -> Written:
    """A record for each row of ``page_id``, ``url`` and ``html``, in archives below ``folder``
    (or a new folder that all executors share).

    The payloads that repeat are staged first. If Spark finds their table small it is
    broadcast, and pages are written where they are read; otherwise pages are shuffled by
    payload, and adaptive execution splits a payload with very many rows.
    """
    spark = pages.sparkSession
    folder = new_path(spark, "warc") if folder is None else folder
    repeated = stage(owners(pages, least_bytes), "payloads")
    rows = _marked(pages).join(repeated.rows, "mark", "left").select("id", "url", "payload", "owner")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, done = None, []
        for batch in batches:
            columns = batch.columns
            for row in range(batch.num_rows):
                page, url, payload, owner = (column[row].as_py() for column in columns)
                if writer is None:
                    writer = ArchiveWriter(folder)
                digest = digest_of(payload)
                record = record_bytes(page, url, payload, digest, owner, date)
                writer.add(record, page, url, digest, date, level)
                if writer.full:
                    done.append(writer.close())
                    writer = None
        if writer is not None:
            done.append(writer.close())
        if done:
            yield pa.RecordBatch.from_pylist([{"archive": a, "n_records": n} for a, n in done])

    manifest = stage(rows.mapInArrow(run, "archive string, n_records long"), "manifest")
    repeated.discard()
    return Written(folder, manifest)


# --- reading ----------------------------------------------------------------


@functools.lru_cache(maxsize=4)
def _opened(place: str) -> tuple[Range, dict[str, Member]]:
    filesystem, path = open_store(place)
    source = Range(filesystem.open_input_file(path))
    return source, members(source)


def _index_ranges(place: str) -> Iterator[dict]:
    _, found = _opened(place)
    indexes = [m for m in found.values() if re.fullmatch(r"indexes/.*\.cdxj?", m.name)]
    if not indexes and any(re.fullmatch(r"archive/.*\.warc(\.gz)?", name) for name in found):
        raise BadArchive(f"{place}: records without an index")
    for member in indexes:
        for begin in range(0, member.size, INDEX_RANGE):
            yield {"archive": place, "index": member.name, "begin": begin}


def _lines(source: Range, member: Member, begin: int) -> Iterator[bytes]:
    """Lines of an index that start in the range at ``begin``; the last one may end after it."""
    end = min(begin + INDEX_RANGE, member.size)
    # A line that starts at ``begin`` follows a line break.
    at = max(begin - 1, 0)
    data = source.read(member.begin + at, end - at)
    while not data.endswith(b"\n") and end < member.size:
        more = source.read(member.begin + end, min(4096, member.size - end))
        stop = more.find(b"\n") + 1
        data += more[:stop] if stop else more
        end += stop or len(more)
    lines = data.split(b"\n")
    return (line for line in (lines if begin == 0 else lines[1:]) if line)


def _places(found: dict[str, Member], lines: Iterable[bytes]) -> Iterator[tuple[int, int]]:
    """Where the records that index lines name lie in the file."""
    for line in lines:
        entry = json.loads(line[line.index(b"{") :])
        member = found[f"archive/{entry['filename']}"]
        offset, length = int(entry["offset"]), int(entry["length"])
        if offset + length > member.size:
            raise BadArchive(f"a record beyond the end of {member.name!r}")
        yield member.begin + offset, length


def _ranged(source: Range, places: Iterable[tuple[int, int]]) -> Iterator[bytes]:
    """The bytes at each place. Places that follow each other are read at once."""
    group: list[tuple[int, int]] = []
    for place in [*places, None]:
        if group and (
            place is None
            or place[0] != sum(group[-1])
            or sum(place) - group[0][0] > READ_BYTES
        ):
            begin = group[0][0]
            data = source.read(begin, sum(group[-1]) - begin)
            yield from (data[a - begin : a - begin + size] for a, size in group)
            group = []
        if place is not None:
            group.append(place)


def _unpacked(data: bytes) -> bytes:
    if data[:2] != b"\x1f\x8b":
        return data
    unpack = zlib.decompressobj(wbits=31)
    record = unpack.decompress(data)
    if not unpack.eof or unpack.unused_data:
        raise BadArchive("an index entry that is not one whole record")
    return record


def read_records(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """Every record that the indexes of ``archives`` (a column ``archive`` of paths) name.

    Columns: ``archive``, ``record_id``, ``record_type``, ``target_uri``, ``date``,
    ``payload`` (NULL for a revisit, and throughout without ``payloads``), ``payload_bytes``,
    ``payload_digest``, ``refers_to``. Each payload is checked against its digest and length.
    """

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place in batch.column(0).to_pylist():
                ranges = list(_index_ranges(place))
                if ranges:
                    yield pa.RecordBatch.from_pylist(ranges)

    schema = pa.schema(
        [(n, pa.string()) for n in ("archive", "record_id", "record_type", "target_uri", "date")]
        + [("payload", pa.binary()), ("payload_bytes", pa.int64())]
        + [(n, pa.string()) for n in ("payload_digest", "refers_to")]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                source, found = _opened(row["archive"])
                lines = _lines(source, found[row["index"]], row["begin"])
                for data in _ranged(source, _places(found, lines)):
                    record = vars(parse_record(_unpacked(data)))
                    if not payloads:
                        record = record | {"payload": None}
                    rows.append({"archive": row["archive"], **record})
                    size += 256 + len(record["payload"] or b"")
                    if size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    ranges = archives.select("archive").mapInArrow(locate, "archive string, index string, begin long")
    # Small rows that stand for much reading: archives of any sizes are spread evenly, over
    # a number of tasks that adaptive execution does not merge by the rows' own bytes.
    tasks = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = ranges.repartition(tasks, "archive", "index", "begin")
    spread = spread.sortWithinPartitions("archive", "begin")
    return spread.mapInArrow(
        read,
        "archive string, record_id string, record_type string, target_uri string, date string, "
        "payload binary, payload_bytes long, payload_digest string, refers_to string",
    )


def resolved(records: DataFrame) -> DataFrame:
    """``records`` with the payload of each revisit, from the response that it refers to.

    Responses that repeat an id have equal payloads; one of each id is taken, and only those
    that a revisit names are moved.
    """
    revisits = records.where("record_type = 'revisit'")
    named = revisits.select("refers_to", "payload_digest").distinct()
    responses = (
        records.where("record_type <> 'revisit'")
        .select(F.col("record_id").alias("refers_to"), "payload_digest", "payload")
        .join(named, ["refers_to", "payload_digest"], "left_semi")
        .dropDuplicates(["refers_to", "payload_digest"])
    )
    filled = revisits.drop("payload").join(responses, ["refers_to", "payload_digest"], "left")
    return records.where("record_type <> 'revisit'").unionByName(filled)


def digests(records: DataFrame, id_type: str = "long") -> DataFrame:
    """Each record's page with its payload's length and digest, its type, and the page that
    a revisit refers to."""

    def page(column: str):
        return F.nullif(F.regexp_extract(column, "^<urn:x-page:(.*)>$", 1), F.lit("")).cast(id_type)

    return records.select(
        page("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page("refers_to").alias("refers_to"),
    )


def packed_and_read(pages: DataFrame) -> DataFrame:
    """``digests`` of all records after a way through archives, which are then deleted."""
    written = write_archives(pages)
    found = stage(
        digests(
            read_records(written.manifest.rows, payloads=False),
            pages.schema["page_id"].dataType.simpleString(),
        ),
        "records",
    )
    written.discard()
    return found.rows
