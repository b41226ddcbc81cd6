"""Repeated byte strings across documents, by a distributed sparse suffix array.

A byte goes if a string of ``WINDOW`` bytes that covers it also starts in a document
with a smaller ``doc_id``. Equal windows have the same least-hashed ``ANCHOR`` bytes at the
same place, so only these anchors are indexed, some six in a hundred positions:

1. Anchors are dealt by hash and those of one document alone are dropped, which says
   for each document what may repeat.
2. For the anchors left, the stretch of text whose windows share the anchor is dealt by
   hash. A block of documents sends equal stretches once, for its smallest document, so a
   passage that a third of the corpus has stays as many rows as there are blocks.
3. In a partition the stretches are put in suffix order from their anchor by deep-shallow
   sorting, equal ones fold to their smallest document, and where stretches of one anchor
   differ their windows are sorted the same way.
4. The repeated ranges go back to the documents.

Rows of the exchanges are blocks of packed, compressed arrays, addressed by partition.

Results, by case: NULL and empty texts, and texts shorter than a window, lose nothing;
a row with a NULL ``doc_id`` neither loses bytes nor makes others lose them; rows that
repeat a ``doc_id`` are one document, never smaller than itself, and lose the same
ranges; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_lake.llm.shingles import BLOCK_BYTES, blocks, mix, multipliers, powers_of
from retail_lake.llm.suffixes import deep_shallow_sort

WINDOW = 50
ANCHOR = 16
#: Bits of an anchor's hash that are sent, besides its partition.
KEY_BITS = 40
#: Windows sorted at a time.
CHUNK = 200_000
BLOCK = "part int, kind int, block binary"
FOUND = "doc_id long, n_bytes long, spans array<struct<start:bigint,end:bigint>>, kept binary"
#: Kinds of blocks.
KEYS, TEXTS, ANSWERS, STRETCHES, RANGES = range(5)

_WEIGHTS = multipliers(2, 5)
_BASE = int(multipliers(1, 6)[0])
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Level of compression: the next ones cost more time than they save room.
_LEVEL = 2


# --- blocks --------------------------------------------------------------

def _pack(*arrays: np.ndarray) -> bytes:
    raw = [np.ascontiguousarray(a).tobytes() for a in arrays]
    head = struct.pack(f"<{len(raw)}q", *map(len, raw))
    return zstandard.ZstdCompressor(level=_LEVEL).compress(head + b"".join(raw))


def _unpack(block: bytes, *types: type) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(block)
    sizes = struct.unpack_from(f"<{len(types)}q", raw)
    out, at = [], 8 * len(types)
    for size, kind in zip(sizes, types, strict=True):
        out.append(np.frombuffer(raw, kind, size // np.dtype(kind).itemsize, at))
        at += size
    return out


def _dealt(parts: np.ndarray, count: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Order by partition, and ``(partition, begin, end)`` of those that have items."""
    order = np.argsort(parts, kind="stable")
    cuts = np.searchsorted(parts[order], np.arange(count + 1))
    return order, [(int(p), int(cuts[p]), int(cuts[p + 1])) for p in np.flatnonzero(np.diff(cuts))]


def _rows(kind: int, dealt: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {
            "part": pa.array([p for p, _ in dealt], pa.int32()),
            "kind": pa.array([kind] * len(dealt), pa.int32()),
            "block": pa.array([b for _, b in dealt], pa.binary()),
        }
    )


def _gather(batches: Iterator[pa.RecordBatch]) -> dict[int, list[bytes]]:
    """The compressed blocks of a partition by kind."""
    out: dict[int, list[bytes]] = {}
    for batch in batches:
        for kind, block in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            out.setdefault(kind, []).append(block)
    return out


def _joined(blocks_: list[bytes], *types: type) -> list[np.ndarray]:
    parts = [_unpack(b, *types) for b in blocks_]
    return [
        np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, kind)
        for i, kind in enumerate(types)
    ]


def _part_of(docs: np.ndarray, count: int) -> np.ndarray:
    return (mix(docs.astype(np.uint64)) % np.uint64(count)).astype(np.int64)


# --- anchors -------------------------------------------------------------

class Stretches:
    """Anchors of a block of texts: per anchor its hash and place, the first byte of
    its stretch, the stretch's length, and the text it is in."""

    def __init__(self, texts: list[bytes]):
        sizes = np.array([len(t) for t in texts], np.int64)
        ends = np.cumsum(sizes)
        self.begins = ends - sizes
        self.raw = np.frombuffer(b"".join(texts) + bytes(64), np.uint8)
        n = len(self.raw) - 64
        words = np.ndarray((n + 56,), "<u8", self.raw.data, 0, (1,))
        least = mix(words[:n] * _WEIGHTS[0] + words[8 : n + 8] * _WEIGHTS[1])
        hashes, where = least, np.arange(n, dtype=np.int32)
        # Leftmost least of each window, over spans that double.
        span, places = 1, WINDOW - ANCHOR + 1
        while span < places:
            step = min(span, places - span)
            lower = least[step:] < least[:-step]
            least = np.where(lower, least[step:], least[:-step])
            where = np.where(lower, where[step:], where[:-step])
            span += step
        inside = np.zeros(n + 1, np.int64)
        long = sizes >= WINDOW
        np.add.at(inside, self.begins[long], 1)
        np.add.at(inside, ends[long] - WINDOW + 1, -1)
        windows = np.flatnonzero(np.cumsum(inside)[:n])
        anchors = where[windows]
        fresh = (anchors[1:] != anchors[:-1]) | (windows[1:] != windows[:-1] + 1)
        first = np.flatnonzero(np.concatenate([[True], fresh])) if len(windows) else windows
        last = np.append(first[1:], len(windows)) - 1
        self.start = windows[first]
        self.length = windows[last] - self.start + WINDOW if len(first) else self.start
        self.anchor = anchors[first].astype(np.int64)
        self.hash = hashes[self.anchor]
        self.text = np.searchsorted(ends, self.start, side="right")

    def keep(self, which: np.ndarray) -> None:
        for name in ("start", "length", "anchor", "hash", "text"):
            setattr(self, name, getattr(self, name)[which])

    def contents(self) -> np.ndarray:
        """Hash of each stretch's bytes and of the anchor's place in it."""
        n = len(self.raw)
        sums = np.cumsum((self.raw + np.uint64(1)) * powers_of(_BASE, n), dtype=np.uint64)
        sums = np.concatenate([np.zeros(1, np.uint64), sums])
        of = sums[self.start + self.length] - sums[self.start]
        of *= powers_of(_INVERSE, n)[self.start]
        place = (self.anchor - self.start).astype(np.uint64)
        return mix(of ^ (self.length.astype(np.uint64) << np.uint64(32)) ^ place)

    def bytes_of(self, which: np.ndarray) -> np.ndarray:
        lengths = self.length[which]
        total = np.cumsum(lengths)
        source = np.repeat(self.start[which] - (total - lengths), lengths)
        return self.raw[source + np.arange(len(source))]


def _keys(hashes: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The partition of each anchor, and a key that with it names the anchor."""
    parts = hashes % np.uint64(count)
    keys = hashes // np.uint64(count) & np.uint64((1 << KEY_BITS) - 1)
    return parts.astype(np.int64), keys << np.uint64(64 - KEY_BITS) | parts


def _pieces(
    docs: np.ndarray, texts: list[bytes], most: int = BLOCK_BYTES
) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Documents, first bytes and pieces of texts; a text longer than a block comes in pieces
    that share a window but for a byte, so that each window is whole in one of them."""
    if all(len(text) <= most for text in texts):
        return docs, np.zeros(len(texts), np.int64), texts
    found = [
        (doc, at, text[at : at + most + WINDOW - 1])
        for doc, text in zip(docs.tolist(), texts, strict=True)
        for at in range(0, max(1, len(text) - WINDOW + 1), most)
    ]
    own, first, pieces = zip(*found, strict=True)
    return np.array(own, np.int64), np.array(first, np.int64), list(pieces)


# --- the four steps ------------------------------------------------------

def _send_keys(count: int) -> Callable:
    """The anchors of each document, dealt by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, _, texts = _pieces(batch.column(0).to_numpy(), batch.column(1).to_pylist())
            for begin, end in blocks(texts):
                found = Stretches(texts[begin:end])
                parts, keys = _keys(found.hash, count)
                doc = docs[begin:end][found.text]
                order = np.lexsort((doc, keys))
                parts, keys, doc = parts[order], keys[order], doc[order]
                fresh = (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])
                fresh = np.concatenate([[True], fresh]) if len(keys) else np.zeros(0, bool)
                parts, keys, doc = parts[fresh], keys[fresh], doc[fresh]
                order, dealt = _dealt(parts, count)
                short = (keys >> np.uint64(64 - KEY_BITS))[order].view(np.uint8)
                short = short.reshape(-1, 8)[:, : KEY_BITS // 8]
                doc = doc[order]
                yield _rows(KEYS, [(p, _pack(short[s:e], doc[s:e])) for p, s, e in dealt])

    return run


def _shared_keys(count: int) -> Callable:
    """Anchors that several documents have, sent to the documents' partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, shorts, docs = [], [], []
        for batch in batches:
            for part, block in zip(
                batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True
            ):
                short, doc = _unpack(block, np.uint8, np.int64)
                shorts.append(short)
                docs.append(doc)
                parts.append(np.full(len(doc), part, np.uint64))
        if not docs:
            return
        doc = np.concatenate(docs)
        wide = np.zeros((len(doc), 8), np.uint8)
        wide[:, : KEY_BITS // 8] = np.concatenate(shorts).reshape(-1, KEY_BITS // 8)
        keys = wide.view(np.uint64).ravel() << np.uint64(64 - KEY_BITS) | np.concatenate(parts)
        order = np.lexsort((doc, keys))
        keys, doc = keys[order], doc[order]
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        sizes = np.diff(np.append(starts, len(keys)))
        several = np.repeat(doc[starts] != doc[starts + sizes - 1], sizes)
        keys, doc = keys[several], doc[several]
        order, dealt = _dealt(_part_of(doc, count), count)
        keys, doc = keys[order], doc[order]
        yield _rows(ANSWERS, [(p, _pack(keys[s:e], doc[s:e])) for p, s, e in dealt])

    return run


def _send_texts(count: int) -> Callable:
    """Texts with what columns there are behind ``doc_id`` and ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = batch.column(0).to_numpy()
            texts = batch.column(1).to_pylist()
            others = batch.select(range(2, batch.num_columns))
            for begin, end in blocks(texts):
                own = docs[begin:end]
                order, dealt = _dealt(_part_of(own, count), count)
                rows = []
                for p, s, e in dealt:
                    at = order[s:e] + begin
                    mine = [texts[i] for i in at]
                    rows.append(
                        (
                            p,
                            _pack(
                                docs[at],
                                np.array([len(t) for t in mine], np.int64),
                                np.frombuffer(b"".join(mine), np.uint8),
                                np.frombuffer(_columns(others.take(pa.array(at))), np.uint8),
                            ),
                        )
                    )
                yield _rows(TEXTS, rows)

    return run


def _columns(batch: pa.RecordBatch) -> bytes:
    if not batch.num_columns:
        return b""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _texts_of(
    packed: list[bytes], most: int = 1_000_000
) -> Iterator[tuple[np.ndarray, list[bytes], list[bytes]]]:
    """Documents, texts and other columns of compressed blocks, some of these at a time."""
    at = 0
    while at < len(packed):
        docs, texts, others, held = [], [], [], 0
        while at < len(packed) and held < most:
            doc, sizes, raw, columns = _unpack(packed[at], np.int64, np.int64, np.uint8, np.uint8)
            data, ends = raw.tobytes(), np.cumsum(sizes).tolist()
            texts += [data[e - s : e] for s, e in zip(sizes.tolist(), ends, strict=True)]
            docs.append(doc)
            others.append(columns.tobytes())
            held += len(packed[at])
            at += 1
        yield np.concatenate(docs), texts, others


def _ranges(doc: np.ndarray, begin: np.ndarray, end: np.ndarray, count: int) -> pa.RecordBatch:
    order, dealt = _dealt(_part_of(doc, count), count)
    doc, begin, end = doc[order], begin[order], end[order]
    return _rows(RANGES, [(p, _pack(doc[s:e], begin[s:e], end[s:e])) for p, s, e in dealt])


def _send_stretches(count: int) -> Callable:
    """Stretches of the anchors that other documents have too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks_ = _gather(batches)
        keys, owner = _joined(blocks_.get(ANSWERS, []), np.uint64, np.int64)
        wanted = np.sort(mix(keys ^ mix(owner.astype(np.uint64))))
        if not len(wanted):
            return
        for whole, uncut, _ in _texts_of(blocks_.get(TEXTS, [])):
            docs, base, texts = _pieces(whole, uncut)
            for begin, end in blocks(texts):
                found = Stretches(texts[begin:end])
                doc = docs[begin:end][found.text]
                _, key = _keys(found.hash, count)
                asked = mix(key ^ mix(doc.astype(np.uint64)))
                at = np.minimum(np.searchsorted(wanted, asked), len(wanted) - 1)
                which = wanted[at] == asked
                found.keep(which)
                doc = doc[which]
                if not len(doc):
                    continue
                contents = found.contents()
                order = np.lexsort((doc, contents))
                starts = np.concatenate([[True], contents[order][1:] != contents[order][:-1]])
                sizes = np.diff(np.append(np.flatnonzero(starts), len(order)))
                smallest = np.repeat(doc[order][starts], sizes)
                repeated = order[doc[order] > smallest]
                place = found.start - found.begins[found.text] + base[begin:end][found.text]
                yield _ranges(
                    doc[repeated],
                    place[repeated],
                    place[repeated] + found.length[repeated],
                    count,
                )
                first = order[doc[order] == smallest]
                parts, _ = _keys(found.hash[first], count)
                inner, dealt = _dealt(parts, count)
                rows = []
                for p, s, e in dealt:
                    own = first[inner[s:e]]
                    rows.append(
                        (
                            p,
                            _pack(
                                found.bytes_of(own),
                                found.length[own].astype(np.uint8),
                                (found.anchor - found.start)[own].astype(np.uint8),
                                doc[own],
                                place[own],
                            ),
                        )
                    )
                yield _rows(STRETCHES, rows)

    return run


def _sorted_stretches(count: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stretches = []
        for batch in batches:
            known = pc.equal(batch.column(1), RANGES)
            yield batch.filter(known)  # as they are
            stretches += batch.filter(pc.invert(known)).column(2).to_pylist()
        raw, length, anchor, doc, place = _joined(
            stretches, np.uint8, np.uint8, np.uint8, np.int64, np.int64
        )
        if len(doc):
            yield _ranges(*repeated_ranges(raw, length, anchor, doc, place), count)

    return run


def _matrix(raw: np.ndarray, start: np.ndarray, length: np.ndarray, width: int) -> np.ndarray:
    """Rows of ``width`` bytes of ``raw`` from ``start``, zero past ``length``. Behind the last
    row ``raw`` has ``width`` bytes more."""
    every = np.lib.stride_tricks.sliding_window_view(raw, width)
    rows = every[start]
    rows[np.arange(width) >= length[:, None]] = 0
    return rows


def repeated_ranges(
    raw: np.ndarray, length: np.ndarray, anchor: np.ndarray, doc: np.ndarray, place: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``doc``, ``begin`` and ``end`` of what smaller documents have too.

    ``raw`` holds the stretches in a row, ``anchor`` is the anchor's place in each.
    """
    length, anchor = length.astype(np.int64), anchor.astype(np.int64)
    begin = np.cumsum(length) - length
    raw = np.concatenate([raw, np.zeros(WINDOW + 8, np.uint8)])
    # Suffix order from the anchor; what precedes it, and the sizes, follow.
    head = WINDOW
    tail = WINDOW - ANCHOR
    rows = np.concatenate(
        [
            _matrix(raw, begin + anchor, length - anchor, head),
            _matrix(raw, begin, anchor, tail),
            length[:, None].astype(np.uint8),
            anchor[:, None].astype(np.uint8),
            np.zeros((len(doc), -(head + tail + 2) % 8), np.uint8),
        ],
        axis=1,
    )
    order, equal = deep_shallow_sort(rows)
    starts = np.flatnonzero(equal == np.arange(len(order)))
    sizes = np.diff(np.append(starts, len(order)))
    least = np.repeat(np.minimum.reduceat(doc[order], starts), sizes)
    whole = order[doc[order] > least]
    # Of each kind of stretch, the smallest document's: compared window by window.
    kind = np.repeat(np.arange(len(starts)), sizes)
    first = doc[order] == least
    firsts, kind = order[first], kind[first]
    anchors = rows[order[starts], :ANCHOR]
    differ = np.concatenate([[True], (anchors[1:] != anchors[:-1]).any(axis=1)])
    group = np.cumsum(differ) - 1
    several = np.bincount(group)[group] > 1
    chosen = several[kind]
    firsts, group = firsts[chosen], group[kind[chosen]]
    parts = [(doc[whole], place[whole], place[whole] + length[whole])]
    windows = length[firsts] - WINDOW + 1
    ends = np.cumsum(windows)
    cut = 0
    while cut < len(firsts):
        base = ends[cut - 1] if cut else 0
        last = max(cut + 1, int(np.searchsorted(ends, base + CHUNK)))
        # A chunk ends where a group of stretches with one anchor does.
        last = int(np.searchsorted(group, group[last - 1], side="right"))
        parts.append(
            _repeated_windows(raw, begin, doc, place, firsts[cut:last], windows[cut:last])
        )
        cut = last
    return tuple(np.concatenate(column) for column in zip(*parts, strict=True))


def _repeated_windows(raw, begin, doc, place, stretches, windows):
    owner = np.repeat(stretches, windows)
    shift = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    width = WINDOW + -WINDOW % 8
    rows = _matrix(raw, begin[owner] + shift, np.full(len(owner), WINDOW), width)
    order, equal = deep_shallow_sort(rows)
    starts = np.flatnonzero(equal == np.arange(len(order)))
    sizes = np.diff(np.append(starts, len(order)))
    least = np.repeat(np.minimum.reduceat(doc[owner[order]], starts), sizes)
    hit = np.sort(order[doc[owner[order]] > least])
    if not len(hit):
        return doc[:0], place[:0], place[:0]
    # Neighbouring windows of a stretch make one range.
    fresh = (hit[1:] != hit[:-1] + 1) | (owner[hit[1:]] != owner[hit[:-1]])
    first = np.concatenate([[True], fresh])
    last = np.concatenate([fresh, [True]])
    of = owner[hit[first]]
    return doc[of], place[of] + shift[hit[first]], place[of] + shift[hit[last]] + WINDOW


def _cut(
    finish: Callable[[np.ndarray, list[bytes], list[list[tuple[int, int]]], list[bytes]], pa.RecordBatch],
) -> Callable:
    """Texts and their ranges meet; ``finish`` makes a batch of documents, texts, maximal
    runs and other columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks_ = _gather(batches)
        doc, begin, end = _joined(blocks_.get(RANGES, []), np.int64, np.int64, np.int64)
        order = np.lexsort((begin, doc))
        doc, begin, end = doc[order], begin[order], end[order]
        for ids, texts, others in _texts_of(blocks_.get(TEXTS, [])):
            low = np.searchsorted(doc, ids).tolist()
            high = np.searchsorted(doc, ids, side="right").tolist()
            spans = [
                union_of(begin[s:e], end[s:e], len(text))
                for text, s, e in zip(texts, low, high, strict=True)
            ]
            yield finish(ids, texts, spans, others)

    return run


def _kept(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for span in spans for x in span), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def _found(ids, texts, spans, others) -> pa.RecordBatch:
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    runs = [[{"start": a, "end": b} for a, b in own] for own in spans]
    kept = [_kept(text, own) for text, own in zip(texts, spans, strict=True)]
    return pa.RecordBatch.from_pydict(
        {
            "doc_id": pa.array(ids),
            "n_bytes": pa.array([len(t) for t in texts], pa.int64()),
            "spans": pa.array(runs, pa.list_(span)),
            "kept": pa.array(kept, pa.binary()),
        }
    )


def _cleaned(place: int) -> Callable:
    """The other columns with the text left, as whole characters, at its place."""

    def finish(ids, texts, spans, others) -> pa.RecordBatch:
        tables = [pa.ipc.open_stream(o).read_all() for o in others]
        columns = pa.concat_tables(tables).combine_chunks().flatten()
        columns = columns.rename_columns([c.removeprefix("_others.") for c in columns.column_names])
        kept = [
            _kept(text, own).decode("utf-8", "ignore")
            for text, own in zip(texts, spans, strict=True)
        ]
        arrays = [c.combine_chunks() for c in columns.columns]
        arrays.insert(place, pa.array(kept, pa.string()))
        names = [*columns.column_names]
        names.insert(place, "text")
        return pa.RecordBatch.from_arrays(arrays, names=names)

    return finish


def union_of(begin: np.ndarray, end: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Maximal runs of ranges that are in order of their begin, within a text."""
    if not len(begin):
        return []
    end = np.minimum(np.maximum.accumulate(end), size)
    fresh = begin[1:] > end[:-1]
    first = np.flatnonzero(np.concatenate([[True], fresh]))
    last = np.append(first[1:], len(begin)) - 1
    found = zip(begin[first].tolist(), end[last].tolist(), strict=True)
    return [(a, b) for a, b in found if a < b]


def _repeated(known: DataFrame, texts: DataFrame, count: int, finish: Callable, schema) -> DataFrame:
    """``known`` has ``doc_id`` and ``text`` as bytes; ``texts`` are blocks of the same rows."""

    def dealt(blocks_: DataFrame) -> DataFrame:
        return blocks_.repartitionById(count, F.col("part"))

    plain = known.select("doc_id", "text").mapInArrow(_send_texts(count), BLOCK)
    keys = known.select("doc_id", "text").mapInArrow(_send_keys(count), BLOCK)
    answers = dealt(keys).mapInArrow(_shared_keys(count), BLOCK)
    stretches = dealt(plain.unionByName(answers)).mapInArrow(_send_stretches(count), BLOCK)
    ranges = dealt(stretches).mapInArrow(_sorted_stretches(count), BLOCK)
    return dealt(texts.unionByName(ranges)).mapInArrow(_cut(finish), schema)


def _partitions(documents: DataFrame) -> int:
    return int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def find_repeats(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``spans array<struct<start, end>>`` (maximal removed runs, in
    bytes) and ``kept`` (the remaining bytes) of every document."""
    count = _partitions(documents)
    text = F.coalesce("text", F.lit("")).cast("binary").alias("text")
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text)
    known = rows.where("doc_id IS NOT NULL")
    texts = known.mapInArrow(_send_texts(count), BLOCK)
    found = _repeated(known, texts, count, _found, FOUND)
    nameless = rows.where("doc_id IS NULL").select(
        "doc_id",
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"),
        F.col("text").alias("kept"),
    )
    return found.unionByName(nameless)


def without_repeats(documents: DataFrame) -> DataFrame:
    """The documents with repeated bytes cut from ``text``; characters that a cut splits go
    whole. All columns stay. A NULL text stays NULL."""
    count = _partitions(documents)
    columns = documents.columns
    others = [c for c in columns if c != "text"]
    whole = documents.where("doc_id IS NOT NULL AND text IS NOT NULL")
    # The other columns in one, so that no name of theirs clashes.
    rows = whole.select(
        F.col("doc_id").cast("long").alias("_id"),
        F.col("text").cast("binary").alias("_text"),
        F.struct(*others).alias("_others"),
    )
    known = rows.select(F.col("_id").alias("doc_id"), F.col("_text").alias("text"))
    texts = rows.mapInArrow(_send_texts(count), BLOCK)
    schema = documents.select(*columns).schema
    cleaned = _repeated(known, texts, count, _cleaned(columns.index("text")), schema)
    rest = documents.where("doc_id IS NULL OR text IS NULL")
    return cleaned.unionByName(rest)


def digests(found: DataFrame) -> DataFrame:
    """Bytes, removed bytes and runs of each document, and the digest of what is kept."""
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
