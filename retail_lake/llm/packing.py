"""Hierarchical packing of documents into windows of several context sizes.

A document's tokens beyond its last full long window are routed to the smallest
tier (context size) that holds them. Tiers are packed from the longest down: a
window opens with the longest piece in stock, its gap is filled with the largest
pieces of shorter tiers that fit, and a last gap by cutting a piece. So every
window is exactly as long as its tier, a power of two, and nothing is padded. What
a task has left at its end is cut into windows of ever smaller powers of two.
Sequences of a block are dealt to step groups of near equal attention cost.

Each task packs the documents it reads, block by block: no shuffle, a bounded
stock, and a lost task is packed again from its own input.

Results, by case: a NULL or empty text is the closing id alone, one piece; rows with
a NULL ``doc_id`` and repeated rows are documents of their own; an empty table gives
no pieces; other columns are ignored.
"""

from __future__ import annotations

import bisect
import functools
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_lake.llm.bpe import Encoder, Vocabulary

#: Context sizes, powers of two.
TIERS = (128, 256, 512, 1024)
#: Sequences of one training step.
STEP = 8
#: Id that closes a document.
CLOSING_ID = 0
#: Text characters packed at a time.
BLOCK_CHARS = 8_000_000
#: Runs of white space that the fast splitter's look-ahead can't take.
LONG_SPACE = re.compile(r"\s{20000}")

SCHEMA = (
    "start long, ids binary, doc_tokens long, sequence_id long, offset long, "
    "tier int, step_group long"
)


def _byte_of_letter() -> dict[str, int]:
    """Byte-level vocabularies write each byte as one printable letter: printable
    Latin-1 bytes as themselves, the others as U+0100 and on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + n): b for n, b in enumerate(others)}


@functools.lru_cache(maxsize=2)
def ranks_of(path: str) -> dict[bytes, int]:
    """Ranks of the ordinary tokens in a tokenizer file, whose ids are in merge order."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    special = {token["content"] for token in content.get("added_tokens", [])}
    letters = _byte_of_letter()
    return {
        bytes(letters[c] for c in token): rank
        for token, rank in content["model"]["vocab"].items()
        if token not in special
    }


@functools.lru_cache(maxsize=2)
def added_of(path: str) -> dict[str, int]:
    """Ids of the added tokens in a tokenizer file."""
    with open(path, encoding="utf-8") as file:
        tokens = json.load(file).get("added_tokens", [])
    if any(token.get(flag) for token in tokens for flag in ("lstrip", "rstrip", "single_word")):
        raise ValueError("added tokens that take white space or whole words only")
    return {token["content"]: token["id"] for token in tokens}


class Tokenizer:
    """Ids of a text, as the file's own library gives without adding special tokens. With
    ``added`` the file's added tokens within a text have their own ids, as by the library's
    defaults; without, they are ordinary text (``encode_special_tokens``)."""

    def __init__(self, path: str, pattern: str, added: bool = False):
        self._added = added_of(path) if added else {}
        # The longest first, where one begins with another.
        names = sorted(self._added, key=len, reverse=True)
        self._split = re.compile(f"({'|'.join(map(re.escape, names))})") if names else None
        self._ranks, self._pattern = ranks_of(path), pattern
        self._fast = tiktoken.Encoding(
            "packing", pat_str=pattern, mergeable_ranks=self._ranks, special_tokens={}
        )
        self._slow: Encoder | None = None

    def ids(self, text: str) -> np.ndarray:
        pieces = self._split.split(text) if self._split else [text]
        found = [
            np.array([self._added[piece]], np.uint32) if at % 2 else self._plain(piece)
            for at, piece in enumerate(pieces)
        ]
        return np.append(np.concatenate(found), CLOSING_ID).astype(np.uint32)

    def _plain(self, text: str) -> np.ndarray:
        if LONG_SPACE.search(text):
            self._slow = self._slow or Encoder(Vocabulary(self._ranks), self._pattern)
            return np.frombuffer(self._slow.encode([text])[0], np.uint32)
        return self._fast.encode_to_numpy(text, disallowed_special=())


class Stock:
    """Pieces ``(document, start, length)`` by length."""

    def __init__(self):
        self.by_length: dict[int, list[tuple[int, int]]] = {}
        self.lengths: list[int] = []

    def add(self, document: int, start: int, length: int) -> None:
        if length not in self.by_length:
            self.by_length[length] = []
            bisect.insort(self.lengths, length)
        self.by_length[length].append((document, start))

    def _take(self, at: int) -> tuple[int, int, int]:
        length = self.lengths[at]
        pieces = self.by_length[length]
        piece = pieces.pop()
        if not pieces:
            del self.by_length[length], self.lengths[at]
        return *piece, length

    def longest(self) -> tuple[int, int, int] | None:
        return self._take(len(self.lengths) - 1) if self.lengths else None

    def fitting(self, gap: int) -> tuple[int, int, int] | None:
        """The longest piece of at most ``gap``, else the head of the next longer one."""
        if not self.lengths:
            return None
        at = bisect.bisect_right(self.lengths, gap)
        if at:
            return self._take(at - 1)
        document, start, length = self._take(0)
        self.add(document, start + gap, length - gap)
        return document, start, gap


def pack(stock: Stock, tiers: tuple[int, ...]) -> Iterator[tuple[int, list]]:
    """Full windows and their pieces; what fills none stays in stock."""
    while (piece := stock.longest()) is not None:
        tier = tiers[bisect.bisect_left(tiers, piece[2])]
        window, gap = [piece], tier - piece[2]
        while gap and (piece := stock.fitting(gap)) is not None:
            window.append(piece)
            gap -= piece[2]
        if gap:
            for piece in window:
                stock.add(*piece)
            return
        yield tier, window


def pack_rest(stock: Stock) -> Iterator[tuple[int, list]]:
    """All that is left, cut into windows of falling powers of two."""
    rest = sum(length * len(stock.by_length[length]) for length in stock.lengths)
    while rest:
        size = 1 << (rest.bit_length() - 1)
        window, gap = [], size
        while gap:
            document, start, length = stock.longest()
            if length > gap:
                stock.add(document, start + gap, length - gap)
                length = gap
            window.append((document, start, length))
            gap -= length
        rest -= size
        yield size, window


def step_groups(windows: list[tuple[int, list]], size: int) -> list[int]:
    """A group for each window: dearest first, dealt to and fro over the groups."""
    cost = [sum(p[2] ** 2 for p in pieces) for _, pieces in windows]
    order = sorted(range(len(windows)), key=lambda i: (-cost[i], i))
    groups = -(-len(windows) // size)
    out = [0] * len(windows)
    for turn, window in enumerate(order):
        row, at = divmod(turn, groups)
        out[window] = groups - 1 - at if row % 2 else at
    return out


class _Task:
    """The stock, documents and counters of one task."""

    def __init__(self, tiers: tuple[int, ...], step: int, partition: int):
        self.tiers, self.step, self.base = tiers, step, partition << 32
        self.stock, self.documents = Stock(), {}
        self.n_documents = self.n_sequences = self.n_groups = 0

    def add(self, doc_id, ids: np.ndarray) -> list[tuple[int, list]]:
        """Full long windows of a document; the rest goes into stock."""
        number, longest = self.n_documents, self.tiers[-1]
        self.n_documents += 1
        self.documents[number] = doc_id, ids
        full = len(ids) // longest * longest
        if len(ids) > full:
            self.stock.add(number, full, len(ids) - full)
        return [(longest, [(number, at, longest)]) for at in range(0, full, longest)]

    def rows(self, windows: list[tuple[int, list]]) -> dict[str, list]:
        out = {n: [] for n in ("doc_id", *re.findall(r"(\w+) (?:long|binary|int)", SCHEMA))}
        groups = step_groups(windows, self.step) if windows else []
        for (tier, pieces), group in zip(windows, groups, strict=True):
            offset = 0
            for number, start, length in pieces:
                doc_id, ids = self.documents[number]
                values = (
                    doc_id, start, ids[start : start + length].tobytes(), len(ids),
                    self.base + self.n_sequences, offset, tier, self.base + self.n_groups + group,
                )
                for column, value in zip(out.values(), values, strict=True):
                    column.append(value)
                offset += length
            self.n_sequences += 1
        self.n_groups += max(groups, default=-1) + 1
        waiting = {p[0] for pieces in self.stock.by_length.values() for p in pieces}
        self.documents = {n: d for n, d in self.documents.items() if n in waiting}
        return out


def pack_documents(
    documents: DataFrame,
    path: str,
    pattern: str,
    tiers: tuple[int, ...] = TIERS,
    step: int = STEP,
) -> DataFrame:
    """Pieces of all documents: ``doc_id``, ``start``, ``ids`` (little-endian unsigned
    32-bit), ``doc_tokens``, ``sequence_id``, ``offset``, ``tier`` and ``step_group``."""
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Tokenizer(path, pattern, added=True)
        task = _Task(tiers, step, TaskContext.get().partitionId())
        types = {"ids": pa.binary(), "tier": pa.int32()}
        id_type = None

        def batch_of(windows):
            columns = task.rows(windows)
            types["doc_id"] = id_type
            arrays = [pa.array(v, types.get(n, pa.int64())) for n, v in columns.items()]
            return pa.RecordBatch.from_arrays(arrays, names=list(columns))

        windows, size = [], 0
        for batch in batches:
            id_type = batch.column(0).type
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                windows += task.add(doc_id, tokenizer.ids(text))
                size += len(text) + 1
                if size >= BLOCK_CHARS:
                    windows += pack(task.stock, tiers)
                    yield batch_of(windows)
                    windows, size = [], 0
        if id_type is not None:
            windows += pack(task.stock, tiers)
            windows += pack_rest(task.stock)
            yield batch_of(windows)

    return texts.mapInArrow(run, f"doc_id {kind}, {SCHEMA}")


def digests(pieces: DataFrame) -> DataFrame:
    """The pieces with their length and the CRC-32 of their ids instead of the ids."""
    return pieces.select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("length"),
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
        "tier",
        "step_group",
    )
