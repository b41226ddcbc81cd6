"""Byte-level BPE with a hierarchical-bitmap rank queue.

Every distinct pre-token of a block of texts is laid out in one linked list of
byte positions. A queue keeps, per merge rank, a bucket of list positions whose
pair has that rank; a three-level bitmap over the ranks tells by find-first-set
which bucket is next. A popped position whose pair changed meanwhile is stale and
skipped. Pre-tokens never touch (a barrier lies between them), so one pop merges
that rank in all of them. Where a merge can bring a lower rank back, those pairs of a
pre-token are merged in one go that lie before the first that does, and the others wait
in a heap; so time stays near linear in the length of a pre-token.

Results, by case: a NULL text is empty; an empty text has no ids and decodes to
no bytes; rows with a NULL ``doc_id`` and repeated rows are encoded like any other
row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import functools
import heapq
from collections.abc import Collection, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Text characters that one block holds; a longer text is a block of its own.
BLOCK_CHARS = 4_000_000
#: Pre-tokens remembered in a task; past that the memory starts anew.
REMEMBERED = 500_000
BARRIER, DEAD = -1, -2
#: Positions of a rank that can bring a lower one back, taken from its bucket at once: the
#: first time, and at least. As many are taken as are merged, up to a factor of two or so.
WIDEST, LEAST_WINDOW = 1 << 16, 16


class Vocabulary:
    """Ranks of a tokenizer, and the rank that each pair of ids merges into."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        size = max(ranks.values()) + 1
        self.size = size
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        words = [b""] * size
        for word, rank in ranks.items():
            words[rank] = word
        self.lengths = np.array([len(w) for w in words], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])[:-1]
        self.bytes = np.frombuffer(b"".join(words), np.uint8)
        keys, merged, reentrant = [], [], set()
        for word, rank in ranks.items():
            for cut in range(1, len(word)):
                left, right = ranks.get(word[:cut]), ranks.get(word[cut:])
                if left is None or right is None:
                    continue
                keys.append(left << 32 | right)
                merged.append(rank)
                # A merge into such an id can bring a lower rank back.
                reentrant.update(part for part in (left, right) if part > rank)
        order = np.argsort(np.array(keys, np.int64))
        self.keys = np.array(keys, np.int64)[order]
        self.merged = np.array(merged, np.int64)[order]
        self.reentrant = reentrant
        pairs = self.byte_ids[:, None] << 32 | self.byte_ids[None, :]
        self.byte_pairs = self._look_up(pairs.ravel()).reshape(256, 256)

    def _look_up(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(keys), -1, np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.merged[at], -1)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, -1 where the pair is in no token."""
        return self._look_up(np.where((left < 0) | (right < 0), -1, left << 32 | right))

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of a sequence of ids."""
        lengths = self.lengths[ids]
        total = int(lengths.sum())
        begin = np.cumsum(lengths) - lengths
        source = np.repeat(self.starts[ids] - begin, lengths) + np.arange(total)
        return self.bytes[source].tobytes()


@functools.lru_cache(maxsize=4)
def load(path: str) -> Vocabulary:
    """The vocabulary of a rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        return Vocabulary({base64.b64decode(token): int(rank) for token, rank in pairs})


class RankQueue:
    """Buckets of positions by rank, under a bitmap of 64-bit words in levels."""

    def __init__(self, size: int, ordered: Collection[int] = ()):
        """``ordered`` are the ranks whose buckets are kept as heaps."""
        self.ordered = ordered
        self.buckets: dict[int, list[int]] = {}
        self.levels: list[list[int]] = []
        while not self.levels or len(self.levels[-1]) > 1:
            size = (size + 63) // 64
            self.levels.append([0] * size)

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.open(rank, [position])
        elif rank in self.ordered:
            heapq.heappush(bucket, position)
        else:
            bucket.append(position)

    def open(self, rank: int, positions: list[int]) -> None:
        self.buckets[rank] = positions
        for words in self.levels:
            word, bit = rank >> 6, rank & 63
            seen = words[word]
            words[word] = seen | 1 << bit
            if seen:
                return
            rank = word

    def pop(self) -> tuple[int, list[int]] | None:
        """The lowest rank and its positions, or None when nothing is left."""
        if not self.buckets:
            return None
        rank = 0
        for words in reversed(self.levels):
            first = words[rank] & -words[rank]
            rank = rank << 6 | first.bit_length() - 1
        at = rank
        for words in self.levels:
            word = at >> 6
            words[word] &= ~(1 << (at & 63))
            if words[word]:
                break
            at = word
        return rank, self.buckets.pop(rank)


def _until_lower(
    vocabulary: Vocabulary,
    rank: int,
    left: np.ndarray,
    ids: np.ndarray,
    following: np.ndarray,
    preceding: np.ndarray,
    barriers: np.ndarray,
) -> np.ndarray:
    """Which of the pairs at ``left`` may be merged in one go: in each piece those up to the
    first whose merge makes a pair of lower rank, which would go before the others."""
    right = following[left]
    before = ids[preceding[left]]
    # The pair just to the left has been merged by then.
    joined = np.concatenate([[False], right[:-1] == preceding[left[1:]]])
    before = np.where(joined, rank, before)
    merged = np.full(len(left), rank, np.int64)
    made = vocabulary.pair_ranks(before, merged)
    lower = (made >= 0) & (made < rank)
    made = vocabulary.pair_ranks(merged, ids[following[right]])
    lower |= (made >= 0) & (made < rank)
    earlier = np.cumsum(lower) - lower
    piece = np.searchsorted(barriers, left)
    _, first, which = np.unique(piece, return_index=True, return_inverse=True)
    return earlier == earlier[first][which]


def merge_block(vocabulary: Vocabulary, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all pieces in a row, and how many of them each piece has."""
    lengths = np.array([len(p) for p in pieces], np.int64)
    raw = np.frombuffer(b"\0" + b"\0".join(pieces) + b"\0", np.uint8)
    barriers = np.concatenate([[0], np.cumsum(lengths + 1)])
    ids = vocabulary.byte_ids[raw]
    ids[barriers] = BARRIER
    following = np.arange(1, len(raw) + 1)
    preceding = np.arange(-1, len(raw) - 1)
    ranks = np.full(len(raw), -1, np.int64)
    ranks[:-1] = vocabulary.byte_pairs[raw[:-1], raw[1:]]
    ranks[barriers] = -1
    ranks[barriers[1:] - 1] = -1

    queue = RankQueue(vocabulary.size, vocabulary.reentrant)
    window: dict[int, int] = {}
    start = np.flatnonzero(ranks >= 0)
    start = start[np.argsort(ranks[start], kind="stable")]
    found, first = np.unique(ranks[start], return_index=True)
    for rank, positions in zip(found.tolist(), np.split(start, first[1:]), strict=bool(len(found))):
        queue.open(rank, positions.tolist())

    while (popped := queue.pop()) is not None:
        rank, positions = popped
        ordered = rank in vocabulary.reentrant
        if ordered:
            # Only so many of the leftmost, as each that is not merged goes back.
            rest = positions
            wide = min(len(rest), window.get(rank, WIDEST))
            if wide == len(rest):
                rest = []
            else:
                positions = [heapq.heappop(rest) for _ in range(wide)]
        left = np.sort(np.array(positions, np.int64))
        left = left[ranks[left] == rank]
        if len(left) > 1:
            left = left[np.concatenate([[True], left[1:] != left[:-1]])]
        if not len(left):
            if ordered and rest:
                queue.open(rank, rest)
            continue
        waiting = left
        # Of pairs that share a token, as in a run of one letter, the leftmost goes first.
        shared = np.concatenate([[False], following[left[:-1]] == left[1:]])
        if shared.any():
            index = np.arange(len(left))
            run = np.maximum.accumulate(np.where(shared, 0, index))
            left = left[(index - run) % 2 == 0]
        if ordered:
            left = left[_until_lower(vocabulary, rank, left, ids, following, preceding, barriers)]
        right = following[left]
        after = following[right]
        ids[left] = rank
        ids[right] = DEAD
        ranks[right] = -1
        following[left] = after
        preceding[after] = left
        before = preceding[left]
        ranks[left] = vocabulary.pair_ranks(ids[left], ids[after])
        ranks[before] = vocabulary.pair_ranks(ids[before], ids[left])
        if ordered:
            back = waiting[ranks[waiting] == rank].tolist()
            window[rank] = max(2 * wide if 2 * len(back) < wide else wide // 2, LEAST_WINDOW)
            for p in back:
                heapq.heappush(rest, p)
            if rest:
                queue.open(rank, rest)
        changed = np.concatenate([left, before])
        new = ranks[changed]
        useful = new >= 0
        for r, p in zip(new[useful].tolist(), changed[useful].tolist(), strict=True):
            queue.push(r, p)

    alive = np.flatnonzero(ids >= 0)
    counts = np.diff(np.searchsorted(alive, barriers))
    return ids[alive], counts


class Encoder:
    """Texts to ids, remembering pre-tokens between blocks."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary = vocabulary
        self.split = regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}

    def _learn(self, pieces: Iterable[str]) -> None:
        new = [p for p in pieces if p not in self.known]
        if len(self.known) + len(new) > REMEMBERED:
            self.known = {}
            new = list(pieces)
        merge = []
        for piece in new:
            raw = piece.encode("utf-8", "surrogatepass")
            rank = self.vocabulary.ranks.get(raw)
            if rank is None:
                merge.append((piece, raw))
            else:
                self.known[piece] = np.uint32(rank).tobytes()
        if merge:
            ids, counts = merge_block(self.vocabulary, [raw for _, raw in merge])
            flat, end = ids.astype(np.uint32).tobytes(), 0
            for (piece, _), count in zip(merge, counts.tolist(), strict=True):
                self.known[piece] = flat[end : end + 4 * count]
                end += 4 * count

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        split = [self.split(text) for text in texts]
        self._learn(set().union(*split))
        known = self.known
        return [b"".join([known[p] for p in pieces]) for pieces in split]


def _blocks(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``BLOCK_CHARS`` characters, or of one long row."""
    begin = size = 0
    for row, text in enumerate(texts):
        if size and size + len(text) > BLOCK_CHARS:
            yield begin, row
            begin, size = row, 0
        size += len(text)
    if begin < len(texts):
        yield begin, len(texts)


def _decoded(vocabulary: Vocabulary, lists: pa.ListArray) -> pa.Array:
    """Bytes of each row's ids: one decode for all rows, cut at the rows' byte offsets."""
    offsets = lists.offsets.to_numpy()
    ids = lists.values.to_numpy()[offsets[0] : offsets[-1]]
    ends = np.concatenate([[0], np.cumsum(vocabulary.lengths[ids])])
    cuts = ends[offsets - offsets[0]].astype(np.int64)
    buffers = [None, pa.py_buffer(cuts.tobytes()), pa.py_buffer(vocabulary.decode(ids))]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lists), buffers).cast(
        pa.binary()
    )


def encode(documents: DataFrame, path: str, pattern: str, back: bool = False) -> DataFrame:
    """``doc_id`` and ``ids array<int>`` of every whole text.

    ``path`` is a rank file that each executor can open, ``pattern`` splits a text
    into pre-tokens that are merged separately. No special tokens are known. With
    ``back`` the ids are decoded again in the same task, as column ``decoded``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = load(path)
        encoder = Encoder(vocabulary, pattern)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for begin, end in _blocks(texts):
                rows = encoder.encode(texts[begin:end])
                ends = np.cumsum([0, *(len(r) // 4 for r in rows)]).astype(np.int32)
                values = pa.array(np.frombuffer(b"".join(rows), np.int32))
                lists = pa.ListArray.from_arrays(pa.array(ends), values)
                columns = {"doc_id": batch.column(0).slice(begin, end - begin), "ids": lists}
                if back:
                    columns["decoded"] = _decoded(vocabulary, lists)
                yield pa.RecordBatch.from_pydict(columns)

    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(
        run, f"doc_id {kind}, ids array<int>" + ", decoded binary" * back
    )


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``ids`` and ``decoded``, the bytes of the ids; NULL ids give none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = load(path)
        for batch in batches:
            columns = {"doc_id": batch.column(0), "ids": batch.column(1)}
            yield pa.RecordBatch.from_pydict(
                columns | {"decoded": _decoded(vocabulary, batch.column(1))}
            )

    ids = F.coalesce("ids", F.array().cast("array<int>")).alias("ids")
    rows = encoded.select("doc_id", ids)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded binary")


def digests(decoded: DataFrame) -> DataFrame:
    """Count of ids, SHA-256 of the decimal ids joined by commas and of the decoded bytes."""
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
