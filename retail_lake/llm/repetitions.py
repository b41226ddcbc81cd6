"""Maximal periodic runs of words, found by catching squares while words are appended.

A square is a stretch of words written twice. For each power of two ``size`` a catcher
stands over the last completed block of ``size`` words. A square of period ``p`` with
``2 * size <= p < 4 * size`` has that block in its second half, so the block also stands
``p`` words earlier: when a block is completed, its earlier places in that distance are
looked up, and each is extended backwards by comparing suffixes. That tells how many more
words must repeat until the square is whole. Each appended word then advances the
comparison of the catcher's next candidate. A new square opens a run, which grows as long as
appended words repeat; squares of a period that an open run has belong to that run. A text
of n words takes O(n log n) lookups, however it repeats.

Catching is spared where it cannot give anything: a run of 12 words or more repeats a
window of 6 words, and every word of it is covered by such windows. Words outside of
repeated windows (compared by hash, so a stretch may be too long, but never too short) are
in no run, and each stretch of covered words is searched by itself.

Results, by case: a NULL or empty text has no words and no runs; repeated rows are judged
like any other row; of runs of equal length the one with the smallest start, then period,
is the longest; an empty table gives an empty result; other columns are ignored. A text is
held whole by one task, with some 150 bytes for each word.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A run has so many words at least, and two periods.
SHORTEST = 12
#: Words of a window that repeats in every run of ``SHORTEST`` words.
WINDOW = 6
#: Bytes of text in an Arrow batch of results, unless one text is longer.
BATCH_BYTES = 8 << 20

Run = tuple[int, int, int]  #: start, length, period


def _encoded(words: Sequence[int]) -> tuple[bytes, int]:
    """Words as bytes of equal width, each behind a mark, so that ``bytes.find`` finds a
    sequence of words only where words begin."""
    ids = np.unique(np.asarray(words, np.int64), return_inverse=True)[1]
    digits, most = 1, 255
    while most < len(ids):
        digits, most = digits + 1, most * 255
    out = np.full((len(ids), digits + 1), 255, np.uint8)
    for place in range(digits, 0, -1):
        out[:, place] = ids % 255
        ids = ids // 255
    return out.tobytes(), digits + 1


class Catcher:
    """Squares with their second half over one completed block, of ``2 * size`` to
    ``4 * size - 1`` words a period.

    ``pending`` holds (words still needed after the block, period), the next due last;
    ``matched`` words after the block are known to repeat at the next one's period.
    """

    __slots__ = ("border", "matched", "pending")

    def __init__(self, border: int, pending: list[tuple[int, int]]):
        self.border, self.pending, self.matched = border, pending, 0

    def advance(self, text: SquareText, end: int) -> Iterator[int]:
        """Periods of the squares that the word before ``end`` completes."""
        seen = end - self.border
        while self.pending:
            needed, period = self.pending[-1]
            at = self.border + self.matched
            if needed < seen or not text.same(at, at - period, end - at):
                self.pending.pop()
                self.matched = 0
                continue
            if needed > seen:
                self.matched = seen
                return
            self.pending.pop()
            self.matched = 0
            yield period


class SquareText:
    """A growing text of words, with its open runs and its catchers.

    The words come at once, but ``append`` looks at none beyond the one it appends.
    """

    def __init__(self, words: Sequence[int]):
        self.words = words
        self.data, self.width = _encoded(words)
        self.end = 0
        self.open: list[list[int]] = []  # [period, start] of runs that reach the end
        self.catchers: dict[int, Catcher] = {}

    def same(self, a: int, b: int, size: int) -> bool:
        """Whether ``size`` words at ``a`` and at ``b`` are equal."""
        width, data = self.width, self.data
        return data[a * width : (a + size) * width] == data[b * width : (b + size) * width]

    def _back(self, a: int, b: int, most: int) -> int:
        """How many words before ``a`` and ``b`` are equal, ``most`` at most."""
        found, step = 0, 1
        while found < most:
            step = min(step, most - found)
            if self.same(a - found - step, b - found - step, step):
                found, step = found + step, step * 2
            elif step == 1:
                break
            else:
                step //= 2
                most = min(most, found + 2 * step)
        return found

    def _catcher(self, size: int) -> Catcher:
        """The catcher of the block of ``size`` words that ends now."""
        end, width, data = self.end, self.width, self.data
        block = end - size
        low, high = max(0, block - 4 * size + 1), block - 2 * size
        # In a run that the block lies in with a whole period, it stands at multiples of the
        # period, and such squares repeat shorter ones.
        for period, start in self.open:
            if period <= size and start <= block:
                high = min(high, start - 1)
        pending = []
        if high >= low:
            needle = data[block * width : end * width]
            at, stop = low * width, (high + size) * width
            while (at := data.find(needle, at, stop)) >= 0:
                period = block - at // width
                before = self._back(block, block - period, min(period - size, block - period))
                needed = period - size - before
                if needed < size:
                    pending.append((needed, period))
                at += width
        pending.sort(key=lambda c: (-c[0], -c[1]))
        return Catcher(end, pending)

    def append(self) -> Iterator[Run]:
        """Take the next word; gives the runs that end before it."""
        words, last = self.words, self.end
        self.end = end = last + 1
        word, still = words[last], []
        for run in self.open:
            if word == words[last - run[0]]:
                still.append(run)
            else:
                yield run[1], last - run[1], run[0]
        self.open = still
        if last and word == words[last - 1]:
            self._square(1)
        size = 1
        while size * 3 <= end:
            if end % size == 0:
                catcher = self._catcher(size)
                if catcher.pending:
                    self.catchers[size] = catcher
                else:
                    self.catchers.pop(size, None)
            catcher = self.catchers.get(size)
            if catcher is not None:
                for period in catcher.advance(self, end):
                    self._square(period)
            size *= 2

    def _square(self, period: int) -> None:
        """A square of ``period`` ends now: it opens a run, unless an open run has it or it
        repeats a shorter square."""
        start = self.end - 2 * period
        for other, begin in self.open:
            if begin <= start and period % other == 0:
                return
        self.open.append([period, start])

    def finish(self) -> Iterator[Run]:
        for period, start in self.open:
            yield start, self.end - start, period
        self.open = []


def runs_of(words: Sequence[int], shortest: int = SHORTEST) -> list[Run]:
    """Runs of ``shortest`` words or more in a whole text, by start and period."""
    text, found = SquareText(words), []
    for _ in range(len(words)):
        found.extend(text.append())
    found.extend(text.finish())
    return sorted((s, n, p) for s, n, p in found if n >= max(shortest, 2 * p))


def covered(ids: np.ndarray, window: int = WINDOW) -> list[tuple[int, int]]:
    """Stretches of words that lie in windows whose hash repeats."""
    n = len(ids) - window + 1
    if n < 2:
        return []
    hashes = np.zeros(n, np.uint64)
    values = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    values ^= values >> np.uint64(29)
    for k in range(window):
        hashes = hashes * np.uint64(0xD6E8FEB86659FD93) + values[k : k + n]
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    alike = ranked[1:] == ranked[:-1]
    if not alike.any():
        return []
    starts = np.zeros(n, bool)
    starts[order[1:][alike]] = True
    starts[order[:-1][alike]] = True
    # The number of repeated windows over each word.
    edges = np.zeros(len(ids) + 1, np.int64)
    edges[:n] += starts
    edges[window : window + n] -= starts
    inside = np.concatenate([[False], np.cumsum(edges[:-1]) > 0, [False]])
    change = np.flatnonzero(inside[1:] != inside[:-1])
    return list(zip(change[::2].tolist(), change[1::2].tolist(), strict=True))


def find_runs(words: Sequence[bytes], shortest: int = SHORTEST) -> list[Run]:
    """``runs_of`` the words of a text, searching only where windows repeat."""
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    if len(number) == len(words):
        return []
    # A run of ``shortest`` words repeats half of them.
    window = max(1, min(WINDOW, shortest // 2))
    found = []
    for begin, end in covered(ids, window):
        if end - begin >= shortest:
            part = runs_of(ids[begin:end].tolist(), shortest)
            found += [(begin + start, length, period) for start, length, period in part]
    return found


def collapse(words: list[bytes], runs: list[Run]) -> bytes:
    """The words joined by one space, without those after the first period of a run."""
    if not runs:
        return b" ".join(words)
    kept, at = [], 0
    for begin, end in sorted((start + period, start + length) for start, length, period in runs):
        if begin > at:
            kept += words[at:begin]
        at = max(at, end)
    return b" ".join(kept + words[at:])


Edit = Callable[[object, list[bytes]], list[bytes]]


def collapse_runs(
    documents: DataFrame, shortest: int = SHORTEST, edit: Edit | None = None
) -> DataFrame:
    """``doc_id``, ``runs`` (array of ``start``, ``length``, ``period`` in words, by start and
    period) and ``collapsed``, the text without what repeats in its runs.

    Words are what white space of ASCII parts. ``edit(doc_id, words)`` may change the words
    of a document before they are searched.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("start", "length", "period")
        schema = pa.schema(
            [
                ("runs", pa.list_(pa.struct([(n, pa.int64()) for n in names]))),
                ("collapsed", pa.binary()),
            ]
        )
        for batch in batches:
            ids, texts = batch.columns
            begin, size, rows = 0, 0, []
            for number in range(batch.num_rows):
                words = texts[number].as_py().split()
                if edit is not None:
                    words = edit(ids[number].as_py(), words)
                runs = find_runs(words, shortest)
                row = [dict(zip(names, r, strict=True)) for r in runs]
                rows.append({"runs": row, "collapsed": collapse(words, runs)})
                size += len(rows[-1]["collapsed"]) + 100 * len(runs)
                if size >= BATCH_BYTES or number + 1 == batch.num_rows:
                    made = pa.RecordBatch.from_pylist(rows, schema=schema)
                    yield pa.RecordBatch.from_arrays(
                        [ids.slice(begin, len(rows)), *made.columns], ["doc_id", *made.schema.names]
                    )
                    begin, size, rows = number + 1, 0, []

    text = F.coalesce("text", F.lit("")).cast("binary").alias("text")
    rows = documents.select("doc_id", text)
    kind = rows.schema["doc_id"].dataType.simpleString()
    made = rows.mapInArrow(
        run,
        f"doc_id {kind}, runs array<struct<start: long, length: long, period: long>>, "
        "collapsed binary",
    )
    return made.withColumn("collapsed", F.col("collapsed").cast("string"))


def planted(doc_id: object, words: list[bytes]) -> list[bytes]:
    """Words with a run at the end, in one document of ten, by the CRC-32 of its id. A NULL
    id plants nothing."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a : a + p]
    times = -(-(n - a) // p)
    return words[:a] + (unit * times)[: n - a]


def digests(collapsed: DataFrame) -> DataFrame:
    """The number of runs, the longest one, and SHA-256 of all runs and of the collapsed text."""
    best = F.array_max(
        F.transform(
            "runs",
            lambda r: F.struct(
                r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")
            ),
        )
    )
    lines = F.transform(
        "runs", lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")])
    )
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    rows = collapsed.withColumn("best", best)
    length, period = F.col("best.length"), -F.col("best.period")
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
