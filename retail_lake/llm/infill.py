"""Fill-in-the-middle forms of documents, by rotations of blocks in place.

A text is cut twice into prefix, middle and suffix. The cuts are found by a scan of its
UTF-8 bytes, the sentinels go into a ``bytearray`` at the cuts, and the blocks change
places by rotations of three reversals each; a reversal moves bytes through a buffer of
fixed size. The inverse rotation gives the text back exactly, from the output and its form
alone. Cuts and forms come from a hash of ``doc_id``, so nothing depends on the order or
the partitioning of the rows.

Results, by case: a NULL or empty text stays plain and empty; a text that holds a sentinel
stays plain; a cut may leave any part empty; a text that is no valid UTF-8 is cut between
its bytes that begin a character, and comes back byte for byte; a NULL ``doc_id`` is hashed
as an empty id; repeated rows get the same form; an empty table gives an empty result;
other columns are ignored. A text of any length is held once, with its sentinels.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes that a reversal or a scan handles at a time.
BUFFER = 1 << 16
#: Bytes of text in an Arrow batch of results, unless one text is longer.
BATCH_BYTES = 8 << 20


@dataclass(frozen=True)
class Rules:
    """How texts are cut. Percentages are of documents, ``spm_percent`` of those not plain."""

    seed: str = "1"
    plain_percent: int = 10
    spm_percent: int = 20
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self):
        marks = self.sentinels
        if not all(marks) or len(set(marks)) < 3:
            raise ValueError("three different sentinels are needed")
        for a in marks:
            for b in marks:
                inside = a != b and a in b
                if inside or any(a.endswith(b[:n]) for n in range(1, min(len(a), len(b)))):
                    raise ValueError(f"{a!r} and {b!r} may overlap in a text")

    @property
    def sentinels(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


def _reverse(data: np.ndarray, begin: int, end: int) -> None:
    """Reverse ``data[begin:end]``, swapping at most ``BUFFER`` bytes from both ends at a time."""
    while end - begin > 1:
        size = min(BUFFER, (end - begin) // 2)
        head = data[begin : begin + size].copy()
        data[begin : begin + size] = data[end - size : end][::-1]
        data[end - size : end] = head[::-1]
        begin, end = begin + size, end - size


def rotate(data: bytearray, begin: int, middle: int, end: int) -> None:
    """Exchange ``data[begin:middle]`` and ``data[middle:end]`` in place: each block is
    reversed, then both together."""
    view = np.frombuffer(data, np.uint8)
    _reverse(view, begin, middle)
    _reverse(view, middle, end)
    _reverse(view, begin, end)


def cut_offsets(text: bytes, cuts: tuple[int, ...]) -> list[int]:
    """Byte offsets of ascending code point numbers; one past the last is the end."""
    view, found, seen = np.frombuffer(text, np.uint8), [], 0
    for begin in range(0, len(text), BUFFER):
        if len(found) == len(cuts):
            break
        heads = np.flatnonzero((view[begin : begin + BUFFER] & 0xC0) != 0x80)
        while len(found) < len(cuts) and cuts[len(found)] < seen + len(heads):
            found.append(begin + int(heads[cuts[len(found)] - seen]))
        seen += len(heads)
    return found + [len(text)] * (len(cuts) - len(found))


def arrange(text: bytes, form: str, first: int, second: int, rules: Rules) -> bytes:
    """The text in its form, cut before the code points ``first`` and ``second``."""
    if form == "plain":
        return text
    prefix, suffix, middle = (mark.encode() for mark in rules.sentinels)
    a, b = cut_offsets(text, (first, second))
    data = bytearray(text)
    data[b:b] = suffix
    data[a:a] = middle
    data[0:0] = prefix
    # prefix | middle | suffix, each behind its sentinel
    a += len(prefix)
    b += len(prefix) + len(middle)
    if form == "psm":
        rotate(data, a, b, len(data))
    else:
        rotate(data, 0, b, len(data))
    return bytes(data)


def restore(output: bytes, form: str, rules: Rules) -> bytes:
    """The text of an output: rotate back, then take the sentinels out."""
    if form == "plain":
        return output
    prefix, suffix, middle = (mark.encode() for mark in rules.sentinels)
    data = bytearray(output)
    p, s, m = data.find(prefix), data.find(suffix), data.find(middle)
    if min(p, s, m) < 0 or (not p == 0 < s < m if form == "psm" else not s == 0 < p < m):
        raise ValueError(f"not an output of form {form}")
    if form == "psm":
        rotate(data, s, m, len(data))
        a, b = s, s + len(data) - m
    else:
        rotate(data, 0, p, len(data))
        a, b = m - p, len(data) - p
    del data[b : b + len(suffix)]
    del data[a : a + len(middle)]
    del data[: len(prefix)]
    return bytes(data)


def _group(digest: Column, number: int) -> Column:
    """The ``number``-th 8 hex digits as a whole number."""
    return F.conv(F.substring(digest, 8 * number + 1, 8), 16, 10).cast("long")


def plan(documents: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """``doc_id``, ``text``, ``n`` code points, ``form`` and the two cuts (NULL if plain)."""
    text = F.coalesce("text", F.lit(""))
    seeded = F.concat(F.lit(f"{rules.seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    rows = documents.select(
        "doc_id", text.alias("text"), F.length(text).cast("long").alias("n"), F.sha2(seeded, 256).alias("digest")
    )
    h1, h2, h3, h4 = (_group(F.col("digest"), i) for i in range(4))
    one, two = h1 % (F.col("n") + 1), h2 % (F.col("n") + 1)
    held = F.lit(False)
    for mark in rules.sentinels:
        held = held | F.contains("text", F.lit(mark))
    plain = (F.col("n") == 0) | held | (h3 % 100 >= 100 - rules.plain_percent)
    form = F.when(plain, "plain").when(h4 % 100 < rules.spm_percent, "spm").otherwise("psm")
    return rows.select(
        "doc_id",
        "text",
        "n",
        form.alias("form"),
        F.when(~plain, F.least(one, two)).alias("first"),
        F.when(~plain, F.greatest(one, two)).alias("second"),
    )


def _mapped(rows: DataFrame, compute, column: str) -> DataFrame:
    """``rows`` (the text or output first) with a binary ``column`` of ``compute(values)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin = size = 0
            made = []
            for number in range(batch.num_rows):
                made.append(compute(*(c[number].as_py() for c in batch.columns[1:])))
                size += len(made[-1])
                if size >= BATCH_BYTES or number + 1 == batch.num_rows:
                    part = batch.slice(begin, len(made))
                    arrays = [*part.columns, pa.array(made, pa.binary())]
                    yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names, column])
                    begin, size, made = number + 1, 0, []

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{fields}, {column} binary")


def transform(documents: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """``doc_id``, ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    ``output`` is the text itself (``plain``), ``<P>prefix<S>suffix<M>middle`` (``psm``) or
    ``<S>suffix<P>prefix<M>middle`` (``spm``) with the sentinels of ``rules``.
    """
    planned = plan(documents, rules).select(
        "doc_id", F.col("text").cast("binary").alias("text"), "form", "first", "second", "n"
    )
    made = _mapped(planned, lambda text, form, a, b, n: arrange(text, form, a, b, rules), "output")
    return made.select(
        "doc_id",
        "n",
        "form",
        F.col("first").alias("prefix_chars"),
        (F.col("second") - F.col("first")).alias("middle_chars"),
        F.col("output").cast("string").alias("output"),
    )


def restored(transformed: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """``transformed`` with ``restored``, the text rebuilt from ``output`` and ``form``."""
    kept = [c for c in transformed.columns if c not in ("output", "form")]
    rows = transformed.select(
        F.struct(*kept).alias("row"), F.col("output").cast("binary").alias("output"), "form"
    )
    made = _mapped(rows, lambda output, form: restore(output, form, rules), "restored")
    return made.select(
        *[F.col("row")[c].alias(c) for c in kept],
        "form",
        F.col("output").cast("string").alias("output"),
        F.col("restored").cast("string").alias("restored"),
    )


def digests(rebuilt: DataFrame) -> DataFrame:
    """Form and lengths of each document, with SHA-256 of its output and restored text."""
    return rebuilt.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"),
    )
