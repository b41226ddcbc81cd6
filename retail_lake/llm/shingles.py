"""Hashed word shingles of a block of texts, by array operations only."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Bytes hashed at a time; a longer text is a block of its own.
BLOCK_BYTES = 2_000_000
# Odd 64-bit constants of the SplitMix and Murmur finalisers.
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)
#: Base of the polynomial that hashes a word, and its inverse modulo 2**64.
_BASE = 0x2545F4914F6CDD1D
_INVERSE = pow(_BASE, -1, 1 << 64)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def multipliers(count: int, seed: int) -> np.ndarray:
    """Odd constants drawn from a seed."""
    at = np.arange(1, count + 1, dtype=np.uint64) + np.uint64(seed << 20)
    return mix(at * _GOLDEN) | np.uint64(1)


def powers_of(base: int, size: int) -> np.ndarray:
    """Powers of an odd base modulo 2**64, remembered for blocks of the usual size."""
    known = _powers.get(base)
    if known is None or len(known) < size:
        known = np.full(max(size, BLOCK_BYTES + 4096), base, np.uint64)
        known[0] = 1
        known = np.multiply.accumulate(known)
        if size <= 2 * BLOCK_BYTES:
            _powers[base] = known
    return known[:size]


def word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of lower-cased bytes, and the byte it starts at."""
    word = ~_SPACE[raw]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], word, [False]]).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    terms = (raw.astype(np.uint64) + np.uint64(1)) * powers_of(_BASE, len(raw))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
    hashes = (sums[ends] - sums[starts]) * powers_of(_INVERSE, len(raw))[starts]
    return mix(hashes ^ (ends - starts).astype(np.uint64)), starts


def shingle_sets(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, and where each text's begin.

    A text of fewer than ``size`` words has them all as one shingle, without words none.
    """
    raw = _LOWER[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
    hashes, starts = word_hashes(raw)
    ends_of = np.cumsum([len(t) + 1 for t in texts])
    first = np.concatenate([[0], np.searchsorted(starts, ends_of)])
    n_words = np.diff(first)
    owner = np.repeat(np.arange(len(texts)), n_words)
    weights = multipliers(size, 1)
    if len(hashes) >= size:
        count = len(hashes) - size + 1
        windows = hashes[:count] * weights[0]
        for k in range(1, size):
            windows += hashes[k : k + count] * weights[k]
        whole = owner[:count] == owner[size - 1 :]
        windows, of = windows[whole], owner[:count][whole]
    else:
        windows, of = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    short = np.flatnonzero((n_words > 0) & (n_words < size))
    own = [
        (hashes[first[t] : first[t + 1]] * weights[: n_words[t]]).sum(dtype=np.uint64)
        + np.uint64(n_words[t])
        for t in short
    ]
    windows = mix(np.concatenate([windows, np.array(own, np.uint64)]))
    of = np.concatenate([of, short])
    order = np.lexsort((windows, of))
    windows, of = windows[order], of[order]
    if len(of):
        fresh = np.concatenate([[True], (windows[1:] != windows[:-1]) | (of[1:] != of[:-1])])
        windows, of = windows[fresh], of[fresh]
    return windows, np.searchsorted(of, np.arange(len(texts) + 1))


def blocks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``BLOCK_BYTES``, or of one long text."""
    begin = size = 0
    for row, text in enumerate(texts):
        if size and size + len(text) > BLOCK_BYTES:
            yield begin, row
            begin, size = row, 0
        size += len(text) + 1
    if begin < len(texts):
        yield begin, len(texts)
