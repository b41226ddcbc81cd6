"""Deep-shallow sorting of byte strings.

Multikey quicksort, eight bytes at a time, splits the strings to a shallow depth.
Groups that still share a prefix, which repeated text makes long, are ordered by a
blind trie: it stores only the bit at which its branches part, so a string is compared
with one other string, whatever their common prefix.
"""

from __future__ import annotations

import numpy as np


def blind_trie(strings: list[int]) -> list[list[int]]:
    """Places of equal-length strings (as big-endian numbers) in ascending order,
    equal strings together.

    An inner node is ``[bit, smaller side, larger side]``; a leaf is a list of places
    wrapped in a tuple. Bits fall along every path.
    """
    root = ([0],)
    for place in range(1, len(strings)):
        value = strings[place]
        node = root
        while isinstance(node, list):
            node = node[2] if value >> node[0] & 1 else node[1]
        differing = value ^ strings[node[0][0]]
        if not differing:
            node[0].append(place)
            continue
        bit = differing.bit_length() - 1
        above, node = None, root
        while isinstance(node, list) and node[0] > bit:
            above, node = node, node[2] if value >> node[0] & 1 else node[1]
        leaf = ([place],)
        inner = [bit, node, leaf] if value >> bit & 1 else [bit, leaf, node]
        if above is None:
            root = inner
        else:
            above[2 if value >> above[0] & 1 else 1] = inner
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if isinstance(node, list):
            stack += (node[2], node[1])
        else:
            out.append(node[0])
    return out


def deep_shallow_sort(matrix: np.ndarray, shallow: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows of a byte matrix, and for each place of it where its run of
    equal rows begins. ``shallow`` counts words of eight bytes."""
    n, width = matrix.shape
    order, begin = np.arange(n), np.zeros(n, np.int64)
    active = np.arange(n)
    for depth in range(min(shallow, width // 8)):
        if not len(active):
            break
        rows = order[active]
        word = np.ascontiguousarray(matrix[rows, 8 * depth : 8 * depth + 8]).view(">u8").ravel()
        word = word.astype(np.uint64)
        within = np.lexsort((word, begin[active]))
        order[active], word, group = rows[within], word[within], begin[active]
        fresh = np.concatenate([[True], (group[1:] != group[:-1]) | (word[1:] != word[:-1])])
        starts = np.flatnonzero(fresh)
        sizes = np.diff(np.append(starts, len(active)))
        begin[active] = np.repeat(active[starts], sizes)
        active = active[np.repeat(sizes > 1, sizes)]
    rest = 8 * min(shallow, width // 8)
    if not len(active) or rest >= width:
        return order, begin
    tails = np.ascontiguousarray(matrix[order[active], rest:]).tobytes()
    size = width - rest
    number = int.from_bytes
    group = begin[active]
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])).tolist()
    places: list[int] = []
    runs: list[int] = []
    for first, last in zip(starts, [*starts[1:], len(active)], strict=True):
        values = [number(tails[at : at + size]) for at in range(first * size, last * size, size)]
        if values.count(values[0]) == last - first:
            places += range(first, last)
            runs += [first] * (last - first)
            continue
        for equal in blind_trie(values):
            runs += [len(places)] * len(equal)
            places += [first + place for place in equal]
    begin[active] = active[runs]
    order[active] = order[active[places]]
    return order, begin
