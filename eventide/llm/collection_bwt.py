"""Burrows-Wheeler transform and common prefixes of a collection, built column by column.

Every round inserts one symbol of each text, from the last to the first, as in external construction for large
collections of short texts. After round j the rows are the sorted suffixes of at most j symbols; the symbol put before
a suffix tells, by its rank among equal symbols, where the suffix one longer belongs. Rows are sequential arrays, read and
rewritten front to back in each round. Once all symbols are in, the ranks lead from each text's empty suffix to its longer
ones, which gives a row's text and length, and neighbouring rows are compared eight symbols at a time.
"""

from __future__ import annotations

import numpy as np

#: Neighbouring rows compared in one go.
BLOCK = 1 << 18


def build(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bwt, lcp, owner, length) per row: symbol before the suffix plus one (0: none), common prefix with the row before
    (no more than 254), the text that the suffix is of, and its length. Texts are of at most 254 bytes.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    data = b"".join(texts)
    flat, ends = np.frombuffer(data, np.uint8), np.cumsum(sizes)
    used = np.bincount(flat, minlength=256) > 0
    kind = np.uint8 if used.sum() < 256 else np.uint16
    code = np.cumsum(used).astype(kind)  # symbols in order, so that with none they fit a byte
    bwt = np.zeros(len(texts), kind)
    live = np.flatnonzero(sizes > 0)
    place = live.copy()  # row of each live text's longest suffix so far, in ascending order
    for column in range(1, int(sizes.max(initial=0)) + 1):
        symbol = code[flat[ends[live] - column]]
        bwt[place] = symbol
        longest = np.zeros(len(bwt), bool)
        longest[place] = True
        # ranks among all rows; those of texts that are done have no symbol and come first
        new = np.flatnonzero(longest[np.argsort(bwt, kind="stable")]) + len(live)
        live = live[np.argsort(symbol, kind="stable")]
        old = np.ones(len(bwt) + len(new), bool)
        old[new] = False
        merged = np.zeros(len(old), kind)
        merged[old] = bwt
        bwt = merged
        stay = sizes[live] > column
        live, place = live[stay], new[stay]
    owner, length = _suffixes(bwt, sizes)
    symbols = np.append(0, np.flatnonzero(used) + 1).astype(np.uint16)
    return symbols[bwt], _common(data, ends[owner] - length, length), owner, length


def _suffixes(bwt: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text and length of each row's suffix."""
    owner, length = np.empty(len(bwt), np.int32), np.zeros(len(bwt), np.uint8)
    rank = np.empty(len(bwt), np.int32)
    rank[np.argsort(bwt, kind="stable")] = np.arange(len(bwt), dtype=np.int32)
    live = place = np.arange(len(sizes), dtype=np.int32)
    owner[live] = live
    for column in range(1, int(sizes.max(initial=0)) + 1):
        stay = sizes[live] >= column
        live, place = live[stay], rank[place[stay]]
        owner[place], length[place] = live, column
    return owner, length


def _common(data: bytes, starts: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Common prefix of each row's suffix and the one before."""
    words = np.ndarray(len(data) + 1, "<u8", data + bytes(8), strides=(1,))
    out = np.zeros(len(starts), np.uint8)
    for first in range(1, len(starts), BLOCK):
        rows = np.arange(first, min(first + BLOCK, len(starts)))
        most, at = np.minimum(length[rows], length[rows - 1]), 0
        one, other = starts[rows - 1], starts[rows]
        while len(rows):
            differ = words[one + at] ^ words[other + at]
            equal = np.bitwise_count((differ & -differ) - np.uint64(1)) >> 3
            out[rows] = np.minimum(at + equal, most)
            at += 8
            on = np.flatnonzero((differ == 0) & (most > at))
            rows, most, one, other = rows[on], most[on], one[on], other[on]
    return out
