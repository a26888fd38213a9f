"""Vectorised views of Arrow text columns: bytes, words and their hashes, a bounded slice at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at once (one longer document is taken alone).
SLICE = 1 << 17

_M = 0x9E3779B97F4A7C15 | 1
_INV = pow(_M, -1, 1 << 64)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the row offsets in them; nulls are empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf, off


def slices(off: np.ndarray, limit: int = SLICE) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or of one row."""
    row, n = 0, len(off) - 1
    while row < n:
        end = int(np.searchsorted(off, off[row] + limit, "right")) - 1
        end = min(max(end, row + 1), n)
        yield row, end
        row = end


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64 bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


class Hasher:
    """64-bit hashes of many spans of one buffer, from running polynomial sums."""

    def __init__(self) -> None:
        self.up, self.down = powers(1, _M), powers(1, _INV)

    def spans(self, text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        n = len(text) + 1
        if len(self.up) < n:
            self.up, self.down = powers(n, _M), powers(n, _INV)
        total = np.zeros(n, np.uint64)
        np.cumsum((text.astype(np.uint64) + np.uint64(1)) * self.up[: n - 1], out=total[1:])
        return mix((total[ends] - total[starts]) * self.down[starts])


#: Bytes with A-Z lowered.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of words [^\x00-\x2F\x3A-\x60\x7B-\x7F] of lowered text.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
#: Bytes of words [^\x20\x09-\x0D].
GRAPH = np.ones(256, bool)
GRAPH[[0x20, 9, 10, 11, 12, 13]] = False


def word_spans(text: np.ndarray, off: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words in ``text`` and the row each is in.  No word crosses a row's end in ``off``."""
    n = len(text)
    inside = np.zeros(n + 2, np.int8)
    inside[1:-1] = keep[text]
    cut = off[1:-1]
    cut = cut[(cut > 0) & (cut < n)]
    starts = np.flatnonzero((inside[1:-1] == 1) & (inside[:-2] == 0))
    ends = np.flatnonzero((inside[1:-1] == 1) & (inside[2:] == 0)) + 1
    if len(cut):
        split = cut[(inside[cut + 1] == 1) & (inside[cut] == 1)]  # a word runs over a row's end
        if len(split):
            # none of them is a start or an end yet
            split = np.unique(split)
            starts = np.sort(np.concatenate((starts, split)), kind="stable")
            ends = np.sort(np.concatenate((ends, split)), kind="stable")
    rows = np.searchsorted(off, starts, "right") - 1
    return starts, ends, rows


#: Kinds of bytes: 0 white space, 1 letters, digits and all beyond ASCII, 2 other signs.
KINDS = np.where(GRAPH, np.where(ALNUM, 1, 2), 0).astype(np.int8)
KINDS[0x41:0x5B] = 1


def kind_spans(text: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the maximal runs of one kind but white space.  None crosses a row's end in ``off``."""
    n = len(text)
    kind = KINDS[text]
    edge = np.ones(n + 1, bool)
    edge[1:n] = kind[1:] != kind[:-1]
    edge[off[(off >= 0) & (off <= n)]] = True
    at = np.flatnonzero(edge)
    starts, ends = at[:-1], at[1:]
    told = kind[starts] > 0 if n else np.zeros(0, bool)
    starts, ends = starts[told], ends[told]
    return starts, ends, np.searchsorted(off, starts, "right") - 1
