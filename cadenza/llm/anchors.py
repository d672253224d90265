"""Where long windows may repeat: anchors that equal windows choose alike.

A text is a row of units (bytes, or hashes of words).  Every window of ``size`` units
chooses the least-hashed run of ``run`` units in it as its anchor, so equal windows
choose equal anchors at equal places.  Only windows whose anchor's hash occurs at two
places can repeat, and only the surroundings of such anchors are sent to other tasks:
about two anchors for each ``size - run`` units, fewer than one in ten of them kept in
texts that do not repeat.
"""

from __future__ import annotations

import numpy as np

from cadenza.llm.columns import Words, keys, mixed, windows

#: An odd base of the polynomial hashes, and its inverse, modulo 2^64.
BASE = int(keys(1, 11)[0])
INVERSE = pow(BASE, -1, 1 << 64)

_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.ones(max(n, 1024), np.uint64)
        have[1:] = base
        have = np.multiply.accumulate(have)
        _POWERS[base] = have
    return have[:n]


def byte_runs(data: np.ndarray, run: int) -> np.ndarray:
    """Hashes of all runs of bytes, from differences of prefix polynomial hashes."""
    n = len(data)
    if n < run:
        return np.zeros(0, np.uint64)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, n), out=prefix[1:])
    return mixed((prefix[run:] - prefix[:-run]) * powers(INVERSE, n - run + 1))


def least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values: from the least of blocks' beginnings
    and ends."""
    n = len(values)
    if n < width:
        return values[:0]
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[:n] = values
    square = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(square, axis=1).ravel()
    back = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


#: Low bits that hold a place; the rest holds the hash.
PLACE = 24


def chosen(hashes: np.ndarray, row_of_unit: np.ndarray, size: int, run: int) -> tuple[np.ndarray, np.ndarray]:
    """Per window that lies in one row: its first unit, and its anchor's first unit.

    ``row_of_unit`` names each unit's row, ascending.
    """
    width, n = size - run + 1, len(row_of_unit)
    if n < size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    found, starts = [], []
    step = 1 << (PLACE - 1)
    low = np.uint64((1 << PLACE) - 1)
    for first in range(0, n - size + 1, step):
        part = hashes[first : first + step + width - 1]
        packed = (part & ~low) | np.arange(len(part), dtype=np.uint64)
        found.append((least(packed, width) & low).astype(np.int64) + first)
        starts.append(np.arange(len(found[-1])) + first)
    start, anchor = np.concatenate(starts), np.concatenate(found)
    whole = row_of_unit[start] == row_of_unit[start + size - 1]
    return start[whole], anchor[whole]


class Bytes:
    """Rows of a block as bytes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, size: int, run: int):
        self.data, self.offsets = data, offsets
        self.row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        self.hashes = byte_runs(data, run)
        self.windows, self.anchor_of = chosen(self.hashes, self.row, size, run)
        self.first = offsets
        self.size = size

    def window_hashes(self, at: np.ndarray) -> np.ndarray:
        return byte_runs(self.data, self.size)[at]

    def slice(self, low: int, high: int) -> bytes:
        return self.data[low:high].tobytes()


class WordUnits:
    """Rows of a block as words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, size: int, run: int):
        self.words = Words(data, offsets)
        self.row = self.words.row
        self.unit_hashes = self.words.hashes()
        self.hashes = windows(self.unit_hashes, run)
        self.windows, self.anchor_of = chosen(self.hashes, self.row, size, run)
        self.first = self.words.first_word
        self.size = size

    def window_hashes(self, at: np.ndarray) -> np.ndarray:
        return windows(self.unit_hashes, self.size)[at]

    def slice(self, low: int, high: int) -> bytes:
        w = self.words
        return w.data[w.start[low] : w.end[high - 1]].tobytes() if high > low else b""


def anchors(units) -> np.ndarray:
    """First units of all anchors, ascending."""
    return np.unique(units.anchor_of)
