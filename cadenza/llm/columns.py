"""Arrow text columns as flat byte arrays, words in them, and 64-bit hashes.

Texts are UTF-8.  All functions work on whole batches, so that Python code runs per
batch and not per word.  Hashes do not depend on the process, the machine or the
batch, and may be compared across tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: The separators of `[^\x20\x09-\x0D]+`.
WHITE = bytes([9, 10, 11, 12, 13, 32])
#: Bytes of text worked on at once; a longer text is a block of its own.
BLOCK_BYTES = 1 << 21

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def fresh(name: str, taken: list[str]) -> str:
    """``name``, or ``name`` with underscores before it that make it new."""
    lower = {t.lower() for t in taken}
    while name.lower() in lower:
        name = "_" + name
    return name


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit words (the finalizer known as splitmix64)."""
    x = x + _GOLDEN
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def keys(n: int, seed: int) -> np.ndarray:
    """``n`` odd 64-bit multipliers."""
    return mixed(np.arange(n, dtype=np.uint64) + np.uint64(seed << 32)) | np.uint64(1)


def byte_column(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and the offsets of its rows; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]] if len(offsets) else data, offsets - offsets[0]


def blocks(offsets: np.ndarray, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``most`` bytes together, or of one longer row."""
    row, n = 0, len(offsets) - 1
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1
        end = min(max(end, row + 1), n)
        yield row, end
        row = end


class Words:
    """Words of a block of rows: where each begins and ends, whose it is, its hash."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, separators: bytes = WHITE, fold: bool = False):
        self.data = data
        is_word = np.ones(256, bool)
        is_word[list(separators)] = False
        inside = np.zeros(len(data) + 1, bool)
        inside[:-1] = is_word[data]
        first = np.zeros(len(data) + 1, bool)
        first[offsets] = True
        # A word begins at a word byte that is first in its row or follows a separator,
        # and ends where the next byte is none or begins a row.
        before = np.zeros(len(data) + 1, bool)
        before[1:] = inside[:-1]
        self.start = np.flatnonzero(inside & (~before | first))
        self.end = np.flatnonzero(before & (~inside | first))
        #: Words of row r are first_word[r]:first_word[r + 1].
        self.first_word = np.searchsorted(self.start, offsets, "left")
        self.row = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first_word))
        if fold:
            lower = np.arange(256, dtype=np.uint8)
            lower[65:91] += 32
            self.data = lower[data]

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self) -> np.ndarray:
        """One hash per word, from its bytes in eights and its length."""
        length = self.end - self.start
        total = mixed(length.astype(np.uint64))
        if not len(length):
            return total
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        eights = np.ndarray((len(self.data) + 1,), "<u8", padded, strides=(1,))
        alive, place = np.arange(len(length)), 0
        while len(alive):
            left = length[alive] - place
            chunk = eights[self.start[alive] + place] & _MASKS[np.minimum(left, 8)]
            total[alive] += mixed(chunk ^ mixed(np.array([place], np.uint64)))
            place += 8
            alive = alive[left > 8]
        return mixed(total)

    def same_as(self, other: np.ndarray) -> bool:
        """Is every word spelled like the word of the given number?"""
        length = self.end - self.start
        if (length != length[other]).any():
            return False
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        eights = np.ndarray((len(self.data) + 1,), "<u8", padded, strides=(1,))
        alive, place = np.flatnonzero(other != np.arange(len(other))), 0
        while len(alive):
            left = length[alive] - place
            mask = _MASKS[np.minimum(left, 8)]
            if ((eights[self.start[alive] + place] ^ eights[self.start[other[alive]] + place]) & mask).any():
                return False
            place += 8
            alive = alive[left > 8]
        return True


_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def windows(values: np.ndarray, size: int, seed: int = 2) -> np.ndarray:
    """Hashes of every ``size`` consecutive hashes; shorter by ``size - 1``."""
    n = len(values) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i, factor in enumerate(keys(size, seed)):
        total += values[i : i + n] * factor
    return mixed(total)


def minimizers(values: np.ndarray, width: int) -> np.ndarray:
    """Places of the least value (rightmost of equals) of each ``width`` consecutive values, ascending.

    Equal stretches of values choose equal places, wherever they stand.
    """
    n = len(values)
    if n < width or not n:
        return np.zeros(0, np.int64)
    best = values.copy()
    place = np.arange(n, dtype=np.int64)
    have = 1
    while have < width:
        step = min(have, width - have)
        m = len(best) - step
        right = best[step:] <= best[:m]
        place = np.where(right, place[step:], place[:m])
        best = np.where(right, best[step:], best[:m])
        have += step
    keep = np.ones(len(place), bool)
    keep[1:] = place[1:] != place[:-1]
    return place[keep]


def strings(values: list) -> pa.Array:
    return pa.array(values, pa.string())
