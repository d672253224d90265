"""Substring dedup by a hash-compared suffix sort.

A byte goes if a string of ``SIZE`` bytes over it also starts anywhere else, in the same
document or another.  Anchors bring the surroundings of possible repeats to one task per
anchor hash (`repeats`).  There the suffixes that begin at the anchors are sorted by
mergesort, and the mirrored ones that end before them likewise.  Two suffixes are
compared by their prefix polynomial hashes: binary search finds their common extension
in a logarithmic number of steps, and the next byte decides.  All merges of a level run
at once over arrays.  The common extensions of neighbours are verified byte by byte; if
one was a collision the block is sorted by its bytes.

With both orders, the suffixes that share ``r`` bytes to the right are runs of one
order, and those that share ``SIZE - r`` to the left runs of the other.  A window that
reaches ``r`` bytes to the right repeats if another anchor is in the same two runs; the
farthest such windows to either side bound what goes around an anchor.

Null and empty texts have no bytes.  Whole copies of a text of ``SIZE`` bytes or more go
in all documents that have them.  Repeated rows are copies.  An empty table gives an
empty result.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm import repeats
from cadenza.llm.anchors import BASE, Bytes, powers

SIZE = 400
#: Bytes of an anchor.
RUN = 100
#: Segments worked on at once.
BLOCK = 1_500


#: Prefix hashes are kept for every so many bytes.
STRIDE = 4
#: Rows widened to hashes or comparisons at once.
CHUNK = 500


class Suffixes:
    """Strings of up to ``width`` bytes from a common start, with their prefix hashes."""

    def __init__(self, strings: list[bytes], width: int):
        self.length = np.array([len(s) for s in strings], np.int64)
        self.bytes = np.zeros((len(strings), width), np.uint8)
        for i, s in enumerate(strings):
            self.bytes[i, : len(s)] = np.frombuffer(s, np.uint8)
        self.prefix = np.zeros((len(strings), width // STRIDE + 1), np.uint64)
        for first in range(0, len(strings), CHUNK):
            terms = (self.bytes[first : first + CHUNK].astype(np.uint64) + np.uint64(1)) * powers(BASE, width)
            sums = np.cumsum(terms, axis=1)[:, STRIDE - 1 :: STRIDE]
            self.prefix[first : first + CHUNK, 1 : sums.shape[1] + 1] = sums

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The common extension of each pair: binary search over prefix hashes, and the
        last few bytes one by one."""
        limit = np.minimum(self.length[a], self.length[b])
        low, high = np.zeros(len(a), np.int64), limit // STRIDE
        while (low < high).any():
            middle = (low + high + 1) >> 1
            same = self.prefix[a, middle] == self.prefix[b, middle]
            low = np.where(same, middle, low)
            high = np.where(same, high, middle - 1)
        found = low * STRIDE
        same = np.ones(len(a), bool)
        for _ in range(STRIDE):
            at = np.minimum(found, self.bytes.shape[1] - 1)
            same &= (found < limit) & (self.bytes[a, at] == self.bytes[b, at])
            found += same
        return found

    def verified(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The common extension of each pair, byte by byte."""
        out = np.empty(len(a), np.int64)
        for first in range(0, len(a), CHUNK):
            x, y = a[first : first + CHUNK], b[first : first + CHUNK]
            differ = self.bytes[x] != self.bytes[y]
            out[first : first + CHUNK] = np.where(differ.any(axis=1), differ.argmax(axis=1), differ.shape[1])
        return np.minimum(out, np.minimum(self.length[a], self.length[b]))

    def before(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether a < b, and whether a <= b."""
        n = self.common(a, b)
        width = self.bytes.shape[1]
        at = np.minimum(n, width - 1)
        x = np.where(n < self.length[a], self.bytes[a, at].astype(np.int64), -1)
        y = np.where(n < self.length[b], self.bytes[b, at].astype(np.int64), -1)
        return x < y, x <= y

    def order(self, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Suffixes sorted inside each group (``begin``, ``size`` of every suffix's group):
        a stable mergesort from below, a level of all groups at a time."""
        n = len(self.length)
        order = np.arange(n)
        local = np.arange(n) - begin
        width = 1
        while width < (int(size.max()) if n else 0):
            run = local // width
            own = begin + run * width
            twin = begin + (run ^ 1) * width
            high = np.clip(begin + size - twin, 0, width)
            left = run % 2 == 0
            low = np.zeros(n, np.int64)
            live = np.flatnonzero(low < high)
            while len(live):
                middle = (low[live] + high[live]) >> 1
                less, most = self.before(order[twin[live] + middle], order[live])
                ahead = np.where(left[live], less, most)
                low[live] = np.where(ahead, middle + 1, low[live])
                high[live] = np.where(ahead, high[live], middle)
                live = live[low[live] < high[live]]
            target = np.minimum(own, twin) + (np.arange(n) - own) + low
            merged = np.empty(n, np.int64)
            merged[target] = order
            order = merged
            width *= 2
        return order

    def sorted(self, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The order, and each one's verified common extension with the one before (-1 at a
        group's first)."""
        order = self.order(begin, size)
        shared = self._shared(order, begin)
        x, y = order[1:], order[:-1]
        if len(order) > 1:
            inside = begin[1:] == begin[:-1]
            equal = self.verified(x, y)
            if (equal[inside] != shared[1:][inside]).any():  # hashes collided
                order = np.array(sorted(range(len(order)), key=lambda i: (begin[i], self.bytes[i, : self.length[i]].tobytes())))
                equal = self.verified(order[1:], order[:-1])
                shared[1:] = np.where(inside, equal, -1)
        return order, shared

    def _shared(self, order: np.ndarray, begin: np.ndarray) -> np.ndarray:
        shared = np.full(len(order), -1, np.int64)
        if len(order) > 1:
            shared[1:] = np.where(begin[1:] == begin[:-1], self.common(order[1:], order[:-1]), -1)
        return shared


def extents(keys: np.ndarray, right: Suffixes, left: Suffixes, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """How far repeated strings of ``size`` bytes reach left and right of each anchor; 0, 0 for none.

    ``keys`` names the groups, equal ones adjacent.
    """
    n = len(keys)
    first = np.ones(n, bool)
    first[1:] = keys[1:] != keys[:-1]
    group = np.cumsum(first) - 1
    begin = np.flatnonzero(first)[group]
    members = np.bincount(group)[group]
    tops, runs = [], []
    for side in (right, left):
        order, shared = side.sorted(begin, members)
        after = np.append(shared[1:], -1)
        top = np.empty(n, np.int64)
        top[order] = np.maximum(shared, after)
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        tops.append(top)
        runs.append((shared, place))
    reach_left, reach_right = np.zeros(n, np.int64), np.zeros(n, np.int64)
    open_ = np.flatnonzero((tops[0] >= 0) & (tops[1] >= 0) & (tops[0] + tops[1] >= size))
    # With one other member, what is shared to the right and to the left is with the same.
    pair = open_[members[open_] == 2]
    reach_right[pair], reach_left[pair] = tops[0][pair], tops[1][pair]
    open_ = open_[members[open_] > 2]
    if len(open_):
        highest = int(tops[0][open_].max())
        for r in range(min(size, highest), max(0, size - int(tops[1][open_].max())) - 1, -1):
            live = open_[(tops[0][open_] >= r) & (tops[1][open_] >= size - r)]
            if not len(live):
                continue
            one = np.cumsum(runs[0][0] < r)[runs[0][1][live]]
            two = np.cumsum(runs[1][0] < size - r)[runs[1][1][live]]
            _, where, times = np.unique(one * (n + 1) + two, return_inverse=True, return_counts=True)
            hit = live[times[where] > 1]
            reach_right[hit] = np.maximum(reach_right[hit], r)
            reach_left[hit] = np.maximum(reach_left[hit], size - r)
    return reach_left, reach_right


def block_spans(block: list[tuple], size: int = SIZE) -> tuple[list[int], list[int], list[int]]:
    """Text ids, first bytes and ends of what repeats."""
    keys = np.array([r[0] for r in block], np.int64)
    right = Suffixes([r[5][r[4] :] for r in block], size)
    left = Suffixes([r[5][: r[4]][::-1] for r in block], size)
    reach_left, reach_right = extents(keys, right, left, size)
    hit = np.flatnonzero(reach_left + reach_right >= size).tolist()
    starts = [block[i][3] - int(reach_left[i]) for i in hit]
    return [block[i][2] for i in hit], starts, [block[i][3] + int(reach_right[i]) for i in hit]


def repeated_spans(rows: DataFrame, size: int = SIZE, run: int = RUN) -> DataFrame:
    """(tid, starts, ends) of the bytes that go, of prepared rows without whole copies."""
    units = partial(Bytes, size=size, run=run)
    keys = repeats.counted_anchors(rows, units, within=True)
    few, many = keys.where(F.col("times") <= repeats.CROWD), keys.where(F.col("times") > repeats.CROWD)

    def sort(batches):
        for block in repeats.groups(batches, BLOCK):
            found = block_spans(block, size)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], names=["tid", "start", "end"])

    sent = repeats.segments(rows, few, units, size - run, size)
    spans = sent.mapInArrow(sort, "tid long, start long, end long")
    if not many.isEmpty():
        spans = spans.unionByName(repeats.crowd_spans(rows, many, units, size, within=True))
    return repeats.united(spans)


def without_repeats(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans, kept_sha256 and ``kept``, the bytes that stay."""
    rows = repeats.prepared(docs, doc_id, text)
    copies = repeats.whole_copies(rows)
    spans = repeated_spans(repeats.representatives(rows, copies))
    found = repeats.marked(docs, doc_id, text, copies, spans)

    def run(batches):
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("body", "times", "starts", "ends"))
            sizes, gone, counts, digests, texts = [], [], [], [], []
            for body, times, starts, ends in zip(*columns, strict=True):
                data = body.encode()
                if times is not None and len(data) >= SIZE:
                    starts, ends = [0], [len(data)]
                stay, at = [], 0
                for a, b in zip(starts or (), ends or (), strict=True):
                    stay.append(data[at:a])
                    at = b
                stay.append(data[at:])
                whole = b"".join(stay)
                sizes.append(len(data))
                gone.append(len(data) - len(whole))
                counts.append(len(starts or ()))
                digests.append(repeats.digest([whole], b""))
                texts.append(whole)
            yield pa.RecordBatch.from_arrays(
                [batch.column("given"), *(pa.array(c, pa.int64()) for c in (sizes, gone, counts)), pa.array(digests, pa.string()), pa.array(texts, pa.binary())],
                names=["given", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    kind = found.schema["given"].dataType.simpleString()
    schema = f"given {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    return found.mapInArrow(run, schema).withColumnRenamed("given", doc_id)
