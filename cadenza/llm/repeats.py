"""Repeated windows across documents: the way to them that both operators share.

1. Texts that occur as wholes more than once are set aside by their hash; of each, the
   document of least id stands for all.
2. Anchors (`anchors`) are counted by hash, with partial sums in every task.
3. Around every anchor whose hash occurs twice, a segment is sent to the task of that
   hash, where an operator's own method finds what repeats.  Segments of a hash arrive
   in order of document id, many hashes per task.
4. Anchors of more than ``CROWD`` places would fill a task.  Their windows are not sent
   as segments but hashed, and counted like any other key, however many they are.
5. Spans found are united per text and cut out.

Lists that are broadcast (repeated anchors, documents set aside, spans) are counted
first; longer ones are joined through a shuffle instead.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.anchors import anchors
from cadenza.llm.columns import blocks, byte_column
from cadenza.session import cut

#: Places of one anchor hash that a task takes as segments, some 3 KB each.
CROWD = 40_000
#: Rows up to which a list is broadcast (8 to 40 bytes each).
BROADCAST_ROWS = 2_000_000
LAST = (1 << 63) - 1
SEGMENT = ("key", "id", "tid", "place", "lead", "seg")


def small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def prepared(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(id, body, tid): null ids come last in every order, null texts are empty."""
    return docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST)).alias("id"), F.coalesce(text, F.lit("")).alias("body")
    ).withColumn("tid", F.xxhash64("body"))


def whole_copies(rows: DataFrame) -> DataFrame:
    """(tid, first, times) of the texts that occur more than once."""
    return cut(rows.groupBy("tid").agg(F.min("id").alias("first"), F.count("*").alias("times")).where("times > 1"))


def representatives(rows: DataFrame, copies: DataFrame) -> DataFrame:
    """``rows`` without those that repeat a whole text of a lesser id."""
    placed = rows.join(small(copies.select("tid", "first")), "tid", "left")
    return placed.where("first IS NULL OR id = first").select("id", "tid", "body")


def counted_anchors(rows: DataFrame, units: Callable, within: bool) -> DataFrame:
    """(key, times) of anchor hashes that occur at two places; in two texts unless ``within``."""

    def run(batches):
        for batch in batches:
            texts = batch.column("tid").to_numpy()
            data, offsets = byte_column(batch.column("body"))
            for first, end in blocks(offsets):
                found = units(data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first])
                at = anchors(found)
                row = found.row[at]
                place = texts[first:end][row]
                if within:
                    # A place is a text and a distance in it, as one number.
                    inside = (at - found.first[row]).astype(np.int64)
                    place = place * np.int64(1_000_003) ^ inside * np.int64(0x5DEECE66D)
                yield pa.RecordBatch.from_arrays([pa.array(found.hashes[at].view(np.int64)), pa.array(place)], names=["key", "place"])

    found = rows.mapInArrow(run, "key long, place long")
    sums = found.groupBy("key").agg(F.min("place").alias("a"), F.max("place").alias("b"), F.count("*").alias("times"))
    return cut(sums.where("a < b").select("key", "times"))


def _known(keys: DataFrame):
    """A broadcast ascending array of keys, or None where they are too many."""
    if keys.count() > BROADCAST_ROWS:
        return None
    array = np.sort(keys.select("key").toArrow().column(0).to_numpy())
    return keys.sparkSession.sparkContext.broadcast(array)


def _among(known: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def segments(rows: DataFrame, keys: DataFrame, units: Callable, before: int, after: int) -> DataFrame:
    """(key, id, tid, place, lead, seg): up to ``before`` units ahead of the anchor (lead) and
    ``after`` from it on, as bytes; by key, then id."""
    known = _known(keys)

    def run(batches):
        for batch in batches:
            ids, texts = batch.column("id").to_numpy(), batch.column("tid").to_numpy()
            data, offsets = byte_column(batch.column("body"))
            for first, end in blocks(offsets):
                found = units(data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first])
                at = anchors(found)
                key = found.hashes[at].view(np.int64)
                if known is not None:
                    keep = _among(known.value, key)
                    at, key = at[keep], key[keep]
                row = found.row[at]
                low = np.maximum(at - before, found.first[row])
                high = np.minimum(at + after, found.first[row + 1])
                parts = [found.slice(a, b) for a, b in zip(low.tolist(), high.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), *(pa.array(c[first:end][row]) for c in (ids, texts)), pa.array(at - found.first[row]), pa.array((at - low).astype(np.int32)), pa.array(parts, pa.binary())],
                    names=list(SEGMENT),
                )

    found = rows.mapInArrow(run, "key long, id long, tid long, place long, lead int, seg binary")
    if known is None:
        found = found.join(keys.select("key"), "key", "left_semi")
    return found.select(*SEGMENT).repartition("key").sortWithinPartitions("key", "id", "tid", "place")


def groups(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[list[tuple]]:
    """Rows of sorted batches in lists of whole keys, of about ``most`` rows; a row that
    repeats the one before (a document given twice) is left out."""
    held: list[tuple] = []
    key = last = None
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in SEGMENT), strict=True):
            if row[0] != key:
                if len(held) >= most:
                    yield held
                    held = []
                key, last = row[0], None
            if row[1:4] != last:
                held.append(row)
                last = row[1:4]
    if held:
        yield held


def crowd_spans(rows: DataFrame, keys: DataFrame, units: Callable, size: int, within: bool) -> DataFrame:
    """(tid, start, end) of repeated windows whose anchors are among ``keys``, by window hashes."""
    known = _known(keys)

    def run(batches):
        for batch in batches:
            ids, texts = batch.column("id").to_numpy(), batch.column("tid").to_numpy()
            data, offsets = byte_column(batch.column("body"))
            for first, end in blocks(offsets):
                found = units(data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first])
                if not len(found.windows):
                    continue
                anchor = found.hashes[found.anchor_of].view(np.int64)
                mine = _among(known.value, anchor) if known is not None else np.ones(len(anchor), bool)
                if not mine.any():
                    continue
                start = found.windows[mine]
                row = found.row[start]
                inside = start - found.first[row]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.window_hashes(start).view(np.int64)), *(pa.array(c[first:end][row]) for c in (ids, texts)), pa.array(inside), pa.array(anchor[mine])],
                    names=["hash", "id", "tid", "start", "key"],
                )

    found = rows.mapInArrow(run, "hash long, id long, tid long, start long, key long")
    if known is None:
        found = found.join(keys.select("key"), "key", "left_semi")
    found = cut(found.select("hash", "id", "tid", "start"))
    place = F.struct("tid", "start") if within else F.col("id")
    ends = found.groupBy("hash").agg(F.min(place).alias("a"), F.max(place).alias("b")).where("a < b")
    ends = cut(ends.select("hash", F.lit(-LAST).alias("least") if within else F.col("a").alias("least")))
    if ends.count() <= BROADCAST_ROWS:
        table = ends.orderBy("hash").toArrow()
        shared = rows.sparkSession.sparkContext.broadcast([table.column(c).to_numpy() for c in ("hash", "least")])
        return found.mapInArrow(_joined_windows(shared, size), "tid long, start long, end long")
    return found.join(ends, "hash").where("id > least").select("tid", "start", (F.col("start") + size).alias("end"))


def _joined_windows(shared, size: int):
    """Repeated windows, those that overlap as one span."""

    def run(batches):
        hashes, least = shared.value
        for batch in batches:
            hash_, ids, tid, start = (batch.column(c).to_numpy() for c in ("hash", "id", "tid", "start"))
            slot = np.minimum(np.searchsorted(hashes, hash_), max(0, len(hashes) - 1))
            hit = (hashes[slot] == hash_) & (least[slot] < ids) if len(hashes) else np.zeros(len(ids), bool)
            tid, start = tid[hit], start[hit]
            order = np.lexsort((start, tid))
            tid, start = tid[order], start[order]
            new = np.ones(len(tid), bool)
            new[1:] = (tid[1:] != tid[:-1]) | (start[1:] > start[:-1] + size)
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(tid)) - 1 if len(first) else first
            yield pa.RecordBatch.from_arrays([pa.array(tid[first]), pa.array(start[first]), pa.array(start[last] + size)], names=["tid", "start", "end"])

    return run


def united(spans: DataFrame) -> DataFrame:
    """(tid, starts, ends): per text, disjoint ascending spans that do not touch."""

    def run(batches):
        for batch in batches:
            starts, ends = [], []
            for spans_ in batch.column("spans"):
                pairs = sorted((s["start"], s["end"]) for s in spans_.as_py())
                merged: list[list[int]] = []
                for a, b in pairs:
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], b)
                    else:
                        merged.append([a, b])
                starts.append([a for a, _ in merged])
                ends.append([b for _, b in merged])
            yield pa.RecordBatch.from_arrays(
                [batch.column("tid"), pa.array(starts, pa.list_(pa.int64())), pa.array(ends, pa.list_(pa.int64()))], names=["tid", "starts", "ends"]
            )

    gathered = spans.groupBy("tid").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    return cut(gathered.mapInArrow(run, "tid long, starts array<long>, ends array<long>"))


def marked(docs: DataFrame, doc_id: str, text: str, copies: DataFrame, spans: DataFrame) -> DataFrame:
    """Rows of ``docs`` with the spans of their text, and (times, first) of their text."""
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = prepared(docs, doc_id, text).join(small(copies), "tid", "left")
    total = spans.agg(F.sum(F.size("starts"))).first()[0] or 0
    spans = F.broadcast(spans) if total <= BROADCAST_ROWS else spans
    rows = rows.join(spans, "tid", "left")
    given = F.when(F.col("id") != LAST, F.col("id")).cast(kind)
    return rows.select(given.alias("given"), "id", "body", "times", "first", "starts", "ends")


def digest(parts: list[bytes], between: bytes) -> str:
    return hashlib.sha256(between.join(parts)).hexdigest()
