"""Benchmark decontamination: windows of benchmark words looked up in training texts.

Words are maximal runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after lower-casing
A-Z.  A benchmark item's windows are its runs of ``size`` words; a shorter item is one
window.  Their hash set is broadcast, each training text slides over it, and every hit
is verified word by word.

The set's size is counted first.  It is cut into parts of ``part_windows`` windows
(bounded size each), and the texts pass through the parts one after another in the
same tasks, so nothing grows with the benchmark but the time; no text is shuffled.

Null or empty texts and items have no words.  A null item id hits but is not listed.
Repeated items and rows count as they stand: each row is judged on its own, an item id
once.  Empty tables give no hits.  Memory is one batch and one long text's words.
"""

from __future__ import annotations


from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.columns import keys, mixed
from cadenza.session import cut

SIZE = 10
#: Windows in one broadcast part: at about 300 bytes each, some 60 MB in a worker.
PART_WINDOWS = 200_000

_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def normal_words(text: str | None) -> list[bytes]:
    return text.encode().translate(_TABLE).split() if text else []


def item_windows(benchmark: DataFrame, item_id: str, text: str, size: int) -> DataFrame:
    """Distinct windows of the items, each with the ids (as strings) that hold it."""

    def slide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out = [], []
            for item, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = normal_words(body)
                for i in range(max(1, len(words) - size + 1) if words else 0):
                    ids.append(item)
                    out.append(b" ".join(words[i : i + size]).decode())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(out, pa.string())], names=["item", "phrase"])

    rows = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("body"))
    return rows.mapInArrow(slide, "item string, phrase string").groupBy("phrase").agg(F.collect_set("item").alias("items"))


class WindowSet:
    """A part of the windows, with the words they use numbered."""

    def __init__(self, rows: list[tuple[str, list[str]]]):
        self.items = {tuple(p.encode().split()): i for p, i in rows}
        self.number = {w: i for i, w in enumerate(dict.fromkeys(w for p in self.items for w in p))}
        self.hashes = {}
        for size in {len(p) for p in self.items}:
            codes = np.array([[self.number[w] for w in p] for p in self.items if len(p) == size], np.int64)
            self.hashes[size] = np.unique(self._hash([codes[:, i] for i in range(size)]))

    @staticmethod
    def _hash(columns: list[np.ndarray]) -> np.ndarray:
        total = np.zeros(len(columns[0]), np.uint64)
        for factor, column in zip(keys(len(columns), 3), columns, strict=True):
            total += (column.astype(np.uint64) + np.uint64(1)) * factor
        return mixed(total)

    def find(self, words: list[bytes]) -> list[tuple[int, int, list[str]]]:
        """Start, size and items of every window that occurs."""
        get = self.number.get
        codes = np.array([get(w, -1) for w in words], np.int64)
        # For each place, how many known words in a row begin there.
        unknown = np.flatnonzero(codes < 0)
        ends = np.append(unknown, len(codes))
        run = ends[np.searchsorted(unknown, np.arange(len(codes)))] - np.arange(len(codes))
        hits = []
        for size, known in self.hashes.items():
            at = np.flatnonzero(run >= size)
            if not len(at):
                continue
            hashed = self._hash([codes[at + i] for i in range(size)])
            slot = np.minimum(np.searchsorted(known, hashed), len(known) - 1)
            for i in at[known[slot] == hashed].tolist():
                items = self.items.get(tuple(words[i : i + size]))
                if items is not None:
                    hits.append((i, size, items))
        return hits


def find_windows(docs: DataFrame, benchmark: DataFrame, *, text: str, item_id: str = "item_id", item_text: str = "text",
                 size: int = SIZE, part_windows: int = PART_WINDOWS) -> DataFrame:
    """``docs`` with ``_n_words``, ``_hit_at`` (places of hit words, ascending) and
    ``_hit_items`` (ids in string order)."""
    found = cut(item_windows(benchmark, item_id, item_text, size))
    n = found.count()
    parts = max(1, -(-n // part_windows))
    out = docs.select(
        "*",
        F.lit(0).cast("long").alias("_n_words"),
        F.array().cast("array<int>").alias("_hit_at"),
        F.array().cast("array<string>").alias("_hit_items"),
    )
    for part in range(parts):
        mine = found.where(F.pmod(F.xxhash64("phrase"), F.lit(parts)) == part) if parts > 1 else found
        rows = [(r.phrase, list(r.items)) for r in mine.toLocalIterator()]
        shared = docs.sparkSession.sparkContext.broadcast(rows)
        out = out.mapInArrow(_searched(shared, text), out.schema)
    return out


def _searched(shared, text):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = WindowSet(shared.value)
        for batch in batches:
            names = batch.schema.names
            counts, places, items = [], [], []
            before = zip(batch.column(text).to_pylist(), batch.column("_hit_at"), batch.column("_hit_items"), strict=True)
            for body, at, seen in before:
                words = normal_words(body)
                hits = part.find(words) if words and part.items else []
                counts.append(len(words))
                if hits:
                    here = {i for start, n, _ in hits for i in range(start, start + n)}
                    places.append(sorted(here.union(at.as_py())))
                    items.append(sorted({i for *_, ids in hits for i in ids}.union(seen.as_py())))
                else:
                    places.append(at.as_py())
                    items.append(seen.as_py())
            new = {"_n_words": pa.array(counts, pa.int64()), "_hit_at": pa.array(places, pa.list_(pa.int32())), "_hit_items": pa.array(items, pa.list_(pa.string()))}
            yield pa.RecordBatch.from_arrays([new[c] if c in new else batch.column(c) for c in names], names=names)

    return search


def hit_counts(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """Per document: id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = find_windows(docs.select(doc_id, text), benchmark, text=text, size=size)
    return found.select(
        doc_id,
        F.col("_n_words").alias("n_words"),
        F.size("_hit_at").cast("long").alias("n_hit"),
        F.size("_hit_items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "_hit_items"), 256).alias("items_sha256"),
        (F.size("_hit_at") > 0).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", size: int = SIZE) -> DataFrame:
    """The rows of ``docs`` in which no window occurs."""
    # Columns of the input may have the names of the marks, so they get plain ones.
    names = [f"c{i}" for i in range(len(docs.columns))]
    found = find_windows(docs.toDF(*names), benchmark, text=names[docs.columns.index(text)], size=size)
    return found.where(F.size("_hit_at") == 0).select(*names).toDF(*docs.columns)




