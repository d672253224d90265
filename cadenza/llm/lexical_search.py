"""Exact ranked search: best documents of each query by inner product, over ball trees.

Terms are maximal runs of letters, digits and all characters beyond ASCII, A-Z in lower
case.  A document's vector holds, for each term of the queries, how often it occurs,
dampened and set against the document's length; a query's vector is one at its terms,
once a term's weight is put into the documents' coordinates.  Scores are integers.

1. Queries are taken in blocks whose terms make at most ``VOCABULARY`` columns (or one
   query with more).  A block's terms are broadcast, and each text becomes the numbers
   and counts of the terms it has, stored once; terms are told apart by their bytes.
2. Counts over all documents (documents, terms, documents with a term) come from the
   stored rows by partial sums.
3. Each task takes its documents in batches and builds a ball tree of each: a node holds
   the mean of its documents, how far the farthest lies from it (the radius), and the same
   along each column.  No score below a node exceeds its centre's score and the query's
   length times the radius (Cauchy and Schwarz), nor the centre's score and the radii of the
   query's columns; the lesser is the bound.  For sparse vectors of few common columns the
   second is mostly the lesser.  Bounds are doubles, raised by more than their rounding can
   amount to, and so never too low.
4. A query opens nodes by falling bound until none can reach its ten best so far, which
   it takes along from batch to batch.  Leaves are scored in 64-bit integers.
5. The tasks' best are ranked in two rounds, so that no query's rows meet in one task
   before they are few.

A first search over a bounded sample of documents (``FLOOR_ROWS``) gives scores that a
query's last result has at least.  They only make bounds bite sooner: what is below them
could not be among the best, ties are kept.

Scores are those of the whole texts of all rows.  Null and empty texts have no terms and
count as no document.  Of equal scores the least identifier comes first, null ones last.
Rows of equal identifier and text are ranked each on its own.  Equal rows of the queries
are one query; a query without a term in any document has no result.  Empty tables give
an empty result.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadenza.llm.columns import Words, blocks, byte_column
from cadenza.session import cut

#: Bytes between terms.
SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
#: Columns of a block of queries, and numbers in a dense batch of documents.
VOCABULARY = 8_192
CELLS = 1 << 22
#: Documents in a leaf; rows of the first sample.
LEAF = 12
FLOOR_ROWS = 4_000
#: Types of identifiers.
KINDS = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
#: Salts of the first round of ranking.
SALTS = 64


def normal_terms(text: str | None) -> list[bytes]:
    """Distinct terms in order of appearance."""
    if not text:
        return []
    data = np.frombuffer(text.encode(), np.uint8)
    words = Words(data, np.array([0, len(data)]), SEPARATORS, fold=True)
    return list(dict.fromkeys(words.data[a:b].tobytes() for a, b in zip(words.start.tolist(), words.end.tolist(), strict=True)))


@dataclass
class Queries:
    """A block of queries: the terms of all, and each one's columns."""

    terms: list[bytes]
    columns: list[np.ndarray]

    @classmethod
    def of(cls, texts: list[str]) -> Queries:
        number: dict[bytes, int] = {}
        columns = [np.array([number.setdefault(t, len(number)) for t in normal_terms(text)], np.int64) for text in texts]
        return cls(list(number), columns)


class TermFinder:
    """Finds the terms of a block of queries in batches of texts."""

    def __init__(self, terms: list[bytes]):
        self.tail = np.frombuffer(b" ".join(terms), np.uint8)
        self.n = len(terms)

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Terms of each row in all, and (row, term, times) by row, then term."""
        rows = len(offsets) - 1
        # The terms themselves are one more row, so that they are hashed and compared alike.
        words = Words(np.concatenate([data, self.tail]), np.append(offsets, offsets[-1] + len(self.tail)), SEPARATORS, fold=True)
        hashes, split = words.hashes(), int(words.first_word[rows])
        order = np.argsort(hashes[split:], kind="stable")
        known = hashes[split:][order]
        slot = np.minimum(np.searchsorted(known, hashes[:split]), max(0, self.n - 1))
        hit = np.flatnonzero(known[slot] == hashes[:split]) if self.n else np.zeros(0, np.int64)
        term = order[slot[hit]]
        right = self._spelled_alike(words, hit, split + term)
        hit, term = hit[right], term[right]
        pairs, times = np.unique(words.row[hit] * max(1, self.n) + term, return_counts=True)
        return np.diff(words.first_word)[:rows], pairs // max(1, self.n), pairs % max(1, self.n), times

    @staticmethod
    def _spelled_alike(words: Words, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        length = words.end[a] - words.start[a]
        alike = length == words.end[b] - words.start[b]
        live, at = np.flatnonzero(alike), 0
        while len(live):
            equal = words.data[words.start[a[live]] + at] == words.data[words.start[b[live]] + at]
            alike[live[~equal]] = False
            at += 1
            live = live[equal & (length[live] > at)]
        return alike


def vectors(docs: DataFrame, shared, doc_id: str, text: str) -> DataFrame:
    """(id, n, terms, times) of the documents with a term: of all terms the number, of the queries' the counts."""

    def run(batches):
        finder = TermFinder(shared.value.terms)
        for batch in batches:
            data, offsets = byte_column(batch.column("body"))
            for first, end in blocks(offsets):
                n, row, term, times = finder.counts(data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first])
                cuts = pa.array(np.searchsorted(row, np.arange(end - first + 1)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(cuts, pa.array(c.astype(kind))) for c, kind in ((term, np.int32), (times, np.int64))]
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(first, end - first), pa.array(n), *lists], names=["id", "n", "terms", "times"])

    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("body"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n long, terms array<int>, times array<long>").where("n > 0")


@dataclass
class Collection:
    """Counts over all documents, and the weights of the queries' terms."""

    documents: int
    length: int
    weight: np.ndarray

    @classmethod
    def of(cls, found: DataFrame, terms: int) -> Collection:
        documents, length = found.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        holding = np.zeros(terms, np.int64)
        for term, times in found.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            holding[term] = times
        weight = [math.floor(1000 * math.log((2 * documents + 2) / (2 * h + 1))) for h in holding.tolist()]
        return cls(documents, length, np.array(weight, np.int64))

    def coordinates(self, n: np.ndarray, times: np.ndarray) -> np.ndarray:
        """A term's part of a score but for its weight; ``n``: the length of its document."""
        m = 100 - 90 + (90 * n * self.documents) // self.length
        return (1_000_000_000 * times) // (1000 * times + 8 * m)


class BallTree:
    """Documents (rows of ``points``, 64-bit integers) below nodes with a centre and radii."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points = points
        #: Two children, or the documents of a leaf.
        self.below: list[list[int] | np.ndarray] = []
        centres, reaches, radii = [], [], []
        stack = [(np.arange(len(points)), -1, 0)]
        while stack:
            rows, parent, side = stack.pop()
            node = len(self.below)
            if parent >= 0:
                self.below[parent][side] = node
            mine = points[rows].astype(np.float64)
            centre = mine.mean(axis=0)
            apart = mine - centre
            distance = np.einsum("ij,ij->i", apart, apart)
            centres.append(centre)
            reaches.append(centre + apart.max(axis=0))
            radii.append(math.sqrt(distance.max()))
            if len(rows) <= leaf or not distance.any():
                self.below.append(rows)
                continue
            # Two points far apart; the others go by the line between them, half to either side.
            a = apart[distance.argmax()]
            to_a = apart - a
            b = apart[np.einsum("ij,ij->i", to_a, to_a).argmax()]
            order = np.argsort(apart @ (b - a), kind="stable")
            half = len(rows) // 2
            self.below.append([-1, -1])
            stack += [(rows[order[half:]], node, 1), (rows[order[:half]], node, 0)]
        # A row for each column, as a query reads a few columns of all nodes.
        self.centre, self.reach, self.radius = np.array(centres).T.copy(), np.array(reaches).T.copy(), np.array(radii)
        # The centre as it was rounded is as good as the exact one, since radii are taken from
        # it.  All that is summed after that is not negative, and so off by less than this share.
        self.slack = 1 + 8 * (points.shape[1] + len(points) + 8) * np.finfo(np.float64).eps

    def bounds(self, columns: np.ndarray) -> np.ndarray:
        """For each node a sum over the columns that no document below it exceeds."""
        ball = self.centre[columns].sum(axis=0) + math.sqrt(len(columns)) * self.radius
        return np.minimum(ball, self.reach[columns].sum(axis=0)) * self.slack + 1

    def best(self, columns: np.ndarray, top: Top) -> int:
        """Offers the documents that may be among the best, by falling bound; leaves opened."""
        bounds = self.bounds(columns).tolist()
        heap, opened = [(-bounds[0], 0)], 0
        while heap and -heap[0][0] >= top.least:
            below = self.below[heapq.heappop(heap)[1]]
            if isinstance(below, list):
                for child in below:
                    if bounds[child] >= top.least:
                        heapq.heappush(heap, (-bounds[child], child))
            else:
                opened += 1
                scores = self.points[below[:, None], columns].sum(axis=1)
                for i in np.flatnonzero(scores >= top.least).tolist():
                    top.offer(int(scores[i]), int(below[i]))
        return opened


class Top:
    """The best (score, identifier) of a query; of equal scores the least identifier, null last."""

    def __init__(self, size: int, floor: int):
        self.size, self.floor = size, max(1, floor)
        self.heap: list[tuple] = []
        self.ids: list | None = None

    @property
    def least(self) -> int:
        return max(self.floor, self.heap[0][0]) if len(self.heap) == self.size else self.floor

    def offer(self, score: int, row: int) -> None:
        id_ = self.ids[row]
        entry = (score, id_ is not None, _Falling(id_))
        if len(self.heap) < self.size:
            heapq.heappush(self.heap, entry)
        else:
            heapq.heappushpop(self.heap, entry)


class _Falling:
    """Orders values the other way round."""

    __slots__ = ("value",)

    def __init__(self, value):
        self.value = value

    def __lt__(self, other):
        return other.value < self.value if self.value is not None else False


def _batches(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """The same rows in tables of about ``rows`` rows."""
    held, n = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            held.append(batch.slice(at, rows))
            n += held[-1].num_rows
            if n >= rows:
                yield pa.Table.from_batches(held)
                held, n = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _searched(found: DataFrame, shared, collection: Collection, floors: list[int], size: int) -> DataFrame:
    """(query, id, score): the best of every task that reach the floors."""
    kind = found.schema["id"].dataType.simpleString()
    arrow = KINDS[kind]

    def run(batches):
        queries: Queries = shared.value
        width = len(queries.terms)
        rows = max(4 * LEAF, CELLS // max(1, width))
        tops = [Top(size, floor) for floor in floors]
        for table in _batches(batches, rows):
            terms, times = (table.column(c).combine_chunks() for c in ("terms", "times"))
            row = np.repeat(np.arange(len(table)), np.diff(terms.offsets.to_numpy()))
            n = table.column("n").to_numpy()
            points = np.zeros((len(table), width), np.int64)
            column = terms.flatten().to_numpy()
            points[row, column] = collection.weight[column] * collection.coordinates(n[row], times.flatten().to_numpy())
            tree = BallTree(points)
            ids = table.column("id").to_pylist()
            for top, columns in zip(tops, queries.columns, strict=True):
                if len(columns):
                    top.ids = ids
                    tree.best(columns, top)
        out = [(number, entry[2].value, entry[0]) for number, top in enumerate(tops) for entry in top.heap]
        columns = list(zip(*out, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], arrow), pa.array(columns[2], pa.int64())], names=["query", "id", "score"])

    return found.mapInArrow(run, f"query int, id {kind}, score long")


def _ranked(found: DataFrame, size: int) -> DataFrame:
    """(query, rank, id, score) of the best rows, in two rounds."""
    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    salted = Window.partitionBy("query", "salt").orderBy(*order)
    some = found.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS))).withColumn("rank", F.row_number().over(salted))
    some = some.where(F.col("rank") <= size).drop("rank", "salt")
    whole = Window.partitionBy("query").orderBy(*order)
    return some.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= size).select("query", "rank", "id", "score")


def _query_blocks(queries: DataFrame, item_id: str, text: str) -> Iterator[list[tuple]]:
    """(item, text) lists, few enough terms each; equal rows once."""
    rows = cut(queries.select(F.col(item_id).alias("item"), F.col(text).alias("body")).where("body IS NOT NULL").distinct())
    room = rows.agg(F.sum(F.size(F.split("body", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")))).first()[0] or 0
    parts = max(1, -(-room // VOCABULARY))
    for part in range(parts):
        mine = rows.where(F.pmod(F.xxhash64("item", "body"), F.lit(parts)) == part).orderBy("item", "body")
        held = [tuple(r) for r in mine.toLocalIterator()]
        if held:
            yield held


def search(docs: DataFrame, queries: DataFrame, *, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
           item_text: str = "text", size: int = 10, floor_rows: int = FLOOR_ROWS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``size`` best documents of each query with a score above 0."""
    spark, results = docs.sparkSession, []
    doc_kind, item_kind = docs.schema[doc_id].dataType.simpleString(), queries.schema[item_id].dataType.simpleString()
    if doc_kind not in KINDS:
        raise ValueError(f"documents are numbered or named: {sorted(KINDS)}")
    for held in _query_blocks(queries, item_id, item_text):
        shared = spark.sparkContext.broadcast(Queries.of([body for _, body in held]))
        found = cut(vectors(docs, shared, doc_id, text))
        collection = Collection.of(found, len(shared.value.terms))
        if not collection.documents:
            continue
        floors = [0] * len(held)
        if floor_rows and collection.documents > 4 * floor_rows:
            share = max(1, collection.documents // floor_rows)
            some = found.where(F.pmod(F.xxhash64("id"), F.lit(share)) == 0)
            for number, score in _ranked(_searched(some, shared, collection, floors, size), size).where(F.col("rank") == size).select("query", "score").collect():
                floors[number] = score
        best = _ranked(_searched(found, shared, collection, floors, size), size)
        names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(held)], f"query int, item {item_kind}")
        results.append(best.join(names, "query").select(F.col("item").alias(item_id), "rank", F.col("id").alias(doc_id), "score"))
    if not results:
        return spark.createDataFrame([], f"`{item_id}` {item_kind}, rank int, `{doc_id}` {doc_kind}, score long")
    out = results[0]
    for more in results[1:]:
        out = out.unionAll(more)
    return out
