"""Periodic runs in documents, by seeds that are extended along diagonals.

Words are the maximal runs of ``[^\\x20\\x09-\\x0D]+``.  A run is a stretch of words that
repeats itself: its smallest period is ``q``, it has ``max(least, times * q)`` words or
more, and no neighbouring word continues it.

Along the diagonal of lag ``q`` (every word against the one ``q`` ahead) such a run is a
stretch of at least ``max(least - q, (times - 1) * q)`` equal words.  That is the overlap
that is guaranteed, so every run holds two occurrences, ``q`` apart, of one k-gram of
that size.  The periods are cut into bands and each band has its k, the least overlap of
its periods; bands end where k would fall below 1.5 times the period.  By the theorem of
Fine and Wilf no further occurrence of the k-gram can then lie between the two (its
distance to the nearer one and ``q`` would both be periods of the k-gram, and ``q`` not
the smallest of the run).  So neighbouring occurrences are all the pairs a band needs:
as many as words at most, not as many as pairs.

A k-gram that occurs twice has shorter ones that do, so each band looks only at the
places the band before has left.  Seeds of a lag are taken in order; the furthest place
that the lag's extensions have covered lets later seeds on them go.  Words are numbered
exactly (equal hashes are checked by bytes) and extensions compare the numbers, so no
hash decides a run.  Texts never leave their task; memory is one batch, or one long
text's words.

Null and empty texts have no words and no run.  Rows stand for themselves, repeated or
not.  All columns stay; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cmp_to_key

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cadenza.llm.anchors import BASE, INVERSE, powers
from cadenza.llm.columns import Words, blocks, byte_column, mixed, strings

LEAST = 24
TIMES = 3


def bands(longest: int, least: int = LEAST, times: int = TIMES) -> Iterator[tuple[int, int, int]]:
    """(first period, last period, k) for periods up to ``longest``."""
    low = 1
    while low <= longest:
        overlap = lambda q: max(least - q, (times - 1) * q)
        k, high = overlap(low), low
        while high < longest and min(k, overlap(high + 1)) >= 1.5 * (high + 1):
            high += 1
            k = min(k, overlap(high))
        yield low, high, k
        low = high + 1


def numbered(words: Words) -> np.ndarray:
    """A number for each word; equal ones for equal words only."""
    _, first, number = np.unique(words.hashes(), return_index=True, return_inverse=True)
    if words.same_as(first[number]):
        return number.astype(np.int64)
    table: dict[bytes, int] = {}  # hashes collided
    spelled = (words.data[a:b].tobytes() for a, b in zip(words.start, words.end, strict=True))
    return np.array([table.setdefault(w, len(table)) for w in spelled], np.int64)


def _equal_length(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading numbers are equal."""
    n, at, step = min(len(a), len(b)), 0, 64
    while at < n:
        differ = np.flatnonzero(a[at : at + step] != b[at : at + step])
        if len(differ):
            return at + int(differ[0])
        at, step = at + step, step * 2
    return n


def _seeds(prefix: np.ndarray, at: np.ndarray, end: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of neighbouring occurrences of a k-gram in a document (first, second), and the
    places that have one.  ``at``: places that may begin one; ``end``: the document's end for each."""
    at = at[at + k <= end[at]]
    hashes = mixed((prefix[at + k] - prefix[at]) * powers(INVERSE, len(prefix))[at]) + end[at].astype(np.uint64)
    order = np.argsort(hashes, kind="stable")
    sorted_, place = hashes[order], at[order]
    same = sorted_[1:] == sorted_[:-1]
    first, second = place[:-1][same], place[1:][same]
    return first, second, np.union1d(first, second)


def _extended(ids: np.ndarray, begin: np.ndarray, end: np.ndarray, first: np.ndarray, lag: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(start, end, lag) of the stretches around seeds; ``first`` ascending within a lag."""
    last, covered = -1, -1
    for i, q in zip(first.tolist(), lag.tolist(), strict=True):
        if q != last:
            last, covered = q, -1
        if i < covered:
            continue
        low, high = int(begin[i]), int(end[i])
        right = _equal_length(ids[i : high - q], ids[i + q : high])
        left = _equal_length(ids[low:i][::-1], ids[low + q : i + q][::-1])
        covered = i + right
        yield i - left, i + right + q, q


def find(ids: np.ndarray, offsets: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, end, period) of all runs; row r of the numbers is offsets[r]:offsets[r + 1]."""
    n = len(ids)
    lengths = np.diff(offsets)
    if not n or lengths.max() < least:
        return []
    begin, end = np.repeat(offsets[:-1], lengths), np.repeat(offsets[1:], lengths)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(mixed(ids.astype(np.uint64)) * powers(BASE, n), out=prefix[1:])
    at = np.arange(n)
    found: dict[tuple[int, int], int] = {}
    for low, high, k in bands(int(lengths.max()) // times, least, times):
        first, second, at = _seeds(prefix, at, end, k)
        if not len(at):
            break
        lag = second - first
        mine = (lag >= low) & (lag <= high)
        first, lag = first[mine], lag[mine]
        order = np.lexsort((first, lag))
        for start, stop, q in _extended(ids, begin, end, first[order], lag[order]):
            # The same stretch with a smaller period, of which q is a multiple, came before.
            if stop - start >= max(least, times * q):
                found.setdefault((start, stop), q)
    return sorted((a, b, q) for (a, b), q in found.items())


def _most_repeated(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """Of (start, length, period), that of greatest length / period, least start, least period."""

    def compare(x, y):
        return y[1] * x[2] - x[1] * y[2] or x[0] - y[0] or x[2] - y[2]

    return min(runs, key=cmp_to_key(compare), default=None)


def _judged(words: Words, offsets: np.ndarray, least: int, times: int) -> list[tuple[list[tuple[int, int, int]], bytes]]:
    """Per row: its runs as (start, length, period), and the words that stay."""
    cuts = words.first_word
    runs: list[list[tuple[int, int, int]]] = [[] for _ in range(len(offsets) - 1)]
    for a, b, q in find(numbered(words), cuts, least, times):
        row = int(words.row[a])
        runs[row].append((a - int(cuts[row]), b - a, q))
    out = []
    for row, mine in enumerate(runs):
        stay = np.ones(int(cuts[row + 1] - cuts[row]), bool)
        for start, length, q in mine:
            stay[start + q : start + length] = False
        kept = np.flatnonzero(stay) + cuts[row]
        out.append((mine, b" ".join(words.data[a:b].tobytes() for a, b in zip(words.start[kept].tolist(), words.end[kept].tolist(), strict=True))))
    return out


def periodic_runs(docs: DataFrame, *, text: str = "text", carry: list[str] | None = None, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """The columns ``carry`` (all if None) of each row, with runs (start, length, period; by start, then
    period) and collapsed, the words outside of repetitions joined by single spaces."""
    carry = docs.columns if carry is None else carry
    if times < 3 or least < 1:  # a repeat seen twice guarantees no k-gram of 1.5 periods
        raise ValueError("times is three or more, least one or more")
    names = [f"c{i}" for i in range(len(carry))]
    rows = docs.select(*(F.col(c).alias(n) for c, n in zip(carry, names, strict=True)), F.col(text).alias("body"))
    new_fields = StructType.fromDDL("runs array<struct<start:long,length:long,period:long>>, collapsed string")
    schema = StructType(rows.drop("body").schema.fields + new_fields.fields)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches):
        for batch in batches:
            data, offsets = byte_column(batch.column("body"))
            for first, end in blocks(offsets):
                words = Words(data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first])
                found = _judged(words, offsets[first : end + 1], least, times)
                runs = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in mine] for mine, _ in found]
                part = batch.slice(first, end - first)
                new = [pa.array(runs, kind), strings([kept.decode() for _, kept in found])]
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), *new], names=[*names, "runs", "collapsed"])

    return rows.mapInArrow(run, schema).toDF(*carry, "runs", "collapsed")


def with_planted_period(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, text): in one document of ten, chosen by the identifier's crc32, the words from a place
    on repeat with a period; both follow from the same number.  No other text is changed, nor
    that of a null identifier."""
    chosen = F.crc32(F.col(doc_id).cast("string"))
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("body"), chosen.alias("h"))
    words = F.when((F.col("h") % 10 == 0) & F.col("body").isNotNull(), F.regexp_extract_all("body", F.lit(r"[^\x20\x09-\x0D]+"), 0))
    rows = rows.withColumn("w", words).withColumns({"n": F.size("w"), "g": F.expr("h div 10")})
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))

    def repeated(i: Column) -> Column:
        at = F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
        return F.get("w", at.cast("int"))

    planted = F.array_join(F.transform(F.sequence(F.lit(0), F.col("n") - 1), repeated), " ")
    return rows.select(F.col("id").alias(doc_id), F.when(F.col("a").isNotNull(), planted).otherwise(F.col("body")).alias(text))


def run_report(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """Per row: id, n_runs, the most repeated run (start, length, period, exponent_milli; null if
    none), runs_sha256 and collapsed_sha256."""
    found = periodic_runs(docs, text=text, carry=[doc_id], least=least, times=times).toDF("id", "runs", "collapsed")

    def run(batches):
        for batch in batches:
            best, digests = [], []
            for runs in batch.column("runs").to_pylist():
                runs = [(r["start"], r["length"], r["period"]) for r in runs]
                start, length, period = _most_repeated(runs) or (None,) * 3
                best.append((len(runs), start, length, period, None if period is None else 1000 * length // period))
                digests.append(hashlib.sha256("".join(f"{a},{b},{q}\n" for a, b, q in runs).encode()).hexdigest())
            collapsed = [hashlib.sha256(t.encode()).hexdigest() for t in batch.column("collapsed").to_pylist()]
            numbers = [pa.array([b[i] for b in best], pa.int64()) for i in range(5)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *numbers, strings(digests), strings(collapsed)], names=["id", *REPORT])

    kind = found.schema["id"].dataType.simpleString()
    schema = f"id {kind}, " + ", ".join(f"{c} {'string' if c.endswith('sha256') else 'long'}" for c in REPORT)
    return found.mapInArrow(run, schema).withColumnRenamed("id", doc_id)


REPORT = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
