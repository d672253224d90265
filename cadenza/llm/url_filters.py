"""URL filters: every glob rule at once, by a bit-parallel automaton.

A rule is a glob over the canonical form of a URL, ``.host NUL path``: the leading
dot makes ``*.org`` fit the host and its subdomains alike, the NUL keeps wildcards of
the host inside the host.  All rules lie one after the other in multiword masks.  A
URL moves all of them by one byte with a shift, two table look-ups and three logical
operations (Shift-And), and all URLs of a batch move together.

* ``*`` in the host part: any run of host bytes; in the path part: any run of bytes.
* ``?``: one byte.
* Every rule is open at its end: it fits what it fits a beginning of.
* Of the fitting rules the longest wins, then the earlier; without one, ``default``.

Null URLs and URLs without ``://`` have an empty host and path and fit no rule with a
host.  Repeated rows are judged alike, each on its own; an empty table gives an empty
result.  Memory is one batch; a very long URL costs one small step per byte.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.columns import byte_column

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``host`` and ``path`` may hold ``*`` and ``?``; the path begins with ``/``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


class Automaton:
    """Masks of all rules: one initial bit per rule, then one bit per byte or ``?``."""

    def __init__(self, rules: list[Rule]):
        self.rules = sorted(rules, key=lambda r: -len(r.text))
        moves: list[tuple[int, np.ndarray]] = []  # bit, bytes that lead into it
        loops: list[tuple[int, np.ndarray]] = []  # bit, bytes that stay in it
        initial, final, bit = [], [], 0
        anything = np.ones(256, bool)
        in_host = anything.copy()
        in_host[0] = False
        for rule in self.rules:
            initial.append(bit)
            loops.append((bit, in_host))
            for part, run in (("." + rule.host + "\0", in_host), (rule.path, anything)):
                for c in part.encode():
                    if c == ord("*"):
                        loops.append((bit, run))
                        continue
                    bit += 1
                    leads = run.copy() if c == ord("?") else np.arange(256) == c
                    moves.append((bit, leads))
            loops.append((bit, anything))  # what follows a fit does not matter
            final.append(bit)
            bit += 1
        self.words = max(1, (bit + 63) // 64)
        self.move = self._table(moves)
        self.loop = self._table(loops)
        self.initial = self._mask(initial)
        self.final = final

    def _mask(self, bits: list[int]) -> np.ndarray:
        mask = np.zeros(self.words, np.uint64)
        for bit in bits:
            mask[bit // 64] |= np.uint64(1) << np.uint64(bit % 64)
        return mask

    def _table(self, places: list[tuple[int, np.ndarray]]) -> np.ndarray:
        table = np.zeros((256, self.words), np.uint64)
        for bit, allowed in places:
            table[allowed, bit // 64] |= np.uint64(1) << np.uint64(bit % 64)
        return table

    def longest(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The winning rule of each row, -1 for none."""
        start, length = offsets[:-1], np.diff(offsets)
        order = np.argsort(-length, kind="stable")
        start, length = start[order], length[order]
        states = np.tile(self.initial, (len(order), 1))
        alive = len(order)
        for place in range(int(length.max()) if len(length) else 0):
            while alive and length[alive - 1] <= place:
                alive -= 1
            now = states[:alive]
            c = data[start[:alive] + place]
            shifted = now << np.uint64(1)
            shifted[:, 1:] |= now[:, :-1] >> np.uint64(63)
            states[:alive] = (shifted & self.move[c]) | (now & self.loop[c])
        best = np.full(len(order), -1)
        for i in reversed(range(len(self.rules))):
            bit = self.final[i]
            fits = (states[:, bit // 64] >> np.uint64(bit % 64)) & np.uint64(1)
            best[fits == 1] = i
        out = np.empty(len(order), np.int64)
        out[order] = best
        return out


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def filter_urls(df: DataFrame, rules: list[Rule], *, id_column: str, url: str = "url", default: str = "allow") -> DataFrame:
    """One row per row of ``df``: the id, host, path, rule (or null) and verdict."""
    automaton = Automaton(rules)
    cases = df.select(
        F.col(id_column).alias("id"),
        F.coalesce(url_host(F.col(url)), F.lit("")).alias("host"),
        F.coalesce(url_path(F.col(url)), F.lit("")).alias("path"),
    )

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([r.text for r in automaton.rules] + [None], object)
        verdicts = np.array([r.verdict for r in automaton.rules] + [default], object)
        for batch in batches:
            host, path = batch.column("host").to_pylist(), batch.column("path").to_pylist()
            # A NUL in a URL must not pass for the mark between host and path.
            whole = [f".{h}".replace("\0", "%00") + "\0" + p for h, p in zip(host, path, strict=True)]
            won = automaton.longest(*byte_column(pa.array(whole, pa.string())))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("host"), batch.column("path"),
                 pa.array(names[won], pa.string()), pa.array(verdicts[won], pa.string())],
                names=["id", "host", "path", "rule", "verdict"],
            )

    kind = cases.schema["id"].dataType.simpleString()
    return cases.mapInArrow(judge, f"id {kind}, host string, path string, rule string, verdict string").withColumnRenamed("id", id_column)
