"""Periodic runs against brute force over all lags, on random, planted and given texts."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.llm import periodic_runs as pr

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words, least=24, times=3):
    """(start, length, period) of all runs, lag by lag."""
    n, found = len(words), {}
    codes = {w: i for i, w in enumerate(dict.fromkeys(words))}
    w = np.array([codes[x] for x in words], np.int64)
    for q in range(1, n // times + 1):
        same = np.concatenate([[False], w[:-q] == w[q:], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if b - a + q >= max(least, times * q):
                found.setdefault((a, b + q), q)
    return sorted((a, b - a, q) for (a, b), q in found.items())


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def report(doc_id, text):
    words = planted(doc_id, WORD.findall(text or ""))
    runs = brute(words)
    gone = {i for a, b, q in runs for i in range(a + q, a + b)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    four = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *four, sha("".join(f"{a},{b},{q}\n" for a, b, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def generated(rng):
    """Texts over few words with repeats inside repeats, powers, and near misses."""
    kind = rng.randrange(6)
    letters = [f"w{i}" for i in range(rng.choice([1, 2, 3, 30]))]
    word = lambda: rng.choice(letters)
    if kind == 0:
        return [word() for _ in range(rng.randrange(90))]
    if kind == 1:  # periods whose inner parts repeat too
        u, v = [word() for _ in range(rng.randint(1, 25))], [word() for _ in range(rng.randint(1, 25))]
        block = [x for _ in range(rng.randint(1, 8)) for x in rng.choice([u, v])]
        return [word()] + block * rng.randint(2, 6) + block[: rng.randrange(len(block))] + [word(), word()]
    if kind == 2:  # runs that touch or overlap
        out = []
        for _ in range(rng.randint(1, 5)):
            block = [word() for _ in range(rng.randint(1, 20))]
            out += block * rng.randint(2, 7) + block[: rng.randrange(len(block))]
        return out
    if kind == 3:
        a, b = ["a"], ["a", "b"]
        while len(b) < rng.randint(30, 300):  # Fibonacci words
            a, b = b, b + a
        return b * rng.randint(1, 4)
    if kind == 4:
        block = [word() for _ in range(rng.randint(1, 60))] * rng.randint(3, 5)
        block[rng.randrange(len(block))] = "other"
        return block
    return ["x"] * rng.randint(20, 27) + [word()] + ["y", "z"] * rng.randint(10, 14)


def test_against_brute_force():
    rng = random.Random(5)
    for _ in range(60):
        texts = [generated(rng) for _ in range(25)]
        words = [w for t in texts for w in t]
        table = {w: i for i, w in enumerate(dict.fromkeys(words))}
        cuts = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        for least, times in ((24, 3), (10, 3), (1, 4)):
            found = pr.find(np.array([table[w] for w in words], np.int64), cuts, least, times)
            expected = [(int(c) + a, int(c) + a + b, q) for c, t in zip(cuts, texts, strict=False) for a, b, q in brute(t, least, times)]
            assert found == sorted(expected), (least, times)


def test_bands_hold_their_bounds():
    for least, times in ((24, 3), (10, 3), (1, 5), (500, 3)):
        seen = []
        for low, high, k in pr.bands(3000, least, times):
            seen += range(low, high + 1)
            assert all(k <= max(least - q, (times - 1) * q) and k >= 1.5 * q - 1 for q in range(low, high + 1))
        assert seen == list(range(1, 3001))


def test_report_of_the_documents(spark, sf_dir):
    import __spark_entry__ as contract

    found = contract.queries()["op12_periodic_runs"](spark, sf_dir)
    rows = {tuple(r) for r in found.collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert rows == {report(d, t) for d, t in docs}
    assert sum(r[1] > 0 for r in rows) > 5


def test_odd_rows(spark):
    long = " ".join(f"w{i % 701}" for i in range(120_000)) + " end"
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, long), (5, "a " * 24), (5, "a " * 24), (None, "b\x00c \x0b" * 30), (6, "a " * 23), (7, "é x " * 24)]
    # Identifiers that are no multiple in the sense of the planted rule keep their words.
    rows = [(next(i for i in range(100 * d, 100 * d + 100) if zlib.crc32(str(i).encode()) % 10) if d else d, t) for d, t in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    planted_rows = pr.with_planted_period(df)
    assert sorted(map(tuple, planted_rows.collect()), key=str) == sorted(rows, key=str)
    found = {(r.doc_id, r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) for r in pr.run_report(planted_rows).collect()}
    assert found == {report(d, t) for d, t in rows}
    assert pr.run_report(df).count() == len(rows)
    assert pr.run_report(df.where("doc_id < 0")).count() == 0


def test_columns_stay(spark):
    df = spark.createDataFrame([(1, "x y " * 20 + "z")], "doc_id long, text string").withColumns({c: F.lit(c) for c in ("runs", "collapsed", "body", "c0")})
    found = pr.periodic_runs(df)
    assert found.columns == [*df.columns, "runs", "collapsed"]
    row = found.first()
    assert row[2:6] == ("runs", "collapsed", "body", "c0")
    assert [tuple(r) for r in row[6]] == [(0, 40, 2)] and row[7] == "x y z"
    with pytest.raises(ValueError):
        pr.periodic_runs(df, times=2)
