"""Ranked search against plain scores of every document for every query."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.llm import lexical_search as ls

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, queries, size=10):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n, length = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in set(queries):
        scores = []
        for i, c in counts:
            m = 10 + 90 * sum(c.values()) * n // length
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if c[t])
            if score > 0:
                scores.append((-score, i is None, i))
        out += [(item, rank + 1, i, -s) for rank, (s, _, i) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:size])]
    return sorted(out, key=str)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def generated(seed, n_docs=700, n_queries=25):
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in ("da", "ÉT", "Zu", "x9") for b in range(60)]
    word = lambda: vocabulary[int(len(vocabulary) * rng.random() ** 2)]
    texts = [" ".join(word() for _ in range(rng.randint(0, 80))) for _ in range(n_docs // 2)]
    docs = [(i, rng.choice(texts).replace(" ", rng.choice([" ", ", ", "_", "\x7f"])) if rng.random() < 0.9 else rng.choice([None, "", "--"])) for i in range(n_docs)]
    queries = [(i, " ".join(word() for _ in range(rng.randint(0, 15)))) for i in range(n_queries)]
    return docs, [*queries, (90, None), (91, "not there"), (92, "...")]


@pytest.mark.parametrize("floor_rows", [0, 40])
def test_against_all_scores(spark, floor_rows, monkeypatch):
    docs, queries = generated(1)
    df, q = spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(queries, "item_id long, text string")
    expected = brute(docs, queries)
    assert rows(ls.search(df, q, floor_rows=floor_rows)) == expected
    monkeypatch.setattr(ls, "VOCABULARY", 60)  # several blocks of queries
    assert rows(ls.search(df, q, floor_rows=floor_rows)) == expected


def test_ties_nulls_and_repeated_rows(spark):
    docs = [(i, "alpha beta") for i in range(30)] + [(None, "alpha beta"), (3, "alpha beta"), (99, "gamma " * 50_000 + "alpha"), (98, None)]
    queries = [(1, "Alpha"), (1, "Alpha"), (None, "beta BETA"), (2, "gamma"), (2, "gamma delta")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit(7) for c in ("id", "n", "item_id", "score")})
    q = spark.createDataFrame(queries, "item_id int, text string").withColumn("rank", F.lit("x"))
    found = ls.search(df, q)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows(found) == brute(docs, queries)
    assert [r.doc_id for r in found.where("item_id = 1").orderBy("rank").collect()] == [0, 1, 2, 3, 3, 4, 5, 6, 7, 8]
    assert rows(ls.search(df, q, size=40)) == brute(docs, queries, 40)


def test_empty_tables(spark):
    df, q = spark.createDataFrame([(1, "a")], "doc_id string, text string"), spark.createDataFrame([(1, "a")], "item_id int, text string")
    for d, w in ((df.where("false"), q), (df, q.where("false")), (df.withColumn("text", F.lit("--")), q)):
        found = ls.search(d, w)
        assert found.count() == 0 and found.dtypes == [("item_id", "int"), ("rank", "int"), ("doc_id", "string"), ("score", "bigint")]
    with pytest.raises(ValueError):
        ls.search(df.withColumn("doc_id", F.lit(1.5)), q)


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(2)
    kinds = rng.integers(0, 12, 600)
    base = rng.integers(0, 10**9, (12, 90)) * (rng.random((12, 90)) < 0.3)
    points = (base[kinds] * rng.integers(25, 35, (600, 90))).astype(np.int64)
    tree = ls.BallTree(points)
    below = [None] * len(tree.below)
    for node in reversed(range(len(tree.below))):
        kids = tree.below[node]
        below[node] = np.concatenate([below[k] for k in kids]) if isinstance(kids, list) else kids
    assert sorted(below[0].tolist()) == list(range(600))
    leaves, opened = sum(not isinstance(b, list) for b in tree.below), 0
    for _ in range(40):
        columns = rng.choice(90, 12, replace=False)
        scores = points[:, columns].sum(axis=1)
        bounds = tree.bounds(columns)
        assert all(bound >= scores[mine].max() for bound, mine in zip(bounds, below, strict=True))
        top = ls.Top(5, 0)
        top.ids = list(range(600))
        opened += tree.best(columns, top)
        assert sorted((-e[0], e[2].value) for e in top.heap) == sorted(zip((-scores).tolist(), range(600), strict=True))[:5]
    assert opened < 0.4 * 40 * leaves
    # Points alike but for their last digits: the least bounds still hold.
    points = np.full((100, 3), 2**46, np.int64) + rng.integers(0, 3, (100, 3))
    assert (ls.BallTree(points).bounds(np.arange(3)) >= 3 * 2**46).all()


def test_terms_are_told_apart_by_bytes(monkeypatch):
    monkeypatch.setattr(ls.Words, "hashes", lambda self: (self.end - self.start).astype(np.uint64))
    finder = ls.TermFinder([b"abc", b"de"])
    data = np.frombuffer(b"abc xyz ABC de fg de", np.uint8)
    n, row, term, times = finder.counts(data, np.array([0, 11, 20]))
    assert n.tolist() == [3, 3] and list(zip(row.tolist(), term.tolist(), times.tolist(), strict=True)) == [(0, 0, 2), (1, 1, 2)]
