"""Both substring operators against brute force, crowds included."""

import hashlib
import random
import re

import pytest

from cadenza.llm import phrase_dedup, repeats, suffix_dedup


def brute_bytes(texts, size):
    places = {}
    data = [(t or "").encode() for t in texts]
    for d, text in enumerate(data):
        for i in range(len(text) - size + 1):
            places.setdefault(text[i : i + size], []).append((d, i))
    gone = [bytearray(len(t)) for t in data]
    for found in places.values():
        if len(found) > 1:
            for d, i in found:
                gone[d][i : i + size] = b"\1" * size
    out = []
    for text, marks in zip(data, gone, strict=True):
        kept = bytes(c for c, m in zip(text, marks, strict=True) if not m)
        spans = len(re.findall(b"\1+", bytes(marks)))
        out.append((len(text), sum(marks), spans, hashlib.sha256(kept).hexdigest()))
    return out


def brute_words(rows, size):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    least = {}
    large = float("inf")
    for (i, _), w in zip(rows, words, strict=True):
        for k in range(len(w) - size + 1):
            key = tuple(w[k : k + size])
            least[key] = min(least.get(key, large), large if i is None else i)
    out = []
    for (i, _), w in zip(rows, words, strict=True):
        gone = set()
        for k in range(len(w) - size + 1):
            if least[tuple(w[k : k + size])] < (large if i is None else i):
                gone.update(range(k, k + size))
        kept = [x for k, x in enumerate(w) if k not in gone]
        out.append((len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return out


def made(seed):
    """Texts with shared passages at odd places, self-repeats, runs of one sign, copies and nulls."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(rng.randint(48, 130)) for _ in range(6)]
    texts = [None, "", "  \n ", "x" * 1500, "ab " * 400, prose(49), prose(50)]
    for _ in range(60):
        parts = [prose(rng.randint(0, 90))]
        for _ in range(rng.randint(0, 3)):
            parts += [rng.choice(passages), prose(rng.randint(0, 60))]
        if rng.random() < 0.2:
            cut = rng.randint(0, 100)
            parts.append(passages[0][cut:])
        texts.append(rng.choice([" ", "\n", "  "]).join(parts))
    texts += [rng.choice(texts[7:]) for _ in range(8)]
    texts.append(texts[10][:-30] + "!" + texts[11])
    return texts


@pytest.mark.parametrize("crowd", [repeats.CROWD, 3])
def test_bytes(spark, crowd, monkeypatch):
    monkeypatch.setattr(repeats, "CROWD", crowd)
    texts = made(1)
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, starts string")
    found = suffix_dedup.without_repeats(docs).orderBy("doc_id").collect()
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found] == brute_bytes(texts, 400)


@pytest.mark.parametrize("crowd", [repeats.CROWD, 3])
def test_words(spark, crowd, monkeypatch):
    monkeypatch.setattr(repeats, "CROWD", crowd)
    texts = made(2)
    rng = random.Random(5)
    ids = rng.sample(range(1000), len(texts) - 1) + [None]
    rows = list(zip(ids, texts, strict=True))
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, first string")
    found = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in phrase_dedup.without_repeats(docs).collect()}
    assert found == dict(zip(ids, brute_words(rows, 50), strict=True))


def test_short_strings_in_memory():
    """Suffix order and extents on few letters, where nearly everything repeats."""
    rng = random.Random(3)
    for _ in range(30):
        texts = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 40))).encode() for _ in range(12)]
        begin = suffix_dedup.np.zeros(len(texts), int)
        size = suffix_dedup.np.full(len(texts), len(texts))
        sufs = suffix_dedup.Suffixes(texts, 40)
        order, shared = sufs.sorted(begin, size)
        assert [texts[i] for i in order] == sorted(texts)
        for k in range(1, len(texts)):
            a, b = texts[order[k]], texts[order[k - 1]]
            n = 0
            while n < min(len(a), len(b)) and a[n] == b[n]:
                n += 1
            assert shared[k] == n


def test_repeated_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b " * 300), (1, "a b " * 300), (2, "c")], "doc_id long, text string")
    assert [r.n_removed for r in suffix_dedup.without_repeats(docs).orderBy("doc_id").collect()] == [1200, 1200, 0]
    assert [r.n_removed for r in phrase_dedup.without_repeats(docs).orderBy("doc_id").collect()] == [0, 0, 0]
    assert suffix_dedup.without_repeats(docs.where("doc_id > 5")).count() == 0
    assert phrase_dedup.without_repeats(docs.where("doc_id > 5")).count() == 0
