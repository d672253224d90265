"""Exact dedup against plain grouping, with nulls, ties, hot texts and clashing names."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from cadenza.llm import content_sort


def expected(rows, keep):
    """Multisets per text: (size, identifier that stays)."""
    by = {}
    for doc_id, text in rows:
        by.setdefault(text or "", []).append(doc_id)
    best = {}
    for text, ids in by.items():
        known = [i for i in ids if i is not None]
        best[text] = (len(ids), (min(known) if keep == "smallest" else max(known)) if known else None)
    return best


def fixture():
    rng = random.Random(3)
    rows = [(i, "hot " * 9) for i in range(400)]  # a third of all rows
    rows += [(1000 + i, f"hot text {i % 90}") for i in range(500)]
    rows += [(2000 + i, rng.choice([None, "", " ", "\n"])) for i in range(40)]
    rows += [(None, "hot " * 9), (None, "none"), (None, "none"), (None, None), (7, "seven"), (7, "seven"), (7, "eight")]
    common = "x" * 300_000
    rows += [(3000 + i, common + str(i % 3)) for i in range(12)]
    rows += [(4000 + i, "é" * 64 + chr(200 + i % 5)) for i in range(60)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_groups(spark, keep):
    rows = fixture()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    found = content_sort.groups(df, keep=keep).collect()
    best = {hashlib.sha256(t.encode()).hexdigest(): v for t, v in expected(rows, keep).items()}
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in found) == sorted((i is None, i or 0) for i, _ in rows)
    for r in found:
        assert (r.group_size, r.keep_id) == best[r.text_sha256]
        assert not r.kept or r.doc_id == r.keep_id
    kept = [r.text_sha256 for r in found if r.kept]
    assert sorted(kept) == sorted(best)


def test_hot_text_is_dealt_to_many_runs(spark):
    df = spark.createDataFrame([(i, "same") for i in range(4000)] + [(5000 + i, f"t{i}") for i in range(4000)], "doc_id long, text string")
    rows = content_sort._sorted(df, "doc_id", "text", content_sort.unchanged, "smallest", None).cache()
    assert rows.where("runs > 1").select("sha").distinct().count() == 1
    assert rows.agg(F.max("times")).first()[0] < 1000
    rows.unpersist()


def test_distinct_rows_keep_all_columns(spark):
    rows = fixture()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("hash", "salt", "body", "id", "c0", "carried", "lead", "runs"):
        df = df.withColumn(name, F.concat(F.lit(name), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))))
    found = content_sort.distinct_documents(df)
    assert found.columns == df.columns
    got = found.collect()
    best = expected(rows, "smallest")
    assert {r.text or "": r.doc_id for r in got} == {t: v[1] for t, v in best.items()}
    assert len(got) == len(best)
    assert all(r.salt == "salt" + ("-" if r.doc_id is None else str(r.doc_id)) for r in got)


def test_normalised_and_empty(spark):
    df = spark.createDataFrame([(1, "A  b\n"), (2, "a b"), (3, "a  c")], "doc_id long, text string")
    found = {r.doc_id: r for r in content_sort.groups(df, normalise=content_sort.folded).collect()}
    assert (found[1].kept, found[2].kept, found[2].keep_id, found[3].group_size) == (True, False, 1, 1)
    assert found[2].text_sha256 == hashlib.sha256(b"a b").hexdigest()
    empty = df.where("doc_id > 9")
    assert content_sort.groups(empty).count() == 0 and content_sort.distinct_documents(empty).count() == 0
    with pytest.raises(ValueError):
        content_sort.groups(df, keep="any")


def test_no_python_on_the_path(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a")], "doc_id long, text string")
    rows = content_sort._sorted(df, "doc_id", "text", content_sort.unchanged, "smallest", None)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in plan and "Python" not in plan and "ArrowEval" not in plan
    # The range exchange is the only one that moves texts.
    assert plan.count("Exchange hashpartitioning") == 0
