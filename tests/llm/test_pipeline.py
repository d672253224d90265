"""The pipeline: every stage acts on what the one before kept."""

import random
import re

from pyspark.sql import functions as F

import corpus_pipeline


def test_stages_act(spark, sf_dir):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghi") for _ in range(rng.randint(2, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    leak = spark.read.parquet(f"{sf_dir}/benchmark.parquet").first().text
    base = prose(120)
    rows = [(i, prose(rng.randint(60, 200)), "en", "s") for i in range(70)]
    rows += [(100, base, "en", "s"), (101, base, "en", "s"), (102, base + " tail", "en", "s"), (103, prose(80) + " " + leak, "en", "s")]
    rows += [(104, prose(70) + " jo.doe@mail.example.org " + prose(9), "en", "s"), (105, "short", "en", "s"), (106, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long")).withColumn("_kept", F.lit(1))
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES:
        seen.append(stage(spark, seen[-1], sf_dir))
    ids = [{r.doc_id for r in d.select("doc_id").collect()} for d in seen]
    assert {105, 106} == ids[0] - ids[1]
    assert {101, 102} == ids[1] - ids[2]
    assert {103} == ids[2] - ids[3]
    assert ids[3] == ids[4] == ids[5]
    for d in seen[:-1]:
        assert d.columns == docs.columns
    masked = seen[4].where("doc_id = 104").first()
    assert re.search(r"<email>", masked.text) and masked.n_chars == len(masked.text)
    assert corpus_pipeline.ORACLE_SQL is None


def test_run_counts(spark, sf_dir):
    n = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    found = corpus_pipeline.run(spark, sf_dir)
    assert 0 < found.count() < n
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
