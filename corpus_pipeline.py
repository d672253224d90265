"""A corpus from documents: quality, near copies, benchmark leaks, personal data, tokens.

Every stage takes what its predecessor kept, as a table written in between.  All but
the last return the columns of ``documents``:

1. quality rules: rejected documents go.
2. n-gram Jaccard join: of each group of similar documents the least id stays.
3. benchmark decontamination: documents with a benchmark window go.
4. personal data: spans become their kind in angle brackets, and ``n_chars`` follows.
5. encoding: doc_id, n_tokens, and digests of the ids and of what they decode to.

Null texts have no words and are rejected by the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm.bpe import round_trip
from cadenza.llm.decontaminate import clean_documents
from cadenza.llm.jaccard_groups import one_of_each
from cadenza.llm.pii import redacted
from cadenza.llm.quality import kept_documents
from cadenza.session import cut, small_batches


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return kept_documents(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = redacted(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return round_trip(docs)


STAGES = [
    ("quality", quality),
    ("near_copies", near_copies),
    ("leaks", leaks),
    ("personal_data", personal_data),
    ("encoding", encoding),
]

#: Encoding and the character model are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
