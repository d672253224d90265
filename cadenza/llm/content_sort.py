"""Exact dedup by a content sort, in DataFrame functions only.

Texts are normalised (not at all unless asked) and sorted across the cluster: Spark
samples splitters, deals the rows out by ranges of them and sorts each range on disk
where it has to.  Equal texts become adjacent, and a window's own comparison of each
row with the one before, over the whole texts, ends a group.  The row with the smallest
(or, if asked, the largest) identifier of a group stays.

The order is that of a text's first ``LEAD`` characters, then of its 64-bit hash, then
of the whole text.  So a splitter stays small however long texts are, rows with a common
beginning can be dealt to different tasks, and whole texts are compared only where
beginning and hash agree.  The hash decides nothing else.

A text that many rows share would be one range.  Texts are therefore counted by their
hash first, with partial sums; those above the share of a task (by bytes, by rows, and
never over ``RUN_BYTES``) get a salt made of the identifier between hash and text, so
that their copies lie in runs on many tasks.  At most one such text can exist for each
share, which bounds the list.  Runs of one text are then put together by their SHA-256,
a row for each run.

Nulls: a null text is empty, and empty texts are equal; a null identifier comes after
all others, and ``keep_id`` is null only if the whole group has none.  Rows of equal
text and identifier are copies, of which one stays.  All columns are kept whatever
their names.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.llm.repeats import small
from cadenza.session import cut

#: Characters of a text that a splitter holds.
LEAD = 64
#: Bytes of copies that one run of the sort may hold.
RUN_BYTES = 16 << 20
#: Runs that make up a task's share of the rows.
RUNS = 4


def unchanged(text: Column) -> Column:
    return text


def folded(text: Column) -> Column:
    """Lower case, white space as single spaces, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(text), r"[\x20\x09-\x0D]+", " "))


def _crowded(rows: DataFrame) -> DataFrame:
    """(hash, runs) of the texts that are dealt to more than one run."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sums = cut(rows.groupBy("hash").agg(F.count("*").alias("n"), F.sum(F.octet_length("body") + 32).alias("bytes")).where("n > 1"))
    total = rows.agg(F.count("*").alias("n"), F.sum(F.octet_length("body") + 32).alias("bytes")).first()
    share = max(1, (total.n or 0) // (RUNS * tasks))
    most = max(1, min(RUN_BYTES, (total.bytes or 0) // (RUNS * tasks)))
    runs = F.greatest(F.ceil(F.col("n") / share), F.ceil(F.col("bytes") / most))
    return sums.select("hash", F.least("n", runs).alias("runs")).where("runs > 1")


def _sorted(docs: DataFrame, doc_id: str, text: str, normalise: Callable[[Column], Column], keep: str, carry: Column | None) -> DataFrame:
    """(id, runs, salt, sha, place, times, top[, carried]): every row, with its run's count and the
    identifier that stays of the run, which has place 1."""
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is smallest or largest")
    body = normalise(F.coalesce(F.col(text), F.lit("")))
    rows = docs.select(F.col(doc_id).alias("id"), body.alias("body"), *([carry.alias("carried")] if carry is not None else []))
    rows = rows.withColumn("hash", F.xxhash64("body"))
    rows = rows.join(small(_crowded(rows)), "hash", "left")
    rows = rows.withColumn("runs", F.coalesce("runs", F.lit(1))).withColumn("salt", F.pmod(F.xxhash64("id"), "runs"))
    rows = rows.withColumn("lead", F.substring("body", 1, LEAD))
    dealt = rows.repartitionByRange("lead", "hash", "salt")
    first = F.col("id").asc_nulls_last() if keep == "smallest" else F.col("id").desc_nulls_last()
    run = Window.partitionBy("lead", "hash", "salt", "body")
    return dealt.select(
        "id",
        "runs",
        "salt",
        F.sha2("body", 256).alias("sha"),
        F.row_number().over(run.orderBy(first)).alias("place"),
        F.count("*").over(run).alias("times"),
        F.first("id").over(run.orderBy(first)).alias("top"),
        *(["carried"] if carry is not None else []),
    )


def _grouped(rows: DataFrame, keep: str) -> DataFrame:
    """``rows`` with the count (``all_times``), identifier (``best``) and one row (``stays``) of the
    whole group: of runs that share a text, the one with the best identifier, then least salt."""
    alone, shared = rows.where("runs = 1"), rows.where("runs > 1")
    order = [F.col("top").asc_nulls_last() if keep == "smallest" else F.col("top").desc_nulls_last(), F.col("salt")]
    heads = shared.where("place = 1").select("sha", "salt", "times", "top")
    ranked = Window.partitionBy("sha").orderBy(*order)
    whole = Window.partitionBy("sha")
    heads = heads.withColumns({"turn": F.row_number().over(ranked), "all_times": F.sum("times").over(whole)}).where("turn = 1")
    heads = cut(heads.select("sha", "all_times", F.col("top").alias("best"), F.col("salt").alias("best_salt")))
    shared = shared.join(small(heads), "sha").withColumn("stays", F.col("salt").eqNullSafe(F.col("best_salt")) & (F.col("place") == 1))
    alone = alone.withColumns({"all_times": F.col("times"), "best": F.col("top"), "stays": F.col("place") == 1})
    return alone.unionByName(shared.drop("best_salt"))


def groups(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", normalise: Callable[[Column], Column] = unchanged, keep: str = "smallest") -> DataFrame:
    """Per row: id, keep_id, group_size, kept and text_sha256 of the normalised text."""
    rows = cut(_sorted(docs, doc_id, text, normalise, keep, None))
    return _grouped(rows, keep).select(
        F.col("id").alias(doc_id),
        F.col("best").alias("keep_id"),
        F.col("all_times").alias("group_size"),
        F.col("stays").alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def distinct_documents(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", normalise: Callable[[Column], Column] = unchanged, keep: str = "smallest") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    # Columns may have any names, so they get plain ones.
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    named = [names[docs.columns.index(c)] for c in (doc_id, text)]
    rows = cut(_sorted(plain, *named, normalise, keep, F.struct(*names)).where("place = 1"))
    return _grouped(rows, keep).where("stays").select(*(f"carried.{c}" for c in names)).toDF(*docs.columns)
