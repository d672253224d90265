"""Labels kept from run to run, searched again only where a group has changed.

Every run stores a digest of each group beside the number of the run that searched it.
A group whose digest is the same as in the run before keeps its labels where they lie;
all others go through the search.  The digest sums hashes of what the search reads of a
row, so it does not depend on the order of rows, and is made by partial sums.

A run counts once its index is written, which comes last; a run that failed before is
written over by the next.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.functions.keys import same_key
from cadenza.operators.series import GROUP, label_cycles
from cadenza.session import cut

DIGEST = ["n", "sum_a", "sum_b"]


def group_digests(df: DataFrame, group: list[str] = GROUP) -> DataFrame:
    """(group, n, sum_a, sum_b): a count and two sums of independent hashes of a group's rows."""
    columns = sorted(df.columns)
    hashes = {"_a": F.xxhash64(F.lit(1), *columns), "_b": F.xxhash64(F.lit(2), *columns)}
    rows = df.select(*group, *(h.cast("decimal(20,0)").alias(n) for n, h in hashes.items()))
    return rows.groupBy(*group).agg(F.count("*").alias("n"), F.sum("_a").alias("sum_a"), F.sum("_b").alias("sum_b"))


class LabelStore:
    """Runs below ``base``: an index of groups, and the labelled rows of those each run searched."""

    def __init__(self, base: str):
        self.base = base.rstrip("/")

    def newest(self, spark: SparkSession) -> int | None:
        try:
            return spark.read.parquet(f"{self.base}/index").agg(F.max("run")).first()[0]
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def update(self, df: DataFrame, **search) -> int:
        """Labels ``df``, searching changed groups only; the number of the run."""
        spark = df.sparkSession
        last = self.newest(spark)
        run = 0 if last is None else last + 1
        digests = cut(group_digests(df))
        placed = digests.withColumn("found_in", F.lit(None).cast("int"))
        if last is not None:
            known = spark.read.parquet(f"{self.base}/index/run={last}")
            alike = same_key("d", "k", GROUP)
            for c in DIGEST:
                alike = alike & (F.col(f"d.{c}") == F.col(f"k.{c}"))
            placed = digests.alias("d").join(known.alias("k"), alike, "left").select("d.*", F.col("k.found_in").alias("found_in"))
        placed = cut(placed)
        rows = df
        if last is not None:
            changed = placed.where("found_in IS NULL").select(*GROUP)
            rows = df.alias("r").join(changed.alias("c"), same_key("r", "c", GROUP), "left_semi")
        label_cycles(rows, **search).write.mode("overwrite").parquet(f"{self.base}/labels/found_in={run}")
        index = placed.withColumn("found_in", F.coalesce("found_in", F.lit(run)))
        index.write.mode("overwrite").parquet(f"{self.base}/index/run={run}")
        return run

    def searched(self, spark: SparkSession, run: int) -> DataFrame:
        """The groups that a run searched."""
        return spark.read.parquet(f"{self.base}/index/run={run}").where(F.col("found_in") == run).select(*GROUP)

    def labelled(self, spark: SparkSession, run: int) -> DataFrame:
        """The labelled rows of all groups as of a run."""
        index = spark.read.parquet(f"{self.base}/index/run={run}").select(*GROUP, "found_in")
        rows = spark.read.parquet(f"{self.base}/labels")
        # What a run searched holds as of that run, so only rows of earlier ones are looked up.
        own, earlier = rows.where(F.col("found_in") == run), rows.where(F.col("found_in") < run)
        index = index.where(F.col("found_in") < run)
        mine = same_key("r", "i", GROUP) & (F.col("r.found_in") == F.col("i.found_in"))
        kept = earlier.alias("r").join(index.alias("i"), mine, "left_semi")
        return own.unionByName(kept).drop("found_in")
