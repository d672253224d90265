"""Repeatable samples and splits (K3-K8).

A row is chosen by a hash of its key, so a sample needs no sort and no shuffle,
and a task that runs again after a lost executor chooses the same rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza import fixed
from cadenza.functions.keys import SPREAD_RANGE, spread

ROW_KEY = ["user_id", "account_id", "transaction_id"]
_BUCKETS = 4096


def keep_fraction(df: DataFrame, fraction: float, keys: list[str], seed: int | None = None) -> DataFrame:
    """Rows whose hash falls into the first ``fraction`` of its range."""
    if fraction >= 1:
        return df
    return df.where(spread(*keys, seed=seed) < F.lit(int(fraction * SPREAD_RANGE)))


def nth_smallest(df: DataFrame, n: int, column: str) -> int | None:
    """The n-th smallest of a column spread evenly over the hash range.

    Counts per slice of the range (a fixed number of rows) find the slice it lies
    in; only that slice is ordered.
    """
    if n <= 0:
        return None
    width = SPREAD_RANGE // _BUCKETS
    sliced = df.select(F.col(column).alias("h"), F.floor(F.col(column) / width).cast("int").alias("slice"))
    counts = sorted(tuple(r) for r in sliced.groupBy("slice").count().collect())
    before = 0
    for slice_number, count in counts:
        if before + count >= n:
            inside = sliced.where(F.col("slice") == slice_number).orderBy("h").limit(n - before)
            return inside.agg(F.max("h")).first()[0]
        before += count
    return SPREAD_RANGE


def keep_exactly(df: DataFrame, n: int, keys: list[str] = ROW_KEY, seed: int | None = None) -> DataFrame:
    """``n`` rows of distinct key (all rows where there are fewer)."""
    last = nth_smallest(df.select(spread(*keys, seed=seed).alias("h")), n, "h")
    if last is None:
        return df.limit(0)
    return df.where(spread(*keys, seed=seed) <= last)


def _first_users(users: DataFrame, fraction: float, column: str) -> int | None:
    total = users.count()
    return nth_smallest(users, math.ceil(round(fraction * total, 9)), column)


def split_by_user(
    df: DataFrame,
    test_fraction: float = fixed.TEST_FRACTION,
    validation_fraction: float = fixed.VALIDATION_FRACTION,
    seed: int = fixed.SAMPLE_SEED,
) -> DataFrame:
    """Add ``part``: test, validation or train; each user is in one part.

    Users are ordered by a hash and the first share of them is taken.  That
    leaves two limits to compare a row's own hash with: the rows do not move.
    """
    users = df.select("user_id").distinct().select(
        spread("user_id", seed=seed).alias("t"), spread("user_id", seed=seed + 1).alias("v")
    )
    test_limit = _first_users(users, test_fraction, "t")
    is_test = F.lit(False) if test_limit is None else F.col("t") <= test_limit
    rest = users.where(~is_test)
    validation_limit = _first_users(rest, validation_fraction / (1 - test_fraction), "v")
    is_validation = F.lit(False) if validation_limit is None else F.col("v") <= validation_limit
    return (
        df.withColumn("t", spread("user_id", seed=seed))
        .withColumn("v", spread("user_id", seed=seed + 1))
        .withColumn("part", F.when(is_test, "test").when(is_validation, "validation").otherwise("train"))
        .drop("t", "v")
    )


def sample_of_users(df: DataFrame, fraction: float = fixed.EVALUATION_FRACTION, seed: int = fixed.SAMPLE_SEED) -> DataFrame:
    """All rows of a share of the users (at least one user)."""
    users = df.select("user_id").distinct().select(spread("user_id", seed=seed + 2).alias("t"))
    limit = _first_users(users, fraction, "t")
    return df if limit is None else df.where(spread("user_id", seed=seed + 2) <= limit)
