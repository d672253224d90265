"""Window functions inside a cycle, best matches, latest predictions.

A cycle has at most one row per few days, so windows over a cycle are bounded by
the calendar.  Whatever runs over an account or a transaction is an aggregation
with partial sums instead, which a hot key cannot overload.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.functions.keys import same_key

CYCLE = ["user_id", "account_id", "cycle_id"]


def in_cycle(cycle: str = "cycle_id"):
    return Window.partitionBy("user_id", "account_id", cycle).orderBy("date", "transaction_id")


def with_neighbour_dates(df: DataFrame) -> DataFrame:
    """``previous_date`` and ``next_date`` of each row in its cycle."""
    order = in_cycle()
    return df.withColumn("previous_date", F.lag("date").over(order)).withColumn(
        "next_date", F.lead("date").over(order)
    )


def cycle_position(df: DataFrame, cycle: str, prefix: str = "") -> DataFrame:
    """Number in the cycle, is first, is a later one; no cycle counts as neither.

    Rows without a cycle take no part in the window: they would all meet in one
    partition per account.  Predicted cycles may gather many rows, so rows are
    numbered per day of a cycle, after the rows of its days before.
    """
    inside = F.col(cycle).isNotNull()
    day = ["user_id", "account_id", cycle, "date"]
    before = Window.partitionBy(*day[:3]).orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
    earlier = (
        df.where(inside)
        .groupBy(*day)
        .count()
        .select(*day, F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_earlier"))
    )
    in_day = F.row_number().over(Window.partitionBy(*day).orderBy("transaction_id"))
    placed = (
        df.where(inside)
        .withColumn("_in_day", in_day)
        .alias("r")
        .join(earlier.alias("e"), same_key("r", "e", day))
        .select("r.*", "e._earlier")
        .withColumn(f"{prefix}nth_in_cycle", (F.col("_earlier") + F.col("_in_day")).cast("int"))
        .drop("_earlier", "_in_day")
        .withColumn(f"{prefix}new_cycle", F.col(f"{prefix}nth_in_cycle") == 1)
        .withColumn(f"{prefix}next_in_cycle", F.col(f"{prefix}nth_in_cycle") > 1)
    )
    outside = (
        df.where(~inside)
        .withColumn(f"{prefix}nth_in_cycle", F.lit(None).cast("int"))
        .withColumn(f"{prefix}new_cycle", F.lit(False))
        .withColumn(f"{prefix}next_in_cycle", F.lit(False))
    )
    return placed.unionByName(outside)


def best_match(
    candidates: DataFrame, score: str, threshold: float, keys: list[str], carried: list[str], cycle: str = "cycle_id"
) -> DataFrame:
    """The candidate of highest score per transaction, if above ``threshold``;
    of equal ones the lowest cycle."""
    best = F.min(F.struct((-F.col(score)).alias("s"), F.col(cycle), *[F.col(c) for c in carried]))
    return (
        candidates.where(F.col(score) > threshold)
        .groupBy(*keys)
        .agg(best.alias("best"))
        .select(*keys, F.col(f"best.{cycle}"), *[F.col(f"best.{c}") for c in carried])
    )


def latest_per_cycle(upcoming: DataFrame) -> DataFrame:
    """One row per cycle: the one with the latest predicted date."""
    others = [c for c in upcoming.columns if c not in CYCLE]
    first = ["predicted_date", "date", "transaction_id"]
    ordered = first + [c for c in others if c not in first]
    return (
        upcoming.where(F.col("cycle_id").isNotNull())
        .groupBy(*CYCLE)
        .agg(F.max(F.struct(*ordered)).alias("last"))
        .select(*CYCLE, *[F.col(f"last.{c}").alias(c) for c in others])
        .select(*upcoming.columns)
    )


def unit(column: Column) -> Column:
    """A hash column as a number in [0, 1)."""
    return column.cast("double") / F.lit(float(1 << 60))
