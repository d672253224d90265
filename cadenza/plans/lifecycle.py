"""What becomes of a prediction after it was made."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza import fixed
from cadenza.operators.positions import CYCLE


def within_horizon(upcoming: DataFrame, now: Column | str, days: int = fixed.HORIZON_DAYS) -> DataFrame:
    """One row per predicted date that lies at most ``days`` after ``now``."""
    now = F.lit(now).cast("date") if isinstance(now, str) else now
    steps = upcoming.select(
        *[c for c in upcoming.columns if c not in ("predicted_next_dates", "predicted_next_amounts")],
        F.inline(
            F.arrays_zip(
                F.col("predicted_next_dates").alias("upcoming_date"),
                F.col("predicted_next_amounts").alias("upcoming_amount"),
            )
        ),
    )
    return steps.where(F.date_diff(F.col("upcoming_date"), now) <= days)


def shifted(latest: DataFrame, as_of: Column | str, days: int = fixed.SHIFT_DAYS) -> DataFrame:
    """Predictions that did not arrive: the sent date moves along with ``as_of``
    for up to ``days`` days while the stored one stays; after that the cycle is
    ``model_deleted``."""
    as_of = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    late = F.date_diff(as_of, F.col("predicted_date"))
    return latest.withColumn("days_late", F.greatest(late, F.lit(0))).withColumns(
        {
            "sent_date": F.when(late <= 0, F.col("predicted_date")).when(late <= days, as_of),
            "status": F.when(late > days, "model_deleted").otherwise("active"),
        }
    )


def with_feedback(latest: DataFrame, feedback: DataFrame) -> DataFrame:
    """Merge user feedback into the state.

    ``feedback``: user, account, cycle, ``at`` (time), ``kind``, ``date``,
    ``signed_amount``, ``description``, ``period_days``.  The latest event of a
    cycle counts.  ``delete`` marks the cycle ``user_deleted`` and keeps it, so
    that it goes on being tracked unseen; ``confirm`` sets a manual prediction one
    user period ahead, for a new cycle too.
    """
    event = F.max(F.struct("at", "kind", "date", "signed_amount", "description", "period_days")).alias("e")
    last = feedback.groupBy(*CYCLE).agg(event)
    confirmed = F.col("e.kind") == "confirm"
    manual = F.date_add(F.col("e.date"), F.col("e.period_days"))

    def pick(new: Column, old: str) -> Column:
        return F.when(confirmed, new).otherwise(F.col(old)).alias(old)

    merged = latest.join(last, CYCLE, "full_outer").where(confirmed | F.col("predicted_date").isNotNull())
    return merged.select(
        *CYCLE,
        pick(F.col("e.date"), "date"),
        pick(manual, "predicted_date"),
        pick(F.col("e.signed_amount"), "predicted_signed_amount"),
        pick(F.col("e.description"), "predicted_description"),
        F.when(F.col("e.kind") == "delete", "user_deleted")
        .when(confirmed, "manual")
        .otherwise("active")
        .alias("status"),
    )


def retroactive_repair(labelled: DataFrame, upcoming: DataFrame) -> DataFrame:
    """Cycles found in history that the model does not know, to be sent again.

    A cycle is known when any of its transactions is in the model's output.
    """
    key = ["user_id", "account_id", "transaction_id"]
    inside = labelled.where(F.col("cycle_id").isNotNull())
    known = inside.join(upcoming.select(*key).distinct(), key, "left_semi").select(*CYCLE).distinct()
    unknown = inside.join(known, CYCLE, "left_anti")
    return (
        unknown.groupBy(*CYCLE)
        .agg(
            F.count("*").alias("n_transactions"),
            F.min("date").alias("first_date"),
            F.max("date").alias("last_date"),
        )
        .withColumn("has_cycle", F.lit(True))
        # Consecutive gaps add up to the whole span.
        .withColumn(
            "average_days_between_transactions",
            F.round(F.date_diff("last_date", "first_date") / (F.col("n_transactions") - 1), 6),
        )
    )
