"""Transactions that must not form a cycle go to cluster -1."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza import fixed


def blocked(
    counterparties=fixed.NEVER_CYCLE_COUNTERPARTIES,
    description=fixed.NEVER_CYCLE_DESCRIPTION,
    unless=fixed.NEVER_CYCLE_UNLESS_DESCRIPTION,
) -> Column:
    """True where a rule applies.  The lists are short constants, so they are
    part of the expression; a missing description matches nothing."""
    text = F.lower(F.coalesce(F.col("description"), F.lit("")))
    rules = [F.col("counterparty").isin(*counterparties), text.rlike(description)]
    rules += [(F.col("counterparty") == name) & ~text.rlike(needed) for name, needed in unless.items()]
    return F.coalesce(reduce(lambda a, b: a | b, rules), F.lit(False))


def reset_blocked(df: DataFrame, **rules) -> DataFrame:
    return df.withColumn(
        "counterparty_cluster", F.when(blocked(**rules), F.lit(-1)).otherwise(F.col("counterparty_cluster"))
    )
