"""Amount columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cadenza.fixed import AMOUNT_DIFFERENCE_CLIP, LOOKAHEAD_STEPS


def signed_amount(amount="amount", kind="transaction_type") -> Column:
    return F.when(F.col(kind) == "debit", -F.col(amount)).otherwise(F.col(amount))


def amount_difference_sql(amount: str, predicted: str) -> str:
    """|(predicted - amount) / amount|, at most 10; null for 0 / 0."""
    return (
        f"case when {amount} = 0 and {predicted} = 0 then null"
        f" when {amount} = 0 and {predicted} is not null then {AMOUNT_DIFFERENCE_CLIP}D"
        f" when {amount} is null or {predicted} is null then null"
        f" else least(abs(({predicted} - {amount}) / {amount}), {AMOUNT_DIFFERENCE_CLIP}D) end"
    )


def amount_difference(amount: str, predicted: str) -> Column:
    return F.expr(amount_difference_sql(amount, predicted))


def next_amounts(amount: str, steps: int = LOOKAHEAD_STEPS) -> Column:
    """The expected amounts: the transaction's own, once per step."""
    return F.array_repeat(F.col(amount), steps)
