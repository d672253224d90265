"""Identity of accounts, transactions and cycles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def account_key(user="user_id", account="account_id") -> Column:
    return F.concat(F.col(user), F.lit("|"), F.col(account))


def transaction_key(transaction="transaction_id", pending="pending") -> Column:
    """``id|pending``; a missing flag becomes an empty text, not a null key."""
    return F.concat(
        F.col(transaction),
        F.lit("|"),
        F.coalesce(F.col(pending).cast("string"), F.lit("")),
    )


def cycle_key(account: Column, cluster: Column, number: Column) -> Column:
    return F.concat(
        account,
        F.lit("x"),
        F.coalesce(cluster.cast("string"), F.lit("")),
        F.lit("_"),
        number.cast("string"),
    )


def new_cycle_key(user="user_id", account="account_id", transaction="transaction_id") -> Column:
    """A repeatable id for a cycle opened by one transaction."""
    return F.sha2(F.concat_ws("|", F.col(user), F.col(account), F.col(transaction), F.lit("new")), 256)


def spread(*keys: str, seed: int | None = None) -> Column:
    """60 hash bits of a key and an optional seed: the same on every run and in
    any engine that knows md5."""
    text = F.concat_ws("|", *[F.col(k) for k in keys], *([F.lit(str(seed))] if seed is not None else []))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


SPREAD_RANGE = 1 << 60


def same_key(left: str, right: str, keys: list[str]) -> Column:
    """Join condition on key columns of two aliases; a null key equals a null.

    The first key is never null (an account), so it stays a plain equality.
    """
    condition = F.col(f"{left}.{keys[0]}") == F.col(f"{right}.{keys[0]}")
    for key in keys[1:]:
        condition = condition & F.col(f"{left}.{key}").eqNullSafe(F.col(f"{right}.{key}"))
    return condition
