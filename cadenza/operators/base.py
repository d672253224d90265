"""Base transaction table of two tenants."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza import fixed
from cadenza.functions.amounts import signed_amount
from cadenza.functions.keys import account_key, transaction_key
from cadenza.operators.sampling import keep_fraction

BASE_COLUMNS = [
    "user_id",
    "account_id",
    "transaction_id",
    "date",
    "pending",
    "signed_amount",
    "counterparty",
    "is_merchant",
    "description",
    "cycle_id",
    "origin",
]


def eligible_users(
    users: DataFrame, countries, *, client_ids=None, test_users: DataFrame | None = None
) -> DataFrame:
    """Users of the countries (and clients), without the test users."""
    chosen = users.where(F.col("country_code").isin(*countries))
    if client_ids is not None:
        chosen = chosen.where(F.col("client_id").isin(*client_ids))
    if test_users is not None:
        chosen = chosen.join(test_users.select("user_id").distinct(), "user_id", "left_anti")
    return chosen


def sample_users(users: DataFrame, wanted: int | None, seed: int = fixed.SAMPLE_SEED) -> DataFrame:
    """Keep about ``wanted`` users, by a hash of the id: the same users on every
    run, executor loss or not.  ``None`` keeps all."""
    if wanted is None:
        return users
    total = users.count()
    fraction = min(1.0, round(wanted / total, 4)) if total else 1.0
    if fraction == 1.0:
        return users
    return keep_fraction(users, fraction, ["user_id"], seed)


def defined_transactions(transactions: DataFrame, first=None, last=None) -> DataFrame:
    """Transactions with a type and a counterparty, dated first..last."""
    kept = transactions.where(
        F.col("transaction_type").isNotNull()
        & F.col("counterparty").isNotNull()
        & (F.trim("counterparty") != "")
    )
    if first is not None:
        kept = kept.where(F.col("date") >= F.lit(first).cast("date"))
    if last is not None:
        kept = kept.where(F.col("date") <= F.lit(last).cast("date"))
    return kept.withColumn("signed_amount", signed_amount())


def _tenant(transactions: DataFrame, users: DataFrame, accounts: DataFrame, origin: str) -> DataFrame:
    """Transactions of chosen users and live accounts.

    Users and accounts meet first: that result is small beside the transactions,
    which then pass through one join.  Spark broadcasts it when its measured size
    allows, and else splits hot users over tasks.
    """
    live = accounts.where(F.col("deleted").isNull()).select("user_id", "account_id")
    owners = users.select("user_id").join(live, "user_id")
    return (
        transactions.join(owners, ["user_id", "account_id"])
        .withColumn("origin", F.lit(origin))
        .select(*BASE_COLUMNS)
    )


def base_transactions(
    tables: dict[str, DataFrame],
    *,
    partner_client_ids,
    app_countries=fixed.APP_COUNTRIES,
    app_client_ids=None,
    partner_countries=fixed.PARTNER_COUNTRIES,
    first=fixed.APP_START_DATE,
    last=fixed.APP_END_DATE,
    app_users: int | None = None,
    partner_users: int | None = None,
    seed: int = fixed.SAMPLE_SEED,
) -> DataFrame:
    """The base table, one lazy plan (sampling counts its users first).

    ``partner_client_ids`` names the clients of the partner tenant, ``None`` for all.
    All users are kept unless a number is asked for; the numbers of the specification
    are in `fixed`.
    """
    app_chosen = sample_users(
        eligible_users(
            tables["users_app"], app_countries, client_ids=app_client_ids, test_users=tables["test_users_app"]
        ),
        app_users,
        seed,
    )
    partner_chosen = sample_users(
        eligible_users(tables["users_partner"], partner_countries, client_ids=partner_client_ids), partner_users, seed
    )
    app = _tenant(
        defined_transactions(tables["transactions_app"], first, last), app_chosen, tables["accounts_app"], "app"
    )
    partner = _tenant(defined_transactions(tables["transactions_partner"]), partner_chosen, tables["accounts_partner"], "partner")
    return (
        app.unionByName(partner)
        .dropDuplicates()
        .withColumnRenamed("cycle_id", "old_cycle_id")
        .withColumn("user_account_id", account_key())
        .withColumn("transaction_pending_id", transaction_key())
    )


