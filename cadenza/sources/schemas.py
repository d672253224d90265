"""Table catalogue: column types and renames of the seven input tables."""

from __future__ import annotations

_USERS = "id string, country_code string, client_id string"
_ACCOUNTS = "id string, user_id string, deleted string, type string"
_TRANSACTIONS = (
    "user_id string, account_id string, transaction_id string, date date, pending boolean,"
    " counterparty string, is_merchant boolean, cycle_id string, description string,"
    " amount double, transaction_type string, internal_transaction boolean"
)

SCHEMAS = {
    "users_app": _USERS,
    "test_users_app": "user_id string",
    "accounts_app": _ACCOUNTS,
    "transactions_app": _TRANSACTIONS,
    "users_partner": _USERS,
    "accounts_partner": _ACCOUNTS,
    "transactions_partner": _TRANSACTIONS,
}

RENAMED = {
    "users_app": {"id": "user_id"},
    "accounts_app": {"id": "account_id"},
    "users_partner": {"id": "user_id"},
    "accounts_partner": {"id": "account_id"},
}

# The app transactions lie in Hive-style folders year=/month=.
PARTITIONS = {"transactions_app": "year int, month int"}


def column_names(table: str) -> list[str]:
    return [field.split()[0] for field in SCHEMAS[table].split(",")]
