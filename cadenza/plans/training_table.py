"""From the input tables to the training table (C7 -> C1-C3 -> C4-C6 -> C8)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cadenza.operators.base import base_transactions
from cadenza.operators.clusters import cluster_counterparties
from cadenza.operators.rules import reset_blocked
from cadenza.operators.series import label_cycles
from cadenza.session import cut


def training_table(
    tables: dict[str, DataFrame],
    *,
    base: dict | None = None,
    rules: dict | None = None,
    labelling: dict | None = None,
) -> DataFrame:
    """Labelled transactions.

    The columns of the base table travel with each row through clustering and
    labelling, so the labels need no join back and no row is multiplied or lost.
    """
    rows = cut(base_transactions(tables, **(base or {})))
    grouped = reset_blocked(cluster_counterparties(rows), **(rules or {}))
    return label_cycles(cut(grouped), **(labelling or {})).drop("user_account_id", "transaction_pending_id")
