"""The search in rounds goes on with the groups that began a cycle only."""

from datetime import date, timedelta

from pyspark.sql import functions as F

from cadenza.operators import series


def test_rounds_leave_groups_without_a_start(spark, monkeypatch):
    rows = [("u", "weekly", f"w{i}", date(2024, 3, 1) + timedelta(days=7 * i), 1, 1.0) for i in range(4)]
    rows += [("u", "none", f"n{i}", date(2024, 3, 1) + timedelta(days=i), 1, 1.0) for i in range(3)]
    thin = spark.createDataFrame(rows, "user_account_id string, counterparty_cluster string, transaction_pending_id string, date date, _again int, signed_amount double")
    seen, first_start = [], series._first_start

    def recorded(free, after, period, error):
        seen.append((period, free.select("g").distinct().count()))
        return first_start(free, after, period, error)

    monkeypatch.setattr(series, "_first_start", recorded)
    found = series._search_in_rounds(thin, 2)
    assert sorted(r.date for r in found.where(F.col("cycle_id").isNotNull()).collect()) == [r[3] for r in rows[:4]]
    weekly = [groups for period, groups in seen if period == 14]
    assert weekly[0] == 2 and max(weekly[1:]) < 2
