"""The search in rounds gets rows of days that a cycle could need only."""

import random
from datetime import date, timedelta

import pyarrow as pa

from cadenza.operators import series

SCHEMA = "user_account_id string, counterparty_cluster string, transaction_pending_id string, date date, signed_amount double"
START = date(2024, 3, 1)


def row(group, number, day, amount):
    return ("u", group, f"{group}{number}", START + timedelta(days=day), amount)


def test_only_rows_in_reach_are_searched(spark, monkeypatch):
    # Three days a week apart, two rows that compete for them, and days that lead nowhere.
    rows = [row("a", i, day, float(i)) for i, day in enumerate([0, 7, 9, 14, 16, 200, 500, 504, 900])]
    rows += [row("none", i, 3 * i * i * i + 100 * i, 1.0) for i in range(9)]
    brought, in_rounds = [], series._search_in_rounds

    def recorded(thin, cap, *near):
        brought.extend((r[0], (r[1] - START).days) for r in thin.select("counterparty_cluster", "date").collect())
        return in_rounds(thin, cap, *near)

    monkeypatch.setattr(series, "_search_in_rounds", recorded)
    df = spark.createDataFrame(rows, SCHEMA)
    found = series.label_cycles(df, group_limit=3)
    got, whole = ({tuple(r) for r in f.collect()} for f in (found, series.label_cycles(df)))
    assert got == whole and len(got) == len(rows)
    assert sorted(brought) == [("a", day) for day in (0, 7, 9, 14, 16)]


def test_reach_of_days():
    """Against the rule stated day by day; groups of one batch do not touch each other."""
    rng = random.Random(3)
    groups = [sorted(rng.sample(range(0, 600, 2), rng.randrange(0, 30))) for _ in range(60)]
    groups[7:9] = [[0, 14, 28], [42, 56]]
    got = series._reach.func(pa.array(groups, pa.list_(pa.int32())).slice(3)).to_pylist()
    seen = 0
    for days, found in zip(groups[3:], got, strict=True):
        wanted = []
        for which, (period, error) in enumerate(series._HALF_DAYS):
            window = {d: [x for x in days if abs(x - d - period) <= error] for d in days}
            starts = {d for d in days if any(window[x] for x in window[d])}
            second = {x for d in starts for x in window[d]}
            needed = starts | second | {x for d in second for x in window[d]}
            wanted += [{"which": which, "day": d, "start": d in starts, "next": window[d]} for d in sorted(needed)]
        assert found == wanted
        seen += len(wanted)
    assert seen > 20
    assert series._reach.func(pa.array([[], [None]], pa.list_(pa.int32()))).to_pylist() == [[], []]
