import random
from datetime import date, timedelta

import duckdb
import pytest
from pyspark.sql import functions as F

from cadenza.functions.keys import same_key
from cadenza.operators import series
from cadenza.operators.series import find_cycles, label_cycles
from cadenza.queries.labelling import _LABEL_COLUMNS, labels_sql

START = date(2020, 1, 1)


def frame(spark, rows):
    """rows: (account, cluster, id, day offset, amount)."""
    data = [(a, c, i, START + timedelta(days=d), float(m)) for a, c, i, d, m in rows]
    return spark.createDataFrame(
        data, "user_account_id string, counterparty_cluster int, transaction_pending_id string, date date, signed_amount double"
    )


def labels(df, **kwargs):
    rows = label_cycles(df, **kwargs).collect()
    return {(r.user_account_id, r.transaction_pending_id): (r.cycle_id, r.cycle_period) for r in rows}


def halves(days):
    return [2 * d for d in days]


def random_groups(seed, groups=40, ids=None):
    rng = random.Random(seed)
    rows = []
    for g in range(groups):
        span, amounts = rng.choice([20, 60, 220]), rng.choice([2, 6, 40])
        for i in range(rng.randint(1, 40)):
            key = f"{i:03}" if ids is None else f"k{rng.randrange(ids)}"
            rows.append((f"a{g}", rng.choice([1, 1, 2]), key, rng.randrange(span), rng.randrange(amounts)))
    return rows


def by_sql(rows):
    """The labels that recursive SQL finds, as sorted rows."""
    con = duckdb.connect()
    con.execute("create table t (user_account_id varchar, counterparty_cluster int, transaction_pending_id varchar, date date, signed_amount double)")
    con.executemany("insert into t values (?, ?, ?, ?, ?)", [(a, c, i, START + timedelta(days=d), m) for a, c, i, d, m in rows])
    return sorted(map(str, con.execute(f"with recursive {labels_sql('select * from t')} select {_LABEL_COLUMNS} from with_labels").fetchall()))


@pytest.mark.parametrize("limit", [series.GROUP_LIMIT, 4])
@pytest.mark.parametrize("ids", [None, 2])
def test_random_groups_against_sql(spark, limit, ids):
    """Small and big groups, with and without repeated keys, have one result."""
    rows = random_groups(11 + limit % 7, ids=ids)
    found = label_cycles(frame(spark, rows), group_limit=limit).selectExpr(*_LABEL_COLUMNS.split(", ")).collect()
    assert sorted(str(tuple(r)) for r in found) == by_sql(rows)


def test_rounds_do_not_grow_with_rows(spark, monkeypatch):
    """Two crowded days and one follower: the number of tables written stays."""
    written = []
    monkeypatch.setattr(series, "cut", lambda df, keep=series.cut: written.append(1) or keep(df))
    counts = []
    for crowd in (20, 400):
        rows = [("u", 1, f"{d}-{i}", d, i) for d in (0, 7) for i in range(crowd)] + [("u", 1, "z", 14, 3)]
        written.clear()
        found = labels(frame(spark, rows), group_limit=7)
        assert sum(c is not None for c, _ in found.values()) == 3
        counts.append(len(written))
    assert counts[0] == counts[1]


def test_worked_example():
    days = [0, 7, 14, 21, 31, 60]
    assert [c >= 0 for c in find_cycles(halves(days), [5.0] * 6)] == [True] * 4 + [False] * 2


def test_two_rows_are_too_short():
    assert find_cycles([0, 14], [1.0, 1.0]) == [-1, -1]


def test_nearest_amount_and_first_on_tie():
    days = halves([0, 7, 7, 14])
    assert [c >= 0 for c in find_cycles(days, [10.0, 30.0, 11.0, 10.0])] == [True, False, True, True]
    assert [c >= 0 for c in find_cycles(days, [10.0, 11.0, 9.0, 10.0])] == [True, True, False, True]


def test_failed_series_frees_its_rows():
    # 0 and 7 do not make a weekly series; 0, 14, 28 are a biweekly one.
    days = halves([0, 7, 14, 28])
    assert [c % 5 if c >= 0 else None for c in find_cycles(days, [1.0] * 4)][0] is not None


def test_cap_and_noise_and_null_cluster(spark):
    three = [("u", 0, f"{p}{k}", p + 7 * k, 1 + 100 * p) for p in range(3) for k in range(3)]
    noise = [("u", -1, f"n{k}", 7 * k, 5) for k in range(3)]
    empty = [("v", None, f"e{k}", 14 * k, 5) for k in range(3)]
    df = frame(spark, three + noise + empty)
    found = labels(df)
    assert len(found) == df.count()
    assert all(found["u", f"{p}{k}"][0] is None for p in range(3) for k in range(3))
    assert found["u", "n0"] == ("ux-1_0", 7.0)
    assert found["v", "e2"] == ("vx_0", 14.0)
    quiet = labels(df, search_noise=False)
    assert quiet["u", "n0"] == (None, None) and len(quiet) == len(found)


def test_big_groups_by_thinning_and_certainty(spark):
    """Hot groups: labels equal those of the search in one piece."""
    rng = random.Random(3)
    rows = []
    for account in range(6):
        span = (20, 40, 9, 16, 60, 30)[account]
        rows += [(f"a{account}", 1, f"{i:04}", rng.randrange(span), rng.choice([5, 5, 5, 9])) for i in range(120)]
    # A hot day, copied a thousand times, with a short series behind it.
    rows += [("hot", 1, f"h{i:05}", 0, 5) for i in range(1000)] + [("hot", 1, "x1", 7, 5), ("hot", 1, "x2", 14, 5)]
    df = frame(spark, rows)
    assert labels(df, group_limit=100) == labels(df)


def test_big_groups_in_rounds(spark):
    """What is neither small nor certain is searched in rounds, alike."""
    rows = [("r", 1, f"{i:02}", d, m) for i, (d, m) in enumerate(
        [(0, 5), (1, 50), (7, 6), (8, 49), (14, 5), (21, 5), (29, 7), (60, 4), (90, 5), (121, 5)])]
    rows += [("s", None, f"{i:02}", d, 5) for i, d in enumerate([0, 14, 28, 42, 45])]
    df = frame(spark, rows)
    assert labels(df, group_limit=3) == labels(df)


def test_certainty_is_never_wrong():
    rng = random.Random(5)
    judge = series._certainly_beyond(2).func
    import pyarrow as pa

    for _ in range(300):
        days = sorted(rng.randrange(40) for _ in range(rng.randrange(3, 80)))
        amounts = [float(rng.randrange(1, 9)) for _ in days]
        counts = {d: days.count(d) for d in days}
        sure = judge(pa.array([[2 * d for d in counts]]), pa.array([list(counts.values())]))[0].as_py()
        if sure:
            assert find_cycles([2 * d for d in days], amounts, 2) == [-1] * len(days)


def test_cap_on_given_labels_with_null_group(spark):
    df = spark.createDataFrame(
        [("u", None, "a"), ("u", None, "b"), ("u", None, "c"), ("u", 1, "d")], "user_account_id string, g int, cycle_id string"
    )
    kept = series.cap_cycles(df, ["user_account_id", "g"]).where(F.col("cycle_id").isNotNull()).collect()
    assert [r.cycle_id for r in kept] == ["d"]


def test_only_changed_groups_are_searched_again(spark):
    from cadenza.plans.repair import LabelStore
    from cadenza.session import work_path

    rng = random.Random(12)
    schema = "user_account_id string, counterparty_cluster string, transaction_pending_id string, date date, signed_amount double, note string"
    rows = []
    for g in range(12):
        for i in range(rng.randint(3, 9)):
            day = date(2022, 1, 1) + timedelta(days=7 * i + (rng.randrange(3) if g % 3 else 0))
            rows.append((f"a{g % 5}", None if g == 4 else f"c{g}", f"{g}-{i}", day, 10.0, "n"))
    store = LabelStore(work_path(spark, "labels"))

    def check(given, changed):
        df = spark.createDataFrame(rng.sample(given, len(given)), schema)
        run = store.update(df)
        assert {tuple(r) for r in store.searched(spark, run).collect()} == changed
        whole = label_cycles(df)
        assert sorted(map(str, store.labelled(spark, run).select(*whole.columns).collect())) == sorted(map(str, whole.collect()))

    groups = {r[:2] for r in rows}
    check(rows, groups)
    check(rows, set())
    more = (*rows[0][:2], "new", rows[0][3] + timedelta(days=70), 10.0, "n")
    check([*rows, more], {rows[0][:2]})
    # Equal rows in place of others, a group that goes, and one that comes back.
    gone = [r for r in rows if r[:2] != rows[-1][:2]]
    check([gone[0] if r == gone[1] else r for r in gone], {rows[0][:2]})
    check(rows, {rows[0][:2], rows[-1][:2]})


def test_first_run_joins_nothing_and_newest_rows_are_not_looked_up(spark, monkeypatch):
    from cadenza.plans import repair
    from cadenza.session import work_path

    def rows(longer):
        data = [(a, "c", f"{i:03}", START + timedelta(days=7 * i), 1.0) for a in "uv" for i in range(4 + (a in longer))]
        return spark.createDataFrame(data, "user_account_id string, counterparty_cluster string, transaction_pending_id string, date date, signed_amount double")

    joined = []
    monkeypatch.setattr(repair, "same_key", lambda *args: joined.append(args) or same_key(*args))
    store = repair.LabelStore(work_path(spark, "labels"))
    store.update(rows(""))
    assert joined == []
    run = store.update(rows("v"))
    assert [tuple(r) for r in store.searched(spark, run).collect()] == [("v", "c")]
    labelled = store.labelled(spark, run)
    assert sorted(map(str, labelled.collect())) == sorted(map(str, label_cycles(rows("v")).select(*labelled.columns).collect()))
    # The join reads folders of earlier runs alone, and index rows of theirs.
    plan = labelled._jdf.queryExecution().optimizedPlan().toString()
    assert f"< {run})" in plan and f"= {run})" in plan
