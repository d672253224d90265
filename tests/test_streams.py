"""Keyed streams against plain loops: shuffled rows, late rows, restarts, interleavings."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from cadenza.plans import lifecycle
from cadenza.operators.positions import latest_per_cycle
from cadenza.session import work_path
from cadenza.streaming import expiry, feedback, order
from cadenza.streaming.keyed import run, written

START = date(2024, 3, 1)
UPCOMING = "user_id string, account_id string, cycle_id string, transaction_id string, date date, predicted_date date, predicted_signed_amount double, predicted_description string"


def day(n):
    return START + timedelta(days=n)


def in_files(spark, rows, schema, parts, path, one_by_one):
    """A stream of ``rows`` in files that are read one per micro-batch, or in runs of their own."""
    size = -(-len(rows) // parts)
    for i in range(parts):
        spark.createDataFrame(rows[i * size : (i + 1) * size], schema).coalesce(1).write.mode("append").parquet(f"{path}/part={i}")
        if not one_by_one:
            yield i
    if one_by_one:
        yield parts


def sent_by_hand(rows, delay, batches):
    """(cycle, transaction, days late, status) and late transactions, day by day."""
    reached, late, seen = None, set(), []
    size = -(-len(rows) // batches)
    for i in range(batches):
        part = rows[i * size : (i + 1) * size]
        late |= {r[3] for r in part if reached is not None and r[4] <= reached}
        seen += [r for r in part if reached is None or r[4] > reached]
        reached = max([r[4] for r in rows[: (i + 1) * size]]) - timedelta(days=delay)
    out = set()
    for cycle in {r[:3] for r in seen}:
        mine = sorted((r for r in seen if r[:3] == cycle), key=lambda r: (r[4], r[3]))
        mine = [r for r, after in zip(mine, [*mine[1:], None], strict=True) if after is None or after[4] != r[4]]
        for r, after in zip(mine, [*mine[1:], None], strict=True):
            for k in range(1, 5):
                due = r[5] + timedelta(days=k)
                if due <= reached and (after is None or after[4] > due):
                    out.add((cycle[2], r[3], k, "active" if k < 4 else "model_deleted"))
    return out, late


@pytest.mark.parametrize("restarts", [True, False])
def test_late_payments_by_event_time(spark, tmp_path, restarts):
    rng = random.Random(4)
    rows = []
    for n in range(160):
        at = day(rng.randrange(60))
        rows.append(("u", "a", f"c{rng.randrange(9)}", f"{n:03}", at, at + timedelta(days=rng.choice([5, 7])), float(n), "text"))
    arrival = {r[3]: r[4] + timedelta(days=rng.choice([0, 1, 3, 15])) for r in rows}
    rows.sort(key=lambda r: (arrival[r[3]], r[3]))
    base = work_path(spark, "expiry")
    for _ in in_files(spark, rows, UPCOMING, 4, str(tmp_path), not restarts):
        stream = spark.readStream.schema(UPCOMING).option("maxFilesPerTrigger", 1).parquet(str(tmp_path))
        expiry.start(stream, base, 3).awaitTermination()
    found = expiry.emitted(spark, base).collect()
    wanted, late = sent_by_hand(rows, 3, 4)
    assert late and {r.transaction_id for r in found if r.status == "late"} == late
    assert {(r.cycle_id, r.transaction_id, r.days_late, r.status) for r in found if r.status != "late"} == wanted
    assert len(found) == len(late) + len(wanted) and {k for *_, k, _ in wanted} == {1, 2, 3, 4}
    for r in found:
        if r.status == "active":
            assert r.sent_date == r.predicted_date + timedelta(days=r.days_late)
        else:
            assert r.sent_date is None


def test_rows_without_dates_or_at_the_end(spark, tmp_path):
    rows = [("u", "a", "c", "1", day(0), None, 1.0, "x"), ("u", "a", "c", "2", None, day(3), 1.0, "x"), ("u", "a", "c", "3", day(1), day(3), None, "x"), ("u", "a", "d", "4", day(30), day(37), 1.0, "x")]
    spark.createDataFrame(rows, UPCOMING).coalesce(1).write.parquet(str(tmp_path / "in"))
    base = work_path(spark, "expiry")
    expiry.start(spark.readStream.schema(UPCOMING).parquet(str(tmp_path / "in")), base, 0).awaitTermination()
    found = expiry.emitted(spark, base).orderBy("days_late").collect()
    assert [(r.transaction_id, r.days_late, r.predicted_signed_amount) for r in found] == [("3", k, None) for k in (1, 2, 3, 4)]


def test_order_and_null_values(spark, tmp_path):
    schema = "id string, account long, date date, value double, note string"
    rows = [(str(i), i % 3 if i % 5 else None, day((i * 7) % 30) if i % 11 else None, None if i % 4 else float(i), None if i % 2 else "n") for i in range(90)]
    base = work_path(spark, "order")
    for _ in in_files(spark, rows, schema, 3, str(tmp_path), True):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path))
        run(order.in_order(stream, ["account"], 4), base, "rows", {}).awaitTermination()
    found = written(spark, base, "rows", f"{schema}, late boolean").collect()
    given = {r[0]: r for r in rows}
    assert all(tuple(r)[:5] == given[r.id] for r in found)
    reached = day(29 - 4)
    late = {r[0] for i, r in enumerate(rows) if r[2] is None or (i >= 30 and r[2] <= reached)}
    assert {r.id for r in found if r.late} == late
    assert {r.id for r in found if not r.late} == {r[0] for r in rows if r[0] not in late and r[2] <= reached}


def test_feedback_in_any_order(spark, tmp_path):
    rng = random.Random(8)
    upcoming, events = [], []
    for n in range(60):
        cycle, at = f"c{rng.randrange(6)}", day(rng.randrange(20))
        upcoming.append(("u", "a", cycle, f"{n:03}", at, at + timedelta(days=7), float(n), f"p{n}"))
        cycle = f"c{rng.randrange(9)}"  # some that nothing predicts
        events.append(("u", "a", cycle, str(START) + f" 10:00:{n % 7:02}", n, rng.choice(["confirm", "delete", "seen"]), at, float(n), f"f{n}", rng.choice([30, None])))
    columns = "user_id string, account_id string, cycle_id string, at string, event_id long, kind string, date date, signed_amount double, description string, period_days int"
    batch = spark.createDataFrame(events, columns).withColumn("at", F.struct("at", "event_id"))
    wanted = lifecycle.with_feedback(latest_per_cycle(spark.createDataFrame(upcoming, UPCOMING)), batch)
    wanted = sorted(map(str, wanted.select(*feedback.state(spark, str(tmp_path / "none")).columns).collect()))
    for seed in range(3):
        base = work_path(spark, "feedback")
        random.Random(seed).shuffle(upcoming)
        random.Random(seed + 9).shuffle(events)
        left = spark.createDataFrame(upcoming, UPCOMING).coalesce(1)
        right = spark.createDataFrame(events, columns).withColumn("at", F.col("at").cast("timestamp")).coalesce(1)
        source = str(tmp_path / str(seed))
        for part in range(2):
            left.where(F.col("predicted_signed_amount") % 2 == part).write.mode("append").parquet(f"{source}/left")
            if part != seed:
                right.where(F.col("event_id") % 2 == part).write.mode("append").parquet(f"{source}/right")
            if seed == part == 1:
                right.where(F.col("event_id") % 2 == 1).write.mode("append").parquet(f"{source}/right")
            if part == 0 and seed == 0:
                right.limit(0).write.mode("append").parquet(f"{source}/right")
            if part == 1 and seed == 0:
                right.where(F.col("event_id") % 2 == 0).write.mode("append").parquet(f"{source}/right")
            streams = [spark.readStream.schema(df.schema).parquet(f"{source}/{name}") for df, name in ((left, "left"), (right, "right"))]
            feedback.start(*streams, base).awaitTermination()
        assert sorted(map(str, feedback.state(spark, base).collect())) == wanted
