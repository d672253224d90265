"""Predictions that did not arrive, live: a keyed state with event-time timers.

A cycle's state is its open prediction, and how many days late that was reported; the
states of a hash bucket of cycles are one key's, with a timer for the first day on which
one of them is due.  When event time passes the predicted date without another transaction of the
cycle, a timer sends the prediction again with its date moved by a day, for up to
``SHIFT_DAYS`` days, while the stored date stays; after that the cycle is
``model_deleted`` and its state is removed.

Event time decides, not the order of arrival: rows wait in the state until the watermark
has reached their date, and are taken in order of date then, with the timers between
them.  So shuffled rows give the same result as sorted ones.  Of rows of one date the
one with the largest transaction id counts, and the others are forgotten at once: the
state holds a row of a cycle for each day of the watermark's delay at most.  Rows behind the
watermark come out as ``late`` and change nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from cadenza import fixed
from cadenza.operators.positions import CYCLE
from cadenza.streaming.keyed import PackedRows, bucket_of, reached_day, run, wake_on, with_event_day, written

_CYCLE = "user_id string, account_id string, cycle_id string"
_GIVEN = f"{_CYCLE}, day int, predicted int, transaction_id string, amount double"
#: ``sent`` is missing where the day is not reached yet.
_STATE = f"{_GIVEN}, sent int"
_OUT = (
    "user_id string, account_id string, cycle_id string, transaction_id string, day int, predicted int,"
    " sent int, amount double, days_late int, status string"
)
EMITTED = (
    "user_id string, account_id string, cycle_id string, transaction_id string, date date, predicted_date date,"
    " sent_date date, predicted_signed_amount double, days_late int, status string"
)


BUCKETS = 512


def _names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


class Expiry(StatefulProcessor):
    """The open predictions of a bucket's cycles, and rows whose day is not reached yet."""

    def __init__(self, days: int):
        self.days = days

    def init(self, handle) -> None:
        self.handle = handle
        self.state = PackedRows(handle, "cycles", _STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        reached = reached_day(timerValues)
        open_, waiting, wake = self._known()
        for part in rows:
            late = []
            for r in zip(*(part[c].tolist() for c in _names(_GIVEN)), strict=True):
                if reached is not None and r[3] <= reached:
                    late.append((*r[:3], r[5], r[3], r[4], None, r[6], None, "late"))
                else:
                    _wait(waiting, r[:3], r[3:])
            if late:
                yield _frame(late)
        yield self._advanced(open_, waiting, wake, reached)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        open_, waiting, wake = self._known()
        reached = reached_day(timerValues)
        # Another timer of this step has done it where nothing is due any more.
        yield _frame([]) if wake is None or wake > reached else self._advanced(open_, waiting, None, reached)

    def _known(self) -> tuple[dict, dict, int | None]:
        """Open predictions and waiting rows by cycle, and the first day on which something is due."""
        open_: dict[tuple, tuple] = {}
        waiting: dict[tuple, dict[int, tuple]] = {}
        for r in self.state.rows():
            if r[-1] is None:
                _wait(waiting, r[:3], r[3:-1])
            else:
                open_[r[:3]] = r[3:]
        return open_, waiting, _first_due(open_, waiting)

    def _advanced(self, open_: dict, waiting: dict, wake: int | None, reached: int | None) -> pd.DataFrame:
        """What is sent up to the day reached; ``wake``: the day for which a timer is set."""
        out = []
        for cycle in dict.fromkeys([*open_, *waiting]):
            one, best = open_.pop(cycle, None), waiting.pop(cycle, {})
            days = sorted(best)
            while reached is not None:
                due = _due(one) if one else None
                if days and days[0] <= reached and (due is None or days[0] <= due):
                    one = (*best[days.pop(0)], 0)
                elif due is not None and due <= reached:
                    day, predicted, transaction, amount, sent = one
                    gone = sent == self.days
                    out.append((*cycle, transaction, day, predicted, None if gone else due, amount, sent + 1, "model_deleted" if gone else "active"))
                    one = None if gone else (day, predicted, transaction, amount, sent + 1)
                else:
                    break
            if one:
                open_[cycle] = one
            if days:
                waiting[cycle] = {d: best[d] for d in days}
        self.state.put([(*c, *one) for c, one in open_.items()] + [(*c, *r, None) for c, best in waiting.items() for r in best.values()])
        first = _first_due(open_, waiting)
        if first is not None and first != wake:
            wake_on(self.handle, first)
        return _frame(out)

    def close(self) -> None:
        pass


def _wait(waiting: dict, cycle: tuple, row: tuple) -> None:
    """Of a cycle's rows of one day the one with the largest transaction id counts."""
    best = waiting.setdefault(cycle, {})
    if row[0] not in best or best[row[0]][2] < row[2]:
        best[row[0]] = row


def _due(one: tuple) -> int:
    return one[1] + one[4] + 1


def _first_due(open_: dict, waiting: dict) -> int | None:
    return min([*map(_due, open_.values()), *(min(best) for best in waiting.values())], default=None)


def _frame(out: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(out, columns=_names(_OUT)).astype({c: "Int32" for c in ("day", "predicted", "sent", "days_late")})


def late_payments(upcoming: DataFrame, delay_days: int, days: int = fixed.SHIFT_DAYS, buckets: int = BUCKETS) -> DataFrame:
    """A stream of predictions (user, account, cycle, transaction, date, predicted date and amount)
    as the stream of what is sent about those that do not arrive, and of late rows."""
    rows = with_event_day(upcoming, delay_days).select(
        *CYCLE,
        "day",
        F.unix_date("predicted_date").alias("predicted"),
        "transaction_id",
        F.col("predicted_signed_amount").alias("amount"),
    )
    # Rows without a date have no place in event time, and those without a predicted one nothing to wait for.
    rows = rows.where("day IS NOT NULL AND predicted IS NOT NULL AND transaction_id IS NOT NULL")
    sent = rows.withColumn("bucket", bucket_of(CYCLE, buckets)).groupBy("bucket").transformWithStateInPandas(Expiry(days), _OUT, "update", "eventTime")
    date = lambda c: F.date_from_unix_date(c)
    return sent.select(
        *CYCLE, "transaction_id", date("day").alias("date"), date("predicted").alias("predicted_date"), date("sent").alias("sent_date"),
        F.col("amount").alias("predicted_signed_amount"), "days_late", "status",
    )


def start(upcoming: DataFrame, base: str, delay_days: int, days: int = fixed.SHIFT_DAYS, **trigger) -> StreamingQuery:
    """Runs :func:`late_payments` into folders below ``base``; started again it goes on from there."""
    return run(late_payments(upcoming, delay_days, days), base, "late-payments", trigger)


def emitted(spark: SparkSession, base: str) -> DataFrame:
    return written(spark, base, "late-payments", EMITTED).drop("batch")
