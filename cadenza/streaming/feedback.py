"""Predictions and user feedback as two streams over one keyed state.

The state of a cycle is its latest prediction and its latest feedback event; the states of
a hash bucket of cycles are one key's.  Both are
maxima of what came, over orders that the rows carry themselves, so the state does not
depend on which stream is read first, in which order rows come or how often.  After
every change the merged row of the cycle is sent again; of a cycle the row of the last
batch holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from cadenza.operators.positions import CYCLE
from cadenza.streaming.keyed import PackedRows, bucket_of, run, written

#: A prediction and a feedback event; their fields from the first on order them.
_PREDICTION = "predicted long, day long, transaction_id string, amount double, description string"
_FEEDBACK = "at long, event_id long, kind string, day long, amount double, description string, period long"
#: Stands for a missing whole number: pandas would turn a column with nulls into floats.
NONE = -(1 << 62)
_CYCLE = "user_id string, account_id string, cycle_id string"
#: A row of the state: which of the two it is (0, 1), then the fields of both; the other's are missing.
_STATE = f"{_CYCLE}, which int, " + ", ".join(
    f"{side}_{f}" for side, fields in (("p", _PREDICTION), ("f", _FEEDBACK)) for f in fields.split(", ")
)
BUCKETS = 512
_MERGED = f"{_CYCLE}, day int, predicted int, amount double, description string, status string"
STATE = (
    "user_id string, account_id string, cycle_id string, date date, predicted_date date,"
    " predicted_signed_amount double, predicted_description string, status string"
)


def _names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


_COLUMNS = list(dict.fromkeys(_names(_PREDICTION) + _names(_FEEDBACK)))


def _larger(old: tuple | None, new: tuple) -> tuple:
    return new if old is None or _order(new) > _order(old) else old


def _order(row: tuple) -> tuple:
    """Nulls come first, as in the batch form."""
    return tuple((v is not None, v) for v in row)


class Merge(StatefulProcessor):
    """Latest prediction and latest feedback of each cycle of a bucket."""

    def init(self, handle) -> None:
        self.state = PackedRows(handle, "cycles", _STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        latest: dict[tuple, list[tuple | None]] = {}
        for r in self.state.rows():
            latest.setdefault(r[:3], [None, None])[r[3]] = r[4:9] if r[3] == 0 else r[9:]
        touched: dict[tuple, None] = {}
        for part in rows:
            for *cycle, is_feedback, row in zip(
                *(part[c].tolist() for c in _names(_CYCLE)), part["is_feedback"].tolist(), part[_COLUMNS].itertuples(index=False, name=None), strict=True
            ):
                cycle = tuple(cycle)
                given = dict(zip(_COLUMNS, (None if v == NONE or v != v else v for v in row), strict=True))
                names = _names(_FEEDBACK if is_feedback else _PREDICTION)
                known = latest.setdefault(cycle, [None, None])
                known[int(is_feedback)] = _larger(known[int(is_feedback)], tuple(given[n] for n in names))
                touched[cycle] = None
        none = (None,) * len(_names(_PREDICTION)), (None,) * len(_names(_FEEDBACK))
        self.state.put(
            [(*c, 0, *p, *none[1]) for c, (p, _) in latest.items() if p] + [(*c, 1, *none[0], *f) for c, (_, f) in latest.items() if f]
        )
        merged = pd.DataFrame([(*c, *self._merged(*latest[c])) for c in touched], columns=_names(_MERGED))
        yield merged.astype({"day": "Int32", "predicted": "Int32"})

    @staticmethod
    def _merged(prediction: tuple | None, feedback: tuple | None) -> tuple:
        kind = feedback[2] if feedback else None
        if kind == "confirm":
            _, _, _, day, amount, description, period = feedback
            ahead = None if day is None or period is None else day + period
            return day, ahead, amount, description, "manual"
        if prediction is None:
            return (None,) * 5  # nothing is predicted, or not any more
        predicted, day, _, amount, description = prediction
        return day, predicted, amount, description, "user_deleted" if kind == "delete" else "active"

    def close(self) -> None:
        pass


def merged(upcoming: DataFrame, feedback: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Two streams as one of merged rows.

    ``upcoming``: cycle, date, transaction, predicted date, amount and description.
    ``feedback``: cycle, ``at`` (time), ``event_id``, ``kind``, ``date``, ``signed_amount``,
    ``description``, ``period_days``.
    """
    def rows_of(df: DataFrame, is_feedback: bool, **given) -> DataFrame:
        kinds = dict(f.split() for f in f"{_PREDICTION}, {_FEEDBACK}".split(", "))
        values = {c: given.get(c, F.lit(None)).cast(kind) for c, kind in kinds.items()}
        values = {c: F.coalesce(v, F.lit(NONE)) if kinds[c] == "long" else v for c, v in values.items()}
        return df.where("cycle_id IS NOT NULL").select(*CYCLE, F.lit(is_feedback).alias("is_feedback"), *(values[c].alias(c) for c in _COLUMNS))

    left = rows_of(
        upcoming.where("predicted_date IS NOT NULL"), False, predicted=F.unix_date("predicted_date"), day=F.unix_date("date"),
        transaction_id=F.col("transaction_id"), amount=F.col("predicted_signed_amount"), description=F.col("predicted_description"),
    )
    right = rows_of(
        feedback, True, at=F.unix_micros(F.col("at").cast("timestamp")), event_id=F.col("event_id"), kind=F.col("kind"),
        day=F.unix_date("date"), amount=F.col("signed_amount"), description=F.col("description"), period=F.col("period_days"),
    )
    rows = left.unionByName(right).withColumn("bucket", bucket_of(CYCLE, buckets)).groupBy("bucket")
    rows = rows.transformWithStateInPandas(Merge(), _MERGED, "update", "none")
    return rows.select(
        *CYCLE,
        F.date_from_unix_date("day").alias("date"),
        F.date_from_unix_date("predicted").alias("predicted_date"),
        F.col("amount").alias("predicted_signed_amount"),
        F.col("description").alias("predicted_description"),
        "status",
    )


def start(upcoming: DataFrame, feedback: DataFrame, base: str, **trigger) -> StreamingQuery:
    """Runs :func:`merged` into folders below ``base``; started again it goes on from there."""
    return run(merged(upcoming, feedback), base, "feedback", trigger)


def state(spark: SparkSession, base: str) -> DataFrame:
    """The rows that hold: of each cycle the last one sent, where something is predicted."""
    rows = written(spark, base, "feedback", STATE)
    others = [c for c in rows.columns if c not in (*CYCLE, "batch")]
    last = rows.groupBy(*CYCLE).agg(F.max_by(F.struct(*others), "batch").alias("last")).select(*CYCLE, "last.*")
    return last.where("status IS NOT NULL")
