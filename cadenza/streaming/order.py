"""Rows in order of event time, and those too late for it.

:func:`in_order` sorts the stream: rows wait in a keyed state
until the watermark has reached their date and are then handed on, all rows of a date in
one micro-batch and no earlier date after it.  A row behind the watermark is handed on at
once, marked ``late``.  The watermark is Spark's own and lies in the checkpoint, so a
stream that starts again, or a batch that runs again, decides as before.

The state is keyed by date and by a hash slice of the key columns and the row, so that
neither a busy date nor a hot account is one value, and there are as many keys as dates
and slices, however many accounts; each is forgotten when its date is reached.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import AtomicType, BinaryType, NullType, TimestampType

from cadenza.streaming.keyed import PackedRows, bucket_of, reached_day, wake_on, with_event_day

#: Of a date whose rows wait: as many values, each with its share of the date's rows.
WAITING_SLICES = 64
#: Stands for a missing date: no day is before it.
NO_DAY = -(1 << 31)


class Waiting(StatefulProcessor):
    """Rows of one date and slice until the date is reached."""

    def __init__(self, names: list[str]):
        self.names = names

    def init(self, handle) -> None:
        self.handle = handle
        self.rows = PackedRows(handle, "rows", _strings(self.names))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        day, reached = key[0], reached_day(timerValues)
        for part in rows:
            part = part[self.names]
            if day == NO_DAY or (reached is not None and day <= reached):
                yield part.assign(day=day, late=True)
            else:
                self.rows.append(pa.RecordBatch.from_pandas(part, schema=self.rows.schema, preserve_index=False))
                wake_on(self.handle, day)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        for batch in self.rows.batches():
            yield batch.to_pandas().assign(day=key[0], late=False)
        self.rows.clear()

    def close(self) -> None:
        pass


def _strings(names: list[str]) -> str:
    return ", ".join(f"{n} string" for n in names)


class _Carried:
    """Columns sent through Python as strings, which keep nulls and every digit, and back."""

    def __init__(self, rows: DataFrame, date: str):
        self.date = date
        self.fields = list(rows.schema)
        for f in self.fields:
            if not isinstance(f.dataType, (AtomicType, NullType)) or isinstance(f.dataType, BinaryType):
                raise ValueError(f"{f.name}: {f.dataType.simpleString()} can't wait in the state")
        self.names = [f"c{i}" for i, f in enumerate(self.fields) if f.name != date]

    def out(self, rows: DataFrame, delay_days: int, by: list[str], slices: int) -> DataFrame:
        """c0, c1, ..., day and slice."""
        timed = with_event_day(rows, delay_days, self.date)
        held = [self._text(f).alias(f"c{i}") for i, f in enumerate(self.fields) if f.name != self.date]
        keys = [F.col(c).cast("string").alias(f"key_{i}") for i, c in enumerate(by)]
        flat = timed.select(*held, *keys, F.coalesce("day", F.lit(NO_DAY)).alias("day"))
        sliced = flat.withColumn("slice", bucket_of([*(f"key_{i}" for i in range(len(by))), *self.names], slices))
        return sliced.select(*self.names, "day", "slice")

    @staticmethod
    def _text(field):
        column = F.col(field.name)
        return F.unix_micros(column).cast("string") if isinstance(field.dataType, TimestampType) else column.cast("string")

    def back(self) -> list:
        """The columns of the rows as they were."""
        given = []
        for i, f in enumerate(self.fields):
            if f.name == self.date:
                given.append(dated("day").cast(f.dataType).alias(f.name))
            elif isinstance(f.dataType, TimestampType):
                given.append(F.timestamp_micros(F.col(f"c{i}").cast("long")).alias(f.name))
            else:
                given.append(F.col(f"c{i}").cast(f.dataType).alias(f.name))
        return given


def dated(column: str):
    return F.date_from_unix_date(F.when(F.col(column) != NO_DAY, F.col(column)))


def in_order(rows: DataFrame, by: list[str], delay_days: int, date: str = "date", slices: int = WAITING_SLICES) -> DataFrame:
    """The stream ``rows`` with ``late``; rows without a date are late."""
    carried = _Carried(rows, date)
    keyed = carried.out(rows, delay_days, by, slices).groupBy("day", "slice")
    found = keyed.transformWithStateInPandas(Waiting(carried.names), f"{_strings(carried.names)}, day int, late boolean", "update", "eventTime")
    return found.select(*carried.back(), "late")
