"""What the keyed streams share: state store, event time in days, result folders, packed state.

A call of a keyed state costs some milliseconds, and so does each of its state's values,
however little they hold.  So keys are hash buckets instead of single cycles or accounts,
and a bucket's rows lie in its state as Arrow batches of up to ``CHUNK`` rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

DAY_MS = 86_400_000
#: Rows of one packed value.
CHUNK = 5_000
_ARROW = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "double": pa.float64()}
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def reached_day(timer_values) -> int | None:
    """The last day of which no more row can come in time; None before the first watermark."""
    at = timer_values.getCurrentWatermarkInMs()
    return at // DAY_MS if at > 0 else None


def wake_on(handle, day: int) -> None:
    """A timer that fires once the watermark has reached ``day``."""
    handle.registerTimer(day * DAY_MS - 1)


class PackedRows:
    """A list of rows in the state of a key; ``fields`` is a schema like ``"a string, b int"``."""

    def __init__(self, handle, name: str, fields: str):
        self.state = handle.getListState(name, "chunk binary")
        self.schema = pa.schema([(f.split()[0], _ARROW[f.split()[1]]) for f in fields.split(", ")])

    def batches(self) -> Iterator[pa.RecordBatch]:
        for (chunk,) in self.state.get():
            yield from pa.ipc.open_stream(bytes(chunk))

    def rows(self) -> Iterator[tuple]:
        for batch in self.batches():
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

    def append(self, batch: pa.RecordBatch) -> None:
        self.state.appendValue((self._packed(batch),))

    def put(self, rows: list[tuple]) -> None:
        """These rows in place of those that were."""
        parts = [list(zip(*rows[i : i + CHUNK], strict=True)) for i in range(0, len(rows), CHUNK)]
        if parts:
            self.state.put([(self._packed(self._batch(columns)),) for columns in parts])
        else:
            self.state.clear()

    def clear(self) -> None:
        self.state.clear()

    def _batch(self, columns: Iterable) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.schema, strict=True)], schema=self.schema)

    def _packed(self, batch: pa.RecordBatch) -> bytes:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, self.schema) as out:
            out.write_batch(batch)
        return sink.getvalue().to_pybytes()


def bucket_of(columns: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int")


def with_event_day(rows: DataFrame, delay_days: int, date: str = "date") -> DataFrame:
    """``rows`` with ``day``, the number of the date's day, and a watermark ``delay_days`` behind
    the latest date seen.

    The watermark stands on a column that later steps do not get, so Spark goes on
    counting it but leaves rows that are behind it to the operator, which can keep them.
    """
    timed = rows.withColumn("_event_time", F.col(date).cast("timestamp")).withWatermark("_event_time", f"{delay_days} days")
    # An expression over the column has no watermark of its own.
    return timed.withColumn("day", F.unix_date(F.to_date(F.col("_event_time")))).drop("_event_time")


def run(rows: DataFrame, base: str, name: str, trigger: dict, each: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Starts writing ``rows`` to folders of ``base`` named by their batch; a batch that runs again
    replaces its own folder."""
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/{name}/batch={number}")

    return (
        rows.writeStream.foreachBatch(each or write)
        .outputMode("update")
        .option("checkpointLocation", f"{base}/{name}-stream")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def written(spark: SparkSession, base: str, name: str, schema: str) -> DataFrame:
    """All rows written so far, with their ``batch``."""
    try:
        return spark.read.schema(f"{schema}, batch long").parquet(f"{base}/{name}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{schema}, batch long")
