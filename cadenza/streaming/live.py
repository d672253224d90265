"""Detection over a stream of transactions (G8 live, G17).

A micro-batch is not a window: rows wait until no row of their window can arrive
any more, and then pass through the same step as in a batch run.  A watermark on the
date, the latest date so far less the lateness allowed, says when that is, and which rows
are too late.  It lies in the progress row, so rows need no keyed state to learn it, and the
windows that a batch's own rows close are processed in that batch.

Everything a batch leaves behind lies in folders named by its number: rows still
waiting, the manifest of the state, results, late rows, and a progress row.  Batch ``n`` reads
the folders of ``n - 1`` and overwrites its own, so a batch that runs again after
a failure gives the same result.  A batch counts once its progress row is written,
which comes last; a detection that starts again on the same folder goes on from the
newest such batch.  What :meth:`finish` adds lies in folders of its own and holds
until another batch comes.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cadenza import fixed
from cadenza.models.pipelines import CycleModels
from cadenza.plans.detection import INPUT, UPCOMING, UPCOMING_COLUMNS, empty_upcoming, run_windows
from cadenza.plans.state import MANIFEST, StateTable
from cadenza.plans.windows import window_map
from cadenza.streaming.keyed import run

_WAITING = (
    "user_id string, account_id string, transaction_id string, date date, signed_amount double,"
    " description string, has_cycle_probability double"
)
_PROGRESS = "done_until date, reached date"


class LiveDetection:
    """One running detection.

    ``base`` is a folder all executors share.  Rows dated more than ``lateness_days``
    before the latest date of the batches before, or in a window already processed,
    are too late: they go to a table of their own instead of changing
    results already sent.
    """

    def __init__(
        self,
        models: CycleModels,
        base: str,
        *,
        prior: DataFrame | None = None,
        lateness_days: int = 0,
        days: int = fixed.WINDOW_DAYS,
    ):
        self.models, self.base, self.prior = models, base.rstrip("/"), prior
        self.lateness_days, self.days = lateness_days, days

    def start(self, transactions: DataFrame, **trigger) -> StreamingQuery:
        return run(transactions.select(*INPUT), self.base, "detection", trigger, self.process)

    def _folder(self, kind: str, batch: int, final: bool = False) -> str:
        return f"{self.base}/{'final_' if final else ''}{kind}/batch={batch}"

    def _before(self, spark: SparkSession, kind: str, batch: int | None, schema: str) -> DataFrame | None:
        if batch is None or batch < 0:
            return None
        return spark.read.schema(schema).parquet(self._folder(kind, batch))

    def _newest(self, spark: SparkSession, kind: str) -> int | None:
        """The newest batch with a progress row."""
        try:
            found = spark.read.schema(f"{_PROGRESS}, batch int").parquet(f"{self.base}/{kind}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return found.agg(F.max("batch")).first()[0]

    def process(self, rows: DataFrame, batch: int, last: bool = False) -> None:
        """Take in one batch and process the windows that the watermark has passed.

        Rows are late by the watermark of the batches before.  With ``last`` all windows
        are processed, upon what batch ``batch`` left.
        """
        spark = rows.sparkSession
        previous = batch if last else batch - 1
        progress = self._before(spark, "progress", previous, _PROGRESS)
        done_until, reached = progress.first() if progress is not None else (None, None)

        rows = rows.persist()
        in_time = F.lit(True)
        for behind in (reached, done_until):
            if behind is not None:
                in_time &= F.col("date") > F.lit(behind)
        # A watermark is reached, not only passed: one day more keeps rows of the latest date in time.
        newest = rows.agg(F.max("date")).first()[0]
        passed = newest and newest - timedelta(days=self.lateness_days + 1)
        reached = max((d for d in (reached, passed) if d is not None), default=None)
        rows.where(F.col("date").isNull() | ~in_time).select(*INPUT).write.mode("overwrite").parquet(self._folder("late", batch, last))

        # Scored once, on arrival: the has-cycle model needs no state.
        fresh = self.models.has_cycle(rows.where(F.col("date").isNotNull() & in_time))
        waiting = self._before(spark, "waiting", previous, _WAITING)
        names = [*INPUT, "has_cycle_probability"]
        arrived = self._folder("arrived", batch, last)
        (fresh.select(*names) if waiting is None else waiting.unionByName(fresh.select(*names))).write.mode(
            "overwrite"
        ).parquet(arrived)
        rows.unpersist()
        arrived_rows = spark.read.schema(_WAITING).parquet(arrived)

        windows = window_map(arrived_rows, days=self.days)
        starts = [r[0] for r in windows.select("window_start").distinct().orderBy("window_start").collect()]
        closed = [s for s in starts if last or (reached is not None and s + timedelta(days=self.days) <= reached)]
        state = self._state(spark, previous)
        name = f"batch={batch}{'-final' if last else ''}-"
        parts = run_windows(
            arrived_rows.join(windows, "date"), closed, state, self.models, self._folder("windows", batch, last), self.days, name
        )
        results = spark.read.schema(UPCOMING).parquet(*parts) if parts else empty_upcoming(spark)
        results.write.mode("overwrite").parquet(self._folder("upcoming", batch, last))
        state.manifest().write.mode("overwrite").parquet(self._folder("manifest", batch, last))
        if closed:
            done_until = closed[-1] + timedelta(days=self.days)
        left = arrived_rows if done_until is None else arrived_rows.where(F.col("date") > F.lit(done_until))
        left.write.mode("overwrite").parquet(self._folder("waiting", batch, last))
        spark.createDataFrame([(done_until, reached)], _PROGRESS).write.mode("overwrite").parquet(
            self._folder("progress", batch, last)
        )

    def _state(self, spark: SparkSession, batch: int | None, final: bool = False) -> StateTable:
        folder = f"{self.base}/state"
        if batch is not None and batch >= 0:
            manifest = spark.read.schema(MANIFEST).parquet(self._folder("manifest", batch, final))
            return StateTable.of_manifest(spark, folder, UPCOMING, manifest)
        state = StateTable(spark, folder, UPCOMING)
        if self.prior is not None:
            state.add(self.prior.select(*UPCOMING_COLUMNS), "prior")
        return state

    def state(self, spark: SparkSession) -> DataFrame:
        """The latest prediction of every cycle so far, however old."""
        newest = self._newest(spark, "progress")
        return self._state(spark, newest, newest is not None and self._newest(spark, "final_progress") == newest).rows()

    def finish(self, spark: SparkSession) -> None:
        """Process what still waits, when no more rows will come for now."""
        newest = self._newest(spark, "progress")
        if newest is not None:
            self.process(spark.createDataFrame([], _WAITING).select(*INPUT), newest, last=True)

    def upcoming(self, spark: SparkSession) -> DataFrame:
        return self._all(spark, "upcoming", UPCOMING).select(*UPCOMING_COLUMNS)

    def late(self, spark: SparkSession) -> DataFrame:
        return self._all(spark, "late", _WAITING).select(*INPUT)

    def _all(self, spark: SparkSession, kind: str, schema: str) -> DataFrame:
        newest = self._newest(spark, "progress")
        if newest is None:
            return spark.createDataFrame([], schema)
        every = spark.read.schema(f"{schema}, batch int").parquet(f"{self.base}/{kind}")
        found = every.where(F.col("batch") <= newest).drop("batch")
        if self._newest(spark, "final_progress") == newest:
            found = found.unionByName(spark.read.schema(schema).parquet(self._folder(kind, newest, True)))
        return found
