"""Session helpers: where intermediate results go, and how lineage is cut."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def local_session(name: str = "cadenza", cpus: str = "*", **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.autoBroadcastJoinThreshold", "10m")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    A cluster names a folder every executor reaches, so checkpoints and
    intermediate tables outlive a lost executor.  Only where the setting is
    missing (tests on one machine) is a local folder made.
    """
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not configured:
        configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="cadenza-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one intermediate table, below the shared folder in a
    folder of this application, which may be removed when it has ended."""
    run = spark.sparkContext.applicationId
    return f"{shared_dir(spark).rstrip('/')}/cadenza-{run}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Store ``df`` as a table in the shared folder and go on from there.

    Lineage ends and a lost executor costs nothing that was stored.  Unlike an
    RDD checkpoint the plan runs once, the table is columnar, and its size is
    known to the optimizer, which then can choose a broadcast by itself.
    """
    path = work_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def at_once(spark: SparkSession, *steps: Callable):
    """What independent steps give, each run in a thread of its own: their many small jobs
    fill the cores that the others leave idle."""
    with ThreadPoolExecutor(len(steps)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]]


#: Rows sent to a Python worker at once; documents may be long.
BATCH_ROWS = 2_000


def small_batches(spark: SparkSession) -> None:
    """Bounds the rows of a batch, in the JVM and in Python workers, for long texts."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name, "10000")) <= BATCH_ROWS:
        spark.conf.set(name, BATCH_ROWS)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that Python
    workers can import it wherever they were started."""
    run = spark.sparkContext.applicationId
    if run in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    base = os.path.join(tempfile.mkdtemp(prefix="cadenza-code-"), "cadenza_code")
    shutil.make_archive(base, "zip", os.path.dirname(package), os.path.basename(package))
    spark.sparkContext.addPyFile(base + ".zip")
    _SHIPPED.add(run)
