"""Session settings and the shared work folder."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_CHOSEN: dict[str, str] = {}
#: The folder of the run that this thread belongs to. A run hands its context to threads of its own.
_RUN: ContextVar[str | None] = ContextVar("civicmart_run", default=None)


def get_session(app: str = "civicmart", master: str | None = None, **conf: object) -> SparkSession:
    """A session with the settings the jobs rely on; `conf` keys use '__' for '.'."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.parquet.filterPushdown", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def use_work_dir(spark: SparkSession, path: str) -> None:
    """Name the work folder of a session that has no `spark.checkpoint.dir`, as tests do."""
    _CHOSEN[spark.sparkContext.applicationId] = path.rstrip("/")


def work_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster (or `use_work_dir`) names it.

    A session without one is refused, local or not: a machine-local folder would not survive
    a lost executor.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or _CHOSEN.get(spark.sparkContext.applicationId)
    if not shared:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all nodes share")
    return shared.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the work folder (in the run's own one inside `scratch`) that no other run uses."""
    return f"{_RUN.get() or work_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """One folder for all frames that a run cuts in this thread, or in threads that run in its context; it is
    dropped at the run's end. A run inside a run uses the outer one's.

    Nothing that leaves the run may still read from it. Frames that other threads cut meanwhile lie elsewhere.
    """
    if _RUN.get():
        yield
        return
    folder = f"{work_dir(spark)}/run-{uuid.uuid4().hex[:12]}"
    token = _RUN.set(folder)
    try:
        yield
    finally:
        _RUN.reset(token)
        drop_path(spark, folder)


def drop_path(spark: SparkSession, path: str) -> None:
    """Deletes a folder and what is in it, wherever Spark can reach it."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


#: How frames and tables are packed: about a third less to write than with the default.
PACKING = "zstd"
_OPEN = "spark.sql.maxConcurrentOutputFileWriters"
_OPEN_LOCK = threading.Lock()
_OPEN_NOW: dict[str, list] = {}


@contextmanager
def open_files(spark: SparkSession, most: int) -> Iterator[None]:
    """Writes into folders by value keep up to `most` files open per task instead of sorting all rows by that value.

    A task that meets more values sorts the rest. The setting is the session's, so it is put back when the last of several
    threads is done.
    """
    app = spark.sparkContext.applicationId
    with _OPEN_LOCK:
        held = _OPEN_NOW.setdefault(app, [0, spark.conf.get(_OPEN)])
        held[0] += 1
        spark.conf.set(_OPEN, most)
    try:
        yield
    finally:
        with _OPEN_LOCK:
            held[0] -= 1
            if not held[0]:
                spark.conf.set(_OPEN, _OPEN_NOW.pop(app)[1])


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared work folder and read it back.

    Ends the lineage in a way a lost executor cannot undo, and gives Catalyst the true file
    size, so that whether a later join broadcasts this frame follows from its measured size.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path, compression=PACKING)
    return spark.read.schema(df.schema).parquet(path)
