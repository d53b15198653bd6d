"""Session settings and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Shuffled rows go when what they were shuffled for is done, not when the driver's memory is next
    # cleared: a fit of many steps would keep those of all its steps.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def build_session(app: str = "songweave", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library assumes; ``conf`` overrides them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set what the library assumes on a session built elsewhere."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A machine-local folder is only ever made up for a local master, where
    driver and tasks share one disk.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="songweave-checkpoint-")
    context.setCheckpointDir(configured)
    return configured


def cut_lineage(df: DataFrame, *by: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder, partitioned ``by`` columns of few values,
    and read it back.

    Several readers then share one computation, and lost executors cost nothing but a re-read.
    Unlike a checkpoint, which keeps the estimated size of the plan it replaces, a stored table
    is planned by its true size. That matters in loops, where estimates multiply per step.
    """
    return stored(df, *by)[0]


# Folders of the tables stored within each open ``passing``, the innermost last.
_PASSING: ContextVar[tuple[list[str], ...]] = ContextVar("passing", default=())


def stored(df: DataFrame, *by: str, outer: bool = False) -> tuple[DataFrame, str]:
    """``cut_lineage`` of ``df``, and the folder it is in: for ``drop``, or for tasks that read it."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.partitionBy(*by).parquet(path)
    open_ = _PASSING.get()[:-1] if outer else _PASSING.get()
    if open_:
        open_[-1].append(path)
    return spark.read.schema(df.schema).parquet(path), path


@contextmanager
def passing() -> Iterator[None]:
    """Tables stored within it are deleted when it ends, but for those stored ``outer``. Only for
    steps whose result is such a table, as a plan would still read the others."""
    own: list[str] = []
    before = _PASSING.set((*_PASSING.get(), own))
    try:
        yield
    finally:
        _PASSING.reset(before)
        for path in own:
            drop(path)


def drop(path: str) -> None:
    """Delete a table that ``stored`` made and that nothing reads any more, as each step of a loop
    leaves one behind."""
    files, folder = filesystem(path)
    if files.get_file_info(folder).type == fs.FileType.Directory:
        files.delete_dir(folder)


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a URI; ``file:/x``, ``file:///x`` and plain paths too."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), os.path.abspath(uri)
    return fs.FileSystem.from_uri(uri)


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Within it, Python gets at most ``rows`` rows of a stored step at once: for rows that are
    large themselves. The session's setting comes back after it."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


# Seconds between two sweeps.
SWEEP_SECONDS = 5.0


@contextmanager
def swept(spark: SparkSession) -> Iterator[None]:
    """Within it the driver's memory is cleared again and again. What an RDD shuffled, as MLlib's do,
    stays on disk until the driver has forgotten the RDD, and a large memory forgets late."""
    done = threading.Event()

    def sweep() -> None:
        while not done.wait(SWEEP_SECONDS):
            spark.sparkContext._jvm.System.gc()

    thread = threading.Thread(target=sweep, daemon=True)
    thread.start()
    try:
        yield
    finally:
        done.set()
        thread.join()
