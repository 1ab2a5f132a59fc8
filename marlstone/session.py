"""Session settings and the shared working folder."""

from __future__ import annotations

import atexit
import gc
import logging
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []
_own_dir: list[str] = []


def shuffle_width(spark: SparkSession) -> int:
    """Number of partitions a shuffle gets by the session's setting."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can read: spark.checkpoint.dir of the session.

    Where the setting is absent (local tests) a temporary folder of this
    process is used; a cluster must set it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
    if not _own_dir:
        _own_dir.append(tempfile.mkdtemp(prefix="marlstone-"))
    return _own_dir[0]


def materialise(df: DataFrame) -> DataFrame:
    """Write df as Parquet into the shared folder and return a scan of it.

    Cuts lineage: a lost executor costs a re-read, never a recomputation of
    the iterations before. The files go when the application ends, or by
    ``release``.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/marlstone-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append((spark, path))
    out = spark.read.schema(df.schema).parquet(path)
    out._marlstone_path = path
    return out


def release(df: DataFrame | None) -> None:
    """Delete the files of a table that materialise returned; a loop does so for the round before the last."""
    path = getattr(df, "_marlstone_path", None)
    if path:
        _drop(df.sparkSession, path)
        for x in [x for x in _written if x[1] == path]:  # not a new list: other threads may add tables
            _written.remove(x)


def part_of(df: DataFrame, whole: DataFrame) -> DataFrame:
    """df as a part of a table that materialise returned: to release it deletes the table's files."""
    df._marlstone_path = getattr(whole, "_marlstone_path", None)
    return df


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[DataFrame]]:
    """Delete at the end what is materialised inside, but for tables put into the list that it gives, and let Spark delete the shuffle files that nothing refers to any more."""
    before = {path for _, path in _written}
    kept: list[DataFrame] = []
    try:
        yield kept
    finally:
        before |= {getattr(df, "_marlstone_path", None) for df in kept}
        for s, path in [x for x in _written if x[1] not in before]:
            _drop(s, path)
        _written[:] = [x for x in _written if x[1] in before]
        tidy(spark)


@contextmanager
def row_by_row(spark: SparkSession) -> Iterator[None]:
    """Rows that hold blocks are read and go to Python one at a time: by default thousands are gathered for either."""
    few = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1", "spark.sql.parquet.columnarReaderBatchSize": "1"}
    before = {key: spark.conf.get(key) for key in few}
    try:
        for key, value in few.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def tidy(spark: SparkSession) -> None:
    """Let the driver give back the memory of what is over."""
    gc.collect()
    spark._jvm.System.gc()


@contextmanager
def tidied(spark: SparkSession, every: float = 1.0) -> Iterator[None]:
    """tidy every second inside: hundreds of small jobs leave a driver more garbage than it takes back by itself."""
    over = threading.Event()

    def run() -> None:
        while not over.wait(every):
            tidy(spark)

    thread = threading.Thread(target=run, daemon=True)
    thread.start()
    try:
        yield
    finally:
        over.set()
        thread.join()


def _drop(spark: SparkSession, path: str, quiet: bool = False) -> None:
    try:
        jvm = spark._jvm
        hpath = jvm.org.apache.hadoop.fs.Path(path)
        hpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hpath, True)
    except Exception as e:
        if not quiet:
            logging.getLogger(__name__).warning("could not delete %s: %s", path, e)


@atexit.register
def _cleanup() -> None:
    for spark, path in _written:
        _drop(spark, path, quiet=True)  # the JVM may be gone already
    _written.clear()
    if _own_dir:
        import shutil

        shutil.rmtree(_own_dir.pop(), ignore_errors=True)
