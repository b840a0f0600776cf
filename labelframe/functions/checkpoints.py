"""Intermediate tables, written as Parquet in the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
RUN_FOLDER = "labelframe.run.folder"
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ROW_GROUP_BYTES = 16 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    A temporary folder stands in only when the setting is absent and Spark itself runs
    in local mode; on a cluster executors could not read it back, so a missing setting
    is an error.
    """
    folder = spark.conf.get(SETTING, None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SETTING} to a folder that all executors can reach")
    folder = tempfile.mkdtemp(prefix="labelframe-checkpoint-")
    spark.conf.set(SETTING, folder)
    return folder


def _path(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def run_folder(spark: SparkSession) -> str:
    """The folder of this application inside the shared one, deleted when its JVM ends."""
    shared = shared_folder(spark).rstrip("/")
    own = f"{shared}/labelframe-{spark.sparkContext.applicationId}"
    if spark.conf.get(RUN_FOLDER, None) != own:
        path, files = _path(spark, own)
        files.mkdirs(path)
        files.deleteOnExit(path)
        spark.conf.set(RUN_FOLDER, own)
    return own


def clean(spark: SparkSession) -> None:
    """Delete the intermediate tables now; frames that read them can no longer be used."""
    path, files = _path(spark, run_folder(spark))
    files.delete(path, True)
    files.mkdirs(path)


class _Writers:
    """By session: how many write just now, and the setting before the first of them.

    Functions that travel to executors may bring this module along; a copy is a new, idle one.
    """

    def __init__(self) -> None:
        self.lock, self.held = threading.Lock(), {}

    def __reduce__(self) -> tuple:
        return _Writers, ()


_writers = _Writers()


@contextmanager
def _cleaned_up(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries inside are deleted after them; the setting comes back when the last thread is out."""
    key = id(spark._jsparkSession)
    with _writers.lock:
        own = _writers.held.setdefault(key, [0, spark.conf.get(CLEAN_UP, None)])
        own[0] += 1
        spark.conf.set(CLEAN_UP, "true")
    try:
        yield
    finally:
        with _writers.lock:
            own[0] -= 1
            if not own[0]:
                del _writers.held[key]
                spark.conf.set(CLEAN_UP, own[1]) if own[1] is not None else spark.conf.unset(CLEAN_UP)


def store(df: DataFrame) -> tuple[DataFrame, str]:
    """As ``materialize``, with the folder, for ``discard``."""
    spark = df.sparkSession
    path = f"{run_folder(spark)}/{uuid.uuid4().hex}"
    with _cleaned_up(spark):
        df.select("*").write.option("compression", "zstd").option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a stored table that nothing reads any more, so that rounds do not pile up."""
    if not path.startswith(f"{run_folder(spark)}/"):
        raise ValueError(f"{path} is no intermediate table of this application")
    folder, files = _path(spark, path)
    files.delete(folder, True)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once, with its lineage cut there, and read it back.

    The table is Parquet, so later reads take only the columns they need and the
    optimizer knows its size.  Row groups are small, since each task that writes holds
    one.  The shuffle files of the write are deleted after it, not when the driver
    happens to collect its garbage: nothing else reads them.  Threads may write at once.
    """
    return store(df)[0]
