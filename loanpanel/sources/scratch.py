"""Intermediate tables that cut lineage and survive lost executors."""

from __future__ import annotations

import tempfile
import threading
import uuid
import weakref
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Files a task keeps open at once when it writes a table by partition: so many
# values need no sort of the task's rows by them. Further values are sorted.
OPEN_FILES = 8

# Spark's setting that removes a query's shuffle files as it ends; otherwise
# they stay until the driver happens to collect its garbage.
REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_folder: list[str] = []
_folders: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()
_writing: dict[SparkSession, list] = {}  # writes going on, and the setting before them
_lock = threading.Lock()


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir. A machine's own
    temporary folder serves only where Spark itself runs on one machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if not _local_folder:
        _local_folder.append(tempfile.mkdtemp(prefix="loanpanel-"))
    return _local_folder[0]


@contextmanager
def _without_shuffle_files(spark: SparkSession) -> Iterator[None]:
    """Queries begun inside leave no shuffle files; the session's own setting
    holds again when the last of the writes that go on at once has ended."""
    with _lock:
        state = _writing.setdefault(spark, [0, spark.conf.get(REMOVE_SHUFFLES, None)])
        state[0] += 1
        spark.conf.set(REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        with _lock:
            state[0] -= 1
            if not state[0]:
                _writing.pop(spark)
                if state[1] is None:
                    spark.conf.unset(REMOVE_SHUFFLES)
                else:
                    spark.conf.set(REMOVE_SHUFFLES, state[1])


def materialise(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write a table once and read it back: for tables many later plans read
    in parts, from columnar files of known size. Its shuffle files go at once."""
    spark = df.sparkSession
    if partition_by:
        spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", OPEN_FILES)
    path = f"{scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"
    with _without_shuffle_files(spark):
        df.write.parquet(path, partitionBy=partition_by, compression="zstd")
    out = spark.read.schema(df.schema).parquet(path)
    _folders[out] = path
    return out


def stored(df: DataFrame) -> DataFrame:
    """Compute an intermediate table once, as files a fraction of the size of a
    checkpoint, which `drop` can delete."""
    return materialise(df, "stored")


def drop(*tables: DataFrame | None) -> None:
    """Delete stored tables that no plan reads any more. Tables that were not
    stored here stay."""
    for table in tables:
        path = _folders.pop(table, None) if table is not None else None
        if path:
            context = table.sparkSession.sparkContext
            folder = context._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def cut(df: DataFrame) -> DataFrame:
    """Compute a narrow intermediate table once, as a reliable checkpoint."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_folder(df.sparkSession))
    return df.checkpoint()


def together(*tasks: Callable[[], object]) -> list:
    """Run driver-side tasks at once, so that their jobs share the cluster."""
    with ThreadPoolExecutor(len(tasks)) as pool:
        return [f.result() for f in [pool.submit(t) for t in tasks]]


def store_all(*tables: DataFrame) -> list[DataFrame]:
    """Compute independent intermediate tables at the same time."""
    return together(*(lambda t=t: stored(t) for t in tables))
