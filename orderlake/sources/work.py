"""Shared scratch space for tables that cut a job in two."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession

_own: dict[str, str] = {}
_lock = threading.Lock()


def shared_folder(spark: SparkSession) -> str | None:
    """The folder all executors can reach, or None on a cluster that names none.

    Where driver and executors are one process and none is named, a temporary folder is
    made when first asked for, one per application.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        return None
    with _lock:
        if context.applicationId not in _own:
            _own[context.applicationId] = tempfile.mkdtemp(prefix="orderlake-")
            files, path = file_system(spark, _own[context.applicationId])
            files.deleteOnExit(path)
        return _own[context.applicationId]


def file_system(spark: SparkSession, folder: str):
    """The Hadoop file system of a folder, and the folder as its path."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def subfolders(spark: SparkSession, folder: str) -> list[str]:
    """Names of the folders in ``folder``, on whatever file system it lies."""
    files, path = file_system(spark, folder)
    return sorted(f.getPath().getName() for f in files.listStatus(path) if f.isDirectory())


def new_work_folder(spark: SparkSession) -> str:
    """A new folder in the shared one. It goes away with the session at the latest."""
    shared = shared_folder(spark)
    if shared is None:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    folder = f"{shared.rstrip('/')}/orderlake-{uuid.uuid4()}"
    files, path = file_system(spark, folder)
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder


def remove_work_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder made by ``new_work_folder``, on whatever file system it lies."""
    files, path = file_system(spark, folder)
    files.delete(path, True)


def observed(observation: Observation, otherwise: dict[str, int]) -> dict[str, int]:
    """What an observation saw, or ``otherwise`` where the optimizer left out an input that it knows to be empty."""
    try:
        return observation.get
    except Py4JJavaError:
        return otherwise


def written(df: DataFrame, path: str, partition_by: str | None = None, dictionary: bool = True) -> DataFrame:
    """``df`` as a table written to ``path``: what follows does not depend on its lineage.

    Without ``dictionary`` no list of a column's values is tried, which takes a third of the time where most differ.
    """
    writer = df.write.option("compression", "zstd").option("parquet.enable.dictionary", dictionary)
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
