"""Where operators keep tables between stages.

Intermediate tables go to the folder named by ``spark.checkpoint.dir``, which the driver and all executors share.
A written table cuts lineage: a lost executor costs a re-read, not a re-run.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

#: Options of tables that hold whole texts.
TEXTS = {"compression": "zstd"}
_left: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the session; a local one is made only in local mode, where all tasks share a disk."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = f"file://{tempfile.mkdtemp(prefix='strandline-')}"
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def keep(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and return a read of it; removed when the driver ends."""
    path = keep_path(df, name, options)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keep_path(df: DataFrame, name: str, options: dict[str, str] | None = None) -> str:
    """As ``keep``; returns the path."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _left.append(path)
    df.write.options(**(options or {})).parquet(path)
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return path


def stage(function: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A stage of a pipeline whose stages are each written and read again: before it runs, tables that earlier stages have left in the
    shared folder are deleted, but for those that ``docs`` itself reads. Tables of a stage that failed go with the next one."""

    @wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        read = {_plain(f) for f in docs.inputFiles()} if _earlier else set()
        for path in [p for p in _earlier if not any(f.startswith(f"{_plain(p)}/") for f in read)]:
            hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop_path, True)
            _earlier.remove(path)
        before = len(_left)
        try:
            return function(spark, docs, sf_dir)
        finally:
            _earlier.extend(_left[before:])
            del _left[before:]

    return run


_earlier: list[str] = []


def _plain(path: str) -> str:
    """A path without its scheme."""
    return re.sub("^[a-z0-9]+:/+", "/", path)


def modest_batches(df: DataFrame, rows: int = 1000, size: int = 16 << 20) -> DataFrame:
    """``df``, after the session's Arrow batches are made small enough for whole texts, in rows and in bytes: a batch is held in
    memory on both sides of the pipe to Python."""
    spark = df.sparkSession
    for setting, most in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", size)):
        now = spark.conf.get(f"spark.sql.execution.arrow.{setting}").rstrip("b")
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(f"spark.sql.execution.arrow.{setting}", str(most))
    return df
