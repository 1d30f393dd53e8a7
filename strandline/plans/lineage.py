"""Cutting the lineage of iterative plans."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def _shared(spark: SparkSession) -> str:
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None and not re.fullmatch(r"local(\[.*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared or f"file://{tempfile.mkdtemp(prefix='strandline-')}")
    return context._jsc.sc().getCheckpointDir().get()


def _folder(df: DataFrame) -> str:
    return _shared(df.sparkSession)


def folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one, removed when the driver ends."""
    path = f"{_shared(spark)}/{name}-{uuid.uuid4().hex}"
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(hadoop_path)
    system.deleteOnExit(hadoop_path)
    return path


def cut(df: DataFrame, _round: int = 0) -> DataFrame:
    """A reliable checkpoint in the shared folder of the session; in local mode without one, in a temporary folder."""
    _folder(df)
    return df.checkpoint()


def stored(df: DataFrame, _round: int = 0) -> DataFrame:
    """As ``cut``, by a table written there and read again: a checkpoint keeps the constraints of its plan, and many rounds
    of joins make those grow until the driver's memory is full. The table is removed when the driver ends."""
    context = df.sparkSession.sparkContext
    path = f"{_folder(df)}/round-{uuid.uuid4().hex}"
    df.write.parquet(path)
    hadoop_path = context._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
