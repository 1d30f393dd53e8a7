"""Sinks: staged Parquet, CSV, samples, reports, and batches whose manifest comes last."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas


def stage(df: DataFrame, path: str, table: str) -> None:
    schemas.conform(df, table).write.mode("overwrite").option("compression", "snappy").parquet(path)


def csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").csv(path)


def sample(df: DataFrame, keys: list[str], n: int = 100, seed: int = 42) -> DataFrame:
    """``n`` rows drawn by hash: the same rows on every run."""
    return df.orderBy(F.xxhash64(F.lit(seed), *keys), *keys).limit(n)


def vectors(df: DataFrame, path: str, key: str, vector: str) -> None:
    df.select(key, vector).write.mode("overwrite").parquet(path)


def report(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").json(path)


def batch(frames: dict[str, DataFrame], folder: str, batch_id: str, source: str) -> DataFrame:
    """Write labelled tables under a batch folder, then the manifest that makes them visible; returns the manifest."""
    spark: SparkSession = next(iter(frames.values())).sparkSession
    entries = []
    for name, df in frames.items():
        df.write.mode("overwrite").parquet(f"{folder}/{batch_id}/{name}")
        entries.append((name, spark.read.parquet(f"{folder}/{batch_id}/{name}").count()))
    rows = [(batch_id, source, f"{folder}/{batch_id}/{name}", name, n) for name, n in entries]
    manifest = spark.createDataFrame(rows, "batch_id string, source string, path string, label string, row_count long")
    manifest.coalesce(1).write.mode("overwrite").json(f"{folder}/{batch_id}/_MANIFEST")
    return manifest
