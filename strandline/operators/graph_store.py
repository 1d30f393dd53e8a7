"""A graph kept in hash buckets under a log of commits, so that a small batch rewrites a small part of it.

A commit writes new folders for the buckets that its rows touch, then one entry of the log, which names the folder of every bucket
of every table: readers of an entry see that state for as long as its folders stay. An entry is created only if no other
writer has made it meanwhile, so of two writers one fails and nothing of it is seen. Rewritten buckets are single files again;
folders that no kept entry names are deleted by ``expire``.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Merge = Callable[[DataFrame, DataFrame, tuple[str, ...]], DataFrame]


class Conflict(RuntimeError):
    """Another writer has committed meanwhile."""


@dataclass(frozen=True)
class Table:
    schema: str
    keys: tuple[str, ...]


@dataclass(frozen=True)
class Store:
    root: str
    tables: dict[str, Table]
    buckets: int = 64
    kept: int = field(default=2)

    def _system(self, spark: SparkSession):  # noqa: ANN202
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        return path, path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self, spark: SparkSession) -> list[int]:
        path, system = self._system(spark)
        folder = path(f"{self.root}/log")
        if not system.exists(folder):
            return []
        names = [f.getPath().getName() for f in system.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n.removesuffix(".json").isdigit())

    def entry(self, spark: SparkSession, version: int | None = None) -> dict:
        """The state of a version, the last one without a number: for each table, the folder of each of its buckets."""
        there = self.versions(spark)
        version = version if version is not None else (there[-1] if there else 0)
        if not version:
            return {"version": 0, "tables": {t: {} for t in self.tables}}
        path, system = self._system(spark)
        stream = system.open(path(f"{self.root}/log/{version:012d}.json"))
        try:
            text = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        return json.loads(text)

    def bucket(self, keys: tuple[Column | str, ...]) -> Column:
        return F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("int")

    def read(self, spark: SparkSession, table: str, version: int | None = None, only: set[int] | None = None) -> DataFrame:
        """A table at a version, or only some buckets of it."""
        state = self.entry(spark, version)["tables"][table]
        folders = [f"{self.root}/{f}" for b, f in sorted(state.items()) if only is None or int(b) in only]
        schema = self.tables[table].schema
        return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)

    def touched(self, rows: DataFrame, *keys: Column | str) -> set[int]:
        """Buckets that rows fall into: at most as many as there are."""
        return {r["b"] for r in rows.select(self.bucket(keys).alias("b")).distinct().collect()}

    def write(self, spark: SparkSession, table: str, new: DataFrame, merge: Merge, version: int) -> dict[str, str]:
        """Merges rows into the buckets they fall into and writes these under a version's folder; nothing is seen before ``commit``."""
        keys = self.tables[table].keys
        own = self.touched(new, *keys)
        if not own:
            return {}
        merged = merge(self.read(spark, table, only=own), new, keys).withColumn("bucket", self.bucket(keys))
        folder = f"{table}/v{version:012d}"
        merged.repartition(len(own), "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/{folder}")
        return {str(b): f"{folder}/bucket={b}" for b in own}

    def commit(self, spark: SparkSession, version: int, written: dict[str, dict[str, str]]) -> int:
        before = self.entry(spark)
        if before["version"] != version - 1:
            raise Conflict(f"version {before['version']} is there, {version - 1} was expected")
        state = {"version": version, "tables": {t: before["tables"].get(t, {}) | written.get(t, {}) for t in self.tables}}
        path, system = self._system(spark)
        target = path(f"{self.root}/log/{version:012d}.json")
        try:
            stream = system.create(target, False)  # fails if the entry is there
        except Exception as error:
            if system.exists(target):
                raise Conflict(f"version {version} was made by another writer") from error
            raise
        stream.write(bytearray(json.dumps(state, sort_keys=True).encode()))
        stream.close()
        return version

    def merge(self, spark: SparkSession, new: dict[str, DataFrame], merge: Merge) -> int:
        """Merges rows of several tables as one commit; returns its version."""
        version = self.entry(spark)["version"] + 1
        return self.commit(spark, version, {t: self.write(spark, t, rows, merge, version) for t, rows in new.items()})

    def expire(self, spark: SparkSession) -> int:
        """Deletes log entries but the last ``kept``, and buckets that none of these names; returns how many folders went."""
        versions = self.versions(spark)
        named = {f for v in versions[-self.kept :] for t in self.entry(spark, v)["tables"].values() for f in t.values()}
        path, system = self._system(spark)
        gone = 0
        for v in versions[: -self.kept]:
            for table in self.entry(spark, v)["tables"].values():
                for folder in set(table.values()) - named:
                    gone += bool(system.delete(path(f"{self.root}/{folder}"), True))
            system.delete(path(f"{self.root}/log/{v:012d}.json"), False)
        return gone
