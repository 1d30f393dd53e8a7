"""Batch drivers: resolve, load, enrich and administer, each step on its own."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import analytics, graph
from ..sources import readers


@dataclass
class Step:
    name: str
    ok: bool
    seconds: float
    result: Any = None
    error: str | None = None


def run_steps(steps: dict[str, Callable[[], Any]], only: Iterable[str] = (), skip: Iterable[str] = (), stop_on_error: bool = False) -> list[Step]:
    """Runs the chosen steps in order; a step that fails doesn't keep the others from running unless told so."""
    only, skip, out = set(only), set(skip), []
    for name, step in steps.items():
        if (only and name not in only) or name in skip:
            continue
        began = time.time()
        try:
            out.append(Step(name, True, time.time() - began, step()))
        except Exception as error:  # isolated: reported, not raised
            out.append(Step(name, False, time.time() - began, error=f"{type(error).__name__}: {error}"))
            if stop_on_error:
                break
    return out


def resolve(named: Callable[[], DataFrame], decide: Callable[[DataFrame], Any], parallel: Callable[[], Any]) -> list[Step]:
    """Mentions, then people (only if there are mentions), and parallels in any case."""
    first = run_steps({"mentions": named})
    rest: dict[str, Callable[[], Any]] = {"people": lambda: decide(first[0].result)} if first[0].ok else {}
    return first + run_steps(rest | {"parallels": parallel})


def changed_files(spark: SparkSession, before: DataFrame, folder: str) -> DataFrame:
    """Which files of a folder are new or changed against a manifest."""
    return analytics.manifest_diff(before, readers.file_digests(spark, folder)).where("status IN ('added', 'changed')")


def load(node_frames: dict[str, DataFrame], edge_frames: dict[str, DataFrame], existing: DataFrame | None = None) -> dict[str, graph.LoadResult]:
    """Counts of created, merged and skipped nodes and edges: all nodes first, then edges with both nodes."""
    nodes = readers.union_all(list(node_frames.values()))
    base = existing if existing is not None else nodes.limit(0)
    out = {k: graph.load_result(base, df, ["label", "id"]) for k, df in node_frames.items()}
    known = base.select("label", "id").union(nodes.select("label", "id")).distinct()
    keys = ["label", "src_id", "dst_id", "props"]
    for k, df in edge_frames.items():
        good, bad = graph.with_endpoints(df, known)
        out[k] = graph.load_result(df.limit(0), good, keys, skipped=bad.count())
    return out


@dataclass
class Audit:
    """Runs of administrative actions, a JSON row each."""

    folder: str
    fields: str = field(default="run_id string, action string, scope string, confirmation string, dry_run boolean, at timestamp, detail string", repr=False)

    def write(self, spark: SparkSession, action: str, scope: str, confirmation: str, dry_run: bool, detail: str = "") -> str:
        run_id = uuid.uuid4().hex
        row = spark.createDataFrame([(run_id, action, scope, confirmation, dry_run, detail)], "run_id string, action string, scope string, confirmation string, dry_run boolean, detail string")
        row.withColumn("at", F.current_timestamp()).coalesce(1).write.mode("append").json(self.folder)
        return run_id

    def last(self, spark: SparkSession, n: int = 10) -> DataFrame:
        return spark.read.schema(self.fields).json(self.folder).orderBy(F.col("at").desc(), "run_id").limit(n)


def _delete(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


#: How a reset may be confirmed, and the word that confirms a full one.
CONFIRMATIONS, TOKEN = ("interactive", "yes-flag", "not-required", "api"), "OBLITERATE"


def reset(spark: SparkSession, root: str, paths: list[str], confirmation: str, audit: Audit, scope: str, dry_run: bool = False, token: str | None = None) -> list[str]:
    """Deletes folders under a root, or only says which; full resets need the token; every run is audited."""
    if confirmation not in CONFIRMATIONS:
        raise ValueError(f"confirmation must be one of {', '.join(CONFIRMATIONS)}")
    if scope == "all" and not dry_run and token != TOKEN:
        raise PermissionError("a full reset needs its token")
    if any(".." in p.split("/") or not p.strip("/. ") for p in paths):
        raise ValueError("paths must stay under the root")
    done = [p for p in paths if dry_run or _delete(spark, f"{root}/{p}")]
    audit.write(spark, "reset", scope, confirmation, dry_run, ",".join(done))
    return done


def reprocess(spark: SparkSession, layout: Any, stage: str, audit: Audit) -> int:
    """Forgets the checkpoints of a stage and those after it, and the stage's progress; returns how many were forgotten."""
    from ..streaming import stages

    rows = stages.read_or_empty(spark, layout.checkpoints, stages.CHECKPOINT)
    kept = stages.forget(rows, stage)
    before, after = rows.count(), kept.count()
    fresh = f"{layout.checkpoints}-{uuid.uuid4().hex}"
    kept.write.parquet(fresh)
    _delete(spark, layout.checkpoints)
    spark.read.schema(stages.CHECKPOINT).parquet(fresh).write.mode("overwrite").parquet(layout.checkpoints)
    _delete(spark, fresh)
    _delete(spark, layout.progress(stage))
    audit.write(spark, "reprocess", stage, "not-required", False, str(before - after))
    return before - after
