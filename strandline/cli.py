"""Command line: ``python -m strandline.cli COMMAND``."""

from __future__ import annotations

import argparse
import json
from pathlib import Path

from pyspark.sql import SparkSession

from .operators import validation
from .plans import catalog, pipeline
from .streaming import stages


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="strandline", description="Queries, streams and administration of the engine")
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("info", help="the session's settings that matter here")
    commands.add_parser("queries", help="names of the registered queries")
    run = commands.add_parser("run", help="run queries over a folder of tables")
    run.add_argument("names", nargs="+", choices=sorted(catalog.QUERIES), metavar="NAME")
    run.add_argument("--data", required=True)
    run.add_argument("--out", help="folder for Parquet tables; without it, rows are shown")
    stream = commands.add_parser("stream", help="run stages of the stream over what has arrived")
    stream.add_argument("root")
    stream.add_argument("--only", nargs="+", choices=stages.STAGES, default=list(stages.STAGES))
    staging = commands.add_parser("validate-staging", help="profile of the staging tables against a baseline")
    staging.add_argument("folder")
    staging.add_argument("--baseline", help="JSON object of expected row counts, or of metrics, by table")
    staging.add_argument("--drift-tolerance", type=float, default=30.0)
    staging.add_argument("--strict", action="store_true", help="fail if a table drifts")
    staging.add_argument("--output-json")
    audit = commands.add_parser("audit", help="the last administrative runs")
    audit.add_argument("root")
    audit.add_argument("--last", type=int, default=10)
    reset = commands.add_parser("reset", help="delete folders of a stage, a source, or all")
    reset.add_argument("root")
    scope = reset.add_mutually_exclusive_group(required=True)
    scope.add_argument("--stage", choices=[p.rstrip("/") for p in stages.PREFIXES])
    scope.add_argument("--source")
    scope.add_argument("--all", action="store_true")
    reset.add_argument("--yes", action="store_true")
    reset.add_argument("--dry-run", action="store_true")
    return parser


def _staging(spark: SparkSession, args: argparse.Namespace) -> int:
    expected = json.loads(Path(args.baseline).read_text()) if args.baseline else {}
    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{args.folder}/*.parquet")
    found = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern)
    paths = {p.rsplit("/", 1)[-1].removesuffix(".parquet"): p for p in (f.getPath().toString() for f in found)}
    rows = {}
    for name, path in paths.items():
        before = expected.get(name)
        baseline = before if isinstance(before, dict) else {} if before is None else {"row_count": before}
        rows[name] = validation.validate(spark.read.parquet(path), validation.table_of(name), baseline, args.drift_tolerance).collect()
    result = validation.report(rows, args.strict)
    print(validation.as_json(result))
    if args.output_json:
        Path(args.output_json).write_text(validation.as_json(result))
    return int(not result["passed"])


def _reset(spark: SparkSession, args: argparse.Namespace) -> None:
    folders = [p.rstrip("/") for p in stages.PREFIXES]
    paths = folders if args.all else [args.stage] if args.stage else [f"{p}/{args.source}" for p in folders]
    scope = "all" if args.all else args.stage or args.source
    token = pipeline.TOKEN if args.yes or args.dry_run or not args.all else input(f"Type {pipeline.TOKEN} to go on: ")
    how = "not-required" if args.dry_run or not args.all else "yes-flag" if args.yes else "interactive"
    done = pipeline.reset(spark, args.root, paths, how, pipeline.Audit(f"{args.root}/audit"), scope, args.dry_run, token)
    print(json.dumps({"scope": scope, "dry_run": args.dry_run, "paths": done}))


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = _parser().parse_args(argv)
    if args.command == "queries":
        print("\n".join(sorted(catalog.QUERIES)))
        return 0
    spark = spark or SparkSession.builder.appName("strandline").getOrCreate()
    if args.command == "info":
        names = ("spark.master", "spark.checkpoint.dir", "spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")
        print(json.dumps({n: spark.conf.get(n, None) for n in names}))
    elif args.command == "run":
        for name in args.names:
            found = catalog.QUERIES[name](spark, args.data)
            if args.out:
                found.write.mode("overwrite").parquet(f"{args.out}/{name}")
            else:
                found.show(truncate=False)
    elif args.command == "stream":
        layout = stages.Layout(args.root)
        work = {"dedup": stages.dedup, "enrich": stages.enrich, "normalize": stages.normalize, "ingest": lambda: stages.ingest(layout)}
        for name in args.only:
            stages.start(spark, layout, name, work[name]()).awaitTermination()
    elif args.command == "audit":
        pipeline.Audit(f"{args.root}/audit").last(spark, args.last).show(truncate=False)
    elif args.command == "reset":
        _reset(spark, args)
    else:
        return _staging(spark, args)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
