"""Checks of staged tables: counts, schema, nulls, duplicates, script coverage, drift, and a verdict."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import schemas


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.bround(part * 100.0 / whole, 2)).otherwise(0.0)


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, nulls, null_pct) of all columns in one pass."""
    names = list(columns or df.columns)
    counts = df.agg(F.count("*").alias("n"), *(F.count_if(F.col(c).isNull()).alias(f"c{k}") for k, c in enumerate(names)))
    pairs = F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(f"c{k}").alias("nulls")) for k, c in enumerate(names)))
    return counts.select("n", F.explode(pairs).alias("p")).select("p.column_name", "p.nulls", percent(F.col("p.nulls"), F.col("n")).alias("null_pct"))


def schema_problems(df: DataFrame, table: str) -> dict[str, list[str]]:
    want, have = {f.name: f.dataType for f in schemas.schema(table)}, {f.name: f.dataType for f in df.schema}
    return {
        "missing": sorted(set(want) - set(have)),
        "extra": sorted(set(have) - set(want)),
        "types": sorted(c for c in want if c in have and want[c].simpleString() != have[c].simpleString()),
    }


def duplicate_ids(df: DataFrame, key: str) -> DataFrame:
    """Rows beyond the first of each id; null ids count as duplicates."""
    return df.agg(F.count("*").alias("n_rows"), (F.count("*") - F.countDistinct(key)).alias("duplicates"))


def match_ratio(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Share of values that match, of values there are and of all rows."""
    hits = F.count_if(F.col(column).rlike(pattern))
    return df.agg(percent(hits, F.count(column)).alias("of_values"), percent(hits, F.count("*")).alias("of_rows"))


def empty_ratio(df: DataFrame, column: str) -> DataFrame:
    blank = F.count_if(F.col(column).isNull() | (F.trim(column) == ""))
    return df.agg(F.count("*").alias("n_rows"), percent(blank, F.count("*")).alias("empty_pct"))


def coverage(df: DataFrame, *columns: str) -> DataFrame:
    return df.agg(*(percent(F.count(c), F.count("*")).alias(f"{c}_pct") for c in columns))


def drift(current: DataFrame, baseline: DataFrame, tolerance: float = 30.0) -> DataFrame:
    """(metric, current, baseline, drift_pct, ok): change against a baseline; against 0 it is 0 or 100."""
    joined = baseline.select("metric", F.col("value").alias("baseline")).join(current.select("metric", F.col("value").alias("current")), "metric", "left")
    now = F.coalesce("current", F.lit(0))
    change = F.when(F.col("baseline") != 0, F.abs(now - F.col("baseline")) * 100.0 / F.abs(F.col("baseline"))).otherwise(F.when(now == 0, 0.0).otherwise(100.0))
    return joined.select("metric", "current", "baseline", change.alias("drift_pct"), (change <= tolerance).alias("ok"))


def invalid_values(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    return df.select(column).distinct().where(F.col(column).isNotNull() & ~F.col(column).isin(*allowed))


def verdict(statuses: Sequence[str], drift_ok: bool = True, strict: bool = False) -> bool:
    """No check failed; in strict mode nothing drifted either."""
    return "FAIL" not in statuses and (drift_ok or not strict)


def report(df: DataFrame, table: str, key: str) -> dict[str, str]:
    """Status of each check of one table: PASS, WARN or FAIL."""
    n = df.count()
    problems = schema_problems(df, table)
    needed = [c for c in schemas.required(table) if c in df.columns]
    nulls = {r["column_name"]: r["null_pct"] for r in null_profile(df, needed).collect()} if needed else {}
    duplicates = duplicate_ids(df, key).first()["duplicates"]
    return {
        "row_count": "PASS" if n else "FAIL",
        "schema": "FAIL" if problems["missing"] or problems["types"] else "WARN" if problems["extra"] else "PASS",
        "required": "PASS" if not any(nulls.values()) else "FAIL",
        "duplicates": "PASS" if not duplicates else "WARN",
    }


def as_json(reports: dict[str, dict[str, str]]) -> str:
    return json.dumps(reports, indent=1, sort_keys=True)
