"""Checks of a staged table as one suite: declared as data, compiled into one aggregation, so a table is read once for all of them.

A check has an aggregate, which is its value, and a rule from values to a status; a rule that gives null leaves the check out,
as those of an empty table do. Statuses are PASS, WARN and FAIL, and DRIFT for a metric beyond its tolerance.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import schemas
from . import quality

#: The key of each table; a letter of the script; shares in percent beyond or below which a check passes.
KEYS = {"hadiths": "source_id", "narrator_mentions": "mention_id", "narrators_bio": "bio_id", "collections": "collection_id"}
SCRIPT, LEAST_SCRIPT, MOST_EMPTY = "[؀-ۿ]", 50.0, 50.0


@dataclass(frozen=True)
class Check:
    """``value`` is an aggregate over the table; ``status`` gets it, and the number of rows."""

    name: str
    value: Column
    status: Callable[[Column, Column], Column]


def _either(passes: Column, otherwise: str) -> Column:
    return F.when(passes, "PASS").otherwise(otherwise)


def table_of(name: str) -> str | None:
    """The table that a file is named after: hadiths_lk is one of hadiths."""
    return next((t for t in sorted(schemas.TABLES, key=len, reverse=True) if name == t or name.startswith(f"{t}_")), None)


def suite(df: DataFrame, table: str | None) -> list[Check]:
    """The checks that a table with these columns gets."""
    there = set(df.columns)
    blank = lambda c: F.count_if(F.col(c).isNull() | (F.btrim(F.col(c), F.lit(" \t\n\r")) == ""))
    checks = [Check("row_count", F.count("*"), lambda v, n: _either(v > 0, "FAIL"))]
    if table is None:
        checks.append(Check("schema_conformance", F.lit(0), lambda v, n: F.lit("WARN")))
    else:
        problems = sum(map(len, quality.schema_problems(df, table).values()))
        checks.append(Check("schema_conformance", F.lit(problems), lambda v, n: _either(v == 0, "FAIL")))
        for c in schemas.required(table):
            if c in there:
                checks.append(Check(f"null_check_{c}", quality.percent(F.count_if(F.col(c).isNull()), F.count("*")), lambda v, n: _either(v == 0, "FAIL")))
    key = KEYS.get(table or "")
    if key in there:
        # distinct keys, a null one among them
        distinct = F.countDistinct(key) + F.when(F.count_if(F.col(key).isNull()) > 0, 1).otherwise(0)
        checks.append(Check("duplicate_ids", F.count("*") - distinct, lambda v, n: F.when(n > 0, _either(v == 0, "WARN"))))
    for c in ("name_ar", "matn_ar"):
        if c in there:
            share = F.when(F.count(c) > 0, quality.percent(F.count_if(F.col(c).rlike(SCRIPT)), F.count(c)))
            checks.append(Check(f"arabic_encoding_{c}", share, lambda v, n: F.when(v.isNotNull(), _either(v > LEAST_SCRIPT, "WARN"))))
    if table == "hadiths":
        for c in ("matn_ar", "matn_en"):
            if c in there:
                checks.append(Check(f"empty_{c}", blank(c), lambda v, n: F.when(n > 0, _either(F.bround(v * 100.0 / n, 2) < MOST_EMPTY, "WARN"))))
        for c, label in (("book_number", "book"), ("chapter_number", "chapter")):
            if c in there:
                checks.append(Check(f"{label}_coverage", quality.percent(F.count(c), F.count("*")), lambda v, n: F.when(n > 0, F.lit("PASS"))))
    return checks


def drifts(baseline: dict[str, float], tolerance: float) -> list[Check]:
    """Metrics against what they were; against 0, no change or a full one."""
    now = {"row_count": F.count("*")}

    def check(metric: str, before: float) -> Check:
        change = F.bround(F.abs(now[metric] - before) * 100.0 / abs(before), 2) if before else F.when(now[metric] == 0, 0.0).otherwise(100.0)
        return Check(f"drift_{metric}", change, lambda v, n: _either(v <= tolerance, "DRIFT"))

    return [check(m, b) for m, b in baseline.items() if m in now]


def run(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """(check, status, value) of all checks, from one aggregation."""
    values = df.agg(F.count("*").alias("n"), *(c.value.cast("double").alias(f"v{k}") for k, c in enumerate(checks)))
    rows = [F.struct(F.lit(c.name).alias("check"), c.status(F.col(f"v{k}"), F.col("n")).alias("status"), F.col(f"v{k}").alias("value")) for k, c in enumerate(checks)]
    return values.select(F.inline(F.array(*rows))).where("status IS NOT NULL")


def validate(df: DataFrame, table: str | None, baseline: dict[str, float] | None = None, tolerance: float = 30.0) -> DataFrame:
    return run(df, [*suite(df, table), *drifts(baseline or {}, tolerance)])


def passed(statuses: Sequence[str], strict: bool = False) -> bool:
    """Nothing failed; if strict, nothing drifted either."""
    return quality.verdict(statuses, "DRIFT" not in statuses, strict)


def report(found: dict[str, list], strict: bool = False) -> dict:
    """What is written as JSON: each file's checks and whether it passed, and whether all did."""
    files = {name: {"checks": [r.asDict() for r in rows], "passed": passed([r["status"] for r in rows], strict)} for name, rows in sorted(found.items())}
    return {"files": files, "passed": all(f["passed"] for f in files.values())}


def as_json(result: dict) -> str:
    return json.dumps(result, indent=1, sort_keys=True)
