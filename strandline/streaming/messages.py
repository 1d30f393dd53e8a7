"""Pointer messages: strict parsing, with what doesn't parse on a side output."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FIELDS = ("batch_id", "source", "b2_path", "timestamp", "record_count")
_SCHEMA = "batch_id string, source string, b2_path string, timestamp timestamp, record_count int"


def parse(raw: DataFrame, column: str = "value") -> DataFrame:
    """``raw`` and the message's fields, with ``error``: null, or why the message is refused. Unknown keys are refused."""
    keys = F.json_object_keys(column)
    message = F.from_json(column, _SCHEMA)
    extra = F.array_except(keys, F.array(*map(F.lit, FIELDS)))
    missing = F.array_except(F.array(*(F.lit(f) for f in FIELDS if f != "timestamp")), keys)
    parsed = raw.withColumn("message", message).withColumn("keys", keys).select(F.col(column).alias("raw_payload"), "message.*", "keys", extra.alias("extra"), missing.alias("missing"))
    empty = F.array_compact(F.array(*(F.when(F.coalesce(F.col(f), F.lit("")) == "", F.lit(f)) for f in ("batch_id", "source", "b2_path"))))
    error = (
        F.when(F.col("keys").isNull(), F.lit("not a JSON object"))
        .when(F.size("extra") > 0, F.concat(F.lit("unknown keys: "), F.array_join("extra", ", ")))
        .when(F.size("missing") > 0, F.concat(F.lit("missing keys: "), F.array_join("missing", ", ")))
        .when(F.size(empty) > 0, F.concat(F.lit("empty: "), F.array_join(empty, ", ")))
        .when(F.col("record_count").isNull() | (F.col("record_count") < 0), F.lit("record_count is not a number of records"))
    )
    return parsed.withColumn("error", error).drop("keys", "extra", "missing")


def split(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    return parsed.where("error IS NULL").drop("error", "raw_payload"), parsed.where("error IS NOT NULL").select("raw_payload", "error")
