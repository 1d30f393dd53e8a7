"""The corpus pipeline, from raw documents to packed sequences: each stage works on the table its predecessor wrote.

Defined results are those of the operators: null and empty texts fail the quality rules' word limit and go; rows with null ids are
documents like others; of repeated rows one stays; ties in exact dedup go to the longest text as written, then the
smallest id; further columns are carried to the last stage, whatever their names; an empty table gives no rows. A stage's
result is to be written before the next stage, or the next run, begins: these delete what earlier ones left in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strandline.llm import exact_dedup, mixing, near_dedup, packing, quality
from strandline.llm.queries import vocabulary
from strandline.llm.store import keep, stage


@stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted(docs)


@stage
def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.survivors(docs)


@stage
def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.distinct(docs)


@stage
def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.copies(docs)


@stage
def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, vocabulary())


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_copies),
    ("MinHash near-dedup", near_copies),
    ("source mixing", source_mix),
    ("best-fit packing", sequences),
]

#: Expectation-maximisation, union-find and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES[:-1]:
        docs = keep(apply(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
