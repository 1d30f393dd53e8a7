"""Audit of how filters interact: what each removes, in every order they could be applied, by lattice-edge aggregation.

The sets of filters already applied form a lattice; applying one more filter is an edge of it, (subset, next filter): 80
edges for five filters. A document contributes to each edge: it reaches the edge if it fails no filter of the
subset, and is removed there if it fails the next one. An order of filters is a path of five edges from the empty set to
the full one, so all 120 orders are read off the aggregated edges by one join with their 600 steps.

Documents are counted by part, failed filters and labels first, so that edges are made from a few counts a part. A filter on
repeated texts fails documents whose text occurs with a smaller id: rows of equal texts are counted by part and
labels before they meet, so a text that a third of all documents share is a few rows when it does.

Defined results: null texts are empty; a null source and an empty one are the same part; a null id is neither smaller nor
greater than others, so it fails no filter on repeated texts and makes none fail; rows with the same id and text don't repeat
each other; labels with the same id count if any of them does, those without a document are ignored; further columns are
ignored; an empty table gives no rows. Very long texts need memory for their words.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: White space, capitals and symbols that the filters count (fixed by the contract).
SPACE, CAPITAL, SYMBOL = r"[\x20\x09-\x0D]+", "[A-Z]", "[#$%&*|]"
#: The filter that fails repeated texts; the others are decided on a document alone.
REPEATED = "E"


def filters() -> dict[str, Column]:
    """Name -> whether a document fails, from its text, its words and the distinct ones among these."""
    words = F.size("words")
    return {
        "A": words < 200,
        "B": 100 * F.size(F.array_distinct("words")) < 50 * words,
        "C": 100 * F.regexp_count("text", F.lit(CAPITAL)) > 2 * F.length("text"),
        "D": F.col("text").rlike(SYMBOL),
    }


def failures(documents: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """doc_id, part, the digest of the text and the failed filters as a mask, for each document."""
    whole = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    worded = whole.withColumn("words", F.array_remove(F.split("text", SPACE), ""))
    mask = sum((F.when(fails, 1 << k).otherwise(0) for k, fails in enumerate(rules.values())), F.lit(0))
    return worded.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), mask.alias("mask"))


def counts(failed: DataFrame, labels: DataFrame, bit: int) -> DataFrame:
    """(part, mask, good, toxic, n): documents by what they fail, ``bit`` set for those whose text a smaller id has."""

    def marked(column: str) -> Column:
        return F.coalesce(F.max(F.col(column) == 1), F.lit(False)).alias(column)

    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic").groupBy("doc_id").agg(marked("quality"), marked("toxic"))
    told = failed.join(known, "doc_id", "left").select(
        "doc_id", "part", "digest", "mask", F.coalesce("quality", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic")
    )
    alike = ["digest", "part", "mask", "good", "toxic"]
    each = told.groupBy(*alike, "doc_id").agg(F.count("*").alias("n"))
    nameless, named = F.col("doc_id").isNull(), F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))
    own = each.groupBy(*alike).agg(F.sum("n").alias("n"), F.sum(F.when(nameless, F.col("n")).otherwise(0)).alias("nameless"), F.min(named).alias("first"))
    least = own.withColumn("least", F.min("first.doc_id").over(Window.partitionBy("digest")))  # at most four rows of a part each
    leading = F.when(F.col("first.doc_id") == F.col("least"), F.col("first.n")).otherwise(0)
    kept = F.col("nameless") + leading
    summed = least.groupBy("part", "mask", "good", "toxic").agg(F.sum(kept).alias("kept"), F.sum(F.col("n") - kept).alias("late"))
    either = F.array(F.struct(F.col("mask").alias("mask"), F.col("kept").alias("n")), F.struct(F.col("mask").bitwiseOR(F.lit(bit)).alias("mask"), F.col("late").alias("n")))
    return summed.select("part", "good", "toxic", F.inline(either)).where("n > 0")


def edges(counted: DataFrame, names: str) -> DataFrame:
    """Counts of each lattice edge (subset, filter) of each part, and the filter's removals over all orders."""
    n = len(names)
    all_edges = [F.struct(F.lit(s).alias("subset"), F.lit(f).alias("filter"), F.lit(1 << f).alias("own")) for s in range(1 << n) for f in range(n) if not s >> f & 1]
    reached = counted.select("*", F.inline(F.array(*all_edges)))
    fails, alive = F.col("mask").bitwiseAND(F.col("own")) != 0, F.col("mask").bitwiseAND(F.col("subset")) == 0

    def count(name: str, where: Column) -> Column:
        return F.sum(F.when(where, F.col("n")).otherwise(0)).alias(name)

    found = reached.groupBy("part", "subset", "filter").agg(
        count("kept", alive & ~fails),
        count("removed", alive & fails),
        count("redundant", ~alive & fails),
        count("unique_fails", F.col("mask") == F.col("own")),
        count("good_lost", alive & fails & F.col("good")),
        count("toxic_lost", alive & fails & F.col("toxic")),
    )
    orders = F.element_at(F.array(*(F.lit(factorial(k) * factorial(n - 1 - k)) for k in range(n))), F.bit_count("subset") + 1)
    return found.withColumn("shapley", F.sum(F.col("removed") * orders).over(Window.partitionBy("part", "filter")))


def paths(spark: SparkSession, names: str) -> DataFrame:
    """(filter_order, step, subset, filter): the steps of every order, each the edge that it takes."""
    orders = spark.range(1).select(F.explode(F.array(*(F.lit("".join(p)) for p in permutations(names)))).alias("filter_order"))
    steps = orders.select("filter_order", F.explode(F.sequence(F.lit(1), F.lit(len(names)))).alias("step"))
    before = sum((F.when(F.instr("filter_order", name) < F.col("step"), 1 << k).otherwise(0) for k, name in enumerate(names)), F.lit(0))
    return steps.select("filter_order", "step", before.alias("subset"), (F.instr(F.lit(names), F.substr("filter_order", "step", F.lit(1))) - 1).alias("filter"))


def audit(documents: DataFrame, labels: DataFrame, rules: dict[str, Column] | None = None) -> DataFrame:
    """One row for each part, order of the filters and step in it."""
    rules = filters() if rules is None else rules
    names = "".join(rules) + REPEATED
    counted = counts(failures(documents, rules), labels, 1 << len(rules))
    steps = F.broadcast(paths(documents.sparkSession, names))  # a row for each step of each order: 600 for five filters
    return edges(counted, names).join(steps, ["subset", "filter"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )
