"""Unit vectors of texts without a trained model: TF-IDF weights of hashed words, projected by a sparse random matrix.

A word's row of the matrix follows from its MD5: eight chunks of it name a place and a sign each, so the matrix is never made or
shipped. Weights are (1 + ln tf) * (1 + ln((1 + n) / (1 + df))). All of it is DataFrame operations: texts are dealt by key, their words counted there,
joined with their document counts, and each gives eight numbers that are added up per text. The counts of the ``COMMON`` words that most texts have are broadcast and
joined where the text is; only rows of other words go by word to their counts and back, as weight and digest, and become eight numbers last.

Defined results: weights are added up as whole numbers of 2 ** -40, so copies have equal vectors in whatever order; texts without a word have no vector; null keys are left out; rows with the same key are one text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD, CHUNKS, COMMON, TASK_TEXTS = r"[\p{L}\p{N}]+", 8, 100_000, 2000


def _projected(digest: Column, dims: int) -> Column:
    """(place, sign) of each chunk of a word's digest."""
    hexed = F.hex(digest)
    chunks = [F.conv(F.substring(hexed, 4 * k + 1, 4), 16, 10).cast("int") for k in range(CHUNKS)]
    return F.array(*(F.struct((c % dims).alias("place"), F.when(c >= 1 << 15, 1.0).otherwise(-1.0).alias("sign")) for c in chunks))


def embed(texts: DataFrame, key: str, column: str, dims: int = 128, keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(id, v): a unit vector of each text, as an array of doubles. ``keep`` stores the words' document counts, which are used twice."""
    found = texts.where(F.col(key).isNotNull()).select(F.col(key).alias("id"), F.array_join(F.regexp_extract_all(F.lower(column), F.lit(WORD), F.lit(0)), " ").alias("words"))
    found = found.where("words <> ''")
    n = found.agg(F.countDistinct("id").alias("n")).first()["n"]
    tasks = max(texts.sparkSession.sparkContext.defaultParallelism, -(-n // TASK_TEXTS))
    counts = found.repartition(tasks, "id").select("id", F.explode(F.split("words", " ")).alias("word")).groupBy("id", "word").agg(F.count("*").alias("tf"))
    seen = counts.groupBy("word").agg(F.count("*").alias("df"))
    seen = keep(seen) if keep else seen
    idf = (1 + F.log(F.lit(1.0 + n) / (1 + F.col("df")))).alias("idf")
    common = seen.orderBy(F.desc("df"), "word").limit(COMMON).select("word", "df", F.unhex(F.md5("word")).alias("digest"))
    known = counts.join(F.broadcast(common), "word", "left")
    near = known.where("df IS NOT NULL").select("id", "tf", idf, "digest")
    rare = known.where("df IS NULL").select("id", "word", "tf").join(seen.hint("merge"), "word").select("id", "tf", idf, F.unhex(F.md5("word")).alias("digest"))

    def added(each: DataFrame, name: str) -> DataFrame:
        sent = each.select("id", F.inline(_projected(F.col("digest"), dims)), ((1 + F.log("tf")) * F.col("idf") * (1 << 40)).cast("long").alias("weight"))
        sums = sent.groupBy("id", "place").agg(F.sum(F.col("weight") * F.col("sign").cast("long")).alias("x"))
        return sums.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("place", "x"))).alias(name))

    both = added(near, "near").join(added(rare.repartition(tasks, "id"), "rare"), "id", "full")
    at = lambda m, k: F.coalesce(F.element_at(m, k), F.lit(0).cast("long"))
    summed = both.select("id", F.transform(F.sequence(F.lit(0), F.lit(dims - 1)), lambda k: (at("near", k) + at("rare", k)).cast("double")).alias("x"))
    measured = summed.withColumn("length", F.sqrt(F.aggregate("x", F.lit(0.0), lambda total, x: total + x * x)))
    return measured.where("length > 0").select("id", F.transform("x", lambda x: x / F.col("length")).alias("v"))
