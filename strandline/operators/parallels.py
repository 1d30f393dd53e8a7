"""Parallel texts: nearest neighbours by inner product of unit vectors.

Exact search (``partners``) multiplies all rows with all, in groups of bounded size that keep each row's best k; the best k of all groups are
then taken per row. For corpora beyond exact search, ``candidates_by_planes`` compares only rows that agree on random hyperplanes.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import similarity
from . import partners

K, THRESHOLD = 50, 0.70


def neighbours(vectors: DataFrame, key: str, vector: str, k: int = K, threshold: float = THRESHOLD, block_rows: int = partners.PART_ROWS) -> DataFrame:
    """(a, b, score) with score >= threshold where b is among the k best of a or a among those of b; a < b, each pair once."""
    rows = vectors.select(F.col(key).alias("id"), F.col(vector).alias("v"), F.lit(0).alias("of"))
    top = partners.within(rows, k, threshold, block_rows)
    return top.groupBy(F.least("id", "partner").alias("a"), F.greatest("id", "partner").alias("b")).agg(F.max("score").alias("score"))


def candidates_by_planes(vectors: DataFrame, key: str, vector: str, planes: int = 12, tables: int = 16, seed: int = 7) -> DataFrame:
    """Pairs (a, b) that fall on the same sides of all planes of a table, for one table at least."""
    width = len(vectors.select(vector).first()[0])
    normals = np.random.default_rng(seed).standard_normal((tables, planes, width))

    def sides(batches):
        for batch in batches:
            m = np.stack(batch["v"].to_numpy()).astype(np.float64)
            codes = ((np.einsum("tpw,nw->ntp", normals, m) > 0) << np.arange(planes)).sum(axis=2) + (np.arange(tables) << planes)
            yield pd.DataFrame({"id": np.repeat(batch["id"].to_numpy(), tables), "code": codes.ravel()})

    kind = dict(vectors.dtypes)[key]
    coded = vectors.select(F.col(key).alias("id"), F.col(vector).alias("v")).mapInPandas(sides, f"id {kind}, code long")
    x, y = coded.alias("x"), coded.alias("y")
    return x.join(y, (F.col("x.code") == F.col("y.code")) & (F.col("x.id") < F.col("y.id"))).select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct()


def links(pairs: DataFrame, corpora: DataFrame, verbatim: float = 0.9, close: float = 0.8) -> DataFrame:
    """Pairs with their tier, and whether they cross sects; ``corpora``: (id, source_corpus)."""
    a, b = corpora.select(F.col("id").alias("a"), F.col("source_corpus").alias("ca")), corpora.select(F.col("id").alias("b"), F.col("source_corpus").alias("cb"))
    return pairs.join(a, "a").join(b, "b").select(
        F.col("a").alias("hadith_id_a"), F.col("b").alias("hadith_id_b"), F.col("score").cast("float").alias("similarity_score"),
        similarity.tier(F.col("score"), verbatim, close).alias("variant_type"), similarity.cross_sect(F.col("ca"), F.col("cb")).alias("cross_sect"),
    )
