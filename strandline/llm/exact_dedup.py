"""Exact dedup by deterministic block naming, in DataFrame operations only.

A text without white space is cut into blocks of a fixed size. Sorting the distinct blocks gives each an integer name;
sorting the distinct pairs of adjacent names gives each pair an integer name; after as many levels as the block count
halves, one name is left. Texts with the same number of blocks are equal exactly if their last names are equal.

Blocks travel once, as distinct values: a block's sort key is its 64-bit hash, and the block itself joins the key
wherever two different blocks share a hash, so names never collide. Keys are sorted over ranges of partitions; hot
keys (copies) shrink to one row per task before they move and meet again only in joins that split skewed keys.

Defined results: null is an empty text; texts of white space only equal the empty text; of repeated rows, one stays;
null ids lose ties against others; further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import TEXTS, keep

#: White space that does not count (fixed by the contract).
SPACE = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, "")


def blocks(text: Column, size: int) -> Column:
    """The text in pieces of ``size`` code points; one empty block for an empty text."""
    return F.when(F.length(text) <= size, F.array(text)).otherwise(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0)))


def names(keys: DataFrame, columns: list[str], label: str) -> DataFrame:
    """An integer for each distinct row of ``columns``, in sorted order."""
    distinct = keys.select(*columns).distinct()
    ranged = distinct.repartitionByRange(*columns).sortWithinPartitions(*columns)
    return keep(ranged.withColumn("name", F.monotonically_increasing_id()), label)


def _same(a: DataFrame, b: DataFrame, columns: list[str]) -> Column:
    return reduce(lambda x, y: x & y, (a[c].eqNullSafe(b[c]) for c in columns))


def identities(documents: DataFrame, block_size: int = 2048, hash_bits: int = 64, row: str | None = None) -> DataFrame:
    """row (numbered here, or taken from the column ``row``), doc_id, n_chars of the text as it is, text_sha256, n_blocks and name: equal texts have equal (n_blocks, name)."""

    def hashed(block: Column) -> Column:
        return F.xxhash64(block) if hash_bits == 64 else F.pmod(F.xxhash64(block), F.lit(1 << hash_bits))

    own = F.col(row) if row else F.monotonically_increasing_id()
    rows = documents.select(own.alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text", normalised(F.col("text")).alias("norm"))
    distinct = rows.select(F.explode(blocks(F.col("norm"), block_size)).alias("block")).select(hashed(F.col("block")).alias("hash"), "block").distinct()
    shared = distinct.groupBy("hash").count().where("count > 1").select("hash")
    contested = sorted(r["hash"] for r in shared.collect())  # hashes of two different blocks: none are expected
    in_doubt = F.array(*map(F.lit, contested)).cast("array<long>")
    cut = keep(
        rows.withColumn("blocks", blocks(F.col("norm"), block_size)).select(
            "row",
            "doc_id",
            F.length(F.coalesce("text", F.lit(""))).alias("n_chars"),
            F.sha2("norm", 256).alias("text_sha256"),
            F.size("blocks").alias("n_blocks"),
            F.transform("blocks", lambda b: F.struct(hashed(b).alias("hash"), F.when(F.array_contains(in_doubt, hashed(b)), b).alias("block"))).alias("keys"),
        ),
        "dedup-blocks",
    )
    level = cut.select("row", "n_blocks", F.posexplode("keys").alias("place", "key")).select("row", "n_blocks", "place", "key.hash", "key.block")
    most = cut.agg(F.max("n_blocks")).first()[0] or 1
    columns, left, done = ["hash", "block"], most, []
    for depth in range(64):
        named = names(level, columns, f"dedup-names-{depth}")
        level = level.join(named, _same(level, named, columns)).select("row", "n_blocks", "place", named["name"])
        level = keep(level, f"dedup-level-{depth}") if left > 1 else level
        ends = F.col("n_blocks") <= F.lit(1 << depth)
        done.append(level.where(ends).select("row", "name"))
        if left <= 1:
            break
        level = (
            level.where(~ends)
            .groupBy("row", "n_blocks", F.shiftright("place", 1).alias("place"))
            .agg(F.max(F.when(F.col("place") % 2 == 0, F.col("name"))).alias("first"), F.max(F.when(F.col("place") % 2 == 1, F.col("name"))).alias("second"))
        )
        columns, left = ["first", "second"], (left + 1) // 2
    return cut.drop("keys").join(reduce(DataFrame.union, done), "row")


def dedup(documents: DataFrame, block_size: int = 2048, hash_bits: int = 64) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 for each row: of equal texts the longest as written, then the
    smallest doc_id, stays."""
    return _decided(documents, block_size, hash_bits).drop("row")


def survivors(documents: DataFrame, block_size: int = 2048) -> DataFrame:
    """The documents that stay, with all their columns."""
    rows = keep(documents.select(F.struct(*documents.columns).alias("document"), F.monotonically_increasing_id().alias("row")), "dedup-documents", TEXTS)
    dropped = keep(_decided(rows.select("row", "document.doc_id", "document.text"), block_size, row="row").where("NOT kept").select("row"), "dedup-dropped")
    return rows.join(dropped, "row", "left_anti").select("document.*")


def _decided(documents: DataFrame, block_size: int = 2048, hash_bits: int = 64, row: str | None = None) -> DataFrame:
    rows = keep(identities(documents, block_size, hash_bits, row), "dedup-rows")
    rank = F.struct("n_chars", F.col("doc_id").isNotNull(), F.bitwise_not("doc_id"), F.bitwise_not("row"))
    groups = rows.groupBy("n_blocks", "name").agg(
        F.count("*").alias("group_size"), F.max_by(F.struct("row", "doc_id"), rank).alias("best")
    )
    copies = keep(groups.where("group_size > 1").select("n_blocks", "name", "group_size", "best.row", "best.doc_id").toDF("n_blocks", "name", "group_size", "keep_row", "keep_id"), "dedup-groups")
    return rows.join(copies, ["n_blocks", "name"], "left").select(
        "row",
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        F.coalesce(F.col("row") == F.col("keep_row"), F.lit(True)).alias("kept"),
        "text_sha256",
    )
