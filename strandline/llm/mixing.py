"""Mixing sources to target weights by a low-discrepancy schedule, in DataFrame operations only.

Each source gets so many slots that blocks of equally many words make up its target; its last slot takes what is left over,
so that targets are met to the word. Slots in mix order are the van der Corput points: the bits of a point, read backwards, are the number of its slot, and the
point falls into the interval of one source, the sources' numbers of slots laid end to end. So every stretch of the mix holds the
sources nearly in their shares. How many slots before this one belong to the same source (its rank), or to any (its place in
the mix), follows from its point by arithmetic: among the slots that share a prefix, points are evenly spaced.

The slot of rank r takes block r of its source's stream: its documents in an order shuffled by hash, cut into blocks of
equally many words, read again from the start when it ends. Documents join slots by source and block. Places in the
stream are running sums over a table sorted over ranges of partitions, so neither a large source nor a group of equal rows meets in one task.

Defined results: null texts have no words; null is a source of its own, last in order; null ids and repeated rows are mixed
like others; sources without words have target 0; further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .store import TEXTS, keep

#: Words of a text (fixed by the contract).
WORD = r"[^\x20\x09-\x0D]+"
#: Rows of a chunk, to base 2, that running sums are taken over at once; bits of a row's number within its partition.
CHUNK_BITS, ROW_BITS = 10, 33


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def running(df: DataFrame, order: list[Column | str], values: dict[str, Column]) -> DataFrame:
    """``df`` with, for each name, the sum of its value over the rows before each in the given order.

    Rows are sorted over ranges of partitions and numbered; sums are taken over chunks of numbers, over the chunks of each
    partition, and over the partitions, whose number is bounded by the session's setting.
    """

    def total(name: str) -> Column:
        return F.sum(name).alias(name)

    def ahead(name: str, window: Window) -> Column:
        return (F.sum(name).over(window.rowsBetween(Window.unboundedPreceding, 0)) - F.col(name)).alias(name)

    label = "-".join(values)
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = ranged.select(F.struct(*df.columns).alias("row"), F.monotonically_increasing_id().alias("at"), *(v.cast("long").alias(n) for n, v in values.items()))
    placed = keep(placed.withColumn("chunk", F.shiftright("at", CHUNK_BITS)), f"mix-{label}")
    chunks = keep(placed.groupBy("chunk").agg(*map(total, values)).withColumn("part", F.shiftright("chunk", ROW_BITS - CHUNK_BITS)), f"mix-{label}-chunks")
    parts = chunks.groupBy("part").agg(*map(total, values)).select("part", *(ahead(n, Window.orderBy("part")).alias(f"part_{n}") for n in values))
    inner = chunks.select("chunk", "part", *(ahead(n, Window.partitionBy("part").orderBy("chunk")) for n in values))
    bases = inner.join(F.broadcast(parts), "part").select("chunk", *((F.col(n) + F.col(f"part_{n}")).alias(f"base_{n}") for n in values))
    within = placed.select("row", "chunk", *(ahead(n, Window.partitionBy("chunk").orderBy("at")) for n in values))
    return within.join(bases, "chunk").select("row.*", *((F.col(f"base_{n}") + F.col(n)).alias(n) for n in values))


def targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most: int = 3) -> DataFrame:
    """From (source, source_size): its number k in order and the words that each source should give, ``most`` times its size at most.

    What sources beyond their limit leave is shared by weight among the rest, in rounds until none is above.
    """
    ranked = running(sizes, [F.col("source").asc_nulls_last()], {"k": F.lit(1)})
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("k") % len(weights) + 1).cast("int"))
    weighed = keep(ranked.withColumn("weight", weight).withColumn("limit", F.lit(most) * F.col("source_size")), "mix-weights")
    unit, full = 0.0, -1
    while True:
        above = F.col("limit") < F.lit(unit) * F.col("weight")
        now = weighed.agg(
            F.sum("source_size").alias("words"), F.sum(F.when(above, F.col("limit"))).alias("given"),
            F.sum(F.when(~above, F.col("weight"))).alias("weight"), F.count(F.when(above, 1)).alias("full"),
        ).first()
        if now["full"] == full or not now["weight"]:
            break
        unit, full = ((now["words"] or 0) - (now["given"] or 0)) / now["weight"], now["full"]
    return weighed.select("k", "source", "source_size", F.least(F.col("limit").cast("double"), F.lit(unit) * F.col("weight")).alias("target"))


def shares(wanted: DataFrame, block_words: int) -> DataFrame:
    """Adds the words ``given`` by each source, its ``slots``, where its interval of points begins, ``low``, and the words of the
    sources ``ahead`` of it."""
    given = wanted.withColumn("given", F.round("target").cast("long"))
    return running(given.withColumn("slots", F.ceil(F.col("given") / block_words).cast("long")), ["k"], {"low": F.col("slots"), "ahead": F.col("source_size")})


def _before(bits: int, low: str, high: str) -> Column:
    """How many slots before that of ``point`` have their points from ``low`` to below ``high``: for each bit of the slot's number, those that
    agree above it and have 0 there, whose points are evenly spaced."""
    step = "shiftleft(1L, s + 1)"

    def upto(end: str) -> str:
        return f"least(greatest(shiftright({end} - (point & (shiftleft(1L, s) - 1L)) + {step} - 1L, s + 1), 0L), shiftleft(1L, {bits - 1} - s))"

    return F.expr(f"aggregate(sequence(0, {bits - 1}), 0L, (a, s) -> a + if((shiftright(point, s) & 1L) = 1L, {upto(high)} - {upto(low)}, 0L))")


def schedule(spark: SparkSession, shared: DataFrame) -> DataFrame:
    """(place, k, rank): the slots of the mix in order, the source of each, and its rank among the slots of that source."""
    counts = shared.agg(F.coalesce(F.sum("slots"), F.lit(0)).alias("slots"), F.count(F.when(F.col("slots") > 0, 1)).alias("sources")).first()
    total, bits = counts["slots"], max(1, (counts["slots"] - 1).bit_length())
    shift = max(0, bits - counts["sources"].bit_length() - 2)  # about as many cells as sources
    low, high = F.col("low"), F.col("low") + F.col("slots")
    cells = shared.where("slots > 0").select("k", "low", high.alias("high"), F.explode(F.sequence(F.shiftright(low, shift), F.shiftright(high - 1, shift))).alias("cell"))
    points = spark.range(total).select(F.col("id").alias("point")).withColumn("cell", F.shiftright("point", shift))
    found = points.join(cells, "cell").where("point >= low AND point < high")
    return found.select(_before(bits, "0L", f"{total}L").alias("place"), "k", _before(bits, "low", "high").alias("rank"))


def pieces(sized: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most: int = 3, block_words: int = 1024) -> tuple[DataFrame, DataFrame]:
    """From rows (row, doc_id, source, size) kept in a table: the stretches of documents that the mix takes, as (row, doc_id, pass, start,
    words, place, offset) with their place in the mix; and the sources with their targets."""
    spark = sized.sparkSession
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    shared = keep(shares(targets(sizes, weights, most), block_words), "mix-sources")
    source = shared.select(F.col("source").alias("name"), "k", "source_size", "given", "ahead")
    full = sized.where("size > 0").join(source, F.col("source").eqNullSafe(F.col("name"))).select("row", "doc_id", "size", "k", "source_size", "given", "ahead", _turn().alias("turn"))
    placed = running(full, ["k", "turn", "doc_id", "size", "row"], {"begin": F.col("size")}).withColumn("begin", F.col("begin") - F.col("ahead"))
    passes = F.expr(f"filter(sequence(0, {most - 1}), c -> begin + c * source_size < given)")
    read = placed.select("row", "doc_id", "size", "k", "given", "begin", "source_size", F.explode(passes).alias("pass")).withColumn("from", F.expr("begin + pass * source_size"))
    read = read.withColumn("upto", F.least(F.col("from") + F.col("size"), "given"))
    cut = read.withColumn("rank", F.explode(F.expr(f"sequence(from div {block_words}, (upto - 1) div {block_words})")))
    cut = cut.withColumn("first", F.greatest("from", F.col("rank") * block_words)).withColumn("last", F.least("upto", (F.col("rank") + 1) * block_words))
    stretches = cut.select(
        "row", "doc_id", "size", "pass", "k", "rank", (F.col("first") - F.col("from")).alias("start"), (F.col("last") - F.col("first")).alias("words"), (F.col("first") - F.col("rank") * block_words).alias("offset")
    )
    return stretches.join(schedule(spark, shared), ["k", "rank"]).drop("k", "rank"), shared


def _turn() -> Column:
    """A document's place in the shuffled order of its source: 60 bits of a hash that any database has."""
    key = F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("size").cast("string"), F.coalesce("source", F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def _sized(documents: DataFrame) -> DataFrame:
    """Rows numbered as read, kept in a table."""
    row = F.monotonically_increasing_id().alias("row")
    return keep(documents.select(row, F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size")), "mix-sizes")


def mix(documents: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most: int = 3, block_words: int = 1024) -> DataFrame:
    """``row`` (of the input as read), doc_id, size, source, source_size, target of the source, and taken words of every document."""
    sized = _sized(documents)
    taken, shared = pieces(sized, weights, most, block_words)
    by_row = taken.groupBy("row").agg(F.sum("words").alias("taken"))
    source = shared.select(F.col("source").alias("name"), "source_size", "target")
    told = sized.join(source, F.col("source").eqNullSafe(F.col("name"))).join(by_row, "row", "left")
    return told.select("row", "doc_id", "size", "source", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def copies(documents: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most: int = 3, block_words: int = 1024) -> DataFrame:
    """The mix as rows in its order: each document as often as it is taken whole, where its first word has its place; a part
    counts from half of the document on. Rows are sorted over ranges of partitions, as written one file after the other."""
    rows = keep(documents.select(F.struct(*documents.columns).alias("document"), F.monotonically_increasing_id().alias("row")), "mix-rows", TEXTS)
    sized = _numbered(rows)
    taken, _ = pieces(sized, weights, most, block_words)
    whole = taken.groupBy("row", "pass").agg(F.sum("words").alias("words"), F.max("size").alias("size"), F.min(F.when(F.col("start") == 0, F.struct("place", "offset"))).alias("at"))
    chosen = whole.where(2 * F.col("words") >= F.col("size")).select("row", "at.place", "at.offset")
    return rows.join(chosen, "row").orderBy("place", "offset", "row").select("document.*")


def _numbered(rows: DataFrame) -> DataFrame:
    """As ``_sized``, from rows that have their numbers."""
    d = F.col("document")
    return keep(rows.select("row", d["doc_id"].cast("long").alias("doc_id"), d["source"].cast("string").alias("source"), word_count(d["text"]).alias("size")), "mix-sizes")
