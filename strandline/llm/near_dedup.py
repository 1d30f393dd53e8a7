"""Near-duplicate groups by SuperMinHash, banding, verification and union-find.

A document's set is its distinct shingles of words. Documents with equal sets form a class by a 128-bit digest of the
set; everything after that handles one row per class, so copies cost nothing more. SuperMinHash fills all slots of a
signature from one permutation per shingle: the values of a shingle over the slots are distinct ranks plus a fraction, which
lowers the variance, and a shingle stops at the highest rank that any slot still holds. Bands of slots give bucket keys.

Within a bucket, each class is first compared with the smallest class of the bucket only, and confirmed links are merged
by star contraction. All classes of buckets in which some are then still apart meet by shared rare shingles: among the
rarest of each set, so many that two sets at the similarity must share one. First, in rounds, each is compared with one
other class for each of its rare shingles, a new one each round, until no round joins any more; a group whose members lie just
below and just above the similarity comes together that way, in proportion to its size. Then those still apart are paired, in
places that leave enough shingles after the shared one. So neither a common passage nor a large group of copies of copies makes all
pairs. Every link is confirmed on the full sets. Bands and rows follow from the similarity: at 0.8, 40 bands of 5 slots, a pair meets in no band once in 8 million pairs.

Defined results: null texts, and texts without words, have no shingles and are linked with nothing; texts with fewer words
than a shingle have one, the whole sequence; repeated rows are linked with each other; a row with a null id is linked like
others, and a group of null ids only has a null id; further columns are ignored; an empty table gives no rows. Texts are
handled whole, one batch of them in memory.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import keep, modest_batches

SLOTS = 200
#: Rare shingles of a set up to which each of its rows carries the list of all of them.
LISTED = 64
#: Rounds of single comparisons, at most, before what is still apart is paired.
ROUNDS = 4
_U = np.uint64
_BASE = 0x9E3779B97F4A7C55
_UNIT = pow(_BASE, -1, 1 << 64)
_BYTES = np.random.default_rng(20240229).integers(0, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in enumerate((_BASE, _UNIT)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles: polynomial hashes of the words joined by spaces, from prefix sums."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # ASCII letters and ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    joined = np.frombuffer(b" ".join(words), np.uint8)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths) - 1
    starts = ends - lengths + 1
    power, unit = _powers(len(joined) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[joined] * power[: len(joined)], dtype=np.uint64)])
    size = min(size, len(words))
    first, last = starts[: len(words) - size + 1], ends[size - 1 :]
    return np.unique(_mix((sums[last] - sums[first]) * unit[first]))


#: Shingles that are worked on at once: each takes a place for every slot.
AT_ONCE = 1 << 17


def signatures(sets: list[np.ndarray], slots: int, most: int = AT_ONCE) -> np.ndarray:
    """SuperMinHash signatures of non-empty sets: one row per set. As a signature is the least value of each slot over the
    set's shingles, large sets are worked on in parts of ``most`` shingles, and small ones together up to so many."""
    out = np.full((len(sets), slots), np.iinfo(np.uint64).max, np.uint64)
    parts = [(k, s[low : low + most]) for k, s in enumerate(sets) for low in range(0, len(s), most)]
    first, size = 0, 0
    for last, (_, part) in enumerate([*parts, (-1, np.zeros(most + 1, np.uint64))]):
        if size + len(part) > most and last > first:
            own = [k for k, _ in parts[first:last]]
            np.minimum.at(out, own, _signatures([p for _, p in parts[first:last]], slots))
            first, size = last, 0
        size += len(part)
    return out


def _signatures(sets: list[np.ndarray], slots: int) -> np.ndarray:
    """Signatures of sets worked on together. A value holds the rank in its top 8 bits, then the fraction."""
    values, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    out = np.full(len(sets) * slots, np.iinfo(np.uint64).max, np.uint64)
    places: np.ndarray | None = None
    for rank in range(slots):
        drawn = _mix(values + _U((rank + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        chosen = (rank + ((drawn >> _U(32)) * _U(slots - rank) >> _U(32))).astype(np.intp)
        fraction = (drawn * _U(0xD6E8FEB86659FD93)) >> _U(8)
        if rank == 0:
            slot = chosen
        else:
            row = np.arange(len(values))
            slot = places[row, chosen].astype(np.intp)
            places[row, chosen] = places[:, rank]
        np.minimum.at(out, owner * slots + slot, fraction | _U(rank << 56))
        highest = out.reshape(-1, slots).max(axis=1) >> _U(56)
        going = (highest > rank)[owner]
        if not going.any():
            break
        if rank == 0:
            values, owner, chosen = values[going], owner[going], chosen[going]
            places = np.tile(np.arange(slots, dtype=np.uint8), (len(values), 1))
            places[np.arange(len(values)), chosen] = 0
        elif going.mean() < 0.7:
            values, owner, places = values[going], owner[going], places[going]
    return out.reshape(-1, slots)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit key of each band of each signature."""
    cells = signature.reshape(len(signature), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), cells.shape[:2])
    for k in range(rows):
        key = _mix(key * _U(0x9E3779B97F4A7C15) + cells[:, :, k])
    return key.view(np.int64)


def _bits(signature: np.ndarray) -> np.ndarray:
    """One bit of each slot, as four integers a row: similar sets differ in few of them."""
    one = (_mix(signature[:, :256]) >> _U(63)).astype(np.uint8)
    one = np.pad(one, ((0, 0), (0, 256 - one.shape[1])))
    return np.packbits(one, axis=1).view(np.int64)


def sketches(documents: DataFrame, size: int, percent: int = 80) -> DataFrame:
    """doc_id, text_hash, n_shingles, the digest of the set (high, low), its band keys and bits, for every document."""
    bands, rows = banding(percent)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 128):
                batch = whole.slice(start, 128)
                sets = [shingles(t, size) for t in batch.column(2).to_pylist()]
                full = [k for k, s in enumerate(sets) if len(s)]
                counts, bits = np.zeros((2, len(sets)), np.int32), np.zeros((len(sets), 4), np.int64)
                counts[0, full], counts[1] = bands, 4
                keys = np.zeros(0, np.int64)
                if full:
                    signature = signatures([sets[k] for k in full], bands * rows)
                    keys, bits[full] = band_keys(signature, bands, rows).ravel(), _bits(signature)
                digest = [[int(np.sum(_mix(s + _U(k)), dtype=np.uint64).astype(np.int64)) for s in sets] for k in (1, 2)]
                lists = [
                    pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(n)]).astype(np.int32), pa.array(values))
                    for n, values in zip(counts, (keys, bits.ravel()), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()), *(pa.array(d, pa.int64()) for d in digest), *lists],
                    ["doc_id", "text_hash", "n_shingles", "high", "low", "keys", "bits"],
                )

    kinds = "doc_id long, text_hash long, n_shingles long, high long, low long, keys array<long>, bits array<long>"
    return _hashed(documents).mapInArrow(sketch, kinds)


def _hashed(documents: DataFrame) -> DataFrame:
    return modest_batches(documents).select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")


def banding(percent: int, slots: int = SLOTS, risk: float = 2e-7) -> tuple[int, int]:
    """Bands, and rows of each: so many rows that a pair at the similarity meets in no band with at most the risk."""
    rows = max((r for r in range(1, slots + 1) if (1 - (percent / 100) ** r) ** (slots // r) <= risk), default=1)
    return slots // rows, rows


def most_apart(percent: int, slots: int = SLOTS, risk: float = 1e-8) -> int:
    """The most places in which the bits of two sets at the similarity differ, but for one pair in 1 / ``risk``.

    A bit differs with probability (1 - similarity) / 2 a slot; the bound is that of independent slots, and those of
    SuperMinHash vary less. It is the smallest number whose binomial tail is at most the risk; at a low similarity it lets all pass.
    """
    p = (1 - percent / 100) / 2
    tail, k = 0.0, slots
    while k > 0:
        tail += math.exp(math.lgamma(slots + 1) - math.lgamma(k + 1) - math.lgamma(slots - k + 1) + k * math.log(p) + (slots - k) * math.log1p(-p)) if p > 0 else 0.0
        if tail > risk:
            break
        k -= 1
    return k


def _alike(a: str, b: str, percent: int) -> Column:
    """Whether sizes allow the similarity, and bits differ in few enough places. A pattern of the join's condition, so
    other pairs are never made."""
    bands, rows = banding(percent)
    limit = most_apart(percent, bands * rows)
    n, m = F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles")
    apart = sum((F.bit_count(F.get(f"{a}.bits", k).bitwiseXOR(F.get(f"{b}.bits", k))) for k in range(4)), F.lit(0))
    return (100 * n >= percent * m) & (100 * m >= percent * n) & (apart <= limit)


def confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}
        for batch in batches:
            a, b, text_a, text_b = (batch.column(i).to_pylist() for i in range(4))
            out = []
            for x, y, s, t in zip(a, b, text_a, text_b, strict=True):
                if len(known) > 64:
                    known.clear()
                for k, text in ((x, s), (y, t)):
                    if k not in known:
                        known[k] = shingles(text, size)
                common = len(np.intersect1d(known[x], known[y], assume_unique=True))
                out.append(100 * common >= percent * (len(known[x]) + len(known[y]) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(out))

    first = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    both = modest_batches(first.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b"))
    return both.select("a", "b", "text_a", "text_b").mapInArrow(check, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(id, root) of every linked id: union-find as alternating large and small stars, in rounds until nothing changes."""
    edges = keep(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "near-edges")
    while True:
        both = edges.union(edges.select("v", "u"))
        least = keep(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "near-least")
        large = keep(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct(), "near-large")
        down = keep(large.groupBy("u").agg(F.min("v").alias("m")), "near-down")
        small = large.join(down, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = keep(small.union(down.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "near-edges")
        same = after.join(edges, ["u", "v"], "left_anti").isEmpty() and edges.join(after, ["u", "v"], "left_anti").isEmpty()
        edges = after
        if same:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("root"))


def _prefixes(texts: DataFrame, members: DataFrame, size: int, percent: int) -> DataFrame:
    """Members once for each of their rarest shingles, with its rank: two sets at the similarity share one of them."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = shingles(text, size)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), k, np.int64)), pa.array(found.view(np.int64))], ["id", "key"])

    spread_out = texts.join(members.select("id"), "id", "left_semi").select("id", "text").mapInArrow(spread, "id long, key long")
    every = keep(spread_out, "near-shingles")
    counts = keep(every.groupBy("key").agg(F.count("*").alias("docs")), "near-counts")
    ranked = every.join(counts, "key").withColumn("rank", F.row_number().over(Window.partitionBy("id").orderBy("docs", "key")))
    short = F.col("n_shingles") - F.ceil(F.col("n_shingles") * percent / 100) + 1
    rarest = ranked.where("docs > 1").join(members, "id").where(F.col("rank") <= short).select("key", "rank", *members.columns)
    rarest = keep(rarest, "near-rarest")
    listed = F.transform(F.array_sort(F.collect_list(F.struct("rank", "key"))), lambda s: s["key"])
    lists = rarest.groupBy("id").agg(F.count("*").alias("n"), listed.alias("listed")).where(F.col("n") <= LISTED)
    return rarest.join(lists.select("id", "listed"), "id", "left")


def _around(rare: DataFrame, turn: int, percent: int) -> DataFrame:
    """Pairs (a, b) of classes still apart: each with the one class that the turn picks for a rare shingle of it."""
    one = F.min(F.struct(F.xxhash64("id", F.lit(turn)).alias("h"), "id", "root", "n_shingles", "bits")).alias("one")
    mixed = rare.groupBy("key").agg(one, F.min("root").alias("r"), F.max("root").alias("s")).where("r < s").select("key", "one.*")
    x, y = rare.alias("x"), mixed.alias("y")
    meet = (F.col("x.key") == F.col("y.key")) & (F.col("x.root") != F.col("y.root")) & _alike("x", "y", percent)
    return x.join(y, meet).select(F.col("y.id").alias("a"), F.col("x.id").alias("b")).distinct()


def _joined(rare: DataFrame, texts: DataFrame, size: int, percent: int) -> tuple[DataFrame, list[DataFrame]]:
    """Rounds of ``_around``: members with the roots they then have, and the links found."""
    links: list[DataFrame] = []
    for turn in range(ROUNDS):
        found = keep(confirmed(_around(rare, turn, percent), texts, size, percent), "near-around")
        if found.isEmpty():
            break
        links.append(found)
        roots = rare.select("id", "root").distinct()
        over = roots.toDF("a", "u"), roots.toDF("b", "v")
        merged = components(found.join(over[0], "a").join(over[1], "b").select(F.col("u").alias("a"), F.col("v").alias("b")))
        moved = merged.select(F.col("id").alias("root"), F.col("root").alias("after"))
        rare = keep(rare.join(moved, "root", "left").withColumn("root", F.coalesce("after", "root")).drop("after"), "near-rare")
    return rare, links


def _sharing(rare: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different roots that share a rare shingle, where its ranks leave enough shingles to reach the similarity.

    Of two sets at the similarity, the first shared shingle in the common order has at least the needed overlap from its
    rank on in both; in the smaller set it lies among even fewer.
    """
    nearest = F.col("n_shingles") - F.ceil(F.col("n_shingles") * (2 * percent) / (100 + percent)) + 1
    x, y = rare.alias("x"), rare.where(F.col("rank") <= nearest).alias("y")
    n, m = F.col("x.n_shingles"), F.col("y.n_shingles")
    overlap = F.ceil((n + m) * percent / (100 + percent))
    left = F.least(n - F.col("x.rank"), m - F.col("y.rank")) + 1
    # where both lists are short, a pair is made at its first shared shingle only; else at each, and made distinct after
    first = F.coalesce(F.get(F.array_intersect("x.listed", "y.listed"), 0) == F.col("x.key"), F.lit(True))
    meet = (F.col("x.key") == F.col("y.key")) & ((n > m) | ((n == m) & (F.col("x.id") < F.col("y.id")))) & (F.col("x.root") != F.col("y.root")) & (left >= overlap) & _alike("x", "y", percent) & first
    return x.join(y, meet).select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct()


def _first() -> Column:
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")


def distinct(documents: DataFrame, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group, that with the smallest doc_id (then text hash), with all columns; rows that agree in both
    are left to exact dedup."""
    found = keep(groups(documents, shingle_words, percent).where("NOT first").select("doc_id", "text_hash"), "near-dropped")
    rows = documents.select(F.struct(*documents.columns).alias("document"))
    same = F.col("dropped.doc_id").eqNullSafe(F.col("document.doc_id").cast("long")) & (F.col("dropped.text_hash") == F.xxhash64("document.text"))
    return rows.join(found.alias("dropped"), same, "left_anti").select("document.*")


def groups(documents: DataFrame, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, text_hash, first, n_shingles, component_id and kept for every document: its group is all it reaches over
    links, and ``first`` marks the one document of it that stays."""
    rows = keep(sketches(documents, shingle_words, percent), "near-rows")
    by_set = rows.where("n_shingles > 0").groupBy("n_shingles", "high", "low").agg(
        F.min("doc_id").alias("least_id"), F.min(_first()).alias("one"), F.count("*").alias("copies")
    )
    classes = keep(by_set.withColumn("id", F.monotonically_increasing_id()), "near-classes")
    one = classes.select("id", F.col("one.doc_id").alias("one_id"), F.col("one.text_hash").alias("one_hash"))
    named = rows.where("n_shingles > 0").join(one, F.col("doc_id").eqNullSafe(F.col("one_id")) & (F.col("text_hash") == F.col("one_hash")))
    named = keep(named.select("id", "n_shingles", "bits", "keys"), "near-named")
    bands = named.select("id", F.explode("keys").alias("key"))
    buckets = keep(bands.groupBy("key").agg(F.min("id").alias("center"), F.max("id").alias("last")).where("center < last").select("key", "center"), "near-buckets")
    placed = keep(bands.join(buckets, "key").distinct(), "near-placed")
    involved = keep(placed.select("id").distinct(), "near-involved")
    facts = keep(named.select("id", "n_shingles", "bits").join(involved, "id", "left_semi").dropDuplicates(["id"]), "near-facts")
    wanted = one.join(involved, "id", "left_semi")
    texts = keep(_hashed(documents).join(wanted, F.col("doc_id").eqNullSafe(F.col("one_id")) & (F.col("text_hash") == F.col("one_hash"))).dropDuplicates(["id"]).select("id", "text"), "near-texts")

    stars = placed.where("id <> center").select(F.col("center").alias("a"), F.col("id").alias("b")).distinct()
    x, y = facts.alias("x"), facts.alias("y")
    likely = stars.join(x, F.col("a") == F.col("x.id")).join(y, (F.col("b") == F.col("y.id")) & _alike("x", "y", percent)).select("a", "b")
    links = keep(confirmed(likely, texts, shingle_words, percent), "near-links")
    roots = components(links)

    members = placed.select("key", "id").join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    members = keep(members.join(facts, "id"), "near-members")
    mixed = keep(members.groupBy("key").agg(F.min("root").alias("r"), F.max("root").alias("s")).where("r <> s").select("key"), "near-mixed")
    apart = keep(members.join(mixed, "key").drop("key").dropDuplicates(["id"]), "near-apart")
    rare = keep(_prefixes(texts, apart, shingle_words, percent), "near-rare")
    rare, more = _joined(rare, texts, shingle_words, percent)
    links = reduce(DataFrame.union, [links, *more, keep(confirmed(_sharing(rare, percent), texts, shingle_words, percent), "near-links")])
    roots = keep(components(links), "near-roots")

    grouped = classes.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    grouped = keep(grouped.where((F.col("copies") > 1) | (F.col("root") != F.col("id"))).select("n_shingles", "high", "low", "least_id", "one", "root").union(
        classes.join(roots.select(F.col("root").alias("id")).distinct(), "id", "left_semi").where("copies = 1").select("n_shingles", "high", "low", "least_id", "one", "id")
    ), "near-grouped")
    smallest = keep(grouped.groupBy("root").agg(F.min("least_id").alias("component_id"), F.min("one").alias("first")), "near-smallest")
    found = keep(grouped.join(smallest, "root").select("n_shingles", "high", "low", "component_id", "first", F.lit(True).alias("grouped")), "near-found")
    return rows.join(found, ["n_shingles", "high", "low"], "left").select(
        "doc_id",
        "text_hash",
        F.coalesce(F.col("first") == _first(), F.lit(True)).alias("first"),
        "n_shingles",
        F.when(F.col("grouped"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(F.col("grouped"), F.col("doc_id").eqNullSafe(F.col("component_id"))).otherwise(F.lit(True)).alias("kept"),
    )
