"""Near-duplicate groups by SimHash fingerprints and multi-index hashing.

A fingerprint has a bit set where over half the 64-bit hashes of a text's shingles have it. Documents with equal fingerprints
are one class. Fingerprints are cut into segments; if two differ in few bits, one segment differs in very few, so each
fingerprint looks up the small Hamming ball around each of its segments in that segment's table, and complete distances decide.
Of the two sides of a pair only the one whose lowest differing bit in the segment is 0 looks the other up. The number of
segments follows from the number of fingerprints: more make fewer look-ups, fewer make longer keys and so fewer chance
matches, which are compared where they meet and make no rows.

A group of near copies of one text would meet itself in all its pairs. So members of a table's bucket are compared with the
bucket's smallest fingerprint first, and merged; then only buckets that hold fingerprints still apart are paired,
and in them only such fingerprints. Every link is decided on whole fingerprints; there is no cap on buckets or partners.

Defined results: null texts and texts without words have fingerprint 0, which links like any other; repeated rows are linked;
a row with a null id is linked like others, and a group of null ids only has a null id; further columns are ignored; an
empty table gives no rows. Shingles of very long texts are hashed in parts.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .near_dedup import components
from .store import keep, modest_batches

#: Hashes whose bits are counted at once.
AT_ONCE = 1 << 16
#: A look-up is moved and sorted, a chance match is only compared: so many of these cost as much.
MATCHES_A_LOOK_UP = 100


def shingle_hashes(text: bytes | None, size: int) -> list[int]:
    """XXH64 with seed 42 of each shingle of words, repeats included."""
    words = (text or b"").lower().split()  # ASCII letters and ASCII white space only
    if not words:
        return []
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    size = min(size, len(words))
    starts = [0, *(ends[: len(words) - size] + 1).tolist()]
    return list(map(xxhash.xxh64_intdigest, map(joined.__getitem__, map(slice, starts, ends[size - 1 :].tolist())), repeat(42)))


def fingerprints_of(hashes: list[list[int]]) -> np.ndarray:
    """The majority bits of each list of hashes; 0 for an empty one."""
    totals = np.array([len(h) for h in hashes], np.int64)
    owner = np.repeat(np.arange(len(hashes)), totals)
    values = np.fromiter((x for h in hashes for x in h), "<u8", len(owner))
    ones = np.zeros((len(hashes), 64), np.int64)
    for low in range(0, len(values), AT_ONCE):
        part = owner[low : low + AT_ONCE]
        first = np.flatnonzero(np.diff(part, prepend=-1))
        bits = np.unpackbits(values[low : low + AT_ONCE].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones[part[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int32)
    return np.packbits(2 * ones > totals[:, None], axis=1, bitorder="little").view("<u8").ravel()


def fingerprints(documents: DataFrame, shingle_words: int = 4) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed integer, of every document."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.zeros(0, "<u8")]
            for low in range(0, batch.num_rows, 64):
                found.append(fingerprints_of([shingle_hashes(t, shingle_words) for t in batch.column(1).slice(low, 64).to_pylist()]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(found).view("<i8"))], ["doc_id", "fp"])

    whole = modest_batches(documents).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return whole.mapInArrow(work, "doc_id long, fp long")


def radii(distance: int, segments: int) -> list[int]:
    """How many bits may differ in each segment's look-up, so that no pair within the distance is missed; -1: no look-up."""
    each, more = divmod(distance, segments)
    return [each if k <= more else each - 1 for k in range(segments)]


def widths(segments: int, bits: int = 64) -> list[int]:
    return [bits // segments + (k < bits % segments) for k in range(segments)]


def masks(width: int, radius: int) -> list[int]:
    """The differences that a ball holds, as bits."""
    return [sum(1 << b for b in places) for r in range(radius + 1) for places in combinations(range(width), r)]


def best_segments(classes: int, distance: int) -> int:
    """The number of segments, all with balls to look up, that costs least for so many fingerprints."""

    def cost(segments: int) -> float:
        balls = [(w, masks(w, r)) for w, r in zip(widths(segments), radii(distance, segments), strict=True)]
        looked_up = sum((1 + len(ball)) / 2 for _, ball in balls)
        return MATCHES_A_LOOK_UP * looked_up + classes * sum(len(ball) / 2**w for w, ball in balls) / 2

    return min(range(2, max(2, distance) + 1), key=cost)


def look_ups(classes: DataFrame, distance: int, segments: int) -> DataFrame:
    """(segment, key, mask) and the row of each class, once for each place of its balls that it looks up; its own place, in
    that segment's table, has mask 0."""

    def own(k: int, shift: int, width: int, radius: int) -> Column:
        part = F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1))
        ball = F.array(*(F.struct(F.lit(m).cast("long").alias("mask"), F.lit(m & -m).cast("long").alias("lowest")) for m in masks(width, radius)))
        wanted = F.filter(ball, lambda b: part.bitwiseAND(b["lowest"]) == 0)
        return F.transform(wanted, lambda b: F.struct(F.lit(k).alias("segment"), part.bitwiseXOR(b["mask"]).alias("key"), b["mask"].alias("mask")))

    sizes = widths(segments)
    places = [own(k, sum(sizes[:k]), w, r) for k, (w, r) in enumerate(zip(sizes, radii(distance, segments), strict=True))]
    return classes.select("*", F.inline(F.concat(*places)))


def apart(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def grouped(classes: DataFrame, distance: int = 4, segments: int | None = None) -> DataFrame:
    """(fp, root) of all classes, from a kept table of distinct ``fp``: equal roots for all that reach each other."""
    segments = segments or best_segments(classes.count(), distance)
    own = look_ups(classes.select("fp"), distance, segments).where("mask = 0").drop("mask")
    centers = own.groupBy("segment", "key").agg(F.min("fp").alias("center"), F.max("fp").alias("last")).where("center < last").drop("last")
    stars = own.join(centers, ["segment", "key"]).where((F.col("fp") != F.col("center")) & (apart(F.col("fp"), F.col("center")) <= distance))
    links = keep(stars.select(F.col("center").alias("a"), F.col("fp").alias("b")).distinct(), "simhash-stars")
    roots = components(links)

    rooted = classes.select("fp").join(roots.withColumnRenamed("id", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    placed = keep(look_ups(rooted, distance, segments), "simhash-look-ups")
    mixed = placed.groupBy("segment", "key").agg(F.min("root").alias("r"), F.max("root").alias("s")).where("r < s").select("segment", "key")
    near = keep(placed.join(mixed, ["segment", "key"], "left_semi"), "simhash-mixed")
    x, y = near.alias("x"), near.where("mask = 0").alias("y")
    meet = (F.col("x.segment") == F.col("y.segment")) & (F.col("x.key") == F.col("y.key")) & (F.col("x.root") != F.col("y.root"))
    once = (F.col("x.mask") != 0) | (F.col("x.fp") < F.col("y.fp"))
    pairs = x.join(y, meet & once & (apart(F.col("x.fp"), F.col("y.fp")) <= distance)).select(F.col("x.root").alias("a"), F.col("y.root").alias("b")).distinct()
    joined = keep(components(keep(pairs, "simhash-links")), "simhash-roots")
    last = joined.select(F.col("id").alias("root"), F.col("root").alias("last"))
    return rooted.join(last, "root", "left").select("fp", F.coalesce("last", "root").alias("root"))


def groups(documents: DataFrame, shingle_words: int = 4, distance: int = 4, segments: int | None = None) -> DataFrame:
    """doc_id, fingerprint in hex, and component_id, the smallest doc_id that the document reaches over links, of every document."""
    rows = keep(fingerprints(documents, shingle_words), "simhash-rows")
    classes = keep(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies")), "simhash-classes")
    rooted = keep(classes.join(grouped(classes, distance, segments), "fp"), "simhash-rooted")
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.sum("copies").alias("documents")).where("documents > 1")
    found = keep(rooted.join(smallest, "root").select("fp", "component_id", F.lit(True).alias("grouped")), "simhash-found")
    return rows.join(found, "fp", "left").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("grouped"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )
