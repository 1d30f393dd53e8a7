"""Best-fit packing: best-fit decreasing over remaining capacities held in a segment tree.

Texts become token ids with a closing id; longer ones are cut so that all pieces but the first are full. Lengths are
whole numbers up to the capacity, so best-fit decreasing depends only on how many pieces have each length. The driver
gets that histogram (at most ``capacity`` rows, whatever the corpus) and packs equal lengths together: the segment
tree finds the tightest remaining capacity that holds a length in logarithmic time, and a run of open bins with that
capacity takes a run of pieces. The outcome is the packing that piece-by-piece best-fit decreasing gives. Each
piece has a rank within its length - its rank in the written partition plus the counts of earlier partitions -
and the plan maps ranges of ranks to bins. No group of equal lengths meets in one task.

Defined results: a null or empty text is one piece, the closing id; repeated rows are packed each; ties in length go by
partition and row; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import keep, modest_batches
from .tokens import encoder

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, local_rank long"
_PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


class CapacityTree:
    """Which remaining capacities have open bins; finds the smallest one of at least a given size."""

    def __init__(self, capacity: int) -> None:
        self.leaves = 1 << capacity.bit_length()
        self.any = [False] * (2 * self.leaves)

    def set(self, capacity: int, open_: bool) -> None:
        node = self.leaves + capacity
        self.any[node] = open_
        while node := node >> 1:
            self.any[node] = self.any[2 * node] or self.any[2 * node + 1]

    def tightest(self, least: int) -> int | None:
        node = self.leaves + least
        if self.any[node]:
            return least
        while node > 1:
            if not node & 1 and self.any[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.any[2 * node] else 2 * node + 1
                return node - self.leaves
            node >>= 1
        return None


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Rows (length, first rank, pieces in a bin, first bin, first offset): pieces from that rank on go to the bins from
    that bin on, so many in each from that offset on, until the next row of the same length."""
    tree, runs, rows, bins = CapacityTree(capacity), defaultdict(list), [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                each = capacity // length
                n = -(-left // each)
                runs[capacity].append((bins, n))
                tree.set(capacity, True)
                bins += n
                room = capacity
            first, n = runs[room].pop()
            each = room // length
            full = min(n, left // each)
            rows.append((length, rank, each, first, capacity - room))
            if full:
                taken, rest = full * each, room - each * length
                if rest:
                    runs[rest].append((first, full))
                    tree.set(rest, True)
            else:
                taken, full, rest = left, 1, room - left * length
                runs[rest].append((first, 1))
                tree.set(rest, True)
            if n > full:
                runs[room].append((first + full, n - full))
            if not runs[room]:
                tree.set(room, False)
            rank, left = rank + taken, left - taken
    return rows


def pieces(documents: DataFrame, vocabulary: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """One row for each piece, with its rank among the pieces of its length in its partition."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end, ranks = encoder(vocabulary).encode, np.array([end_id], "<u4").tobytes(), defaultdict(int)
        for batch in batches:
            out = []
            doc_ids, texts, parts = (batch.column(i).to_pylist() for i in range(3))
            for doc_id, coded, part in zip(doc_ids, encode(texts), parts, strict=True):
                ids = coded + end
                low, high, k = 0, (len(ids) // 4 - 1) % capacity + 1, 0
                while low < len(ids) // 4:
                    out.append((doc_id, k, low, high - low, zlib.crc32(ids[4 * low : 4 * high]), part, ranks[high - low]))
                    ranks[high - low] += 1
                    low, high, k = high, high + capacity, k + 1
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "local_rank"]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            columns = zip(*out, strict=True) if out else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    return modest_batches(documents).select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.spark_partition_id().alias("part")).mapInArrow(cut, _PIECES)


def pack(documents: DataFrame, vocabulary: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """The sequence and the place in it of every piece."""
    spark = documents.sparkSession
    cut = keep(pieces(documents, vocabulary, capacity, end_id), "pieces")
    by_part = keep(cut.groupBy("length", "part").count(), "piece-counts")
    total = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    rows = plan(total, capacity)
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    placed = spark.sparkContext.broadcast((table[:, 0] << 48 | table[:, 1], table))
    before = F.sum("count").over(Window.partitionBy("length").orderBy("part")) - F.col("count")
    bases = by_part.select("length", "part", before.alias("base"))
    ranked = cut.join(bases, ["length", "part"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("local_rank")).alias("rank")
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, found = placed.value
        for batch in batches:
            length, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 5))
            row = found[np.searchsorted(keys, length << 48 | rank, "right") - 1]
            ahead = rank - row[:, 1]
            sequence, offset = row[:, 3] + ahead // row[:, 2], row[:, 4] + ahead % row[:, 2] * length
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return ranked.mapInArrow(place, _PACKED)
