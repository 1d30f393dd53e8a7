"""Token-ID output: Parquet files of token lists in document order, and selective reads of them.

``write`` lays the corpus out as a token stream: documents in ascending id order, each closed by an end id. Files hold
``doc_id``, ``n_tokens``, ``local_start`` (ids before the document within its file) and ``ids``, a list column whose
ids are dictionary-coded; the sorted number columns are delta-coded. Row groups and pages are small and indexed, so
a reader with a document or a column in mind skips the rest. ``read`` adds each file's place in the stream.

Defined results: a null text has only the end id; null ids of documents come first; rows with the same id follow each other in
any order; further columns are ignored; an empty table gives an empty table. Very long texts need memory for one text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .store import keep, keep_path, modest_batches
from .tokens import encoder

#: Parquet settings: format version 2 delta-codes integers that are not dictionary-coded; page indexes are always written.
LAYOUT = {
    "parquet.writer.version": "v2",
    "parquet.block.size": str(16 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#local_start": "false",
    "parquet.enable.dictionary#n_tokens": "false",
    "compression": "snappy",
}

_FILE = "doc_id long, file int, local_start long, n_tokens long, ids array<int>"


def write(documents: DataFrame, vocabulary: str, end_id: int = 2, layout: dict[str, str] | None = None) -> str:
    """Tokenise whole texts, write them in ascending document order and return the folder."""

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end, start = encoder(vocabulary).encode, np.array([end_id], "<u4").tobytes(), 0
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in (0, 1, 2)]
            coding = encode(columns[2])
            for low in range(0, len(columns[0]), 256):
                doc_ids, files = (c[low : low + 256] for c in columns[:2])
                coded = [ids + end for ids in islice(coding, 256)]
                sizes = np.array([len(c) // 4 for c in coded], np.int64)
                starts = start + np.concatenate([[0], np.cumsum(sizes)])
                start = int(starts[-1])
                ids = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)),
                    pa.array(np.frombuffer(b"".join(coded), "<i4")),
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, pa.int64()), pa.array(files, pa.int32()), pa.array(starts[:-1]), pa.array(sizes), ids],
                    ["doc_id", "file", "local_start", "n_tokens", "ids"],
                )

    ordered = (
        modest_batches(documents).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange("doc_id", F.monotonically_increasing_id())  # rows with the same id, or none, are dealt out too
        .sortWithinPartitions("doc_id", "text")
        .select("doc_id", F.spark_partition_id().alias("file"), "text")
    )
    return keep_path(ordered.mapInArrow(tokenise, _FILE), "tokens", LAYOUT | (layout or {}))


def read(spark: SparkSession, folder: str, columns: tuple[str, ...] = ("doc_id", "n_tokens", "ids")) -> DataFrame:
    """The files' rows with ``start``, the ids of all documents before; unread columns stay on disk.

    The table of files has a row for each file, so its running total needs no more than that.
    """
    files = spark.read.schema(_FILE).parquet(folder)
    bases = keep(files.groupBy("file").agg(F.sum("n_tokens").alias("n")), "token-files")
    before = bases.alias("a").select(
        F.col("file").alias("of"),
        (F.sum("n").over(Window.orderBy("file")) - F.col("n")).alias("base"),
    )
    return files.join(F.broadcast(before), F.col("file") == F.col("of")).select(
        (F.col("base") + F.col("local_start")).alias("start"), *columns
    )


def checksums(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the crc32 of the ids as little-endian unsigned 32-bit integers."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(2)
            offsets = ids.offsets.to_numpy()
            values = ids.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False)
            crc = [zlib.crc32(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.diff(offsets).astype(np.int64)), pa.array(crc, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return modest_batches(tokens).select("doc_id", "start", "ids").mapInArrow(sums, "doc_id long, start long, n_tokens long, ids_crc32 long")
