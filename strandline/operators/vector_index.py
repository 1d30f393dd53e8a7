"""A persisted index over unit vectors: an inverted file of cells around centroids.

Centroids are fitted by k-means on a sample of at most ``sample_per_cell`` vectors a cell; every vector is written to the cell of its nearest
centroid, in Parquet sorted by cell, beside a table of the cells. A search looks into the nearest cells of each query only;
without a number of cells to probe it looks into all that can hold a partner at the threshold, so it is exact. That follows from
angles: no member of a cell is nearer to a query than the centroid's angle less the widest angle of the cell.

Cells are cut into parts of bounded size, which stand on shelves, and the queries are cut into parts too, so a cell that holds a third of
all vectors is many groups, and a query that wants all cells is copied once for each shelf. There are at most ``MOST_CELLS`` cells, whose table fits any machine; more vectors make larger cells, in more parts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import partners

MOST_CELLS, BLOCK_ROWS = 1 << 15, 2048


@dataclass(frozen=True)
class Index:
    """An index as read: ``vectors`` (id, v, cell, part) and ``cells`` (cell, center, n, parts, least), ``least`` being the lowest
    inner product of the cell's members with its center."""

    vectors: DataFrame
    cells: DataFrame


def fit(vectors: DataFrame, key: str, vector: str, cells: int, sample_per_cell: int = 64, rounds: int = 10, seed: int = 7) -> np.ndarray:
    """Unit centroids of a sample drawn by hash of the key, of about ``cells * sample_per_cell`` vectors."""
    n = vectors.count()
    share = min(1.0, cells * sample_per_cell / max(n, 1))
    drawn = vectors.where(F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1 << 30)) < int(share * (1 << 30)) + (share == 1.0))
    if cells == 1:
        means = drawn.select(F.posexplode(vector).alias("place", "x")).groupBy("place").agg(F.avg("x").alias("x")).orderBy("place").collect()
        center = np.array([[r["x"] for r in means]], np.float64)
        return center / np.maximum(np.linalg.norm(center), 1e-12)
    model = KMeans(k=cells, seed=seed, maxIter=rounds, distanceMeasure="cosine").fit(drawn.select(array_to_vector(F.col(vector).cast("array<double>")).alias("features")))
    centers = np.array(model.clusterCenters(), np.float64)
    return centers / np.maximum(np.linalg.norm(centers, axis=1, keepdims=True), 1e-12)


def build(vectors: DataFrame, key: str, vector: str, path: str, keep: Callable[[DataFrame], DataFrame], cells: int | None = None, block_rows: int = BLOCK_ROWS, **fitting: int) -> Index:
    """Writes the index of all vectors to a new folder and returns it as read. ``keep`` writes a table between two steps."""
    rows = vectors.where(F.col(vector).isNotNull())
    n = rows.count()
    kind = dict(vectors.dtypes)[key]
    if not n:
        empty = vectors.limit(0).select(F.col(key).alias("id"), F.col(vector).alias("v"), F.lit(0).alias("cell"), F.lit(0).alias("part"))
        empty.write.parquet(f"{path}/vectors")
        vectors.sparkSession.createDataFrame([], "cell int, center array<double>, n long, parts int, least double").write.parquet(f"{path}/cells")
        return load(vectors.sparkSession, path)
    centers = fit(rows, key, vector, min(n, cells or int(max(1, min(MOST_CELLS, round(n**0.5))))), **fitting)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            product = _matrix(batch.column(1)) @ centers.T
            cell = product.argmax(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(product[np.arange(len(cell)), cell])], ["id", "v", "cell", "near"])

    own = dict(vectors.dtypes)[vector]
    placed = keep(rows.select(F.col(key).alias("id"), F.col(vector).alias("v")).mapInArrow(place, f"id {kind}, v {own}, cell int, near double"))
    sizes = placed.groupBy("cell").agg(F.count("*").alias("n"), F.min("near").alias("least"))
    table = vectors.sparkSession.createDataFrame([(k, c.tolist()) for k, c in enumerate(centers)], "cell int, center array<double>")
    found = keep(table.join(sizes, "cell").withColumn("parts", F.ceil(F.col("n") / block_rows).cast("int")).select("cell", "center", "n", "parts", "least"))
    parted = placed.join(F.broadcast(found.select("cell", "parts")), "cell")  # a row for each cell: at most MOST_CELLS
    dealt = parted.select("id", "v", "cell", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part"))
    dealt.repartitionByRange("cell", "part").sortWithinPartitions("cell", "part").write.parquet(f"{path}/vectors")
    found.coalesce(1).write.parquet(f"{path}/cells")
    return load(vectors.sparkSession, path)


def load(spark: SparkSession, path: str) -> Index:
    return Index(spark.read.parquet(f"{path}/vectors"), spark.read.parquet(f"{path}/cells"))


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 1)


def search(index: Index, queries: DataFrame, key: str, vector: str, keep: Callable[[DataFrame], DataFrame], k: int = 50, threshold: float = -1.0, probes: int | None = None, block_rows: int = partners.PART_ROWS) -> DataFrame:
    """(id, partner, score, rank): the ``k`` best partners of each query with at least the threshold, by score and id, never itself.

    ``probes``: how many of the nearest cells a query looks into; None: all that can hold such a partner. Cells stand on shelves in
    order, large ones in parts on several. A query goes to each shelf with a cell that it wants once, however many it wants there.
    """
    cells = sorted(index.cells.collect(), key=lambda r: r["cell"])  # bounded by MOST_CELLS
    if not cells:
        return queries.limit(0).select(F.col(key).alias("id"), F.col(key).alias("partner"), F.lit(0.0).alias("score"), F.lit(1).alias("rank"))
    names, n, parts = (np.array([r[c] for r in cells], np.int64) for c in ("cell", "n", "parts"))
    centers, widest = np.array([r["center"] for r in cells]), np.arccos(np.clip([r["least"] for r in cells], -1, 1))
    on = partners.shelf_rows(centers.shape[1], block_rows)
    before = np.cumsum(n) - n
    first, last = before // on, (before + (parts - 1) * n // parts) // on
    shelves = int(last.max()) + 1
    from_cell, to_cell = np.searchsorted(last, np.arange(shelves), "left"), np.searchsorted(first, np.arange(shelves), "right")

    def wants(matrix: np.ndarray) -> np.ndarray:
        product = matrix.astype(np.float64) @ centers.T
        if probes is not None:
            wanted = np.zeros(product.shape, bool)
            np.put_along_axis(wanted, np.argsort(-product, axis=1, kind="stable")[:, :probes], True, axis=1)
            return wanted
        length = np.maximum(np.linalg.norm(matrix.astype(np.float64), axis=1, keepdims=True), 1e-12)
        angle = np.maximum(np.arccos(np.clip(product / length, -1, 1)) - widest[None, :], 0)
        return np.cos(angle) * length >= threshold - 1e-6

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, (1 << 22) // len(centers))
        for batch in batches:
            for low in range(0, batch.num_rows, step):
                few = batch.slice(low, step)
                sums = np.pad(np.cumsum(wants(partners.matrix(few.column(1))[0]), axis=1), ((0, 0), (1, 0)))
                rows, shelf = np.nonzero(sums[:, to_cell] > sums[:, from_cell])
                taken = few.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(shelf.astype(np.int32))], ["id", "v", "shelf"])

    kind, own = dict(queries.dtypes)[key], dict(queries.dtypes)[vector]
    rows = keep(queries.where(F.col(vector).isNotNull()).select(F.col(key).alias("id"), F.col(vector).alias("v")))
    query_parts = max(1, -(-rows.count() // block_rows))
    asked = rows.mapInArrow(probe, f"id {kind}, v {own}, shelf int").withColumn("query_part", F.pmod(F.xxhash64("id"), F.lit(query_parts)).cast("int"))
    stands = rows.sparkSession.createDataFrame([tuple(map(int, r)) for r in zip(names, before, n, parts)], "cell int, before long, n long, parts int")
    shelf = F.floor((F.col("before") + F.floor(F.col("part") * F.col("n") / F.col("parts"))) / on).cast("int")
    held = index.vectors.join(F.broadcast(stands), "cell").select("id", "v", "cell", shelf.alias("shelf"), F.explode(F.sequence(F.lit(0), F.lit(query_parts - 1))).alias("query_part"))

    def work(asking: pa.Table, there: pa.Table) -> pa.Table:
        there = there.sort_by("cell")
        cell = there["cell"].to_numpy()
        starts = np.flatnonzero(np.diff(cell, prepend=-1)) if len(cell) else np.zeros(0, np.int64)
        places = np.searchsorted(names, cell[starts])
        runs = list(zip(starts.tolist(), [*starts[1:].tolist(), len(cell)], strict=True)) if len(cell) else []
        return partners.told(asking, there, partners.best(asking, there, k, threshold, runs, lambda m: wants(m)[:, places]))

    return partners.ranked(partners.meet(asked, held, ["query_part", "shelf"], query_parts * shelves, work), k)


def pairs(found: DataFrame) -> DataFrame:
    """(a, b, score), a < b: each pair of a search of the whole index in itself once."""
    return found.groupBy(F.least("id", "partner").alias("a"), F.greatest("id", "partner").alias("b")).agg(F.max("score").alias("score"))
