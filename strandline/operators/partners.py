"""The best partners of vectors by inner product, in groups of bounded size.

Queries are dealt into parts, vectors onto shelves of at most ``SHELF_NUMBERS`` numbers; a part meets a shelf in one group, in which
tiles are multiplied in single precision. Where all vectors ask, shelves meet each other, each two once, and both sides ask. What can be among the best, by a bound on the rounding, is computed again
in double precision, number after number, so that equal vectors have equal scores, as in SQL. A group keeps the best ``k`` of each query only, so
what leaves it grows with queries times shelves, not with pairs.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PART_ROWS, SHELF_NUMBERS, MOST_TASKS = 8192, 1 << 23, 2000
_ROWS, _COLUMNS, _LOWEST = 512, 2048, np.float32(-3e38)

#: For some queries (a matrix) whether each wants each of the runs of vectors.
Wants = Callable[[np.ndarray], np.ndarray]


def shelf_rows(width: int, least: int = 1) -> int:
    """How many vectors of ``width`` numbers a shelf has."""
    return max(least, SHELF_NUMBERS // max(width, 1), 1)


def matrix(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Vectors as rows, in their own precision, and which of them are null: those are zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    null = column.is_null().to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False)
    known = len(null) - int(null.sum())
    rows = values.reshape(known, -1) if known else np.zeros((0, 0), values.dtype)
    if known == len(null):
        return rows, null
    out = np.zeros((len(null), rows.shape[1]), values.dtype)
    out[~null] = rows
    return out, null


def _dots(x: np.ndarray, y: np.ndarray, r: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products of rows r and q, of matrices with a row for each place, added up in order."""
    total = np.zeros(len(r))
    for a, b in zip(x, y, strict=True):
        total += np.multiply(a[r], b[q], dtype=np.float64)
    return total


def best(asking: pa.Table, there: pa.Table, k: int, threshold: float, runs: list[tuple[int, int]] | None = None, wants: Wants | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of ``asking``, row of ``there``, score): the ``k`` best with at least the threshold, by score and id, never the same id. Null
    vectors have no score and come last, where there is no threshold. ``runs`` of rows of ``there`` are looked into where
    ``wants`` says so."""
    (x, x_null), (y, y_null) = matrix(asking["v"]), matrix(there["v"])
    if not len(x) or not len(y):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    width = max(x.shape[1], y.shape[1])
    x, y = (m if m.shape[1] == width else np.zeros((len(m), width), m.dtype) for m in (x, y))
    ids_x, ids_y = (t["id"].to_numpy() for t in (asking, there))
    order = np.argsort(ids_y, kind="stable")
    rank = np.empty(len(y), np.int64)
    rank[order] = np.arange(len(y))
    same = np.searchsorted(ids_y[order], ids_x, "left"), np.searchsorted(ids_y[order], ids_x, "right")
    x32, y32 = x.astype(np.float32, copy=False), y.astype(np.float32, copy=False)
    x_t, y_t = np.ascontiguousarray(x.T), np.ascontiguousarray(y.T)
    longest = float(np.linalg.norm(y32, axis=1).max(initial=0))
    margin = (1.3e-7 * (width + 8) * np.linalg.norm(x32, axis=1) * longest + 1e-30).astype(np.float32)
    lowest = max(threshold, float(_LOWEST))
    runs = [(0, len(y))] if runs is None else runs
    nulls = x_null.any() or y_null.any()
    out = []
    for low in range(0, len(x), _ROWS):
        own = np.arange(low, min(low + _ROWS, len(x)))
        bound = (lowest - margin[own] * np.float32(1.5)).astype(np.float32)
        doubles = [(r, order[b]) for r, i in enumerate(own) for b in range(same[0][i], same[1][i])]
        twin_r, twin_q = (np.array([d[n] for d in doubles], np.int64) for n in (0, 1))
        wanted = wants(x[own]) if wants else None
        waiting, size = [], 0

        def merged() -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
            r, q, s = (np.concatenate(c) for c in zip(*waiting, strict=True))
            good = s >= lowest
            r, q, s = r[good], q[good], s[good]
            sort = np.lexsort((rank[q], -s, r))
            r, q, s = r[sort], q[sort], s[sort]
            starts = np.searchsorted(r, np.arange(len(own) + 1))
            full = np.flatnonzero(np.diff(starts) >= k)
            bound[full] = np.maximum(bound[full], (s[starts[full] + k - 1] - 1.5 * margin[own[full]]).astype(np.float32))
            top = np.arange(len(r)) - starts[r] < k
            return [(r[top], q[top], s[top])]

        for n, (start, stop) in enumerate(runs):
            among = np.arange(len(own)) if wanted is None else np.flatnonzero(wanted[:, n])
            if not len(among):
                continue
            whole = len(among) == len(own)
            for first in range(start, stop, _COLUMNS):
                last = min(first + _COLUMNS, stop)
                product = (x32[own] if whole else x32[own[among]]) @ y32[first:last].T
                if nulls:
                    product[x_null[own[among]]] = _LOWEST
                    product[:, y_null[first:last]] = _LOWEST
                here = (twin_q >= first) & (twin_q < last)
                if here.any():
                    row = np.full(len(own), -1)
                    row[among] = np.arange(len(among))
                    r, q = row[twin_r[here]], twin_q[here] - first
                    product[r[r >= 0], q[r >= 0]] = -np.inf
                near = product >= bound[among, None]
                if last - first > k and np.count_nonzero(near) > 4 * k * len(among):
                    kth = np.partition(product, last - first - k, axis=1)[:, last - first - k]
                    bound[among] = np.maximum(bound[among], kth - 3 * margin[own[among]])
                    near = product >= bound[among, None]
                hits = np.flatnonzero(near)
                if not len(hits):
                    continue
                r, q = np.divmod(hits, last - first)
                r, q = among[r], q + first
                s = _dots(x_t, y_t, own[r], q)
                if nulls:
                    s[x_null[own[r]] | y_null[q]] = _LOWEST
                waiting.append((r, q, s))
                size += len(r)
                if size > 3 * k * len(own):
                    waiting = merged()
                    size = len(waiting[0][0])
        if waiting:
            r, q, s = merged()[0]
            out.append((own[r], q, s))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def told(asking: pa.Table, there: pa.Table, found: tuple[np.ndarray, np.ndarray, np.ndarray]) -> pa.Table:
    """(id, partner, score) of what ``best`` found; null scores where it has none."""
    r, q, s = found
    return pa.table({"id": asking["id"].take(pa.array(r)), "partner": there["id"].take(pa.array(q)), "score": pa.array(s, pa.float64(), mask=s <= _LOWEST)})


def ranked(each: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of all groups, with their rank."""
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.col("score").desc(), "partner"))
    return each.withColumn("rank", rank).where(F.col("rank") <= k)


def meet(asked: DataFrame, held: DataFrame, by: list[str], groups: int, work: Callable[[pa.Table, pa.Table], pa.Table]) -> DataFrame:
    """(id, partner, score) of ``work`` on each group of both sides. The number of tasks follows from the groups, not from their bytes: it is
    the products that take time."""
    kind, tasks = dict(asked.dtypes)["id"], max(1, min(groups, MOST_TASKS))
    sides = [df.toDF(*df.columns).repartition(tasks, *by).groupBy(*by) for df in (asked, held)]  # columns of their own on both sides
    return sides[0].cogroup(sides[1]).applyInArrow(work, f"id {kind}, partner {kind}, score double")


def within(vectors: DataFrame, k: int, threshold: float | None = None, part_rows: int = PART_ROWS) -> DataFrame:
    """(id, partner, score, rank): the ``k`` best partners of each of ``vectors`` (id, v, of) among those of the same ``of``. Rows with a null ``of``
    have none.

    Each two blocks of a label meet in one group, so a vector is sent as often as its label has blocks: these have at least ``part_rows`` rows and,
    where that is more, an eighth of the label's, as far as a shelf holds them."""
    first = vectors.where("v IS NOT NULL").select(F.size("v").alias("n")).first()
    if threshold is not None:
        vectors = vectors.where("v IS NOT NULL")
    most = shelf_rows(first["n"] if first else 1, part_rows)
    sizes = vectors.where("of IS NOT NULL").groupBy("of").agg(F.count("*").alias("n"))
    rows = F.least(F.lit(most), F.greatest(F.lit(part_rows), F.ceil(F.col("n") / 8)))
    sizes = sizes.select("of", F.ceil(F.col("n") / rows).cast("int").alias("blocks"))
    groups = sizes.agg(F.sum(F.col("blocks").cast("long") * (F.col("blocks") + 1) / 2)).first()[0] or 1
    placed = vectors.join(sizes, "of").withColumn("block", F.pmod(F.xxhash64("id", F.lit(1)), F.col("blocks")).cast("int"))
    low = placed.select("of", "id", "v", F.col("block").alias("low"), F.explode(F.sequence("block", F.col("blocks") - 1)).alias("high"))
    high = placed.select("of", "id", "v", F.explode(F.sequence(F.lit(0), "block")).alias("low"), F.col("block").alias("high"))
    lowest, by = -np.inf if threshold is None else threshold, ["of", "low", "high"]

    def work(asking: pa.Table, there: pa.Table) -> pa.Table:
        return told(asking, there, best(asking, there, k, lowest))

    def back(asking: pa.Table, there: pa.Table) -> pa.Table:
        one = asking.num_rows and asking["low"][0] == asking["high"][0]  # a block with itself has been asked
        return work(asking.slice(0, 0) if one else asking, there)

    # Spark reads what the first has shuffled again for the second
    return ranked(meet(low, high, by, int(groups), work).union(meet(high, low, by, int(groups), back)), k)
