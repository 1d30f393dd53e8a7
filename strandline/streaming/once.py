"""Each key once in a while: keyed state that expires, for messages that come again.

The state of a key is when it was last let through. A row is let through if its key has no state, or if that is at least ``ttl``
older than the row; rows of a key are taken in order of time. A timer clears the state once the watermark has passed
its end, so what is kept follows the keys of one ``ttl``, not all there ever were. State and timers are part of the query's
checkpoint: a restarted query goes on where it stopped.

The rows of a key in one micro-batch are held together; ``maxFilesPerTrigger`` and the like bound these.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def in_order(rows: pd.DataFrame, time: str, order: list[str]) -> pd.DataFrame:
    """Rows by time and order; without pandas' own sorting of a table, which costs a key of a few rows more than all else, where numbers decide."""
    if len(rows) < 2:
        return rows
    keys = [rows[c].to_numpy() for c in (*reversed(order), time)]
    if any(k.dtype.kind not in "iM" for k in keys):
        return rows.sort_values([time, *order], kind="stable")
    return rows.take(np.lexsort(keys))


class Once(StatefulProcessor):
    """Lets a key's row through if none has been within ``ttl_us`` microseconds before."""

    def __init__(self, time: str, order: list[str], ttl_us: int) -> None:
        self.time, self.order, self.ttl_us = time, order, ttl_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "at long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        parts = list(rows)
        every = in_order(parts[0] if len(parts) == 1 else pd.concat(parts), self.time, self.order)
        at = every[self.time].to_numpy().astype("datetime64[us]").astype("int64")
        state = self.last.get()  # each call of the state goes through a socket: no more than needed
        known = last = state[0] if state else None
        chosen = []
        for k, t in enumerate(at.tolist()):
            if last is None or t >= last + self.ttl_us:
                chosen.append(k)
                last = t
        if chosen:
            if known is not None:
                for timer in list(self.handle.listTimers()):
                    self.handle.deleteTimer(timer)
            self.last.update((last,))
            self.handle.registerTimer(-(-(last + self.ttl_us) // 1000))
            yield every if len(chosen) == len(every) else every.iloc[chosen]

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        self.last.clear()
        yield from ()

    def close(self) -> None:
        pass


def once(rows: DataFrame, key: str, time: str, ttl: timedelta, delay: str = "0 seconds", order: tuple[str, ...] = ()) -> DataFrame:
    """Of a stream's rows, those whose key has not come within ``ttl`` before; rows with a null time or key are left out.

    ``delay``: how much later than others a row may come; ``order``: columns that decide between equal times.
    """
    known = rows.where(F.col(key).isNotNull() & F.col(time).isNotNull()).withWatermark(time, delay)
    processor = Once(time, list(order), int(ttl.total_seconds() * 1_000_000))
    return known.groupBy(key).transformWithStateInPandas(processor, rows.schema, "Update", "EventTime")


def start(rows: DataFrame, write: Callable[[DataFrame, int], None], progress: str, available_now: bool = True) -> StreamingQuery:
    """Starts a query over ``once`` with the state store that it needs; the session's own setting stays as it is."""
    spark, setting = rows.sparkSession, "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting)
    spark.conf.set(setting, PROVIDER)
    try:
        writer = rows.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", progress)
        return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")).start()
    finally:
        spark.conf.set(setting, before)
