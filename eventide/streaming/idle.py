"""State that expires after idling, in event time.

Spark's state TTL needs processing time and never ends by itself. Here each key
has one event-time timer, moved at every write: when the watermark passes the last
write plus ``ttl_ms``, the state is cleared and reported. So expiry follows the
data, also in a bounded run (``availableNow``), and is never early: no event that
is not late can still belong to an expired state.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from .jobs import use_rocksdb

IDLE_OUT = T.StructType([T.StructField("user_id", T.StringType()), T.StructField("first_ms", T.LongType()),
                         T.StructField("last_ms", T.LongType()), T.StructField("n_events", T.LongType()),
                         T.StructField("expired_ms", T.LongType())])


class IdleState(StatefulProcessor):
    """Per user the number, first and last time of the events since the state was
    last empty; one row out for every state that has expired. A batch's rows of a
    user come as Arrow batches and are folded with array operations."""

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("idle", "n long, first_ms long, last_ms long")

    def _rows(self, user, first, last, n) -> pd.DataFrame:
        last = np.asarray(last, dtype=np.int64)
        return pd.DataFrame({"user_id": [user] * len(last), "first_ms": np.asarray(first, dtype=np.int64), "last_ms": last,
                             "n_events": np.asarray(n, dtype=np.int64), "expired_ms": last + self.ttl_ms})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        times = np.sort(np.concatenate([r["timestamp_ms"].dropna().to_numpy(dtype=np.int64) for r in rows]))
        if not len(times):
            return
        held = self.state.get() if self.state.exists() else None
        if held is not None:
            n, first, last = held
            self.handle.deleteTimer(int(last) + self.ttl_ms)
            times = np.maximum(times, int(last))  # an event late within the watermark does not move the clock back
            times = np.concatenate(([int(last)], times))
        cut = np.flatnonzero(np.diff(times) >= self.ttl_ms) + 1
        begin, end = np.concatenate(([0], cut)), np.append(cut, len(times))
        firsts, lasts, counts = times[begin], times[end - 1], end - begin
        if held is not None:
            firsts[0], counts[0] = first, counts[0] - 1 + n
        if len(begin) > 1:
            yield self._rows(key[0], firsts[:-1], lasts[:-1], counts[:-1])
        self.state.update((int(counts[-1]), int(firsts[-1]), int(lasts[-1])))
        self.handle.registerTimer(int(lasts[-1]) + self.ttl_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.state.exists():
            n, first, last = self.state.get()
            if int(last) + self.ttl_ms <= expiredTimerInfo.getExpiryTimeInMs():
                self.state.clear()
                yield self._rows(key[0], [first], [last], [n])

    def close(self) -> None:
        pass


def idle_stream(events: DataFrame, ttl_ms: int) -> DataFrame:
    """Expired states of a stream with user_id, timestamp_ms and a watermarked event_time."""
    use_rocksdb(events.sparkSession)
    rows = events.select("user_id", F.col("timestamp_ms").cast("bigint").alias("timestamp_ms"), "event_time")
    return rows.groupBy("user_id").transformWithStateInPandas(IdleState(ttl_ms), IDLE_OUT, "Append", "EventTime")
