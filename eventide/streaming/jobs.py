"""Structured Streaming forms of the pipeline (S1, S4, X1, X5-X7, W6/W8 online, E1).

Row-wise, grouped, windowed, session and dedup operators take a streaming
DataFrame unchanged. Per-key order-dependent logic (the retry counter, its
timers) runs in ``transformWithState`` with the RocksDB state store. Sinks are
idempotent: each micro-batch overwrites its own ``batch=<id>`` folder, so a
replayed batch after a restart replaces instead of duplicating.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions import validation as V
from ..functions.expr import DEFAULT_FEATURES
from ..sources.events import RAW_EVENT_SCHEMA, parse_events

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
WATERMARK = "5 minutes"
LOW_LATENCY_WATERMARK = "2 seconds"


def use_rocksdb(spark: SparkSession) -> None:
    """transformWithState needs the RocksDB state store (set before the query starts)."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


# ---------------------------------------------------------------- sources

def file_events(spark: SparkSession, path: str, fmt: str = "json", schema: T.StructType | None = None,
                max_files: int | None = None) -> DataFrame:
    """S1 on files: newline JSON (or parquet) under a fixed schema; unknown
    fields are ignored and missing ones are null."""
    r = spark.readStream.schema(schema or RAW_EVENT_SCHEMA)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.format(fmt).load(path)


def kafka_events(spark: SparkSession, servers: str, topics: str, starting: str = "earliest",
                 raw: bool = True) -> DataFrame:
    """S1/S2 on Kafka: ``topics`` may list several (comma separated); the
    ``topic`` column tells them apart. Needs the Kafka connector on the classpath."""
    k = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topics).option("startingOffsets", starting).load())
    return parse_events(k.select("topic", F.col("value").cast("string").alias("value")), "value",
                        raw=raw, keep=["topic"])


def with_event_time(df: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Event time from epoch ms plus a bounded out-of-orderness watermark."""
    ts = F.col("timestamp_ms").cast("string")
    return (df.withColumn("event_time", F.timestamp_millis(V.ts_value(ts)))
              .withWatermark("event_time", watermark))


# ---------------------------------------------------------------- stateless / built-in stateful

def running_counts(events: DataFrame) -> DataFrame:
    """E1 / A1 online: per-user count, emitted in update mode (the last value per
    key equals the batch count)."""
    return events.groupBy("user_id").agg(F.count(F.lit(1)).alias("event_count"))


def tumble_stream(events: DataFrame, size: str = "1 minute", key: str = "user_id") -> DataFrame:
    """X2 online: event-time tumbling counts per key with window start/end in epoch ms."""
    return (events.groupBy(key, F.window("event_time", size).alias("w"))
            .agg(F.count(F.lit(1)).alias("n_events"))
            .select(key, F.unix_millis(F.col("w.start")).alias("window_start_ms"),
                    F.unix_millis(F.col("w.end")).alias("window_end_ms"), "n_events"))


def session_stream(events: DataFrame, gap: str = "30 minutes", key: str = "user_id") -> DataFrame:
    """X4 online: ``session_window`` per key (events exactly one gap apart merge)."""
    from ..operators.windows import sessions_streaming
    return sessions_streaming(events, gap, key)


def dedup_stream(events: DataFrame, id_col: str = "event_id") -> DataFrame:
    """U2 online: drop redeliveries of an id within the watermark delay."""
    return events.dropDuplicatesWithinWatermark([id_col])


def idempotent_writer(out_dir: str, fmt: str = "parquet", lane_col: str | None = "lane"):
    """S4 sink for ``foreachBatch``: one write per micro-batch into
    ``<out>/batch=<id>`` (split by lane), replacing what a replay of the same
    batch wrote before."""
    def write(batch: DataFrame, batch_id: int) -> None:
        w = batch.write.mode("overwrite").format(fmt)
        if lane_col:
            w = w.partitionBy(lane_col)
        w.save(f"{out_dir}/batch={batch_id}")
    return write


# ---------------------------------------------------------------- retry state

RETRY_OUT = T.StructType([
    T.StructField("user_id", T.StringType()), T.StructField("event_id", T.LongType()),
    T.StructField("timestamp_ms", T.LongType()), T.StructField("route", T.StringType()),
    T.StructField("retry_count", T.IntegerType()), T.StructField("delay_ms", T.LongType()),
    T.StructField("attempt", T.IntegerType()),
])


#: Entries that one call adds to the list state.
APPEND_AT_ONCE = 10_000


class RetryProcessor(StatefulProcessor):
    """Per-user consecutive-failure counter with back-off timers.

    New events: a failure raises the counter (1..max -> retry after
    1000 * 2^(n-1) ms, max+1 -> dead letter, counter reset); a success resets
    it. Each retry is kept in a list state and replayed when its time has come;
    ``replay_fails(event_id, attempt)`` decides the replay outcome (default: the
    replay succeeds, a transient failure). Replays do not touch the counter.
    ``ttl_ms`` expires idle state (processing-time mode only).

    State calls go over a socket, so their number is by user and micro-batch, not
    by failure: one timer stands at or before the user's next replay, and when it
    fires all replays due by now run in order of time.
    """

    def __init__(self, max_retries: int = 3, ttl_ms: int | None = None, replay_fails=None,
                 time_mode: str = "EventTime"):
        self.max_retries = max_retries
        self.ttl_ms = ttl_ms
        self.replay_fails = replay_fails or (lambda event_id, attempt: False)
        self.by_event_time = time_mode.lower() == "eventtime"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.count = handle.getValueState("retry_count", "n int", self.ttl_ms)
        self.pending = handle.getListState(
            "pending", "event_id long, timestamp_ms long, retry_at long, attempt int", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues):
        uid = key[0]
        cnt = self.count.get()[0] if self.count.exists() else 0
        retries = []
        for r in sorted(rows, key=lambda x: (x.timestamp_ms, x.event_id)):
            if r.failed:
                cnt += 1
                if cnt <= self.max_retries:
                    delay = 1000 * 2 ** (cnt - 1)
                    retries.append((r.event_id, r.timestamp_ms, r.timestamp_ms + delay, 1))
                    yield Row(user_id=uid, event_id=r.event_id, timestamp_ms=r.timestamp_ms, route="retry",
                              retry_count=cnt, delay_ms=delay, attempt=0)
                else:
                    yield Row(user_id=uid, event_id=r.event_id, timestamp_ms=r.timestamp_ms, route="dlq",
                              retry_count=cnt, delay_ms=None, attempt=0)
                    cnt = 0
            else:
                cnt = 0
                yield Row(user_id=uid, event_id=r.event_id, timestamp_ms=r.timestamp_ms, route="success",
                          retry_count=None, delay_ms=None, attempt=0)
        self.count.update((cnt,))
        for k in range(0, len(retries), APPEND_AT_ONCE):
            self.pending.appendList(retries[k:k + APPEND_AT_ONCE])
        if retries:
            self.handle.registerTimer(min(at for _, _, at, _ in retries))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        uid = key[0]
        # timers before the clock of the batch fire in it
        clock = timerValues.getCurrentWatermarkInMs() if self.by_event_time else timerValues.getCurrentProcessingTimeInMs()
        due = max(expiredTimerInfo.getExpiryTimeInMs(), clock - 1)
        queue = [(at, n, event_id, ts, attempt) for n, (event_id, ts, at, attempt) in enumerate(self.pending.get())]
        heapq.heapify(queue)
        held = n = len(queue)
        done = 0
        while queue and queue[0][0] <= due:
            at, _, event_id, ts, attempt = heapq.heappop(queue)
            done += 1
            failed = self.replay_fails(event_id, attempt)
            if failed and attempt < self.max_retries:
                heapq.heappush(queue, (at + 1000 * 2 ** attempt, n, event_id, ts, attempt + 1))
                n += 1
                route = "replay_retry"
            else:
                route = "replay_dlq" if failed else "replay_success"
            yield Row(user_id=uid, event_id=event_id, timestamp_ms=ts, route=route,
                      retry_count=None, delay_ms=None, attempt=attempt)
        if queue:
            # put replaces, so what is left goes in by one put and further appends
            keep = [(event_id, ts, at, attempt) for at, _, event_id, ts, attempt in queue]
            if done:
                self.pending.put(keep[:APPEND_AT_ONCE])
                for k in range(APPEND_AT_ONCE, len(keep), APPEND_AT_ONCE):
                    self.pending.appendList(keep[k:k + APPEND_AT_ONCE])
            self.handle.registerTimer(queue[0][0])
        elif held:
            self.pending.clear()

    def close(self) -> None:
        pass


def retry_stream(events: DataFrame, max_retries: int = 3, time_mode: str = "EventTime",
                 ttl_ms: int | None = None, replay_fails=None) -> DataFrame:
    """W6/W8/X6 online: ``events`` needs user_id, event_id, timestamp_ms,
    failed and (for event time) a watermarked ``event_time``."""
    use_rocksdb(events.sparkSession)
    proc = RetryProcessor(max_retries, ttl_ms, replay_fails, time_mode)
    cols = events.select("user_id", "event_id", "timestamp_ms", "failed",
                         *(["event_time"] if time_mode.lower() == "eventtime" else []))
    # timers run on the input watermark; the output carries no event-time column
    return cols.groupBy("user_id").transformWithState(proc, RETRY_OUT, "Append", time_mode)


FEATURE_OUT = T.StructType([
    T.StructField("user_id", T.StringType()), T.StructField("event_id", T.LongType()),
    T.StructField("product_id", T.StringType()), T.StructField("timestamp_ms", T.LongType()),
    T.StructField("gap_minutes", T.DoubleType()), T.StructField("avg_time_category", T.DoubleType()),
    T.StructField("click_count", T.DoubleType()), T.StructField("purchase_count", T.DoubleType()),
    T.StructField("recency", T.DoubleType()),
])


class FeatureProcessor(StatefulProcessor):
    """W3 / J2 online: per user, the newest ``limit`` events of the current
    history in list state (an idle gap >= ``ttl_ms`` clears it); every event is
    stored, then the four features are read over the stored list."""

    def __init__(self, limit: int = 100, ttl_ms: int = 24 * 3600 * 1000):
        self.limit = limit
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.recent = handle.getListState("recent", "ts long, category string, event_type string")
        self.last = handle.getValueState("last_ts", "ts long")

    def handleInputRows(self, key, rows, timerValues):
        uid = key[0]
        hist = list(self.recent.get()) if self.recent.exists() else []
        last = self.last.get()[0] if self.last.exists() else None
        for r in sorted(rows, key=lambda x: (x.timestamp_ms, x.event_id)):
            gap = None if last is None else r.timestamp_ms - last
            if gap is not None and gap >= self.ttl_ms:
                hist = []
            hist.append((r.timestamp_ms, r.category, r.event_type))
            hist = hist[-self.limit:]
            last = r.timestamp_ms
            n = len(hist)
            cats = {("\u0000null" if c is None else c) for _, c, _ in hist}
            clicks = sum(1 for _, _, t in hist if t in ("click", "view"))
            buys = sum(1 for _, _, t in hist if t == "purchase")
            yield Row(user_id=uid, event_id=r.event_id, product_id=r.product_id, timestamp_ms=r.timestamp_ms,
                      gap_minutes=None if gap is None else gap / 60000.0,
                      avg_time_category=n / len(cats), click_count=float(clicks),
                      purchase_count=float(buys), recency=DEFAULT_FEATURES[3] if gap is None else gap / 60000.0)
        self.recent.clear()
        if hist:
            self.recent.put(hist)
        if last is not None:
            self.last.update((last,))

    def close(self) -> None:
        pass


def features_stream(events: DataFrame, limit: int = 100, ttl_ms: int = 24 * 3600 * 1000) -> DataFrame:
    """Online features of validated events (user_id, event_id, product_id,
    category, event_type, timestamp_ms as BIGINT)."""
    use_rocksdb(events.sparkSession)
    cols = events.select("user_id", "event_id", "product_id", "category", "event_type", "timestamp_ms")
    return cols.groupBy("user_id").transformWithState(FeatureProcessor(limit, ttl_ms), FEATURE_OUT,
                                                      "Append", "None")


def score_stream(raw: DataFrame, limit: int = 100) -> DataFrame:
    """E2 online: validate -> online features -> score (ml_predictions rows)."""
    from ..functions.expr import score_linear
    ok = V.valid_only(V.with_errors(raw))
    f = features_stream(ok, limit)
    return f.withColumn("prediction", score_linear("avg_time_category", "click_count", "purchase_count",
                                                   "recency"))


def fanout_stream(raw: DataFrame, failed, watermark: str = WATERMARK) -> DataFrame:
    """S4 / E3 online: one tagged stream of the lanes (validation_errors,
    success, retry, dlq) for :func:`idempotent_writer`; validation rows come
    straight from the rules, valid rows go through the retry state."""
    chk = V.with_errors(raw)
    verr = V.validation_errors(chk).select(F.col("validation_rule").alias("detail"), "event_id", "user_id",
                                           F.lit("validation_errors").alias("lane"))
    ok = with_event_time(V.valid_only(chk), watermark).withColumn("failed", failed)
    routed = retry_stream(ok).filter(F.col("attempt") == 0).select(
        F.col("retry_count").cast("string").alias("detail"), "event_id", "user_id", F.col("route").alias("lane"))
    return verr.unionByName(routed)


def state_partitions(spark: SparkSession) -> int:
    """State partitions for a new streaming query: one per task slot of the
    cluster (fixed in the checkpoint at the first start, so size it for the
    cluster, not for a test session's shuffle default; each stateful Python
    partition also holds a worker, so more partitions than slots only queue)."""
    return max(2, spark.sparkContext.defaultParallelism)


def run_available(df: DataFrame, sink: str, checkpoint: str, mode: str = "append",
                  fmt: str = "parquet", foreach=None, partitions: int | None = None):
    """Run a streaming DataFrame over everything available now and stop (X7:
    restarting with the same checkpoint resumes where it stopped). The state
    partition count is set for the start of this query only."""
    spark = df.sparkSession
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(partitions or state_partitions(spark)))
    try:
        w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
        q = w.foreachBatch(foreach).start() if foreach else w.format(fmt).start(sink)
    finally:
        spark.conf.set(key, before)
    q.awaitTermination()
    return q
