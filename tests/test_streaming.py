"""Batch = stream checks and restart from checkpoint."""

import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from eventide.operators import features as FE
from eventide.operators import lanes as LN
from eventide.sources.events import RAW_EVENT_SCHEMA, events_from_tables
from eventide.streaming import jobs as S


def _write_files(spark, out_dir, n_files=6):
    """Test events as newline-JSON files, one per time range, written in time order."""
    ev = events_from_tables(spark, SF_SMALL).withColumn("timestamp_ms", F.col("timestamp_ms").cast("string"))
    pdf = ev.orderBy("timestamp_ms", "event_id").toPandas()
    os.makedirs(out_dir, exist_ok=True)
    size = (len(pdf) + n_files - 1) // n_files
    paths = []
    for i in range(n_files):
        part = pdf.iloc[i * size:(i + 1) * size]
        p = os.path.join(out_dir, f"events-{i:03d}.json")
        part.to_json(p, orient="records", lines=True)
        paths.append(p)
    return pdf, paths


def test_running_count_stream_equals_batch(spark, scratch):
    src = os.path.join(scratch, "in")
    pdf, _ = _write_files(spark, src)
    stream = S.with_event_time(S.file_events(spark, src, max_files=2))
    counts = S.running_counts(stream)
    q = (counts.writeStream.outputMode("update").format("memory").queryName("rc_test")
         .option("checkpointLocation", os.path.join(scratch, "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.sql("SELECT user_id, max(event_count) AS n FROM rc_test GROUP BY user_id").toPandas()
    want = pdf.groupby("user_id").size().rename("n").reset_index()
    m = got.merge(want, on="user_id", suffixes=("_s", "_b"))
    assert len(m) == len(want) and (m.n_s == m.n_b).all()


def test_restart_from_checkpoint_no_loss_no_duplicates(spark, scratch):
    src = os.path.join(scratch, "in")
    full, paths = _write_files(spark, os.path.join(scratch, "all"))
    os.makedirs(src)
    # first run sees half of the files
    for p in paths[:3]:
        os.link(p, os.path.join(src, os.path.basename(p)))
    out, ck = os.path.join(scratch, "out"), os.path.join(scratch, "ck")
    stream = S.file_events(spark, src, max_files=1).withColumn("lane", F.lit("events"))
    S.run_available(stream, out, ck, foreach=S.idempotent_writer(out))
    for p in paths[3:]:
        os.link(p, os.path.join(src, os.path.basename(p)))
    stream = S.file_events(spark, src, max_files=1).withColumn("lane", F.lit("events"))
    S.run_available(stream, out, ck, foreach=S.idempotent_writer(out))
    got = spark.read.parquet(out)
    assert got.count() == len(full)
    assert got.select("event_id").distinct().count() == len(full)


def test_retry_stream_equals_batch(spark, scratch):
    src = os.path.join(scratch, "in")
    pdf, _ = _write_files(spark, src, n_files=1)
    stream = S.with_event_time(S.file_events(spark, src))
    stream = stream.withColumn("timestamp_ms", F.col("timestamp_ms").cast("bigint")) \
                   .withColumn("failed", F.col("event_type") == "error")
    routed = S.retry_stream(stream)
    out = os.path.join(scratch, "out")
    S.run_available(routed, out, os.path.join(scratch, "ck"))
    got = spark.read.parquet(out)
    first = got.filter(F.col("attempt") == 0).select("event_id", "route", "retry_count").toPandas()
    batch = LN.retry_route(events_from_tables(spark, SF_SMALL), F.col("event_type") == "error")
    want = batch.select("event_id", "route", "retry_count").toPandas()
    m = first.merge(want, on="event_id", suffixes=("_s", "_b"))
    assert len(m) == len(want) == len(pdf)
    assert (m.route_s == m.route_b).all()
    assert (m.retry_count_s.fillna(0) == m.retry_count_b.fillna(0)).all()
    # every retry is replayed once its timer fires (W8); the default replay succeeds
    replays = got.filter(F.col("route") == "replay_success").count()
    assert replays == int((want.route == "retry").sum())


def test_dedup_within_watermark(spark, scratch):
    src = os.path.join(scratch, "in")
    pdf, paths = _write_files(spark, src, n_files=2)
    # redeliver the first file (at-least-once producer)
    dup = pd.read_json(paths[0], lines=True, dtype=False)
    dup.to_json(os.path.join(src, "events-redelivered.json"), orient="records", lines=True)
    stream = S.with_event_time(S.file_events(spark, src, schema=RAW_EVENT_SCHEMA), "1 hour")
    out = os.path.join(scratch, "out")
    S.run_available(S.dedup_stream(stream), out, os.path.join(scratch, "ck"))
    got = spark.read.parquet(out)
    assert got.count() == len(pdf)
    assert got.select("event_id").distinct().count() == len(pdf)
    _ = FE


def test_feature_stream_equals_batch(spark, scratch):
    src = os.path.join(scratch, "in")
    _write_files(spark, src, n_files=3)
    scored = S.score_stream(S.file_events(spark, src, max_files=1), limit=20)
    out = os.path.join(scratch, "out")
    S.run_available(scored, out, os.path.join(scratch, "ck"))
    got = spark.read.parquet(out)
    from eventide.functions import validation as V
    raw = events_from_tables(spark, SF_SMALL).withColumn("timestamp_ms", F.col("timestamp_ms").cast("string"))
    want = FE.features_online(V.valid_only(V.with_errors(raw)), 20)
    cols = ["event_id"] + FE.FEATURES
    a = sorted(tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in got.select(*cols).collect())
    b = sorted(tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in want.select(*cols).collect())
    assert a == b


@pytest.mark.parametrize("ttl_ms", [None, 15000])
def test_state_ttl_expires_idle_counter(spark, scratch, ttl_ms):
    """Without a TTL the retry counter persists across batches (1, 2, 3);
    with a state TTL the counter of a user idle for longer than the TTL has
    expired, so its next failure counts 1 again. Processing-time mode never
    reports itself caught up, so the test polls the sink and stops by hand.
    (Open finding: with the TTL set, this build also reset the counter
    between two batches a few seconds apart, earlier than the TTL.)"""
    import time as _t

    src = os.path.join(scratch, "in")
    os.makedirs(src)
    rows = lambda eid: pd.DataFrame([{"user_id": "u1", "product_id": "p", "category": "c",
                                      "event_type": "error", "timestamp_ms": str(1700000000000 + eid),
                                      "event_id": eid}])
    stream = S.file_events(spark, src).withColumn("timestamp_ms", F.col("timestamp_ms").cast("bigint")) \
              .withColumn("failed", F.col("event_type") == "error")
    routed = S.retry_stream(stream, time_mode="ProcessingTime", ttl_ms=ttl_ms)
    name = f"ttl_test_{ttl_ms or 0}"
    q = (routed.writeStream.format("memory").queryName(name).outputMode("append")
         .trigger(processingTime="1 second")
         .option("checkpointLocation", os.path.join(scratch, "ck")).start())

    def wait_for(eid, deadline=90):
        end = _t.time() + deadline
        while _t.time() < end:
            if spark.sql(f"SELECT 1 FROM {name} WHERE event_id = {eid}").count():
                return
            _t.sleep(0.5)
        raise AssertionError(f"event {eid} not processed")

    try:
        for eid, f in ((1, "a"), (2, "b")):
            rows(eid).to_json(os.path.join(src, f + ".json"), orient="records", lines=True)
            wait_for(eid)
        if ttl_ms:
            _t.sleep(ttl_ms / 1000 + 10)   # idle longer than the TTL
        rows(3).to_json(os.path.join(src, "c.json"), orient="records", lines=True)
        wait_for(3)
    finally:
        q.stop()
    got = {r.event_id: r.retry_count for r in spark.sql(f"SELECT * FROM {name} WHERE attempt = 0").collect()}
    assert got[1] == 1
    if ttl_ms is None:
        assert (got[2], got[3]) == (2, 3)
    else:
        assert got[3] == 1


def _final_updates(spark, stream_df, scratch, keys):
    """Run an update-mode aggregate to completion; the last value per key."""
    out = os.path.join(scratch, "out")
    S.run_available(stream_df, None, os.path.join(scratch, "ck"), mode="update",
                    foreach=S.idempotent_writer(out, lane_col=None))
    got = spark.read.parquet(out)
    return got.groupBy(*keys).agg(F.max("n_events").alias("n_events"))


def test_tumble_stream_equals_batch(spark, scratch):
    from eventide.operators import windows as WN
    src = os.path.join(scratch, "in")
    _write_files(spark, src, n_files=3)
    stream = S.tumble_stream(S.with_event_time(S.file_events(spark, src, max_files=1), "1 hour"))
    keys = ["user_id", "window_start_ms", "window_end_ms"]
    got = _final_updates(spark, stream, scratch, keys)
    want = WN.tumble_counts(events_from_tables(spark, SF_SMALL), 60_000)
    cols = keys + ["n_events"]
    assert sorted(got.select(*cols).collect()) == sorted(want.select(*cols).collect())


def test_session_stream_equals_batch(spark, scratch):
    """Session windows only support append mode: a later sentinel event (another
    user, in a later file) moves the watermark past every real session so all
    of them are emitted before the run ends."""
    from eventide.operators import windows as WN
    src = os.path.join(scratch, "in")
    pdf, paths = _write_files(spark, src, n_files=1)
    sentinel = pdf.iloc[[0]].copy()
    sentinel["user_id"] = "sentinel"
    sentinel["timestamp_ms"] = str(int(pdf.timestamp_ms.astype("int64").max()) + 10 * 86400000)
    sp = os.path.join(src, "events-zz-sentinel.json")
    sentinel.to_json(sp, orient="records", lines=True)
    st = os.stat(paths[0]).st_mtime
    os.utime(sp, (st + 60, st + 60))
    stream = S.session_stream(S.with_event_time(S.file_events(spark, src, max_files=1), "1 hour"), "30 minutes")
    out = os.path.join(scratch, "out")
    S.run_available(stream, out, os.path.join(scratch, "ck"))
    got = spark.read.parquet(out).filter(F.col("user_id") != "sentinel")
    want = WN.sessions(events_from_tables(spark, SF_SMALL), 30 * 60_000)
    cols = ["user_id", "session_start_ms", "session_end_ms", "n_events"]
    assert sorted(got.select(*cols).collect()) == sorted(want.select(*cols).collect())


def test_fanout_stream_equals_batch_lanes(spark, scratch):
    """S4/E3 online: validation lane + retry-routed lanes through the
    idempotent per-batch writer equal the batch lanes."""
    from eventide.sources import derived as D
    from eventide.sources.events import RAW_EVENT_SCHEMA as RS
    raw = D.raw_events(events_from_tables(spark, SF_SMALL)).withColumn("amount", F.col("value"))
    src = os.path.join(scratch, "in")
    raw.drop("value", "sent_ms").coalesce(1).write.json(src)
    stream = S.file_events(spark, src, schema=RS)
    lanes = S.fanout_stream(stream, D.scoring_fails("amount"), watermark="1 day")
    out = os.path.join(scratch, "out")
    S.run_available(lanes, None, os.path.join(scratch, "ck"), foreach=S.idempotent_writer(out))
    got = spark.read.parquet(out)
    want = LN.fanout_lanes(raw.drop("amount"), D.scoring_fails())
    for lane, key in (("success", "success"), ("retry", "retry"), ("dlq", "dlq")):
        g = sorted(r.event_id for r in got.filter(F.col("lane") == lane).select("event_id").collect())
        b = sorted(r.event_id for r in want[key].select("event_id").collect())
        assert g == b and g, lane
    g = sorted((r.event_id, r.detail) for r in got.filter(F.col("lane") == "validation_errors").collect())
    b = sorted((r.event_id, r.validation_rule) for r in want["validation_errors"].collect())
    assert g == b
