"""Committed folders, the history store, late lanes, idle state and recovery."""
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_CHECK, SF_SMALL
from eventide.operators import features as FE
from eventide.operators import windows as WN
from eventide.plans import params as P
from eventide.plans.queries import QUERIES, arrival_slices, mon
from eventide.sources.commits import CommittedFolder, exactly_once
from eventide.streaming import jobs as S
from eventide.streaming.history import HistoryStore
from eventide.streaming.idle import idle_stream
from eventide.streaming.late import LateLanes

HOUR = 3_600_000


def events(spark, rows):
    return spark.createDataFrame(rows, "user_id string, event_id long, timestamp_ms long, event_type string, category string")


def ids(df):
    return sorted((r["user_id"] or "", r["event_id"]) for r in df.select("user_id", "event_id").collect())


def test_only_committed_batches_are_read(spark, scratch):
    folder = CommittedFolder(spark, f"file://{scratch}/f")
    df = spark.range(3).withColumn("k", F.lit("a"))
    assert folder.read(df.schema).count() == 0 and folder.before(0) is None
    folder.write(df, 0)
    assert folder.read(df.schema).count() == 0  # written, not committed
    folder.commit(0, {"n": 3})
    folder.commit(0, {"n": 4})  # a second committer is late: the first one counts
    assert folder.facts(0) == {"n": 3} and folder.before(5) == {"n": 3} and folder.committed() == [0]
    exactly_once(spark, f"file://{scratch}/f")(df.union(df), 0)  # a replay adds nothing
    assert folder.read(df.schema).count() == 3


def shuffled_batches(rng, rows, n, late_ms):
    """Rows in batches by a time of arrival up to late_ms after the event."""
    order = sorted(rows, key=lambda r: r[2] + rng.randrange(late_ms + 1))
    cut = sorted(rng.sample(range(len(order)), n - 1))
    return [order[i:j] for i, j in zip([0, *cut], [*cut, len(order)])]


@pytest.mark.parametrize("seed", range(2))
def test_store_after_any_batches_is_the_batch_window(spark, scratch, seed):
    """Hot user, gaps of exactly the TTL, late events that bridge gaps, null users,
    empty batches, replays."""
    rng = random.Random(seed)
    rows, k = [], 0
    for user in ("hot", "a", "b", "c", None):
        t = 0
        for _ in range(400 if user == "hot" else 30):
            t += rng.choice([0, 1000, HOUR, 24 * HOUR - 1, 24 * HOUR, 24 * HOUR + 1]) if user != "hot" else rng.choice([1000, 30 * HOUR, 60_000])
            rows.append((user, k, t, "view", "x"))
            k += 1
    late = 10 * 60_000
    store = HistoryStore(spark, f"file://{scratch}/store", buckets=4, limit=20, late_ms=late)
    batches = shuffled_batches(rng, rows, 5, late)
    batches.insert(2, [])
    seen = []
    for i, b in enumerate(batches):
        store.merge(events(spark, b), i)
        if i in (1, 3):
            store.merge(events(spark, b + [("a", 10**6, 10**12, "view", "x")]), i)  # a replay, with other rows even
        seen += b
        as_of = max(r[2] for r in seen) + rng.randrange(HOUR)
        assert ids(store.history(as_of)) == ids(FE.history_as_of(events(spark, seen), as_of, 20))
        stored = store.rows().groupBy("user_id").count().collect()
        assert all(r["count"] <= 20 for r in stored)
    assert [p for p in store.folder.committed()] == list(range(6))


def test_store_survives_a_kill_before_the_commit(spark, scratch, monkeypatch):
    store = HistoryStore(spark, f"file://{scratch}/store", buckets=2)
    store.merge(events(spark, [("a", 1, 0, "view", "x")]), 0)
    real = store.folder.commit
    monkeypatch.setattr(store.folder, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        store.merge(events(spark, [("a", 2, 1, "view", "x"), ("b", 3, 1, "view", "x")]), 1)
    assert ids(store.rows()) == [("a", 1)]
    monkeypatch.setattr(store.folder, "commit", real)
    store.merge(events(spark, [("a", 2, 1, "view", "x")]), 1)
    assert ids(store.rows()) == [("a", 1), ("a", 2)]


def test_merge_touches_only_the_batch_s_buckets(spark, scratch):
    store = HistoryStore(spark, f"file://{scratch}/store", buckets=8)
    store.merge(events(spark, [(f"u{i}", i, i, "view", "x") for i in range(100)]), 0)
    store.merge(events(spark, [("u1", 200, 200, "view", "x")]), 1)
    versions = store.folder.facts(1)["versions"]
    assert sorted(versions.values()) == [0] * 7 + [1] and len(store._written(1)) == 1
    assert store.rows().count() == 101


def test_store_from_a_file_stream(spark, scratch):
    e = mon(spark, SF_SMALL).select("user_id", "event_id", "timestamp_ms", "event_type", "category", "arrival_ms")
    for part in arrival_slices(e):
        part.coalesce(1).write.mode("append").parquet(f"{scratch}/in")
    store = HistoryStore(spark, f"file://{scratch}/store", buckets=4)
    stream = S.file_events(spark, f"{scratch}/in", fmt="parquet", schema=e.schema, max_files=1)
    S.run_available(stream, None, f"{scratch}/ck", foreach=store.merge)
    assert len(store.folder.committed()) == P.SLICES
    assert ids(store.history(P.AS_OF_MS)) == ids(FE.history_as_of(e, P.AS_OF_MS))


def test_late_lanes_of_a_stream_equal_the_batch(spark, scratch):
    e = mon(spark, SF_CHECK).select("event_id", "timestamp_ms", "arrival_ms")
    sink = LateLanes(spark, f"file://{scratch}/lanes", P.LATE_LANE_MS, P.ALLOWED_LATENESS_MS)
    parts = arrival_slices(e, 5)
    for k, part in enumerate(parts):
        sink.merge(part, k)
    sink.merge(parts[1], 1)
    got = sorted(map(tuple, sink.read().select("event_id", "lane", "watermark_ms").collect()))
    want = WN.late_lanes(e, bound_ms=P.LATE_LANE_MS, allowed_ms=P.ALLOWED_LATENESS_MS).select("event_id", "lane", "watermark_ms")
    assert got == sorted(map(tuple, want.collect()))
    assert {lane for _, lane, _ in got} == {"on_time", "allowed", "too_late"}


def test_idle_state_expires_neither_early_nor_late(spark, scratch):
    """Gaps just below, at and above the TTL; a late event within the watermark; null times; batch by batch."""
    ttl = 60_000
    steps = [[("a", 0), ("b", 10), ("a", 59_999), ("n", None)], [("a", 119_998), ("b", 60_010)], [("a", 119_000), ("a", 179_998), ("b", 100_000)],
             [("z", 10_000_000)]]
    base = 10**12
    for rows in steps:
        rows = [(u, None if t is None else base + t) for u, t in rows]
        spark.createDataFrame(rows, "user_id string, timestamp_ms long").coalesce(1).write.mode("append").parquet(f"{scratch}/in")
    schema = spark.read.parquet(f"{scratch}/in").schema
    s = S.with_event_time(S.file_events(spark, f"{scratch}/in", fmt="parquet", schema=schema, max_files=1), "30 seconds")
    out = idle_stream(s, ttl)
    S.run_available(out, None, f"{scratch}/ck", foreach=exactly_once(spark, f"file://{scratch}/out"))
    got = sorted(map(tuple, CommittedFolder(spark, f"file://{scratch}/out").read(out.schema).drop("batch").collect()))
    got = [(u, a - base, b - base, n, e - base) for u, a, b, n, e in got]
    assert got == [("a", 0, 119_998, 4, 179_998), ("a", 179_998, 179_998, 1, 239_998), ("b", 10, 10, 1, 60_010),
                   ("b", 60_010, 100_000, 2, 160_000)]


def test_watermark_drops_rows(spark):
    counted = QUERIES["watermark_late"](spark, SF_SMALL).agg(F.sum("n_events")).first()[0]
    assert counted < mon(spark, SF_SMALL).count()


def test_recovery_leaves_nothing_of_the_killed_attempt(spark):
    r = QUERIES["recovery"](spark, SF_SMALL).agg(F.sum("n_events"), F.sum("n_distinct")).first()
    assert r[0] == r[1] == mon(spark, SF_SMALL).count()
