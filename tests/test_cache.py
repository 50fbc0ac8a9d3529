"""The bounded cache against a plain Python one; the miss chain split at gaps."""
import random

import pytest
from pyspark.sql import functions as F

from eventide.operators import cache as C
from eventide.operators import score as SC


def plain(rows, ttl, cap, shards, shard):
    """event_id -> (hit, prediction, filled by, error), and the entries left in each shard."""
    caches, out = {}, {}
    for e, u, t, s, f in sorted(rows, key=lambda r: (r[2] is not None, r[2] or 0, r[0])):
        c = caches.setdefault(shard[u], [])
        held = next((x for x in c if x[0] == u), None)
        if t is None:
            out[e] = (False, 0.5, None, "scoring failed") if f else (False, s, e, None)
        elif held and t - held[1] < ttl:
            out[e] = (True, held[3], held[2], None)
        else:
            if held:
                c.remove(held)
            if f:
                out[e] = (False, 0.5, None, "scoring failed")
            else:
                out[e] = (False, s, e, None)
                c.append((u, t, e, s))
                if len(c) > cap:
                    c.remove(min(c, key=lambda x: (x[1], x[2])))
    return out, {k: sorted(c, key=lambda x: (x[1], x[2])) for k, c in caches.items()}


@pytest.mark.parametrize("seed,shards,piece_rows", [(0, 1, 40), (1, 1, 7), (2, 3, 25), (3, 2, 10**6)])
def test_equals_a_plain_cache(spark, seed, shards, piece_rows):
    """Cap 3, hot user, ties in time, failures, events without a time or user."""
    rng = random.Random(seed)
    users = ["hot"] * 6 + [f"u{i}" for i in range(8)] + [""]
    rows, t = [], 0
    for e in range(300):
        t += rng.choice([0, 1, 3, 10, 60])
        rows.append((e, rng.choice(users), None if rng.random() < 0.02 else t, round(rng.random(), 3), rng.random() < 0.1))
    rng.shuffle(rows)
    df = spark.createDataFrame([(e, u or None, t, s, f) for e, u, t, s, f in rows],
                               "event_id long, user_id string, timestamp_ms long, s double, f boolean")
    shard = {r["user_id"] or "": r["k"] for r in df.select("user_id", C.shard_of("user_id", shards).alias("k")).distinct().collect()}
    want, left = plain(rows, 50, 3, shards, shard)
    out, held = C.prediction_cache(df, F.col("s"), F.col("f"), 50, 3, shards, piece_rows=piece_rows)
    assert {r["event_id"]: (r["cache_hit"], r["prediction"], r["filled_by"], r["error"]) for r in out.collect()} == want
    assert any(h for h, *_ in want.values()) and out.count() == len(rows)
    got = {}
    for r in sorted(held.collect(), key=lambda r: r["place"]):
        got.setdefault(r["shard"], []).append((r["user_id"], r["written_ms"], r["filled_by"], r["prediction"]))
    assert got == {k: c for k, c in left.items() if c}


def test_empty_table(spark):
    df = spark.createDataFrame([], "event_id long, user_id string, timestamp_ms long")
    out, held = C.prediction_cache(df, F.lit(0.5), F.lit(False), 50, 3, 2)
    assert out.count() == 0 and held.count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_miss_chain_with_sessions_equals_the_fold(spark, seed):
    rng = random.Random(seed)
    rows, t = [], 0
    for e in range(250):
        t += rng.choice([0, 1, 5, 20, 49, 50, 51, 200])
        rows.append((e, rng.choice(["a", "b", None]), t))
    df = spark.createDataFrame(rows, "event_id long, user_id string, timestamp_ms long")
    cache = {}
    want = {e: h for (e, _, _), (h, *_) in zip(rows, C.fold([(e, u, t, 0.0, False) for e, u, t in rows], cache, 50, 10**6))}
    assert {r["event_id"]: r["cache_hit"] for r in SC.cache_hits(df, 50).collect()} == want
