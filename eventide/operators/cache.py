"""The bounded prediction cache, with its scores and evictions.

Each scoring worker (shard) keeps the predictions of the users it serves. An event
hits while its user's entry is less than ``ttl_ms`` old; else it is scored and its
entry written anew, and beyond ``cap`` entries the oldest written one goes, so that
user's next event misses. A score that fails is the fallback 0.5; it fills nothing,
and an expired entry is gone all the same.

This is a fold over a shard's events in time order: every eviction depends on all
writes before. It runs in pieces of the time line side by side. A piece is folded
from a guess of the cache at its start (at first an empty one), and again whenever
the piece before it ends with another cache than was guessed, until nothing changes
any more. Then every piece was folded from its true start, so the result is that of
the plain fold, whatever the number of pieces; caches forget quickly, so a few
rounds are enough in practice. A task holds one piece of one shard and ``cap``
entries: a user with a third of all events is cut into pieces like any other.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import FALLBACK_SCORE
from ..session import checkpoint_dir
from .windows import order_bucket

#: Events a piece should hold.
PIECE_ROWS = 250_000
_ERROR = "scoring failed"

_ROWS = ("kind string, shard int, piece int, event_id long, cache_hit boolean, prediction double, filled_by long, error string, "
         "place int, user_id string, written_ms long, digest string")


def shard_of(key: str, shards: int) -> Column:
    """The worker that serves a key: a hash that any engine can repeat."""
    return F.pmod(F.conv(F.substring(F.md5(F.coalesce(F.col(key), F.lit(""))), 1, 8), 16, 10).cast("bigint"), F.lit(shards)).cast("int")


def fold(events, cache: dict, ttl_ms: int, cap: int):
    """The plain cache. ``events``: (event_id, user, time, score, fails) in order;
    ``cache``: user -> (time written, event that filled it, score), oldest first,
    changed in place. One (hit, prediction, filled by, error) an event."""
    for event_id, user, t, score, fails in events:
        if t is None:
            yield (False, FALLBACK_SCORE, None, _ERROR) if fails else (False, score, event_id, None)
            continue
        held = cache.get(user)
        if held is not None and t - held[0] < ttl_ms:
            yield True, held[2], held[1], None
            continue
        if held is not None:
            del cache[user]
        if fails:
            yield False, FALLBACK_SCORE, None, _ERROR
            continue
        cache[user] = (t, event_id, score)
        if len(cache) > cap:
            del cache[next(iter(cache))]
        yield False, score, event_id, None


def _piece_fold(ttl_ms: int, cap: int):
    import hashlib

    def run(key, rows: pa.Table, start: pa.Table) -> pa.Table:
        shard, piece = (k.as_py() for k in key)
        entries = start.sort_by("place").to_pydict()
        cache = {u: (t, e, p) for u, t, e, p in zip(*(entries[c] for c in ("user_id", "written_ms", "filled_by", "prediction")), strict=True)}
        rows = rows.sort_by([("timestamp_ms", "ascending"), ("event_id", "ascending")])
        cols = [rows.column(c).to_pylist() for c in ("event_id", "user_id", "timestamp_ms", "score", "fails")]
        made = list(zip(*fold(zip(*cols, strict=True), cache, ttl_ms, cap), strict=True)) or [()] * 4
        n, m = len(cols[0]), len(cache)
        ends = list(cache.values())
        digest = hashlib.md5(repr([(u, *v[:2]) for u, v in cache.items()]).encode()).hexdigest()
        none = [None]
        data = {
            "kind": ["row"] * n + ["entry"] * m + ["end"], "event_id": cols[0] + none * (m + 1), "cache_hit": list(made[0]) + none * (m + 1),
            "prediction": list(made[1]) + [v[2] for v in ends] + none, "filled_by": list(made[2]) + [v[1] for v in ends] + none,
            "error": list(made[3]) + none * (m + 1), "place": none * n + list(range(m)) + none, "user_id": none * n + list(cache) + none,
            "written_ms": none * n + [v[0] for v in ends] + none, "digest": none * (n + m) + [digest]}
        total = n + m + 1
        types = {"event_id": pa.int64(), "cache_hit": pa.bool_(), "prediction": pa.float64(), "filled_by": pa.int64(), "error": pa.string(),
                 "place": pa.int32(), "user_id": pa.string(), "written_ms": pa.int64(), "digest": pa.string(), "kind": pa.string()}
        names = [c.split(" ")[0] for c in _ROWS.split(", ")]
        fixed = {"shard": pa.array([shard] * total, pa.int32()), "piece": pa.array([piece] * total, pa.int32())}
        return pa.table([fixed.get(c) if c in fixed else pa.array(data[c], types[c]) for c in names], names=names)
    return run


def prediction_cache(events: DataFrame, score: Column, fails: Column, ttl_ms: int, cap: int, shards: int = 1,
                     key: str = "user_id", piece_rows: int = PIECE_ROWS) -> tuple[DataFrame, DataFrame]:
    """(one row an event, with event_id, cache_hit, prediction, filled_by and error;
    the cache at the end: shard, user_id, written_ms, filled_by, prediction, place).

    ``events`` has event_id, the key and timestamp_ms. An event without a time
    misses and fills nothing; events without a key are one user's.
    """
    spark = events.sparkSession
    checkpoint_dir(spark)
    rows = events.select("event_id", F.coalesce(F.col(key), F.lit("")).alias("user_id"), "timestamp_ms", score.cast("double").alias("score"),
                         F.coalesce(fails, F.lit(False)).alias("fails"), shard_of(key, shards).alias("shard")).checkpoint()
    n = max(1, -(-rows.count() // piece_rows))
    rows = order_bucket(rows, "timestamp_ms", n, out="piece").withColumn("piece", F.coalesce("piece", F.lit(0)).cast("int"))
    group = ["shard", "piece"]
    # the piece of the same shard before each: one row a piece and shard
    before = (rows.select(*group).distinct()
              .withColumn("prior", F.lag("piece").over(Window.partitionBy("shard").orderBy("piece")))).checkpoint()
    nothing = spark.createDataFrame([], "shard int, piece int, user_id string, written_ms long, filled_by long, prediction double, place int")
    run = _piece_fold(ttl_ms, cap)

    def folded(of: DataFrame, starts: DataFrame) -> DataFrame:
        starts = starts.select(*(F.col(c).alias(c) for c in starts.columns))  # columns of its own, not those of ``of``
        return (of.groupBy(*group).cogroup(starts.groupBy(*group)).applyInArrow(run, _ROWS)).checkpoint()

    rounds = [folded(rows, nothing)]
    last = before.select(*group, F.lit(0).alias("round")).checkpoint()
    used = before.select(*group, F.lit(None).cast("string").alias("guess")).checkpoint()
    while True:
        ends = None
        for k, done in enumerate(rounds):
            own = done.where("kind = 'end'").select(*group, "digest", F.lit(k).alias("round")).join(last, [*group, "round"]).drop("round")
            ends = own if ends is None else ends.unionByName(own)
        starts_from = (before.where("prior is not null").alias("b").join(
            ends.alias("e"), (F.col("b.shard") == F.col("e.shard")) & (F.col("b.prior") == F.col("e.piece")))
            .select("b.shard", "b.piece", "b.prior", "digest"))
        wrong = (starts_from.join(used, group).where(~F.col("guess").eqNullSafe(F.col("digest")))
                 .select(*group, "prior", "digest")).checkpoint()
        if wrong.isEmpty():
            break
        entries = None
        for k, done in enumerate(rounds):
            own = (done.where("kind = 'entry'").withColumn("round", F.lit(k)).join(last, [*group, "round"])
                   .select("shard", F.col("piece").alias("prior"), "user_id", "written_ms", "filled_by", "prediction", "place"))
            entries = own if entries is None else entries.unionByName(own)
        starts = wrong.join(entries, ["shard", "prior"]).select("shard", "piece", "user_id", "written_ms", "filled_by", "prediction", "place")
        again = wrong.select(*group)
        rounds.append(folded(rows.join(again, group, "left_semi"), starts))
        k = len(rounds) - 1
        last = last.join(again, group, "left_anti").unionByName(again.withColumn("round", F.lit(k))).checkpoint()
        used = (used.join(again, group, "left_anti").unionByName(wrong.select(*group, F.col("digest").alias("guess")))).checkpoint()

    out, cache = None, None
    final = before.groupBy("shard").agg(F.max("piece").alias("piece"))
    for k, done in enumerate(rounds):
        own = done.withColumn("round", F.lit(k)).join(last, [*group, "round"])
        made = own.where("kind = 'row'").select("event_id", "cache_hit", "prediction", "filled_by", "error")
        held = own.where("kind = 'entry'").join(final, group).select("shard", "user_id", "written_ms", "filled_by", "prediction", "place")
        out, cache = (made, held) if out is None else (out.unionByName(made), cache.unionByName(held))
    return out, cache
