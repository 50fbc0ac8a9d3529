"""Model scoring.

``score_linear`` is the documented logistic model as a Catalyst expression (the
flagship's exact, SQL-checkable scorer). The trained model is an MLlib
RandomForest; its score is P(class 1) read from the probability vector.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import FALLBACK_SCORE
from ..session import checkpoint_dir
from .features import FEATURES

# Fixed values of the documented linear model (intercept, then one weight per feature).
LINEAR_INTERCEPT = -1.0
LINEAR_WEIGHTS = (0.02, 0.05, 0.4, -0.0005)
# Fixed values of the reference model: 50 trees, depth 5, seed 42, 80/20 split.
RF_TREES = 50
RF_DEPTH = 5
RF_SEED = 42
CACHE_TTL_MS = 30_000
CACHE_CAP = 1000


def score_with_fallback(df: DataFrame, score: Column, fails: Column) -> DataFrame:
    """M5: a failed or missing score becomes 0.5 and the row carries the error."""
    raw = F.when(~fails, score)
    bad = raw.isNull() | F.isnan(raw)
    return (df.withColumn("prediction", F.when(bad, F.lit(FALLBACK_SCORE)).otherwise(raw))
              .withColumn("fallback", bad)
              .withColumn("error", F.when(bad, F.lit("scoring failed"))))


def with_status(df: DataFrame) -> DataFrame:
    """M6: scored rows carry status SUCCESS."""
    return df.withColumn("status", F.lit("SUCCESS"))


# ---------------------------------------------------------------- W10: batched inference

def make_linear_predict_fn():
    """Loaded once per Python worker by ``predict_batch_udf``."""
    w = np.asarray(LINEAR_WEIGHTS, dtype=np.float64)

    def predict(x: np.ndarray) -> np.ndarray:
        z = LINEAR_INTERCEPT + x @ w
        return 1.0 / (1.0 + np.exp(-z))
    return predict


def batched_scores(df: DataFrame, batch_size: int = 32) -> DataFrame:
    """Score through Arrow batches of ``batch_size`` rows; the batch size
    is physical only and never changes the rows."""
    from pyspark.ml.functions import predict_batch_udf
    udf = predict_batch_udf(make_linear_predict_fn, return_type=T.DoubleType(),
                            batch_size=batch_size, input_tensor_shapes=[[len(FEATURES)]])
    return df.withColumn("prediction", udf(F.array(*[F.col(c).cast("double") for c in FEATURES])))


# ---------------------------------------------------------------- W4 / W5: prediction cache

def next_expiry(events: DataFrame, ttl_ms: int, key: str = "user_id", range_ms: int = 60_000) -> DataFrame:
    """For each event the first later event of its key at least ``ttl_ms`` later
    (the event that would miss if this one filled the cache): column ``nxt``.

    A probe at ts + ttl looks for the first real event at or after it. Probes
    and events are cut into fixed time pieces per key: the answer is found
    inside the probe's own piece (a window over one (key, piece)), or else it
    is the first event of the key's next non-empty piece, read from a
    (key, piece) table. No window spans a whole key.
    """
    from .windows import join_null_safe, time_bucket
    probes = events.select(key, (F.col("timestamp_ms") + ttl_ms).alias("timestamp_ms"),
                           F.col("event_id").alias("src"), F.lit(0).alias("_real"))
    reals = events.select(key, "timestamp_ms", F.lit(None).cast("bigint").alias("src"),
                          F.lit(1).alias("_real"), F.col("event_id").alias("_eid"))
    both = reals.unionByName(probes, allowMissingColumns=True).withColumn(
        "_rng", time_bucket("timestamp_ms", range_ms))
    # newest first inside a piece; real events sort before a probe of the same
    # time (>= picks them) and, among equal times, the lowest event id comes last
    w = (Window.partitionBy(key, "_rng").orderBy(F.col("timestamp_ms").desc(), F.col("_real").desc(),
                                                 F.col("_eid").desc())
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = both.withColumn("_in", F.last(F.when(F.col("_real") == 1, F.col("_eid")), ignorenulls=True).over(w))
    # first event of each piece, and for every piece seen (by events or probes)
    # the first event of the nearest later piece that has events
    firsts = (both.groupBy(key, "_rng").agg(
        F.min_by(F.when(F.col("_real") == 1, F.col("_eid")),
                 F.when(F.col("_real") == 1, F.struct("timestamp_ms", "_eid"))).alias("_first")))
    later = Window.partitionBy(key).orderBy(F.col("_rng").desc()).rowsBetween(Window.unboundedPreceding, -1)
    nxt_piece = firsts.withColumn("_next", F.last("_first", ignorenulls=True).over(later)).select(key, "_rng", "_next")
    return (join_null_safe(found.filter(F.col("_real") == 0), nxt_piece, [key, "_rng"])
            .select(F.col("src").alias("event_id"), F.coalesce("_in", "_next").alias("nxt")))


def cache_misses(events: DataFrame, ttl_ms: int = CACHE_TTL_MS, key: str = "user_id") -> DataFrame:
    """Event ids that miss the per-key prediction cache.

    The first event of a key misses; a later event hits while it is less than
    ``ttl_ms`` after the last miss, else it misses and restarts the clock. The
    misses are the chain first -> nxt -> nxt... ; an event that follows a gap of
    ``ttl_ms`` misses whatever came before, so the chain is cut into sessions
    there. Within sessions it is marked with pointer doubling (log2 of the
    longest session's chain rounds of joins on event_id), so no key's events are
    ever gathered in one place.
    """
    from .windows import keyed_order
    spark = events.sparkSession
    checkpoint_dir(spark)
    events = events.where(F.col("timestamp_ms").isNotNull())
    starts = (keyed_order(events.select(key, "timestamp_ms", "event_id"), key)
              .where(F.col("_prev_ts").isNull() | (F.col("timestamp_ms") - F.col("_prev_ts") >= ttl_ms))
              .select("event_id")).checkpoint()
    jump = (next_expiry(events, ttl_ms, key).filter(F.col("nxt").isNotNull())
            .join(starts.select(F.col("event_id").alias("nxt")), "nxt", "left_anti").select("event_id", "nxt")).checkpoint()
    levels = [jump]
    while True:
        prev = levels[-1]
        a, b = prev.alias("a"), prev.alias("b")
        nxt = (a.join(b, F.col("a.nxt") == F.col("b.event_id"))
                .select(F.col("a.event_id").alias("event_id"), F.col("b.nxt").alias("nxt"))).checkpoint()
        if nxt.isEmpty():
            break
        levels.append(nxt)
    marked = starts
    for lv in reversed(levels):
        step = marked.join(lv, "event_id").select(F.col("nxt").alias("event_id"))
        marked = marked.unionByName(step).checkpoint()
    return marked


def cache_hits(events: DataFrame, ttl_ms: int = CACHE_TTL_MS, key: str = "user_id") -> DataFrame:
    """Every event with ``cache_hit``, one row per input row: repeated deliveries of
    an id share its flag; an event without a time always misses and fills nothing."""
    misses = cache_misses(events, ttl_ms, key).distinct().withColumn("_miss", F.lit(True))
    hit = F.col("_miss").isNull() & F.col("timestamp_ms").isNotNull()
    return events.join(misses, "event_id", "left").withColumn("cache_hit", hit).drop("_miss")


def cache_contents(hits: DataFrame, cap: int = CACHE_CAP, key: str = "user_id") -> DataFrame:
    """Keys in the cache at the end: each key's last fill, newest ``cap``
    kept (eviction drops the oldest written); a top-k, so Spark plans it as a
    partial top-k per partition and one small merge."""
    fills = (hits.filter(~F.col("cache_hit")).groupBy(key)
             .agg(F.max("timestamp_ms").alias("cached_at_ms")))
    return fills.orderBy(F.col("cached_at_ms").desc(), F.col(key).asc()).limit(cap)


# ---------------------------------------------------------------- M1-M4: trained model

def assemble(df: DataFrame, out: str = "features") -> DataFrame:
    """M3: the four features in fixed order as one vector column."""
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=FEATURES, outputCol=out).transform(df)


def train_forest(train: DataFrame, label: str = "target"):
    """M1: RandomForest with 50 trees, depth 5, seed 42."""
    from pyspark.ml.classification import RandomForestClassifier
    rf = RandomForestClassifier(featuresCol="features", labelCol=label, numTrees=RF_TREES,
                                maxDepth=RF_DEPTH, seed=RF_SEED)
    return rf.fit(assemble(train))


def score_model(model, df: DataFrame) -> DataFrame:
    """M4: one score per row, P(class 1)."""
    from pyspark.ml.functions import vector_to_array
    out = model.transform(assemble(df))
    return out.withColumn("score", vector_to_array("probability")[1]).drop(
        "features", "rawPrediction", "probability")


def label_next_purchase(online: DataFrame, horizon_ms: int, key: str = "user_id", range_ms: int | None = None) -> DataFrame:
    """Training label: 1 when the user's next event within ``horizon_ms`` is a
    purchase. The next event is a forward link across pieces, no window over a user."""
    from .windows import keyed_next
    n = keyed_next(online, ["timestamp_ms", "event_type"], key, range_ms=range_ms)
    hit = (F.col("next_timestamp_ms") - F.col("timestamp_ms") <= horizon_ms) & (F.col("next_event_type") == "purchase")
    return n.withColumn("target", F.when(hit, 1.0).otherwise(0.0)).drop("next_timestamp_ms", "next_event_type")
