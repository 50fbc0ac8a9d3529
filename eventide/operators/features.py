"""Per-user history and features.

History semantics: each user's store keeps the newest ``limit`` events; the
whole list expires ``ttl_ms`` after its last write, so an idle gap of at least
the TTL starts a new history. All of it runs on one hash exchange on user_id.
``row_number() <= limit`` is planned as a window group limit, which trims every
map partition to ``limit`` rows per user *before* the shuffle, so a hot user
never ships more than ``limit`` rows per partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import (DEFAULT_FEATURES, MS_PER_MIN, is_click, is_purchase,
                              score_linear)

HISTORY_LIMIT = 100
HISTORY_TTL_MS = 24 * 3600 * 1000
NULL_CATEGORY = "\u0000null"  # null category is its own group

FEATURES = ["avg_time_category", "click_count", "purchase_count", "recency"]


def _newest_first(key: str = "user_id") -> Window:
    return Window.partitionBy(key).orderBy(F.col("timestamp_ms").desc(), F.col("event_id").desc())


def last_n(events: DataFrame, limit: int = HISTORY_LIMIT, key: str = "user_id") -> DataFrame:
    """Newest ``limit`` events per user, with ``pos`` 1 = newest."""
    return (events.withColumn("pos", F.row_number().over(_newest_first(key)))
                  .filter(F.col("pos") <= limit))


def mark_history(events: DataFrame, as_of_ms: int, limit: int = HISTORY_LIMIT,
                 ttl_ms: int = HISTORY_TTL_MS, key: str = "user_id") -> DataFrame:
    """The newest ``limit`` events per user up to ``as_of``, each flagged
    ``in_hist``: part of the stored history at ``as_of`` (the current run, a gap
    >= ttl between neighbours ends it; nothing when the newest event is ``ttl``
    or more before ``as_of``). Every user keeps at least its newest row, so a
    user whose history expired is still present (flag false)."""
    recent = last_n(events.filter(F.col("timestamp_ms") <= as_of_ms), limit, key)
    w = _newest_first(key)
    older = F.lead("timestamp_ms").over(w)
    flagged = recent.withColumn(
        "_starts", older.isNull() | (F.col("timestamp_ms") - older >= ttl_ms))
    # rows of the current run come before (newest-first) the first row that starts a run
    first_start = F.min(F.when(F.col("_starts"), F.col("pos"))).over(Window.partitionBy(key))
    newest = F.max("timestamp_ms").over(Window.partitionBy(key))
    return (flagged.withColumn("_cut", first_start).withColumn("_newest", newest)
            .withColumn("in_hist", (F.col("pos") <= F.col("_cut")) & (F.lit(as_of_ms) - F.col("_newest") < ttl_ms))
            .drop("_starts", "_cut", "_newest"))


def history_as_of(events: DataFrame, as_of_ms: int, limit: int = HISTORY_LIMIT,
                  ttl_ms: int = HISTORY_TTL_MS, key: str = "user_id") -> DataFrame:
    """W1 + W2: the stored history of each user at ``as_of_ms``."""
    return mark_history(events, as_of_ms, limit, ttl_ms, key).filter("in_hist").drop("in_hist")


def unexpired_history(events: DataFrame, as_of_ms: int, ttl_ms: int = HISTORY_TTL_MS, key: str = "user_id",
                      range_ms: int | None = None) -> DataFrame:
    """W2 alone: all events of each user's current run at ``as_of_ms`` (no gap of
    ``ttl_ms`` inside it or after it), however long the run; no window over a user.

    Runs are numbered over event-time pieces (:func:`windows.keyed_order`); the last
    run of each user comes from an aggregate, combined map-side.
    """
    from .windows import join_null_safe, keyed_order, piece_width
    upto = events.filter(F.col("timestamp_ms") <= as_of_ms)
    runs = keyed_order(upto, key, "timestamp_ms", ttl_ms, inclusive=True, range_ms=range_ms or piece_width(upto))
    last = (runs.groupBy(key).agg(F.max("_sess").alias("_last"), F.max("timestamp_ms").alias("_newest"))
            .where(F.lit(as_of_ms) - F.col("_newest") < ttl_ms))
    return join_null_safe(runs, last, [key]).where(F.col("_sess") == F.col("_last")).select(*events.columns)


def scored_users(events: DataFrame, as_of_ms: int, limit: int = HISTORY_LIMIT,
                 ttl_ms: int = HISTORY_TTL_MS, key: str = "user_id") -> DataFrame:
    """Flagship in one exchange: every user seen up to ``as_of`` with its
    features over the stored history (defaults without history) and its score.
    Conditional aggregates over :func:`mark_history` replace a second scan
    for the user list and the join back."""
    m = mark_history(events, as_of_ms, limit, ttl_ms, key)
    h = F.col("in_hist")
    n = F.count_if(h)
    n_cat = F.count_distinct(F.when(h, F.coalesce(F.col("category"), F.lit(NULL_CATEGORY))))
    g = m.groupBy(key).agg(
        n.alias("_n"), n_cat.alias("_ncat"),
        F.count_if(h & is_click()).cast("double").alias("click_count"),
        F.count_if(h & is_purchase()).cast("double").alias("purchase_count"),
        F.max(F.when(h, F.col("timestamp_ms"))).alias("_newest"))
    has = F.col("_n") > 0
    d = dict(zip(FEATURES, DEFAULT_FEATURES))
    out = (g.withColumn("has_history", has)
            .withColumn("avg_time_category", F.when(has, (F.col("_n") / F.col("_ncat")).cast("double"))
                        .otherwise(F.lit(d["avg_time_category"])))
            .withColumn("click_count", F.when(has, F.col("click_count")).otherwise(F.lit(d["click_count"])))
            .withColumn("purchase_count", F.when(has, F.col("purchase_count"))
                        .otherwise(F.lit(d["purchase_count"])))
            .withColumn("recency", F.when(has, ((F.lit(as_of_ms) - F.col("_newest")) / MS_PER_MIN).cast("double"))
                        .otherwise(F.lit(d["recency"]))))
    return score_users(out.drop("_n", "_ncat", "_newest"))


def feature_aggs(as_of: Column) -> list[Column]:
    n = F.count(F.lit(1))
    n_cat = F.count_distinct(F.coalesce(F.col("category"), F.lit(NULL_CATEGORY)))
    return [
        (n / n_cat).cast("double").alias("avg_time_category"),
        F.count_if(is_click()).cast("double").alias("click_count"),
        F.count_if(is_purchase()).cast("double").alias("purchase_count"),
        ((as_of - F.max("timestamp_ms")) / MS_PER_MIN).cast("double").alias("recency"),
    ]


def user_features(history: DataFrame, as_of_ms: int, key: str = "user_id") -> DataFrame:
    """A3: the four features per user over its stored history."""
    return history.groupBy(key).agg(*feature_aggs(F.lit(as_of_ms)))


def with_defaults(users: DataFrame, feats: DataFrame, key: str = "user_id") -> DataFrame:
    """J1 + P11: every user of ``users`` with its features, defaults when absent."""
    joined = users.join(feats, key, "left")
    out = joined.withColumn("has_history", F.col("avg_time_category").isNotNull())
    for name, d in zip(FEATURES, DEFAULT_FEATURES):
        out = out.withColumn(name, F.coalesce(F.col(name), F.lit(d)))
    return out


def score_users(feats: DataFrame) -> DataFrame:
    return feats.withColumn("prediction", score_linear(*FEATURES))


def running_count(events: DataFrame, key: str = "user_id", range_ms: int = 60_000) -> DataFrame:
    """A1: every event emits its key's updated count (event-time order, event_id tie-break).

    Skew-safe form: rows are cut into fixed event-time ranges of ``range_ms``
    (a key holding a third of the data is cut into one piece per range).
    Counts per (key, range) give each piece its offset; the running number is
    then a window partitioned by (key, range) plus that offset, so no single
    task holds a whole hot key. Rows with a null key count as one key; null
    times come first.
    """
    from .windows import join_null_safe, time_bucket  # local import: windows imports nothing from here
    b = events.withColumn("_rng", time_bucket("timestamp_ms", range_ms))
    sizes = b.groupBy(key, "_rng").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(key).orderBy("_rng").rowsBetween(Window.unboundedPreceding, -1)
    offs = sizes.select(key, "_rng", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    w = Window.partitionBy(key, "_rng").orderBy("timestamp_ms", "event_id")
    return (join_null_safe(b, offs, [key, "_rng"])
             .withColumn("event_count", F.col("_off") + F.row_number().over(w))
             .drop("_rng", "_off"))


def user_counts(events: DataFrame, key: str = "user_id") -> DataFrame:
    """A2: final per-key count (the last value of A1)."""
    return events.groupBy(key).agg(F.count(F.lit(1)).alias("event_count"))


def category_counts(events: DataFrame, key: str = "user_id") -> DataFrame:
    """A4: events per (user, category)."""
    return events.groupBy(key, "category").agg(F.count(F.lit(1)).alias("n_events"))


def ttl_sessions(events: DataFrame, ttl_ms: int = HISTORY_TTL_MS, key: str = "user_id") -> DataFrame:
    """Online form of W2: ``hist_session`` numbers each run of a user's events
    whose neighbours are less than ``ttl_ms`` apart; ``gap_minutes`` to the
    previous event; ``pos`` = position of the event in its user (1-based).
    Built by :func:`windows.keyed_order` (no whole-user window)."""
    from .windows import keyed_order
    s = keyed_order(events, key, "timestamp_ms", ttl_ms, inclusive=True)
    return (s.withColumn("gap_minutes", ((F.col("timestamp_ms") - F.col("_prev_ts")) / MS_PER_MIN).cast("double"))
             .withColumnRenamed("_sess", "hist_session").withColumnRenamed("_pos", "pos").drop("_prev_ts"))


FRAME_BLOCK = 1 << 16


def features_online(events: DataFrame, limit: int = HISTORY_LIMIT, ttl_ms: int = HISTORY_TTL_MS,
                    key: str = "user_id", block: int = FRAME_BLOCK) -> DataFrame:
    """The features every event sees: its user's last ``limit`` events
    of the current history, the event itself included (store, then read).
    ``recency`` is the time since the user's event before it (the default without one).

    Skew-safe frame: events are grouped in blocks of ``block`` consecutive
    events of a user; each block also receives the previous block's last
    ``limit - 1`` events as context rows, so the ``limit``-row frame is exact
    while no window partition holds more than ``block + limit - 1`` rows.
    Context rows exist only for users with more than one block of events.
    """
    block = max(block, limit)
    s = ttl_sessions(events, ttl_ms, key).withColumn("_blk", F.floor((F.col("pos") - 1) / block))
    ctx = (s.filter(F.pmod(F.col("pos") - 1, F.lit(block)) >= block - (limit - 1))
            .withColumn("_blk", F.col("_blk") + 1).withColumn("_ctx", F.lit(True)))
    both = s.withColumn("_ctx", F.lit(False)).unionByName(ctx)
    w = (Window.partitionBy(key, "_blk", "hist_session").orderBy("timestamp_ms", "event_id")
         .rowsBetween(-(limit - 1), Window.currentRow))
    n = F.count(F.lit(1)).over(w)
    n_cat = F.size(F.collect_set(F.coalesce(F.col("category"), F.lit(NULL_CATEGORY))).over(w))
    out = (both.withColumn("avg_time_category", (n / n_cat).cast("double"))
               .withColumn("click_count", F.sum(is_click().cast("int")).over(w).cast("double"))
               .withColumn("purchase_count", F.sum(is_purchase().cast("int")).over(w).cast("double"))
               .withColumn("recency", F.coalesce("gap_minutes", F.lit(DEFAULT_FEATURES[FEATURES.index("recency")]))))
    return out.filter(~F.col("_ctx")).drop("_ctx", "_blk")
