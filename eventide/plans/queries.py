"""Registered queries: one per operator of the inventory, each over the test tables.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame whose column names
equal those of the matching DuckDB statement in :mod:`eventide.plans.oracle`.
Computed doubles are rounded to 6 decimals so both engines compare exactly.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import expr as X
from ..functions import validation as V
from ..operators import cache as CA
from ..operators import drift as DR
from ..operators import features as FE
from ..operators import forest as FO
from ..operators import lanes as LN
from ..operators import metrics as MT
from ..operators import quantiles as QU
from ..operators import recommend as RC
from ..operators import rules as RU
from ..operators import score as SC
from ..operators import slo as SL
from ..operators import windows as WN
from ..session import checkpoint_dir
from ..sources import derived as D
from ..sources.events import events_from_tables, parse_events, to_json_value
from ..sources.commits import CommittedFolder, exactly_once
from ..streaming import jobs as ST
from ..streaming.history import HistoryStore
from ..streaming.idle import idle_stream
from ..streaming.late import LateLanes
from . import params as P

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn
    return deco


# ---------------------------------------------------------------- inputs

_PLANS: dict = {}


def shared_plan(fn):
    """Build a shared input DataFrame once per (application, data folder).

    A DataFrame is an immutable logical plan, so queries can start from the
    same object; this saves the thousands of Python-to-JVM calls that building
    the validation and metric plans costs (no data is cached).
    """
    def wrapper(spark: SparkSession, d: str) -> DataFrame:
        k = (fn.__name__, spark.sparkContext.applicationId, d)
        if k not in _PLANS:
            _PLANS[k] = fn(spark, d)
        return _PLANS[k]
    wrapper.__name__ = fn.__name__
    wrapper.__doc__ = fn.__doc__
    return wrapper


@shared_plan
def ev(spark: SparkSession, d: str) -> DataFrame:
    return events_from_tables(spark, d)


@shared_plan
def raw(spark: SparkSession, d: str) -> DataFrame:
    return D.raw_events(ev(spark, d))


@shared_plan
def checked(spark: SparkSession, d: str) -> DataFrame:
    return V.with_errors(raw(spark, d))


@shared_plan
def valid(spark: SparkSession, d: str) -> DataFrame:
    return V.valid_only(checked(spark, d))


def round_doubles(df: DataFrame) -> DataFrame:
    return df.select(*[X.r6(f.name).alias(f.name) if f.dataType.typeName() in ("double", "float")
                       else F.col(f.name) for f in df.schema.fields])


def _error_failed():
    return F.col("event_type") == "error"


def _out_of_range():
    return F.col("value") >= D.FAIL_VALUE


@shared_plan
def mon(spark, d):
    """Events with arrival, processing time, scenario and the late flag."""
    m = D.monitored(ev(spark, d))
    return (m.withColumn("latency_ms", X.latency_ms())
             .withColumn("is_late_arrival", X.is_late("arrival_ms")))


@shared_plan
def fanout(spark, d):
    """The E3 lanes of the fault-injected raw events (scoring fails as in ``scoring_fails``)."""
    return LN.fanout_lanes(raw(spark, d), D.scoring_fails())


@shared_plan
def event_lanes(spark, d):
    """All lanes of the raw events, tagged, with predictions and times."""
    return LN.tagged_lanes(raw(spark, d), D.scoring_fails(), D.processing_ms(), P.CHECK_LIMIT)


# ---------------------------------------------------------------- flagship

def user_scores_plan(events: DataFrame, as_of_ms: int, limit: int) -> DataFrame:
    """validate -> newest ``limit`` per user -> TTL -> features -> score, one row per user."""
    scored = FE.scored_users(events, as_of_ms, limit)
    return round_doubles(scored.select("user_id", "has_history", *FE.FEATURES, "prediction"))


@query("user_scores")
def q_user_scores(spark, d):
    return user_scores_plan(valid(spark, d), P.AS_OF_MS, P.CHECK_LIMIT)


# ---------------------------------------------------------------- 2.1 sources / sinks

@query("src_events")
def q_src_events(spark, d):
    """Events as JSON messages (with extra fields) parsed under the fixed schema."""
    msgs = to_json_value(ev(spark, d).withColumn("send_time", F.col("value")))
    parsed = parse_events(msgs, "value")
    return parsed.select("event_id", "user_id", "product_id", "category", "event_type",
                         "timestamp_ms", "is_late")


# ---------------------------------------------------------------- 2.2 projections

@query("map_pair")
def q_map_pair(spark, d):
    return ev(spark, d).select("event_id", "user_id", F.lit(1).cast("bigint").alias("one"))


@query("event_time")
def q_event_time(spark, d):
    e = ev(spark, d)
    return e.select("event_id",
                    F.date_format(X.ms_to_ntz("timestamp_ms"), "yyyy-MM-dd HH:mm:ss.SSS").alias("event_time"),
                    X.truncate_to_second_ms("timestamp_ms").cast("bigint").alias("event_time_sec_ms"))


@query("type_flags")
def q_type_flags(spark, d):
    return ev(spark, d).select("event_id", X.is_click().alias("is_click"),
                               X.is_purchase().alias("is_purchase"), X.is_cart().alias("is_cart"))


@query("validate")
def q_validate(spark, d):
    """P5: the messages of every event, in rule order."""
    c = checked(spark, d)
    return c.select("event_id", F.size("errors").cast("bigint").alias("n_errors"),
                    F.array_join(F.transform("errors", lambda e: e["message"]), " | ").alias("messages"))


@query("validation_errors")
def q_validation_errors(spark, d):
    v = V.validation_errors(checked(spark, d))
    return v.select("event_id", "user_id", "field", "value", "validation_rule", "timestamp",
                    F.col("rule_no").cast("bigint").alias("rule_no"))


@query("error_field")
def q_error_field(spark, d):
    v = V.validation_errors(checked(spark, d))
    return v.select("event_id", "validation_rule", "field",
                    V.field_from_message(F.col("validation_rule")).alias("field_parity"))


@query("valid_only")
def q_valid_only(spark, d):
    return valid(spark, d).select("event_id", "user_id", "product_id", "category", "event_type",
                                  "timestamp_ms")


@query("key_format")
def q_key_format(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet")
    return e.select("event_id", X.key("user", "user_id").alias("user_key"),
                    X.key("product", F.get_json_object("props", "$.k")).alias("product_key"),
                    X.key("user", F.col("event_id") % 50).alias("bench_user"))


@query("iso_time")
def q_iso_time(spark, d):
    e = ev(spark, d).select("event_id", "timestamp_ms", X.iso_time("timestamp_ms").alias("iso"))
    return e.select("event_id", "iso", (X.parse_iso("iso") == F.col("timestamp_ms")).alias("round_trip"))


# ---------------------------------------------------------------- 2.4 / 2.5 keyed aggregates and windows

@query("running_count")
def q_running_count(spark, d):
    return FE.running_count(ev(spark, d)).select("event_id", "user_id", "event_count")


@query("user_counts")
def q_user_counts(spark, d):
    return FE.user_counts(ev(spark, d))


@query("category_counts")
def q_category_counts(spark, d):
    return FE.category_counts(ev(spark, d))


@query("user_features")
def q_user_features(spark, d):
    hist = FE.history_as_of(ev(spark, d), P.AS_OF_MS, P.CHECK_LIMIT)
    return round_doubles(FE.user_features(hist, P.AS_OF_MS))


@query("last_100")
def q_last_100(spark, d):
    return FE.last_n(ev(spark, d), P.CHECK_LIMIT).select(
        "user_id", "event_id", F.col("pos").cast("bigint").alias("pos"))


@query("history_ttl")
def q_history_ttl(spark, d):
    """W2 at the end of the data, without the length cut."""
    return FE.unexpired_history(ev(spark, d), P.AS_OF_MS).select("user_id", "event_id")


@query("features_online")
def q_features_online(spark, d):
    f = FE.features_online(ev(spark, d), P.CHECK_LIMIT)
    return round_doubles(f.select("event_id", "user_id", F.col("hist_session").cast("bigint").alias("hist_session"),
                                  "gap_minutes", *FE.FEATURES))


# ---------------------------------------------------------------- lanes, retry, fan-out


@query("retry_route")
def q_retry_route(spark, d):
    r = LN.retry_route(ev(spark, d), _error_failed())
    return r.select("event_id", "user_id", "failed", F.col("retry_count").cast("bigint").alias("retry_count"),
                    "route")


@query("retry_backoff")
def q_retry_backoff(spark, d):
    r = LN.retry_route(ev(spark, d), _error_failed()).filter(F.col("route") == "retry")
    return r.select("event_id", F.col("retry_count").cast("bigint").alias("retry_count"), "delay_ms",
                    "retry_at_ms")


@query("sink_fanout")
def q_sink_fanout(spark, d):
    lanes = fanout(spark, d)
    s = lanes["success"].select(F.lit("success").alias("lane"), "event_id", "user_id",
                                F.col("status").alias("detail"))
    v = lanes["validation_errors"].select(F.lit("validation_errors").alias("lane"), "event_id", "user_id",
                                          F.col("validation_rule").alias("detail"))
    q = lanes["dlq"].select(F.lit("dlq").alias("lane"), "event_id", "user_id",
                            F.concat_ws(" ", "error_type", "error_message", "original_event").alias("detail"))
    r = lanes["retry"].select(F.lit("retry").alias("lane"), "event_id", "user_id",
                              F.col("retry_count").cast("string").alias("detail"))
    return s.unionByName(v).unionByName(q).unionByName(r)


@query("event_json")
def q_event_json(spark, d):
    return raw(spark, d).select("event_id", LN.event_json().alias("original_event"))


@query("error_trunc")
def q_error_trunc(spark, d):
    c = checked(spark, d).withColumn("original_event", LN.event_json())
    v = V.validation_errors(c, keep=("original_event",))
    text = F.concat(F.col("validation_rule"), F.lit(" in "), F.col("original_event"))
    return v.select("event_id", F.col("rule_no").cast("bigint").alias("rule_no"), LN.error_trunc(text).alias("error"))


# ---------------------------------------------------------------- scoring

def _online(spark, d, limit=P.CHECK_LIMIT):
    return FE.features_online(ev(spark, d), limit)


@query("feature_asof")
def q_feature_asof(spark, d):
    """Every event scored with the features it sees (ml_predictions lane)."""
    o = FE.score_users(_online(spark, d)).withColumn("processing_time", D.processing_ms())
    return round_doubles(o.select("event_id", "user_id", "product_id", "prediction",
                                  F.col("timestamp_ms").alias("event_time"), "processing_time"))


@query("score_fallback")
def q_score_fallback(spark, d):
    o = _online(spark, d)
    s = SC.score_with_fallback(o, X.score_linear(*FE.FEATURES), _out_of_range())
    return round_doubles(s.select("event_id", "prediction", "fallback", "error"))


@query("score_success")
def q_score_success(spark, d):
    s = event_lanes(spark, d).where("lane = 'success'")
    return round_doubles(s.select("event_id", "user_id", "product_id", "prediction", "event_time", "processing_time", "status"))


@query("event_lanes")
def q_event_lanes(spark, d):
    """The rows of all lanes, from one pass over the raw events."""
    return round_doubles(event_lanes(spark, d))


@query("infer_batches")
def q_infer_batches(spark, d):
    o = SC.batched_scores(_online(spark, d), batch_size=32)
    return round_doubles(o.select("event_id", "prediction"))


@query("cache_hits")
def q_cache_hits(spark, d):
    h = SC.cache_hits(ev(spark, d), P.CACHE_TTL_MS)
    return h.select("event_id", "user_id", "cache_hit")


@query("cache_evict")
def q_cache_evict(spark, d):
    h = SC.cache_hits(ev(spark, d), P.CACHE_TTL_MS)
    return SC.cache_contents(h, P.CACHE_CAP)


def _bounded_cache(spark, d):
    """Scored events and the caches' content, under evictions (W4 + W5)."""
    o = FE.features_online(mon(spark, d), P.CHECK_LIMIT).withColumn("score", X.score_linear(*FE.FEATURES))
    o = o.select("event_id", "user_id", "product_id", "timestamp_ms", "processing_time", "latency_ms", "score",
                 D.scoring_fails().alias("fails")).checkpoint()
    out, held = CA.prediction_cache(o, F.col("score"), F.col("fails"), P.CACHE_TTL_MS, P.CACHE_CAP, P.CACHE_SHARDS)
    return o, out, held


@query("optimized_predictions")
def q_optimized_predictions(spark, d):
    """Every event's prediction, cached or computed; a failed one is the
    fallback with its error and latency -1; a hit takes no scoring time."""
    o, out, _ = _bounded_cache(spark, d)
    j = o.select("event_id", "user_id", "product_id", "timestamp_ms", "processing_time", "latency_ms").join(out, "event_id")
    took = F.when(F.col("error").isNotNull(), -1).when(F.col("cache_hit"), 0).otherwise(F.col("latency_ms"))
    return round_doubles(j.select("event_id", "user_id", "product_id", "prediction", F.col("timestamp_ms").alias("event_time"),
                                  "processing_time", took.cast("bigint").alias("latency_ms"), "cache_hit", "error"))


@query("cache_contents")
def q_cache_contents(spark, d):
    """What each worker's cache holds at the end, oldest written first."""
    _, _, held = _bounded_cache(spark, d)
    return round_doubles(held.select(F.col("shard").cast("bigint").alias("shard"), "user_id", F.col("written_ms").alias("cached_at_ms"),
                                     F.col("place").cast("bigint").alias("place"), "prediction"))


@query("pred_union")
def q_pred_union(spark, d):
    """Per-event predictions and per-user batch predictions on one output."""
    single = FE.score_users(_online(spark, d)).select(
        "user_id", "product_id", "prediction", F.col("timestamp_ms").alias("event_time"))
    batch = (user_scores_plan(ev(spark, d), P.AS_OF_MS, P.CHECK_LIMIT)
             .select("user_id", "prediction", F.lit(True).alias("batch_processed")))
    u = single.unionByName(batch, allowMissingColumns=True)
    return round_doubles(u.withColumn("batch_processed", F.coalesce("batch_processed", F.lit(False))))


# ---------------------------------------------------------------- windows, late data, dedup


@query("tumble")
def q_tumble(spark, d):
    return WN.tumble_counts(ev(spark, d), WN.MINUTE_MS)


@query("session_events")
def q_session_events(spark, d):
    return WN.session_events(ev(spark, d), WN.MINUTE_MS)


@query("sessions")
def q_sessions(spark, d):
    s = WN.sessions(ev(spark, d), P.SESSION_GAP_MS)
    return s.select("user_id", "session_start_ms", "session_end_ms", "n_events")


@query("late_split")
def q_late_split(spark, d):
    lanes = WN.late_lanes(mon(spark, d), bound_ms=P.LATE_LANE_MS, allowed_ms=P.ALLOWED_LATENESS_MS)
    return lanes.select("event_id", "lane", "watermark_ms")


@query("count_window")
def q_count_window(spark, d):
    c = WN.count_windows(mon(spark, d), ["arrival_ms", "event_id"], 100)
    return (c.groupBy("chunk").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_event_id"),
                                   F.max("event_id").alias("last_event_id"),
                                   F.count_if("is_late_arrival").alias("n_late")))


@query("dedup_events")
def q_dedup_events(spark, d):
    dup = WN.redeliveries(mon(spark, d))
    once = WN.dedup(dup)
    return once.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_events"),
                                       F.max("arrival_ms").alias("last_arrival_ms"))


# ---------------------------------------------------------------- latency, loss, run checks

@query("latency_ms")
def q_latency_ms(spark, d):
    return mon(spark, d).select("event_id", "latency_ms")


@query("is_late")
def q_is_late(spark, d):
    m = mon(spark, d)
    return m.select("event_id", (F.col("arrival_ms") - F.col("timestamp_ms")).alias("delay_ms"),
                    F.col("is_late_arrival").alias("is_late"))


@query("latency_band")
def q_latency_band(spark, d):
    m = mon(spark, d).withColumn("band", X.latency_band("latency_ms"))
    return m.groupBy("event_type", "band").agg(F.count(F.lit(1)).alias("n"))


@query("latency_components")
def q_latency_components(spark, d):
    """P14 per component: delivery, processing and both, with the offender."""
    delivery = F.col("arrival_ms") - F.col("timestamp_ms")
    return round_doubles(SL.latency_components(mon(spark, d), {
        "delivery": delivery, "processing": F.col("latency_ms"), "end_to_end": delivery + F.col("latency_ms")}, "end_to_end"))


@query("late_rate")
def q_late_rate(spark, d):
    m = WN.tumble(mon(spark, d), P.HOUR_MS)
    return round_doubles(SL.late_rate(m, ["window_start_ms"]))


@query("latency_stats")
def q_latency_stats(spark, d):
    return round_doubles(SL.latency_stats(D.received(mon(spark, d)), ["event_type"]))


@query("latency_sla")
def q_latency_sla(spark, d):
    return round_doubles(SL.latency_sla(D.received(mon(spark, d)), ["load_scenario"]))


def _sample(spark, d):
    return SL.first_n(D.received(mon(spark, d)), P.SAMPLE_N)


@query("sample_first_n")
def q_sample_first_n(spark, d):
    return _sample(spark, d).select("event_id", "user_id", "is_late")


@query("late_check")
def q_late_check(spark, d):
    return round_doubles(SL.late_check(D.received(mon(spark, d))))


@query("latency_sketch")
def q_latency_sketch(spark, d):
    """A7 by sketches: a sketch an hour and event type, merged by event type;
    whether each quantile's rank is within the stated error of the exact rank."""
    rec = D.received(mon(spark, d)).withColumn("hour", F.floor(F.col("timestamp_ms") / P.HOUR_MS))
    parts = QU.merged(QU.sketches(rec, ["event_type", "hour"], "latency_ms"), ["event_type"])
    qs = [0.5, 0.95, 0.99]
    got = QU.sketch_quantiles(parts, qs).select("event_type", F.posexplode("quantiles").alias("k", "at"))
    got = got.withColumn("q", F.element_at(F.array(*map(F.lit, qs)), F.col("k") + 1))
    v = F.col("latency_ms")
    ranks = got.join(rec.select("event_type", "latency_ms"), "event_type").groupBy("event_type", "q").agg(
        (F.count_if(v < F.col("at")) / F.count(v)).alias("below"), (F.count_if(v <= F.col("at")) / F.count(v)).alias("upto"))
    e = 2 * QU.rank_error()
    return ranks.select("event_type", "q", ((F.col("below") <= F.col("q") + e) & (F.col("upto") >= F.col("q") - e)).alias("within"))


@query("data_loss")
def q_data_loss(spark, d):
    m = mon(spark, d)
    return round_doubles(SL.data_loss(m, D.received(m)))


@query("verdict")
def q_verdict(spark, d):
    """A10: overall = every non-null verdict is true (a null verdict is ignored)."""
    m = mon(spark, d)
    rec = D.received(m)
    sla = SL.latency_sla(rec.withColumn("all", F.lit("all")), ["all"]).select(
        F.lit("latency").alias("check"), F.col("sla_pass").alias("ok"))
    late = SL.late_check(rec).select(F.lit("late_data").alias("check"), F.col("passed").alias("ok"))
    loss = SL.data_loss(m, rec).select(F.lit("loss").alias("check"), F.col("passed").alias("ok"))
    checks = sla.unionByName(late).unionByName(loss)
    return checks.agg(F.max(F.when(F.col("check") == "latency", F.col("ok"))).alias("latency_ok"),
                      F.max(F.when(F.col("check") == "late_data", F.col("ok"))).alias("late_ok"),
                      F.max(F.when(F.col("check") == "loss", F.col("ok"))).alias("loss_ok"),
                      F.every("ok").alias("overall"))


@query("scenario_counts")
def q_scenario_counts(spark, d):
    return mon(spark, d).groupBy("load_scenario").agg(F.count(F.lit(1)).alias("n_events"))


def _phase(m):
    return m.withColumn("phase", F.when(F.col("timestamp_ms") < P.DRIFT_SPLIT_MS, "before").otherwise("after"))


@query("before_after")
def q_before_after(spark, d):
    return round_doubles(SL.before_after(_phase(D.received(mon(spark, d))), "phase"))


@query("throughput")
def q_throughput(spark, d):
    return round_doubles(SL.throughput(mon(spark, d), ["load_scenario"]))


@query("latency_hist")
def q_latency_hist(spark, d):
    m = _phase(D.received(mon(spark, d))).filter(F.col("latency_ms") > 0)
    return round_doubles(SL.histogram(m, "phase", "latency_ms"))


@query("dlq_share")
def q_dlq_share(spark, d):
    """Dead letters / all messages per day."""
    lanes = fanout(spark, d)
    day = F.col("timestamp_ms") - F.pmod(F.col("timestamp_ms"), F.lit(P.DAY_MS))
    dlq = lanes["dlq"].withColumnRenamed("timestamp", "timestamp_ms").select(day.alias("day_ms"), F.lit(1).alias("_d"))
    allm = ev(spark, d).select(day.alias("day_ms"), F.lit(0).alias("_d"))
    out = allm.unionByName(dlq).groupBy("day_ms").agg(
        F.count_if(F.col("_d") == 0).alias("n_messages"), F.count_if(F.col("_d") == 1).alias("n_dlq"))
    return round_doubles(out.withColumn("dlq_share", F.col("n_dlq") / F.col("n_messages")))


@query("error_counters")
def q_error_counters(spark, d):
    """A5: validation errors by (field, rule) and dead letters by error type."""
    lanes = fanout(spark, d)
    v = lanes["validation_errors"].groupBy("field", "validation_rule").agg(F.count(F.lit(1)).alias("n"))
    v = v.select(F.lit("validation_errors_total").alias("counter"), F.col("field").alias("label_a"),
                 F.col("validation_rule").alias("label_b"), "n")
    q = lanes["dlq"].groupBy("error_type").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("dlq_messages_total").alias("counter"), F.col("error_type").alias("label_a"),
        F.lit(None).cast("string").alias("label_b"), "n")
    return v.unionByName(q)


# ---------------------------------------------------------------- recommendations


@query("top_items")
def q_top_items(spark, d):
    return RC.top_items(ev(spark, d), P.TOP_K).select("category", F.col("rank").cast("bigint").alias("rank"),
                                                      "product_id", "n")


@query("cold_start")
def q_cold_start(spark, d):
    c = RC.cold_start(ev(spark, d), P.COLD_AS_OF_MS, P.TOP_K)
    return c.select("user_id", "category", F.col("rank").cast("bigint").alias("rank"), "product_id", "n")


@query("ctr")
def q_ctr(spark, d):
    return round_doubles(RC.ctr(ev(spark, d)))


@query("recs_topk")
def q_recs_topk(spark, d):
    return RC.als_topk(ev(spark, d), P.TOP_K)


@query("recs_recall")
def q_recs_recall(spark, d):
    """K2 by hashed buckets against all pairs: users searched, and whether at least
    nine in ten of their top items were found."""
    uf, itf, _, _ = RC.als_factors(ev(spark, d))
    exact = RC.exact_topk(uf, itf, P.TOP_K).select("u", "i", F.lit(1).alias("e"))
    found = RC.hashed_topk(uf, itf, P.TOP_K, bucket_items=8).select("u", "i", F.lit(1).alias("f"))
    both = exact.join(found, ["u", "i"], "left")
    return both.agg(F.count_distinct("u").alias("n_users"), (F.sum("f") >= 0.9 * F.sum("e")).alias("recall_ok"))


# ---------------------------------------------------------------- drift

@shared_plan
def _period_features(spark, d):
    e = ev(spark, d)
    ref = (e.filter(F.col("timestamp_ms") < P.DRIFT_SPLIT_MS).groupBy("user_id")
           .agg(*FE.feature_aggs(F.lit(P.DRIFT_SPLIT_MS))))
    cur = (e.filter((F.col("timestamp_ms") >= P.DRIFT_SPLIT_MS) & (F.col("timestamp_ms") <= P.AS_OF_MS))
           .groupBy("user_id").agg(*FE.feature_aggs(F.lit(P.AS_OF_MS))))
    return DR.to_long(ref, FE.FEATURES), DR.to_long(cur, FE.FEATURES)


@query("drift_psi")
def q_drift_psi(spark, d):
    ref, cur = _period_features(spark, d)
    return round_doubles(DR.psi(ref, cur))


@query("drift_align")
def q_drift_align(spark, d):
    ref, cur = _period_features(spark, d)
    return DR.aligned_bins(ref, cur)


@query("drift_ks")
def q_drift_ks(spark, d):
    ref, cur = _period_features(spark, d)
    return round_doubles(DR.ks(ref, cur))


@query("drift_chi2")
def q_drift_chi2(spark, d):
    ref, cur = _period_features(spark, d)
    few = F.col("column").isin("click_count", "purchase_count")
    return round_doubles(DR.chi2(ref.filter(few), cur.filter(few)))


@query("drift_wasserstein")
def q_drift_wasserstein(spark, d):
    ref, cur = _period_features(spark, d)
    return round_doubles(DR.wasserstein(ref, cur))


@query("drift_dataset")
def q_drift_dataset(spark, d):
    ref, cur = _period_features(spark, d)
    return round_doubles(DR.dataset_drift(DR.wasserstein(ref, cur)))


@query("max_drift")
def q_max_drift(spark, d):
    ref, cur = _period_features(spark, d)
    return round_doubles(DR.max_drift(DR.wasserstein(ref, cur)))


@query("drift_alert")
def q_drift_alert(spark, d):
    """Daily PSI of each day's user features against the reference; alert above 0.2."""
    ref, _ = _period_features(spark, d)
    e = ev(spark, d).filter((F.col("timestamp_ms") >= P.DRIFT_SPLIT_MS) & (F.col("timestamp_ms") <= P.AS_OF_MS))
    e = e.withColumn("day_ms", F.col("timestamp_ms") - F.pmod(F.col("timestamp_ms"), F.lit(P.DAY_MS)))
    daily = e.groupBy("day_ms", "user_id").agg(*FE.feature_aggs(F.col("day_ms") + P.DAY_MS))
    cur = DR.to_long(daily, FE.FEATURES, by=["day_ms"])
    p = DR.psi(ref, cur, by=["day_ms"])
    out = p.groupBy("day_ms").agg(F.max("psi").alias("drift_score"))
    return round_doubles(out.withColumn("alert", F.col("drift_score") > DR.ALERT_SCORE))


# ---------------------------------------------------------------- metrics and alerts


@shared_plan
def metric_samples(spark, d):
    c = checked(spark, d)
    verr = (c.select("sent_ms", F.explode_outer("errors").alias("e")).filter(F.col("e").isNotNull())
            .select("sent_ms", F.col("e.field").alias("field")))
    dlq = fanout(spark, d)["dlq"].select(F.col("timestamp").alias("timestamp_ms"))
    return MT.metric_table(mon(spark, d), verr, dlq)


@query("m_threshold")
def q_m_threshold(spark, d):
    m = metric_samples(spark, d)
    parts = [MT.threshold(m, "kafka_consumergroup_lag", ">", 1000.0),
             MT.threshold(m, "flink_taskmanager_job_task_operator_currentEmitEventTimeLag", ">", 1000.0),
             MT.threshold(m, "ml_inference_latency_p95", ">", 75.0)]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return round_doubles(out.select("metric", "series", "ts_ms", "value", "firing"))


@query("m_increase")
def q_m_increase(spark, d):
    m = metric_samples(spark, d).filter(F.col("metric") == "events_total")
    return round_doubles(MT.increase(m, P.METRIC_RANGE_MS).select("series", "ts_ms", "increase"))


@query("m_up")
def q_m_up(spark, d):
    return MT.threshold(metric_samples(spark, d), "up", "==", 0.0, (("job", "=", "flink"),)).select("series", "ts_ms", "value", "firing")


@query("m_rate")
def q_m_rate(spark, d):
    m = metric_samples(spark, d).filter(F.col("metric").isin("dlq_messages_total", "events_total"))
    return round_doubles(MT.rate(m, P.METRIC_RANGE_MS).select("series", "ts_ms", "rate"))


@query("m_sum_by")
def q_m_sum_by(spark, d):
    return round_doubles(MT.sum_by(metric_samples(spark, d), "validation_errors_total", "field"))


@query("m_hist_quantile")
def q_m_hist_quantile(spark, d):
    return round_doubles(MT.histogram_quantile(metric_samples(spark, d), 0.95, "ml_latency_bucket",
                                               P.METRIC_RANGE_MS))


@query("m_avg_latency")
def q_m_avg_latency(spark, d):
    return round_doubles(MT.ratio_of_rates(metric_samples(spark, d), "ml_latency_sum", "ml_latency_count",
                                           P.METRIC_RANGE_MS))


@query("m_cpu")
def q_m_cpu(spark, d):
    c = MT.cpu_busy(metric_samples(spark, d), P.METRIC_RANGE_MS)
    return round_doubles(c.withColumn("firing", F.col("value") > 80.0))


@query("m_mem")
def q_m_mem(spark, d):
    c = MT.memory_used(metric_samples(spark, d))
    return round_doubles(c.withColumn("firing", F.col("value") > 90.0))


@query("m_series")
def q_m_series(spark, d):
    m = metric_samples(spark, d).filter(F.col("metric") == "kafka_consumergroup_lag")
    return round_doubles(m.select("ts_ms", F.col("labels")["consumergroup"].alias("consumergroup"),
                                  F.col("labels")["partition"].alias("partition"), "value"))


@query("alerts")
def q_alerts(spark, d):
    return MT.alerts(metric_samples(spark, d), P.METRIC_RANGE_MS).select(
        "alert", "severity", "series", "start_ms", "end_ms", "fires_from_ms", "fired")


#: Added before rounding: percentages that end in an exact half at the last decimal go up in both engines.
_TIE = 1e-9


@shared_plan
def rule_samples(spark, d):
    """The metric table and the daily drift score."""
    return metric_samples(spark, d).unionByName(MT.drift_samples(QUERIES["drift_alert"](spark, d)))


@query("alert_rules")
def q_alert_rules(spark, d):
    """All rules by the evaluator, with matchers, groups and covered ranges."""
    return RU.alert_intervals(rule_samples(spark, d), P.METRIC_RANGE_MS).select(
        "alert", "severity", "labels", "start_ms", "end_ms", "fires_from_ms", "fired")


@query("panels")
def q_panels(spark, d):
    """The dashboard's panels with their bands (back-pressure has no source here)."""
    b = MT.bands(RU.panel_values(rule_samples(spark, d), P.METRIC_RANGE_MS))
    return round_doubles(b.withColumn("value", F.col("value") + _TIE))


@query("m_cpu_covered")
def q_m_cpu_covered(spark, d):
    """T8 over covered time: hours without samples are neither busy nor idle."""
    cpu = tuple(p for p in RU.PANELS if p.name == "cpu_busy_pct")
    v = RU.evaluate(metric_samples(spark, d), cpu, P.METRIC_RANGE_MS)
    return round_doubles(v.select("labels", "ts_ms", (F.col("value") + _TIE).alias("value")))


@query("m_hist_quantile_by")
def q_m_hist_quantile_by(spark, d):
    """T6 by job and operator."""
    return round_doubles(MT.histogram_quantile(MT.operator_buckets(mon(spark, d)), 0.95, "operator_latency_bucket", P.METRIC_RANGE_MS,
                                               ("job", "operator")))


@query("alert_for")
def q_alert_for(spark, d):
    """W11 alone: p95 latency above 75 ms for 5 minutes, on hourly samples."""
    m = metric_samples(spark, d).filter(F.col("metric") == "ml_inference_latency_p95")
    c = m.withColumn("cond", F.col("value") > 75.0).withColumn("_for", F.lit(5 * 60000).cast("long"))
    return MT.alert_for(c, P.HOUR_MS, ["series"], F.col("_for")).select(
        "series", "start_ms", "end_ms", "fires_from_ms", "fired")


@query("m_bands")
def q_m_bands(spark, d):
    m = metric_samples(spark, d)
    lt = MT.latest(m.filter(F.col("metric").isin("kafka_consumergroup_lag", "ml_inference_latency_p95")))
    vals = lt.select("metric", "series", "value")
    cpu = MT.cpu_busy(m, P.METRIC_RANGE_MS)
    mem = MT.memory_used(m)
    last = lambda x, name: (x.groupBy("instance").agg(F.max_by("value", "ts_ms").alias("value"))
                            .select(F.lit(name).alias("metric"),
                                    F.concat(F.lit(name + "{instance="), "instance", F.lit("}")).alias("series"),
                                    "value"))
    vals = vals.unionByName(last(cpu, "cpu_busy_pct")).unionByName(last(mem, "memory_used_pct"))
    return round_doubles(MT.bands(vals))


# ---------------------------------------------------------------- remaining sources and sinks

TOPICS = ["user_events", "ml_predictions_success", "validation_errors", "dlq_fatal_errors"]


def topic_stream(spark, d) -> DataFrame:
    """S2 input: four topics as one record stream (topic, event_id, value JSON)."""
    lanes = fanout(spark, d)
    user_events = ev(spark, d).select(F.lit("user_events").alias("topic"), "event_id",
                                      LN.event_json().alias("value"))
    succ = lanes["success"].select(F.lit("ml_predictions_success").alias("topic"), "event_id",
                                   F.to_json(F.struct("user_id", "product_id", "status")).alias("value"))
    verr = lanes["validation_errors"].select(F.lit("validation_errors").alias("topic"), "event_id",
                                             F.to_json(F.struct("user_id", "field", "validation_rule")).alias("value"))
    dlq = lanes["dlq"].select(F.lit("dlq_fatal_errors").alias("topic"), "event_id",
                              F.to_json(F.struct("user_id", "error_type")).alias("value"))
    return user_events.unionByName(succ).unionByName(verr).unionByName(dlq)


@query("src_multi_topic")
def q_src_multi_topic(spark, d):
    """One stream of four topics, dispatched on the topic name."""
    s = topic_stream(spark, d)
    return s.groupBy("topic").agg(F.count(F.lit(1)).alias("n_messages"),
                                  F.count_distinct(F.get_json_object("value", "$.user_id")).alias("n_users"))


@query("route_topic")
def q_route_topic(spark, d):
    """Keep the records of the prediction topics."""
    s = topic_stream(spark, d)
    return s.filter(F.col("topic").isin("ml_predictions", "optimized_predictions", "ml_predictions_success")) \
            .select("topic", "event_id")


@query("sink_json")
def q_sink_json(spark, d):
    """S3: user_recommendations rows serialized as JSON, then read back."""
    out = to_json_value(FE.user_counts(ev(spark, d)))
    back = out.select("value", F.from_json("value", "user_id string, event_count bigint").alias("r"))
    return back.select("value", "r.user_id", "r.event_count")


@query("hist_store")
def q_hist_store(spark, d):
    """The history store's content (newest first, 100 kept, 24 h expiry) after the
    events were merged into it in micro-batches by arrival, one of them twice."""
    store = HistoryStore(spark, _stream_dir(spark, "history"), buckets=P.HISTORY_BUCKETS)
    slices = arrival_slices(mon(spark, d))
    for batch_id, batch in enumerate(slices):
        store.merge(batch, batch_id)
    store.merge(slices[1], 1)  # delivered once more: changes nothing
    h = store.history(P.AS_OF_MS)
    return h.select("user_id", F.col("pos").cast("bigint").alias("pos"), "event_id",
                    LN.event_json(["event_type", "category", "timestamp_ms"]).alias("entry"))


@query("parse_tolerant")
def q_parse_tolerant(spark, d):
    """Every 13th stored entry is truncated; malformed entries are skipped."""
    msgs = ev(spark, d).select(F.col("user_id").alias("owner"), "event_id", LN.event_json().alias("value"))
    msgs = msgs.withColumn("value", F.when(F.col("event_id") % 13 == 0,
                                           F.expr("substring(value, 1, length(value) - 1)")).otherwise(F.col("value")))
    parsed = parse_events(msgs, "value", keep=["owner"])
    return parsed.groupBy(F.col("owner").alias("user_id")).agg(F.count(F.lit(1)).alias("n_messages"),
                                    F.count_if(F.col("_corrupt_record").isNull()).alias("n_parsed"),
                                    F.count_if(F.col("_corrupt_record").isNotNull()).alias("n_corrupt"))


@query("defaults")
def q_defaults(spark, d):
    """Cold-start defaults as of the second day: unknown label and default
    features, which are scored like any others, for users without history."""
    e = ev(spark, d)
    upto = e.filter(F.col("timestamp_ms") <= P.COLD_AS_OF_MS)
    hist = FE.history_as_of(upto, P.COLD_AS_OF_MS)
    feats = FE.user_features(hist, P.COLD_AS_OF_MS)
    last_cat = (hist.filter(F.col("pos") == 1).select("user_id", F.col("category").alias("last_category")))
    users = e.select("user_id").distinct()
    j = FE.with_defaults(users, feats).join(last_cat, "user_id", "left")
    j = j.withColumn("last_category", F.coalesce("last_category", F.lit(X.UNKNOWN)))
    j = j.withColumn("prediction", X.score_linear(*FE.FEATURES))
    return round_doubles(j.select("user_id", "last_category", "has_history", *FE.FEATURES, "prediction"))


# ---------------------------------------------------------------- trained model

def training_rows(spark, d):
    o = FE.features_online(ev(spark, d))
    return SC.label_next_purchase(o, P.DAY_MS).withColumn("is_train", FO.split_flag("event_id"))


def _trained(spark, d):
    """(the forest, the rows): features and labels are written once, and every pass
    of the training reads them. Each query trains its own."""
    checkpoint_dir(spark)
    rows = training_rows(spark, d).select("event_id", "user_id", "timestamp_ms", *FE.FEATURES, "target", "is_train").checkpoint()
    return SC.train_forest(rows.filter("is_train")), rows


@query("split")
def q_split(spark, d):
    t = training_rows(spark, d)
    return t.groupBy(F.when(F.col("is_train"), "train").otherwise("test").alias("split")) \
            .agg(F.count(F.lit(1)).alias("n"))


@query("assemble")
def q_assemble(spark, d):
    from pyspark.ml.functions import vector_to_array
    a = SC.assemble(FE.features_online(ev(spark, d), P.CHECK_LIMIT))
    arr = vector_to_array("features")
    return round_doubles(a.select("event_id", *[arr[i].alias(f"f{i}") for i in range(4)]))


@query("train")
def q_train(spark, d):
    m, _ = _trained(spark, d)
    return spark.createDataFrame([(m.getNumTrees, m.getOrDefault("maxDepth"), m.totalNumNodes)],
                                 "num_trees int, max_depth int, total_nodes int")


@query("score")
def q_score(spark, d):
    m, rows = _trained(spark, d)
    t = FO.score_forest(rows.filter(~F.col("is_train")), FO.Forest.of(m, spark))
    return round_doubles(t.select("event_id", "user_id", "score", "target"))


@query("infer_user_batches")
def q_infer_user_batches(spark, d):
    """The trained forest called in batches of distinct users, a user's first
    event since the last call standing for it; ``same`` says whether the score is
    that of the model's own transform."""
    m, rows = _trained(spark, d)
    made = FO.score_user_batches(rows, FO.Forest.of(m, spark), P.BATCH_USERS, P.CACHE_SHARDS)
    plain = SC.score_model(m, rows).select("event_id", F.col("score").alias("plain"))
    return made.join(plain, "event_id").select(F.col("shard").cast("bigint").alias("shard"), "batch", "user_id", "event_id", "n_events",
                                               (F.abs(F.col("score") - F.col("plain")) < 1e-9).alias("same"))


@query("accuracy")
def q_accuracy(spark, d):
    m, rows = _trained(spark, d)
    s = SC.score_model(m, rows.filter(~F.col("is_train")))
    return round_doubles(s.agg(F.count(F.lit(1)).alias("n_test"),
                               F.avg((F.col("prediction") == F.col("target")).cast("double")).alias("accuracy")))


# ---------------------------------------------------------------- streaming forms (run to completion)


def _stream_dir(spark, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never a machine-local one)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/eventide-stream/{name}-{uuid.uuid4().hex}"


def _event_files(spark, d, base: str, fmt: str = "parquet") -> str:
    """The test events as message files (written by Spark), the stream's input.
    Raw message form (timestamp_ms as text); JSON parsing itself is S1's query."""
    path = f"{base}/input"
    e = ev(spark, d).withColumn("timestamp_ms", F.col("timestamp_ms").cast("string"))
    e.drop("value").write.format(fmt).save(path)
    return path


def arrival_slices(df: DataFrame, n: int = P.SLICES, arrival: str = "arrival_ms") -> list[DataFrame]:
    """``df`` as ``n`` micro-batches by equal ranges of arrival time (two numbers
    reach the driver). Rows without a time are in the first."""
    lo, hi = df.agg(F.min(arrival), F.max(arrival)).first()
    at = F.coalesce(F.floor((F.col(arrival) - F.lit(lo)) * n / F.lit(max(1, (hi or 0) - (lo or 0) + 1))), F.lit(0))
    return [df.where(at == k) for k in range(n)]


FILES_A_SLICE = 2


def _sliced_files(spark, df: DataFrame, base: str, arrival: str = "arrival_ms") -> DataFrame:
    """A file stream of ``df``, one micro-batch per arrival slice: the slices are
    written one after the other, in a fixed number of files each."""
    path = f"{base}/input"
    for part in arrival_slices(df, arrival=arrival):
        part.repartition(FILES_A_SLICE).write.mode("append").parquet(path)
    return ST.file_events(spark, path, fmt="parquet", schema=df.schema, max_files=FILES_A_SLICE)


def _arriving(spark, d) -> DataFrame:
    """Events with arrival times; every LATE_EVERY-th arrives LATE_BY_MS late."""
    late = F.col("event_id") % P.LATE_EVERY == 0
    return (mon(spark, d).select("event_id", "user_id", "timestamp_ms", "arrival_ms")
            .withColumn("arrival_ms", F.when(late, F.col("timestamp_ms") + P.LATE_BY_MS).otherwise(F.col("arrival_ms"))))


@query("watermark_late")
def q_watermark_late(spark, d):
    """Hourly counts of a stream in which late rows fall out of closed windows:
    a window counts what arrives before the watermark has passed its end."""
    base = _stream_dir(spark, "watermark-late")
    s = _sliced_files(spark, _arriving(spark, d), base)
    s = ST.with_event_time(s, f"{P.WATERMARK_MS // 1000} seconds")
    counts = (s.groupBy(F.window("event_time", f"{P.HOUR_MS // 1000} seconds").alias("w")).agg(F.count(F.lit(1)).alias("n_events"))
              .select(F.unix_millis(F.col("w.start")).alias("window_start_ms"), "n_events"))
    ST.run_available(counts, None, f"{base}/ck", mode="update", foreach=exactly_once(spark, f"{base}/out"))
    folder = CommittedFolder(spark, f"{base}/out")
    folder.remove(f"{base}/input")
    return folder.read(counts.schema).groupBy("window_start_ms").agg(F.max("n_events").alias("n_events"))


@query("late_stream")
def q_late_stream(spark, d):
    """X3 on a stream: the lanes of every event, late ones kept, batch by batch."""
    base = _stream_dir(spark, "late")
    s = _sliced_files(spark, mon(spark, d).select("event_id", "timestamp_ms", "arrival_ms"), base)
    sink = LateLanes(spark, f"{base}/out", P.LATE_LANE_MS, P.ALLOWED_LATENESS_MS)
    ST.run_available(s, None, f"{base}/ck", foreach=sink.merge)
    sink.folder.remove(f"{base}/input")
    return sink.read().select("event_id", "lane", "watermark_ms")


@query("state_ttl")
def q_state_ttl(spark, d):
    """Per-user state that expires after idling for STATE_TTL_MS of event time."""
    base = _stream_dir(spark, "ttl")
    events = mon(spark, d).select("user_id", "timestamp_ms", "arrival_ms")
    _sliced_files(spark, events, base)
    # the run is bounded: a last row of no user lets the watermark pass every timer
    spark.range(1).select(F.lit(_END).alias("user_id"), F.lit(int(_END_MS)).alias("timestamp_ms"),
                          F.lit(int(_END_MS)).alias("arrival_ms")).write.mode("append").parquet(f"{base}/input")
    s = ST.file_events(spark, f"{base}/input", fmt="parquet", schema=events.schema, max_files=FILES_A_SLICE)
    out = idle_stream(ST.with_event_time(s, "1 hour"), P.STATE_TTL_MS)
    ST.run_available(out, None, f"{base}/ck", foreach=exactly_once(spark, f"{base}/out"))
    folder = CommittedFolder(spark, f"{base}/out")
    folder.remove(f"{base}/input")
    return folder.read(out.schema).where(~F.col("user_id").eqNullSafe(F.lit(_END))).select(
        "user_id", "first_ms", "last_ms", "n_events", "expired_ms")


class _Killed(Exception):
    """Raised by the recovery query inside a micro-batch."""


@query("recovery")
def q_recovery(spark, d):
    """A run that dies inside its second micro-batch, after the batch's files are
    written and before they count, and is started again: events by user, none lost
    and none doubled."""
    base = _stream_dir(spark, "recovery")
    s = _sliced_files(spark, mon(spark, d).select("event_id", "user_id", "arrival_ms"), base)

    def dies(batch_id: int) -> None:
        if batch_id == 1:
            raise _Killed("inside a micro-batch")

    try:
        ST.run_available(s, None, f"{base}/ck", foreach=exactly_once(spark, f"{base}/out", between=dies))
    except Exception as e:
        if "inside a micro-batch" not in str(e):
            raise
    ST.run_available(s, None, f"{base}/ck", foreach=exactly_once(spark, f"{base}/out"))
    folder = CommittedFolder(spark, f"{base}/out")
    folder.remove(f"{base}/input")
    return folder.read(s.schema).groupBy("user_id").agg(F.count(F.lit(1)).alias("n_events"),
                                                        F.count_distinct("event_id").alias("n_distinct"))


@query("watermark")
def q_watermark(spark, d):
    """X1 + E1: running counts over the event stream with a 5-minute watermark;
    the last emitted count per user equals the batch count."""
    base = _stream_dir(spark, "watermark")
    src = _event_files(spark, d, base)
    counts = ST.running_counts(ST.with_event_time(ST.file_events(spark, src, fmt="parquet")))
    ST.run_available(counts, None, f"{base}/ck", mode="update",
                     foreach=ST.idempotent_writer(f"{base}/out", lane_col=None))
    out = spark.read.parquet(f"{base}/out")
    return out.groupBy("user_id").agg(F.max("event_count").alias("event_count"))


#: User and time of the row that ends a bounded retry run (2100-01-01).
_END, _END_MS = "\x00end", "4102444800000"


def _retry_run(spark, d):
    base = _stream_dir(spark, "retry")
    src = _event_files(spark, d, base)
    s = ST.with_event_time(ST.file_events(spark, src, fmt="parquet"))
    s = s.withColumn("timestamp_ms", F.col("timestamp_ms").cast("bigint")).withColumn(
        "failed", F.col("event_type") == "error")
    routed = ST.retry_stream(s)
    ST.run_available(routed, f"{base}/out", f"{base}/ck")
    # the run is bounded: a last row of no user, far ahead, lets the watermark pass every pending timer
    end = spark.range(1).select(F.lit(_END).alias("user_id"), F.lit(_END_MS).alias("timestamp_ms"))
    end.write.mode("append").parquet(src)
    ST.run_available(routed, f"{base}/out", f"{base}/ck")
    return spark.read.parquet(f"{base}/out").where(~F.col("user_id").eqNullSafe(F.lit(_END)))


@query("retry_state")
def q_retry_state(spark, d):
    """The retry counter as keyed state (transformWithState), new events only."""
    r = _retry_run(spark, d).filter(F.col("attempt") == 0)
    return r.select("event_id", "user_id", "route", F.col("retry_count").cast("bigint").alias("retry_count"))


@query("retry_replay")
def q_retry_replay(spark, d):
    """Retried events re-run when their back-off timer fires (transient
    failures: the replay succeeds); replays per user."""
    r = _retry_run(spark, d).filter(F.col("route").startswith("replay"))
    return r.groupBy("user_id", "route").agg(F.count(F.lit(1)).alias("n"))


@query("feature_lookup")
def q_feature_lookup(spark, d):
    """Each event looks up its user's features as of
    the split (stored history at that time); users without history get the
    cold-start vector. A left join on user_id: the feature side has one row per
    user; a hot user's events are split by AQE's skew-join handling."""
    e = ev(spark, d)
    feats = FE.user_features(FE.history_as_of(e, P.DRIFT_SPLIT_MS), P.DRIFT_SPLIT_MS)
    j = FE.with_defaults(e.select("event_id", "user_id"), feats)
    return round_doubles(j.select("event_id", "user_id", "has_history", *FE.FEATURES))
