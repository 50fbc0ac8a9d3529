"""Validation lanes, retry routing and the three-way fan-out.

A scoring attempt either succeeds or fails; consecutive failures of one user
count 1, 2, 3 (retry with back-off 1 s, 2 s, 4 s) and the 4th goes to the
dead-letter lane with retry_count 4 and resets the counter; a success resets it
too. Rows that fail validation never touch the counter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import validation as V

MAX_RETRIES = 3
BASE_DELAY_MS = 1000
ERROR_TRUNC = 100
EVENT_FIELDS = ["user_id", "product_id", "category", "event_type", "timestamp_ms"]


def event_json(cols: list[str] | None = None) -> Column:
    """The event re-encoded as JSON, null fields kept as ``null``."""
    return F.to_json(F.struct(*(cols or EVENT_FIELDS)), {"ignoreNullFields": "false"})


def error_trunc(text: Column) -> Column:
    """P10: first 100 characters of an error text."""
    return F.substring(text, 1, ERROR_TRUNC)


def retry_route(events: DataFrame, failed: Column, key: str = "user_id",
                max_retries: int = MAX_RETRIES, range_ms: int = 60_000) -> DataFrame:
    """W6 + W7 in batch form: ``retry_count``, ``route`` and back-off per attempt.

    k = position inside the current run of consecutive failures = row number
    minus the row number of the user's last success before it;
    retry_count = ((k-1) % (max+1)) + 1.

    Skew-safe: rows are cut into fixed event-time ranges (see
    ``features.running_count``); a (key, range) table carries each range's row
    offset and the last success position before it, so the per-row window
    only spans one (key, range) piece. Rows with a null key are one key; null
    times come first.
    """
    from .windows import join_null_safe, time_bucket
    df = events.withColumn("failed", failed)
    b = df.withColumn("_rng", time_bucket("timestamp_ms", range_ms))
    w = Window.partitionBy(key, "_rng").orderBy("timestamp_ms", "event_id")
    local = (b.withColumn("_lrn", F.row_number().over(w))
              .withColumn("_lok", F.max(F.when(~F.col("failed"), F.col("_lrn"))).over(
                  w.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    per = local.groupBy(key, "_rng").agg(F.count(F.lit(1)).alias("_n"), F.max("_lok").alias("_last_local"))
    prior = Window.partitionBy(key).orderBy("_rng").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("_off", F.coalesce(F.sum("_n").over(prior), F.lit(0)))
    # the last success of a range sits at its offset + local position; null in a range without a success
    last_in = F.col("_off") + F.col("_last_local")
    per = per.withColumn("_ok_before", F.max(last_in).over(prior)).select(key, "_rng", "_off", "_ok_before")
    j = join_null_safe(local, per, [key, "_rng"])
    rn = F.col("_off") + F.col("_lrn")
    last_ok = F.greatest(F.col("_ok_before"), F.col("_off") + F.col("_lok"))
    k = rn - F.coalesce(last_ok, F.lit(0))
    cnt = F.when(F.col("failed"), ((k - 1) % (max_retries + 1)) + 1)
    out = j.withColumn("retry_count", cnt.cast("int")).drop("_rng", "_lrn", "_lok", "_off", "_ok_before")
    route = (F.when(~F.col("failed"), F.lit("success"))
             .when(F.col("retry_count") <= max_retries, F.lit("retry"))
             .otherwise(F.lit("dlq")))
    delay = F.when(route == "retry",
                   (F.lit(BASE_DELAY_MS) * F.pow(F.lit(2), F.col("retry_count") - 1)).cast("bigint"))
    return (out.withColumn("route", route).withColumn("delay_ms", delay)
               .withColumn("retry_at_ms", F.col("timestamp_ms") + F.col("delay_ms")))


def tagged_lanes(raw: DataFrame, failed: Column, processing: Column, limit: int | None = None, key: str = "user_id") -> DataFrame:
    """S4 / M6 in one pass over the raw events: every output row of every lane with
    its ``lane``, so a sink writes them all at once (``partitionBy("lane")``).

    A success carries its prediction, event and processing time; a broken rule its
    field, value and message; a dead letter the event, the error and the count; a
    pending retry its count and time. An invalid event goes along under a key of its
    own, so it neither sees nor changes a user's history or failures.
    """
    from .features import FEATURES, HISTORY_LIMIT, features_online
    from ..functions.expr import score_linear
    chk = V.with_errors(raw)
    ts = V.ts_value(F.col("timestamp_ms").cast("string"))
    rows = (chk.select(*(F.col(c) for c in raw.columns if c != "timestamp_ms"), ts.alias("timestamp_ms"), F.explode_outer("errors").alias("_e"))
            .withColumn("_bad", F.col("_e").isNotNull())
            .withColumn("_who", F.when(F.col("_bad"), F.concat(F.lit("\u0000"), F.col("event_id").cast("string"))).otherwise(F.col(key))))
    seen = features_online(rows, limit or HISTORY_LIMIT, key="_who")
    r = retry_route(seen, failed & ~F.col("_bad"), "_who")
    lane = F.when(F.col("_bad"), F.lit("validation_errors")).otherwise(F.col("route"))
    of = lambda name, value: F.when(lane == name, value)
    return r.select(
        lane.alias("lane"), "event_id", key, of("success", F.col("product_id")).alias("product_id"),
        of("success", score_linear(*FEATURES)).alias("prediction"), F.col("timestamp_ms").alias("event_time"),
        of("success", processing).alias("processing_time"), of("success", F.lit("SUCCESS")).alias("status"),
        F.col("_e.field").alias("field"), F.col("_e.value").alias("bad_value"), F.col("_e.message").alias("validation_rule"),
        of("dlq", event_json()).alias("original_event"),
        of("dlq", F.concat(F.lit("model input out of range for "), F.col("product_id"))).alias("error_message"),
        of("dlq", F.lit("ScoringError")).alias("error_type"),
        F.when(lane.isin("dlq", "retry"), F.col("retry_count").cast("bigint")).alias("retry_count"),
        of("retry", F.col("retry_at_ms")).alias("retry_at_ms"))


def classify(raw: DataFrame, failed: Column, key: str = "user_id") -> DataFrame:
    """E3 in batch: validation, then retry routing of the valid rows.

    Returns one row per raw event with ``lane`` in validation_error / success /
    retry / dlq and the validation ``errors`` array.
    """
    chk = V.with_errors(raw)
    bad = chk.withColumn("lane", F.lit("validation_error"))
    ok = V.valid_only(chk)
    routed = retry_route(ok, failed, key).withColumn("lane", F.col("route"))
    return routed, bad


def fanout_lanes(raw: DataFrame, failed: Column, key: str = "user_id") -> dict[str, DataFrame]:
    """The three output lanes (plus pending retries) of one input."""
    routed, bad = classify(raw, failed, key)
    success = (routed.filter(F.col("lane") == "success")
               .select("event_id", "user_id", "product_id", "timestamp_ms",
                       F.lit("SUCCESS").alias("status")))
    dlq = (routed.filter(F.col("lane") == "dlq")
           .select("event_id", "user_id", event_json().alias("original_event"),
                   F.concat(F.lit("model input out of range for "), F.col("product_id")).alias("error_message"),
                   F.lit("ScoringError").alias("error_type"), F.col("timestamp_ms").alias("timestamp"),
                   "retry_count"))
    retry = routed.filter(F.col("lane") == "retry").select("event_id", "user_id", "retry_count",
                                                           "delay_ms", "retry_at_ms")
    verr = V.validation_errors(bad.drop("lane"))
    return {"success": success, "validation_errors": verr, "dlq": dlq, "retry": retry}
