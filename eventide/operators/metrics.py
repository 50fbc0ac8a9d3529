"""Metric time series and alert rules (T1-T12, W11, P14's band table).

Metrics live in one long table ``(metric, labels map, series, ts_ms, value)``;
``series`` is the metric name with its sorted labels, the identity of one time
series. Range functions are window frames over a series ordered by time:

* increase over a range: the sum of the per-sample increases inside
  ``(t - range, t]``; a drop is a counter reset, so the new value is the
  increase (no extrapolation to the range edges, unlike the original engine);
* rate = increase / range seconds;
* ``for`` durations: islands of consecutive true samples; an island fires from
  its start + ``for`` when it lasts that long.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

HOUR_MS = 3600 * 1000
WEEK_MS = 7 * 24 * HOUR_MS
LE_BOUNDS = ["10", "20", "50", "100", "+Inf"]
MEM_TOTAL = 8589934592.0
MEM_PER_EVENT = 134217728.0
N_PARTITIONS = 3
N_INSTANCES = 2

# The eleven alert rules (name, metric, comparison, threshold,
# for-duration minutes, severity), in their original order.
ALERT_RULES = [
    ("HighKafkaLag", "kafka_consumergroup_lag", ">", 1000.0, 5, "critical"),
    ("KafkaUnderReplicatedPartitions", "kafka_topic_partition_under_replicated_partition", ">", 0.0, 2, "warning"),
    ("HighFlinkProcessingLatency", "flink_taskmanager_job_task_operator_currentEmitEventTimeLag", ">", 1000.0, 1, "warning"),
    ("FlinkCheckpointFailures", "increase:flink_jobmanager_job_numberOfFailedCheckpoints", ">", 0.0, 2, "critical"),
    ("FlinkTaskManagerDown", "up", "==", 0.0, 1, "critical"),
    ("FlinkBackpressure", "flink_taskmanager_job_task_backPressuredTimeMsPerSecond", ">", 500.0, 2, "warning"),
    ("HighMLInferenceLatency", "ml_inference_latency_p95", ">", 75.0, 5, "warning"),
    ("MLModelPredictionDrift", "data_drift_score", ">", 0.2, 10, "warning"),
    ("HighDLQRate", "rate:dlq_messages_total", ">", 0.1, 5, "warning"),
    ("HighMemoryUsage", "memory_used_pct", ">", 90.0, 5, "warning"),
    ("HighCPUUsage", "cpu_busy_pct", ">", 80.0, 5, "warning"),
]

# Dashboard bands (metric, bound, band); a value takes the band of
# the largest bound not above it. Throughput is reversed (red when low).
BANDS = [
    ("kafka_consumergroup_lag", 0.0, "green"), ("kafka_consumergroup_lag", 500.0, "yellow"),
    ("kafka_consumergroup_lag", 1000.0, "red"),
    ("ml_inference_latency_p95", 0.0, "green"), ("ml_inference_latency_p95", 50.0, "yellow"),
    ("ml_inference_latency_p95", 75.0, "red"),
    ("flink_taskmanager_job_task_backPressuredTimeMsPerSecond", 0.0, "green"),
    ("flink_taskmanager_job_task_backPressuredTimeMsPerSecond", 100.0, "yellow"),
    ("flink_taskmanager_job_task_backPressuredTimeMsPerSecond", 500.0, "red"),
    ("data_drift_score", 0.0, "green"), ("data_drift_score", 0.1, "yellow"), ("data_drift_score", 0.2, "red"),
    ("cpu_busy_pct", 0.0, "green"), ("cpu_busy_pct", 70.0, "yellow"), ("cpu_busy_pct", 90.0, "red"),
    ("memory_used_pct", 0.0, "green"), ("memory_used_pct", 70.0, "yellow"), ("memory_used_pct", 90.0, "red"),
    ("throughput_per_s", 0.0, "red"), ("throughput_per_s", 100.0, "yellow"), ("throughput_per_s", 500.0, "green"),
]


def hour_end(ts: str = "timestamp_ms") -> Column:
    return F.col(ts) - F.pmod(F.col(ts), F.lit(HOUR_MS)) + HOUR_MS


def series_name(metric: Column, labels: list[tuple[str, Column]]) -> Column:
    if not labels:
        return metric
    parts = []
    for i, (k, v) in enumerate(sorted(labels, key=lambda kv: kv[0])):
        parts += [F.lit(("," if i else "") + k + "="), v]
    return F.concat(metric, F.lit("{"), *parts, F.lit("}"))


def _sample(df: DataFrame, metric: str, labels: list[tuple[str, str]], value: Column) -> DataFrame:
    lab = [(k, F.col(c).cast("string")) for k, c in labels]
    mp = F.create_map(*[x for k, v in lab for x in (F.lit(k), v)]) if lab else \
        F.create_map().cast("map<string,string>")
    return df.select(F.lit(metric).alias("metric"), mp.alias("labels"),
                     series_name(F.lit(metric), lab).alias("series"), F.col("ts_ms"), value.cast("double").alias("value"))


def _counter(hourly: DataFrame, keys: list[str], inc: str) -> Column:
    """Cumulative value of an hourly increment, restarting every week (a process restart)."""
    w = (Window.partitionBy(*keys, F.floor(F.col("ts_ms") / WEEK_MS)).orderBy("ts_ms")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return F.sum(inc).over(w)


def metric_table(mon: DataFrame, verr: DataFrame, dlq: DataFrame) -> DataFrame:
    """The long metric table derived from monitored events and the error lanes.

    ``mon`` needs timestamp_ms, arrival_ms, latency_ms, event_type, event_id;
    ``verr`` sent_ms and field; ``dlq`` timestamp_ms. Every series is an
    hourly aggregate, so the table has (series x hours) rows however many
    events there are.
    """
    m = mon.withColumn("ts_ms", hour_end())
    # counters
    et = m.groupBy("event_type", "ts_ms").agg(F.count(F.lit(1)).alias("inc"))
    events_total = _sample(et, "events_total", [("event_type", "event_type")], _counter(et, ["event_type"], "inc"))
    ve = verr.withColumn("ts_ms", hour_end("sent_ms")).groupBy("field", "ts_ms").agg(F.count(F.lit(1)).alias("inc"))
    verr_total = _sample(ve, "validation_errors_total", [("field", "field")], _counter(ve, ["field"], "inc"))
    dq = dlq.withColumn("ts_ms", hour_end()).groupBy("ts_ms").agg(F.count(F.lit(1)).alias("inc"))
    dlq_total = _sample(dq, "dlq_messages_total", [], _counter(dq, [], "inc"))
    lat = F.col("latency_ms")
    hb = m.groupBy("ts_ms").agg(*[F.count_if(lat <= float(b)).alias("le_" + b) for b in LE_BOUNDS[:-1]],
                                F.count(F.lit(1)).alias("le_inf"), F.sum(lat).alias("lsum"))
    buckets = hb.select("ts_ms", F.explode(F.array(*[
        F.struct(F.lit(b).alias("le"), F.col("le_" + (b if b != "+Inf" else "inf")).alias("inc"))
        for b in LE_BOUNDS])).alias("x")).select("ts_ms", "x.le", "x.inc")
    bucket_total = _sample(buckets, "ml_latency_bucket", [("le", "le")], _counter(buckets, ["le"], "inc"))
    lsum = _sample(hb, "ml_latency_sum", [], _counter(hb, [], "lsum"))
    lcnt = _sample(hb, "ml_latency_count", [], _counter(hb, [], "le_inf"))
    # gauges
    part = m.withColumn("partition", F.col("event_id") % N_PARTITIONS)
    lag = part.groupBy("partition", "ts_ms").agg(F.count_if(F.col("arrival_ms") > F.col("ts_ms")).alias("v"))
    lag = lag.withColumn("consumergroup", F.lit("recs")).withColumn("topic", F.lit("user_events"))
    kafka_lag = _sample(lag, "kafka_consumergroup_lag",
                        [("consumergroup", "consumergroup"), ("partition", "partition"), ("topic", "topic")],
                        F.col("v"))
    hourly = m.groupBy("ts_ms").agg(
        F.max(F.col("arrival_ms") - F.col("timestamp_ms")).alias("emit_lag"),
        F.percentile(lat.cast("double"), 0.95).alias("p95"),
        *[F.count_if(F.col("event_id") % N_INSTANCES == i).alias(f"n{i}") for i in range(N_INSTANCES)],
        *[F.sum(F.when(F.col("event_id") % N_INSTANCES == i, lat)).alias(f"busy{i}") for i in range(N_INSTANCES)])
    emit = _sample(hourly.withColumn("operator_name", F.lit("score")),
                   "flink_taskmanager_job_task_operator_currentEmitEventTimeLag",
                   [("operator_name", "operator_name")], F.col("emit_lag"))
    p95 = _sample(hourly, "ml_inference_latency_p95", [], F.col("p95"))
    inst = hourly.select("ts_ms", F.explode(F.array(*[
        F.struct(F.lit(f"tm-{i}").alias("instance"), F.col(f"n{i}").alias("n"),
                 F.coalesce(F.col(f"busy{i}"), F.lit(0)).alias("busy_ms")) for i in range(N_INSTANCES)])).alias("x")
    ).select("ts_ms", "x.instance", "x.n", "x.busy_ms").withColumn("job", F.lit("flink"))
    up = _sample(inst, "up", [("instance", "instance"), ("job", "job")],
                 F.when(F.col("n") > 0, 1.0).otherwise(0.0))
    inst = inst.withColumn("idle_inc", F.lit(3600.0) - F.col("busy_ms") / 1000.0).withColumn("mode", F.lit("idle"))
    idle = _sample(inst, "node_cpu_seconds_total", [("instance", "instance"), ("mode", "mode")],
                   _counter(inst, ["instance"], "idle_inc"))
    mem_t = _sample(inst, "node_memory_MemTotal_bytes", [("instance", "instance")], F.lit(MEM_TOTAL))
    mem_a = _sample(inst, "node_memory_MemAvailable_bytes", [("instance", "instance")],
                    F.lit(MEM_TOTAL) - F.col("n") * MEM_PER_EVENT)
    out = events_total
    for x in (verr_total, dlq_total, bucket_total, lsum, lcnt, kafka_lag, emit, p95, up, idle, mem_t, mem_a):
        out = out.unionByName(x)
    return out


def operator_buckets(mon: DataFrame, job: str = "flink") -> DataFrame:
    """Latency bucket counters by job and operator (the load scenario that it serves)."""
    m = mon.withColumn("ts_ms", hour_end()).withColumnRenamed("load_scenario", "operator").withColumn("job", F.lit(job))
    lat = F.col("latency_ms")
    h = m.groupBy("ts_ms", "job", "operator").agg(*[F.count_if(lat <= float(b)).alias("le_" + b) for b in LE_BOUNDS[:-1]],
                                                  F.count(F.lit(1)).alias("le_inf"))
    x = h.select("ts_ms", "job", "operator", F.explode(F.array(*[
        F.struct(F.lit(b).alias("le"), F.col("le_" + (b if b != "+Inf" else "inf")).alias("inc")) for b in LE_BOUNDS])).alias("x"))
    x = x.select("ts_ms", "job", "operator", "x.le", "x.inc")
    return _sample(x, "operator_latency_bucket", [("job", "job"), ("le", "le"), ("operator", "operator")],
                   _counter(x, ["job", "operator", "le"], "inc"))


def drift_samples(daily: DataFrame, day_ms: int = 24 * HOUR_MS) -> DataFrame:
    """The daily drift score (D6: day_ms, drift_score) as samples at the day's end."""
    return _sample(daily.select((F.col("day_ms") + day_ms).alias("ts_ms"), "drift_score"), "data_drift_score", [], F.col("drift_score"))


# ---------------------------------------------------------------- range functions

def increase(metrics: DataFrame, range_ms: int) -> DataFrame:
    """Increase over ``range_ms`` at every sample of every series."""
    w = Window.partitionBy("series").orderBy("ts_ms")
    prev = F.lag("value").over(w)
    delta = F.when(prev.isNull(), F.lit(0.0)).when(F.col("value") < prev, F.col("value")).otherwise(
        F.col("value") - prev)
    rng = Window.partitionBy("series").orderBy("ts_ms").rangeBetween(-(range_ms - 1), 0)
    return (metrics.withColumn("_d", delta)
            .withColumn("increase", F.sum("_d").over(rng)).drop("_d"))


def rate(metrics: DataFrame, range_ms: int) -> DataFrame:
    """T4: per-second rate over ``range_ms``."""
    return increase(metrics, range_ms).withColumn("rate", F.col("increase") / (range_ms / 1000.0))


def latest(metrics: DataFrame) -> DataFrame:
    """Latest sample of each series (instant vector at the end)."""
    return metrics.groupBy("metric", "series").agg(
        F.max("ts_ms").alias("ts_ms"), F.max_by("value", "ts_ms").alias("value"),
        F.max_by("labels", "ts_ms").alias("labels"))


def threshold(metrics: DataFrame, metric: str, op: str, bound: float, matchers: tuple = ()) -> DataFrame:
    """Instant comparison on the latest sample of each series of ``metric``
    whose labels match (see :mod:`rules`)."""
    from .rules import Term
    lt = latest(metrics.filter(Term(metric, matchers).selects()))
    cond = {">": F.col("value") > bound, "==": F.col("value") == bound, "<": F.col("value") < bound}[op]
    return lt.withColumn("firing", cond)


def sum_by(metrics: DataFrame, metric: str, label: str) -> DataFrame:
    """T5: sum(metric) by (label) over the latest sample of each series."""
    lt = latest(metrics.filter(F.col("metric") == metric))
    return lt.groupBy(F.col("labels")[label].alias(label)).agg(F.sum("value").alias("value"))


def histogram_quantile(metrics: DataFrame, q: float, bucket_metric: str, range_ms: int, by: tuple[str, ...] = ()) -> DataFrame:
    """Quantile from cumulative buckets of sum(rate(bucket)) by (le, and the
    labels ``by``), at each time.

    rank = q * count(+Inf); the first bucket whose count reaches the rank is
    interpolated linearly from the previous bound (0 for the first bucket);
    a rank in +Inf returns the largest finite bound.
    """
    r = rate(metrics.filter(F.col("metric") == bucket_metric), range_ms)
    le = F.col("labels")["le"]
    per = r.groupBy("ts_ms", *(F.col("labels")[b].alias(b) for b in by), le.alias("le")).agg(F.sum("rate").alias("c"))
    group = ["ts_ms", *by]
    per = per.withColumn("bound", F.when(F.col("le") == "+Inf", F.lit(float("inf"))).otherwise(F.col("le").cast("double")))
    w, whole = Window.partitionBy(*group).orderBy("bound"), Window.partitionBy(*group)
    per = (per.withColumn("prev_bound", F.coalesce(F.lag("bound").over(w), F.lit(0.0)))
              .withColumn("prev_c", F.coalesce(F.lag("c").over(w), F.lit(0.0)))
              .withColumn("total", F.max(F.when(F.col("le") == "+Inf", F.col("c"))).over(whole))
              .withColumn("max_finite", F.max(F.when(F.col("le") != "+Inf", F.col("bound"))).over(whole))
              .withColumn("rank", F.col("total") * q))
    hit = per.filter((F.col("c") >= F.col("rank")) & (F.col("total") > 0))
    first = hit.groupBy(*group).agg(F.min_by(F.struct("bound", "prev_bound", "c", "prev_c", "rank", "max_finite"),
                                              "bound").alias("b"))
    val = F.when(F.col("b.bound") == float("inf"), F.col("b.max_finite")).otherwise(
        F.col("b.prev_bound") + (F.col("b.bound") - F.col("b.prev_bound"))
        * (F.col("b.rank") - F.col("b.prev_c")) / (F.col("b.c") - F.col("b.prev_c")))
    return first.select(*group, val.alias("quantile"))


def ratio_of_rates(metrics: DataFrame, num: str, den: str, range_ms: int) -> DataFrame:
    """rate(num) / rate(den) at each time (e.g. mean latency)."""
    r = rate(metrics.filter(F.col("metric").isin(num, den)), range_ms)
    p = r.groupBy("ts_ms").agg(F.sum(F.when(F.col("metric") == num, F.col("rate"))).alias("_n"),
                               F.sum(F.when(F.col("metric") == den, F.col("rate"))).alias("_d"))
    return p.select("ts_ms", F.when(F.col("_d") > 0, F.col("_n") / F.col("_d")).alias("value"))


def cpu_busy(metrics: DataFrame, range_ms: int) -> DataFrame:
    """100 - avg by (instance)(rate(idle seconds)) * 100, from the time on at
    which a series covers the whole range: before it the counter's rise is partial
    and an idle host would look busy."""
    idle = metrics.filter((F.col("metric") == "node_cpu_seconds_total") & (F.col("labels")["mode"] == "idle"))
    began = F.min("ts_ms").over(Window.partitionBy("series"))
    r = rate(idle, range_ms).withColumn("_t0", began).where(F.col("ts_ms") - F.col("_t0") >= range_ms)
    return (r.groupBy("ts_ms", F.col("labels")["instance"].alias("instance"))
             .agg((F.lit(100.0) - F.avg("rate") * 100).alias("value")))


def memory_used(metrics: DataFrame) -> DataFrame:
    """(total - available) / total * 100 per instance and time."""
    m = metrics.filter(F.col("metric").isin("node_memory_MemTotal_bytes", "node_memory_MemAvailable_bytes"))
    p = m.groupBy("ts_ms", F.col("labels")["instance"].alias("instance")).agg(
        F.max(F.when(F.col("metric") == "node_memory_MemTotal_bytes", F.col("value"))).alias("_t"),
        F.max(F.when(F.col("metric") == "node_memory_MemAvailable_bytes", F.col("value"))).alias("_a"))
    return p.select("ts_ms", "instance", ((F.col("_t") - F.col("_a")) / F.col("_t") * 100).alias("value"))


# ---------------------------------------------------------------- alerts

def rules_table(spark: SparkSession) -> DataFrame:
    schema = T.StructType([T.StructField("alert", T.StringType()), T.StructField("expr", T.StringType()),
                           T.StructField("op", T.StringType()), T.StructField("bound", T.DoubleType()),
                           T.StructField("for_min", T.IntegerType()), T.StructField("severity", T.StringType())])
    return spark.createDataFrame(ALERT_RULES, schema)


def rule_inputs(metrics: DataFrame, range_ms: int) -> DataFrame:
    """Every rule's input series as (expr, series, ts_ms, value)."""
    plain = metrics.select(F.col("metric").alias("expr"), "series", "ts_ms", "value")
    counters = metrics.filter(F.col("metric").isin("dlq_messages_total",
                                                   "flink_jobmanager_job_numberOfFailedCheckpoints"))
    inc = increase(counters, range_ms)
    incs = inc.select(F.concat(F.lit("increase:"), "metric").alias("expr"), "series", "ts_ms",
                      F.col("increase").alias("value"))
    rates = inc.select(F.concat(F.lit("rate:"), "metric").alias("expr"), "series", "ts_ms",
                       (F.col("increase") / (range_ms / 1000.0)).alias("value"))
    cpu = cpu_busy(metrics, range_ms).select(F.lit("cpu_busy_pct").alias("expr"),
                                             F.concat(F.lit("cpu{instance="), "instance", F.lit("}")).alias("series"),
                                             "ts_ms", "value")
    mem = memory_used(metrics).select(F.lit("memory_used_pct").alias("expr"),
                                      F.concat(F.lit("memory{instance="), "instance", F.lit("}")).alias("series"),
                                      "ts_ms", "value")
    return plain.unionByName(incs).unionByName(rates).unionByName(cpu).unionByName(mem)


def alert_for(cond: DataFrame, step_ms: int, key: list[str], for_ms: Column) -> DataFrame:
    """Islands of consecutive true samples (``step_ms`` apart) per ``key``;
    an island fires from start + for when it lasts at least that long. A false
    or null sample ends an island, however short the time between samples."""
    w = Window.partitionBy(*key).orderBy("ts_ms")
    t = cond.withColumn("cond", F.coalesce("cond", F.lit(False)))
    prev, was = F.lag("ts_ms").over(w), F.lag("cond").over(w)
    t = t.withColumn("_new", F.when(prev.isNull() | ~was | (F.col("ts_ms") - prev > step_ms), 1).otherwise(0))
    t = t.withColumn("_isl", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    t = t.filter(F.col("cond"))
    isl = t.groupBy(*key, "_isl").agg(F.min("ts_ms").alias("start_ms"), F.max("ts_ms").alias("end_ms"),
                                      F.first("_for").alias("_for"))
    return (isl.withColumn("fires_from_ms", F.col("start_ms") + F.col("_for"))
               .withColumn("fired", F.col("end_ms") >= F.col("fires_from_ms")).drop("_isl", "_for"))


def alerts(metrics: DataFrame, range_ms: int, step_ms: int = HOUR_MS) -> DataFrame:
    """All rules with severity and ``for`` -> alert intervals per series.
    The rule list is a fixed 11-row table, broadcast into the join."""
    rules = rules_table(metrics.sparkSession)
    inp = rule_inputs(metrics, range_ms).join(F.broadcast(rules), "expr")
    cond = (F.when(F.col("op") == ">", F.col("value") > F.col("bound"))
            .when(F.col("op") == "==", F.col("value") == F.col("bound"))
            .otherwise(F.col("value") < F.col("bound")))
    c = inp.withColumn("cond", cond).withColumn("_for", F.col("for_min").cast("long") * 60000)
    out = alert_for(c, step_ms, ["alert", "severity", "series"], F.col("_for"))
    return out


def bands(values: DataFrame, metric_col: str = "metric", value_col: str = "value") -> DataFrame:
    """Band of each panel value: the band of the largest bound <= value (a
    small fixed table joined on the metric name). The lowest band has no lower
    end; a null value or a metric without bands keeps its row with a null band."""
    spark = values.sparkSession
    b = spark.createDataFrame(BANDS, "bmetric string, bound double, band string")
    steps = b.groupBy("bmetric").agg(F.array_sort(F.collect_list(F.struct("bound", "band"))).alias("_steps"))  # one row a metric
    j = values.join(F.broadcast(steps), F.col(metric_col) == F.col("bmetric"), "left")
    reached = F.try_element_at(F.filter("_steps", lambda s: s["bound"] <= F.col(value_col)), F.lit(-1))["band"]
    lowest = F.when(F.col(value_col).isNotNull(), F.col("_steps")[0]["band"])
    return j.withColumn("band", F.coalesce(reached, lowest)).drop("bmetric", "_steps")
