"""Alert rules and panels as data, evaluated in one pass.

A rule names the series it reads (metric and label matchers), what it takes of them
(the value, the increase or the per-second rate over a range), the labels it groups
by, and how the terms make one value. All rules go over the metric table together:
range functions are computed once a series, each sample is dealt to the rules that
select it, and one aggregate makes every rule's values.

Ranges know their coverage: a rate divides by the time that samples cover, not by
the whole range, so hours without samples count for nothing (they are no idle time
and no busy time), and a series without a covered step in the range has no rate.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .metrics import HOUR_MS, alert_for

#: How a label is matched; patterns match the whole label. A missing label counts as "".
MATCHERS: dict[str, Callable[[Column, str], Column]] = {
    "=": lambda c, v: c == v, "!=": lambda c, v: c != v,
    "=~": lambda c, v: c.rlike(f"^(?:{v})$"), "!~": lambda c, v: ~c.rlike(f"^(?:{v})$")}
COMPARISONS: dict[str, Callable[[Column, float], Column]] = {
    ">": lambda c, v: c > v, "<": lambda c, v: c < v, "==": lambda c, v: c == v, ">=": lambda c, v: c >= v, "<=": lambda c, v: c <= v}


@dataclass(frozen=True)
class Term:
    """Series of one metric: those with the given labels; the sample's value, or
    its increase or rate over the range."""

    metric: str
    matchers: tuple[tuple[str, str, str], ...] = ()
    take: str = "value"  # or increase, rate

    def selects(self) -> Column:
        on = F.col("metric") == self.metric
        for label, op, v in self.matchers:
            on = on & MATCHERS[op](F.coalesce(F.col("labels")[label], F.lit("")), v)
        return on


@dataclass(frozen=True)
class Rule:
    """A value for each group of labels and time. ``by`` None keeps all labels of a
    series; else samples that share these labels are put together by ``aggregate``."""

    name: str
    terms: tuple[Term, ...]
    op: str = ">"
    bound: float = 0.0
    for_min: int = 0
    severity: str = ""
    by: tuple[str, ...] | None = None
    aggregate: str = "avg"
    value: Callable[..., Column] = lambda x: x


_HOST = ("instance",)
_MEMORY = (Term("node_memory_MemTotal_bytes"), Term("node_memory_MemAvailable_bytes"))
_IDLE = (Term("node_cpu_seconds_total", (("mode", "=", "idle"),), "rate"),)
_USED = lambda total, free: F.when(total != 0, (total - free) / total * 100)
_BUSY = lambda idle: F.lit(100.0) - idle * 100

# The eleven alert rules in their original order (name, series, comparison, bound, minutes, severity).
RULES = (
    Rule("HighKafkaLag", (Term("kafka_consumergroup_lag"),), ">", 1000.0, 5, "critical"),
    Rule("KafkaUnderReplicatedPartitions", (Term("kafka_topic_partition_under_replicated_partition"),), ">", 0.0, 2, "warning"),
    Rule("HighFlinkProcessingLatency", (Term("flink_taskmanager_job_task_operator_currentEmitEventTimeLag"),), ">", 1000.0, 1, "warning"),
    Rule("FlinkCheckpointFailures", (Term("flink_jobmanager_job_numberOfFailedCheckpoints", take="increase"),), ">", 0.0, 2, "critical"),
    Rule("FlinkTaskManagerDown", (Term("up", (("job", "=", "flink"),)),), "==", 0.0, 1, "critical"),
    Rule("FlinkBackpressure", (Term("flink_taskmanager_job_task_backPressuredTimeMsPerSecond"),), ">", 500.0, 2, "warning"),
    Rule("HighMLInferenceLatency", (Term("ml_inference_latency_p95"),), ">", 75.0, 5, "warning"),
    Rule("MLModelPredictionDrift", (Term("data_drift_score"),), ">", 0.2, 10, "warning"),
    Rule("HighDLQRate", (Term("dlq_messages_total", take="rate"),), ">", 0.1, 5, "warning"),
    Rule("HighMemoryUsage", _MEMORY, ">", 90.0, 5, "warning", _HOST, value=_USED),
    Rule("HighCPUUsage", _IDLE, ">", 80.0, 5, "warning", _HOST, value=_BUSY),
)

#: The dashboard's panels: what each band table's value is.
PANELS = (
    Rule("kafka_consumergroup_lag", (Term("kafka_consumergroup_lag"),)),
    Rule("ml_inference_latency_p95", (Term("ml_inference_latency_p95"),)),
    Rule("flink_taskmanager_job_task_backPressuredTimeMsPerSecond", (Term("flink_taskmanager_job_task_backPressuredTimeMsPerSecond"),)),
    Rule("data_drift_score", (Term("data_drift_score"),)),
    Rule("cpu_busy_pct", _IDLE, by=_HOST, value=_BUSY),
    Rule("memory_used_pct", _MEMORY, by=_HOST, value=_USED),
    Rule("throughput_per_s", (Term("events_total", take="rate"),), by=(), aggregate="sum"),
)


def with_ranges(samples: DataFrame, range_ms: int, step_ms: int) -> DataFrame:
    """Adds ``increase`` and ``rate`` over (t - range, t] of every series. A drop is
    a counter reset. The covered time is that of steps between samples, ``step_ms``
    each at most."""
    order = Window.partitionBy("series").orderBy("ts_ms")
    before, at = F.lag("value").over(order), F.lag("ts_ms").over(order)
    rise = F.when(before.isNull(), 0.0).when(F.col("value") < before, F.col("value")).otherwise(F.col("value") - before)
    span = order.rangeBetween(-(range_ms - 1), 0)
    s = samples.withColumn("_rise", rise).withColumn("_covered", F.when(at.isNull(), 0).otherwise(F.least(F.col("ts_ms") - at, F.lit(step_ms))))
    s = s.withColumn("increase", F.sum("_rise").over(span)).withColumn("_covered", F.sum("_covered").over(span))
    return s.withColumn("rate", F.when(F.col("_covered") > 0, F.col("increase") * 1000.0 / F.col("_covered"))).drop("_rise", "_covered")


def _labels(by: tuple[str, ...] | None) -> Column:
    """label=value of the kept labels, by name."""
    kept = F.col("labels") if by is None else F.map_filter("labels", lambda k, _: k.isin(*by) if by else F.lit(False))
    return F.array_join(F.transform(F.array_sort(F.map_entries(kept)), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")


def evaluate(samples: DataFrame, rules: tuple[Rule, ...], range_ms: int, step_ms: int = HOUR_MS) -> DataFrame:
    """(rule, labels, ts_ms, value) of all rules, one scan of ``samples`` (metric,
    labels, series, ts_ms, value). A group without a value for a term has none."""
    s = with_ranges(samples, range_ms, step_ms)
    hits = [F.when(t.selects(), F.struct(F.lit(k).alias("rule"), F.lit(j).alias("term"), F.col(t.take).alias("x"), _labels(r.by).alias("labels")))
            for k, r in enumerate(rules) for j, t in enumerate(r.terms)]
    dealt = (s.select("ts_ms", F.explode(F.array_compact(F.array(*hits))).alias("h")).select("ts_ms", "h.*")
             .where(F.col("x").isNotNull()))
    terms = range(max(len(r.terms) for r in rules))
    own = [F.when(F.col("term") == j, F.col("x")) for j in terms]
    made = dealt.groupBy("rule", "labels", "ts_ms").agg(*(f(own[j]).alias(f"{n}{j}") for j in terms
                                                          for n, f in (("avg", F.avg), ("sum", F.sum), ("max", F.max), ("min", F.min))))
    value, name = F.lit(None).cast("double"), F.lit(None).cast("string")
    for k, r in enumerate(rules):
        here = F.col("rule") == k
        value = F.when(here, r.value(*(F.col(f"{r.aggregate}{j}") for j in range(len(r.terms))))).otherwise(value)
        name = F.when(here, F.lit(r.name)).otherwise(name)
    return made.select(F.col("rule").alias("_rule"), name.alias("rule"), "labels", "ts_ms", value.alias("value")).where(F.col("value").isNotNull())


def alert_intervals(samples: DataFrame, range_ms: int, rules: tuple[Rule, ...] = RULES, step_ms: int = HOUR_MS) -> DataFrame:
    """(alert, severity, labels, start_ms, end_ms, fires_from_ms, fired) of
    every run of true samples."""
    v = evaluate(samples, rules, range_ms, step_ms)
    cond, severity, wait = F.lit(None).cast("boolean"), F.lit(None).cast("string"), F.lit(None).cast("bigint")
    for k, r in enumerate(rules):
        here = F.col("_rule") == k
        cond = F.when(here, COMPARISONS[r.op](F.col("value"), r.bound)).otherwise(cond)
        severity = F.when(here, F.lit(r.severity)).otherwise(severity)
        wait = F.when(here, F.lit(r.for_min * 60000)).otherwise(wait)
    c = v.select(F.col("rule").alias("alert"), severity.alias("severity"), "labels", "ts_ms", cond.alias("cond"), wait.alias("_for"))
    return alert_for(c, step_ms, ["alert", "severity", "labels"], F.col("_for"))


def panel_values(samples: DataFrame, range_ms: int, panels: tuple[Rule, ...] = PANELS, step_ms: int = HOUR_MS) -> DataFrame:
    """(metric, labels, value): each panel's latest value by group."""
    v = evaluate(samples, panels, range_ms, step_ms)
    return v.groupBy(F.col("rule").alias("metric"), "labels").agg(F.max_by("value", "ts_ms").alias("value"))
