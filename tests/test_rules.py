"""Rules and panels: matchers, groups, covered ranges, runs of true samples, bands."""
import pytest
from pyspark.sql import functions as F

from eventide.operators import metrics as MT
from eventide.operators import rules as R

H = R.HOUR_MS


def samples(spark, rows):
    """Rows of (metric, labels, hour, value)."""
    name = lambda m, d: m + "{" + ",".join(f"{k}={v}" for k, v in sorted(d.items())) + "}"
    return spark.createDataFrame([(m, d, name(m, d), h * H, float(v)) for m, d, h, v in rows],
                                 "metric string, labels map<string,string>, series string, ts_ms long, value double")


def test_selectors_leave_foreign_jobs_alone(spark):
    s = samples(spark, [("up", {"job": j, "instance": i}, h, v) for j, i, v in
                        (("flink", "a", 0), ("flink", "b", 1), ("kafka", "a", 0), ("flink-old", "c", 0)) for h in (1, 2)] + [("up", {}, 1, 0)])
    got = {(r["alert"], r["labels"]) for r in R.alert_intervals(s, 6 * H).collect()}
    assert got == {("FlinkTaskManagerDown", "instance=a,job=flink")}
    now = MT.threshold(s, "up", "==", 0.0, (("job", "=", "flink"),)).where("firing")
    assert [r["series"] for r in now.collect()] == ["up{instance=a,job=flink}"]


@pytest.mark.parametrize("matcher,want", [(("job", "=", "a"), {"a"}), (("job", "!=", "a"), {"b", "ab", ""}), (("job", "=~", "a|b"), {"a", "b"}),
                                          (("job", "!~", "a.*"), {"b", ""}), (("job", "=", ""), {""})])
def test_matchers(spark, matcher, want):
    s = samples(spark, [("m", {"job": j} if j else {}, 1, 1) for j in ("a", "b", "ab", "")] + [("other", {"job": "a"}, 1, 1)])
    hits = s.where(R.Term("m", (matcher,)).selects()).collect()
    assert {r["labels"].get("job", "") for r in hits} == want


def test_rates_divide_by_covered_time(spark):
    """A counter of 1800 a sampled hour is busy half of the time, gaps or not; the
    first sample and a lone sample have no rate; a reset counts the new value."""
    hours = [0, 1, 2, 9, 10, 30]
    rows = [("c", {"instance": "x"}, h, 1800.0 * (k + 1)) for k, h in enumerate(hours)]
    rows += [("c", {"instance": "y"}, 5, 7.0)] + [("c", {"instance": "z"}, h, v) for h, v in ((0, 100), (1, 3700), (2, 360))]
    rule = (R.Rule("r", (R.Term("c", take="rate"),), by=("instance",)),)
    got = {(r["labels"], r["ts_ms"] // H): r["value"] for r in R.evaluate(samples(spark, rows), rule, 6 * H).collect()}
    assert got == {("instance=x", h): 0.5 for h in (1, 2, 9, 10, 30)} | {("instance=z", 1): 1.0, ("instance=z", 2): pytest.approx((3600 + 360) / 7200)}


def test_terms_meet_by_label_and_groups_are_put_together(spark):
    mem = [("node_memory_MemTotal_bytes", {"instance": i}, 1, t) for i, t in (("a", 100), ("b", 200), ("c", 50))]
    mem += [("node_memory_MemAvailable_bytes", {"instance": i}, 1, f) for i, f in (("a", 5), ("b", 150))]
    idle = [("node_cpu_seconds_total", {"instance": "a", "cpu": c, "mode": m}, h, v * h) for c, v in (("0", 360.0), ("1", 720.0))
            for m in ("idle", "user") for h in (1, 2)]
    got = {(r["rule"], r["labels"]): r["value"] for r in R.evaluate(samples(spark, mem + idle), R.RULES, 6 * H).collect()}
    assert got == {("HighMemoryUsage", "instance=a"): pytest.approx(95.0), ("HighMemoryUsage", "instance=b"): pytest.approx(25.0),
                   ("HighCPUUsage", "instance=a"): pytest.approx(100 - 15.0)}
    by_none = (R.Rule("t", (R.Term("node_memory_MemTotal_bytes"),), by=(), aggregate="sum"),)
    assert [(r["labels"], r["value"]) for r in R.evaluate(samples(spark, mem), by_none, H).collect()] == [("", 350.0)]


def test_runs_of_true_samples(spark):
    s = samples(spark, [("kafka_consumergroup_lag", {"partition": "0"}, h, v) for h, v in ((1, 2000), (2, 1500), (3, 10), (4, 1001), (9, 5000))])
    got = [tuple(r) for r in R.alert_intervals(s, 6 * H).select("alert", "start_ms", "end_ms", "fired").orderBy("start_ms").collect()]
    assert got == [("HighKafkaLag", H, 2 * H, True), ("HighKafkaLag", 4 * H, 4 * H, False), ("HighKafkaLag", 9 * H, 9 * H, False)]


def test_every_rule_and_panel_can_fire(spark):
    rows = []
    for r in R.RULES + R.PANELS:
        for t in r.terms:
            labels = {label: v for label, _, v in t.matchers} | {"instance": "i"}
            rows += [(t.metric, labels, h, v) for h, v in ((1, 0.0), (2, 0.0 if r.op == "==" else 9000.0))]
    rows = [x for x in rows if x[0] not in ("node_memory_MemAvailable_bytes", "node_cpu_seconds_total")]
    rows += [("node_memory_MemAvailable_bytes", {"instance": "i"}, h, 1.0) for h in (1, 2)]
    rows += [("node_cpu_seconds_total", {"instance": "i", "mode": "idle"}, h, 5.0 * h) for h in (1, 2)]
    s = samples(spark, [(m, dict(d), h, v) for m, d, h, v in sorted({(m, tuple(sorted(d.items())), h, v) for m, d, h, v in rows})])
    assert {r["alert"] for r in R.alert_intervals(s, 6 * H).collect()} == {r.name for r in R.RULES}
    bands = {r["metric"]: r["band"] for r in MT.bands(R.panel_values(s, 6 * H)).collect()}
    assert set(bands) == {p.name for p in R.PANELS} and None not in bands.values()


def test_one_scan_of_the_samples(spark, scratch):
    samples(spark, [("up", {"job": "flink"}, 1, 0)]).write.parquet(f"{scratch}/s")
    plan = R.alert_intervals(spark.read.parquet(f"{scratch}/s"), 6 * H)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_bands_keep_repeated_rows(spark):
    v = spark.createDataFrame([("data_drift_score", 0.15)] * 3 + [("data_drift_score", None), ("x", 1.0), ("throughput_per_s", -1.0)],
                              "metric string, value double")
    got = sorted((r["metric"], r["value"] or 0, r["band"] or "") for r in MT.bands(v).collect())
    assert got == [("data_drift_score", 0, "")] + [("data_drift_score", 0.15, "yellow")] * 3 + [("throughput_per_s", -1.0, "red"), ("x", 1.0, "")]


def test_quantiles_by_labels(spark):
    rows = [("b", {"le": le, "operator": o}, h, c * h) for o, cs in (("p", (10, 90, 100)), ("q", (95, 99, 100)))
            for le, c in zip(("10", "20", "+Inf"), cs) for h in (1, 2)]
    got = {r["operator"]: r["quantile"] for r in MT.histogram_quantile(samples(spark, rows), 0.5, "b", 6 * H, ("operator",)).where(
        F.col("ts_ms") == 2 * H).collect()}
    assert got == {"p": pytest.approx(10 + 10 * 40 / 80), "q": pytest.approx(10 * 50 / 95)}
