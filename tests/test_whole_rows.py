"""Rows with null keys or times, repeated ids, values outside the listed ranges: none gets lost."""

from pyspark.sql import functions as F

from eventide.operators import features as FE
from eventide.operators import lanes as LN
from eventide.operators import metrics as MT
from eventide.operators import recommend as RE
from eventide.operators import score as SC
from eventide.operators import slo as SL
from eventide.operators import windows as WN

EVENT = "event_id long, user_id string, product_id string, category string, event_type string, timestamp_ms long"


def _events(spark, rows):
    return spark.createDataFrame([(i, u, f"product_{i % 3}", c, e, t) for i, (u, c, e, t) in enumerate(rows)], EVENT)


def _nulls(spark):
    return _events(spark, [("a", "books", "view", 0), (None, "books", "error", 70_000), (None, None, "view", 5),
                           ("a", "books", "error", None), (None, "books", "view", None), ("a", "home", "view", 200_000)])


def test_running_count_keeps_null_keys_and_times(spark):
    got = {r.event_id: r.event_count for r in FE.running_count(_nulls(spark)).collect()}
    assert got == {3: 1, 0: 2, 5: 3, 4: 1, 2: 2, 1: 3}


def test_keyed_order_keeps_null_keys_and_times(spark):
    got = {r.event_id: (r._pos, r._sess) for r in WN.keyed_order(_nulls(spark), gap_ms=100_000).collect()}
    assert got == {3: (1, 1), 0: (2, 2), 5: (3, 3), 4: (1, 1), 2: (2, 2), 1: (3, 2)}


def test_retry_route_keeps_null_keys_and_times(spark):
    got = {r.event_id: (r.route, r.retry_at_ms) for r in LN.retry_route(_nulls(spark), F.col("event_type") == "error").collect()}
    assert got == {0: ("success", None), 1: ("retry", 71_000), 2: ("success", None), 3: ("retry", None),
                   4: ("success", None), 5: ("success", None)}


def test_cache_hits_one_row_a_delivery(spark):
    ev = _nulls(spark)
    got = sorted((r.event_id, r.cache_hit) for r in SC.cache_hits(ev.union(ev.where("event_id = 0")), 100_000).collect())
    assert got == [(0, False), (0, False), (1, True), (2, False), (3, False), (4, False), (5, False)]


def test_history_cut_at_100(spark):
    ev = _events(spark, [("a", "books", "view", i) for i in range(130)])
    assert sorted(r.event_id for r in FE.last_n(ev, 100).collect()) == list(range(30, 130))


def test_late_check_without_rows_has_no_verdict(spark):
    none = spark.createDataFrame([], "is_late boolean")
    assert SL.late_check(none).first().passed is None


def test_bands_keep_every_value(spark):
    rows = [("cpu_busy_pct", v) for v in (-5.0, 0.0, 75.0, None)] + [("unknown", 1.0)]
    got = {(r.metric, r.value): r.band for r in MT.bands(spark.createDataFrame(rows, "metric string, value double")).collect()}
    assert got == {("cpu_busy_pct", -5.0): "green", ("cpu_busy_pct", 0.0): "green", ("cpu_busy_pct", 75.0): "yellow",
                   ("cpu_busy_pct", None): None, ("unknown", 1.0): None}


def test_false_sample_ends_an_alert(spark):
    rows = [(i * 15_000, i % 2 == 0) for i in range(60)]
    c = (spark.createDataFrame(rows, "ts_ms long, cond boolean").withColumn("k", F.lit(1))
         .withColumn("_for", F.lit(5 * 60_000).cast("long")))
    got = MT.alert_for(c, 60_000, ["k"], F.col("_for")).collect()
    assert len(got) == 30 and not any(r.fired for r in got)


def test_cold_start_without_popularity_takes_the_overall_list(spark):
    ev = _events(spark, [("a", "books", "view", 0), ("a", "books", "view", 1), ("a", "books", "view", 2), ("a", "books", "view", 3),
                         ("new", "garden", "view", 100), ("nil", None, "view", 100), ("old", "books", "view", 100)])
    got = sorted((r.user_id, r["rank"], r.product_id, r.n) for r in RE.cold_start(ev, 50, k=2).collect())
    top = [(1, "product_0", 2), (2, "product_1", 1)]
    assert got == [(u, *t) for u in ("new", "nil", "old") for t in top]


def test_idle_host_is_not_busy_at_its_start(spark):
    rows = [(h * 3_600_000, 3600.0 * h) for h in range(1, 13)]
    m = spark.createDataFrame(rows, "ts_ms long, value double").select(
        F.lit("node_cpu_seconds_total").alias("metric"), F.lit("s").alias("series"), "ts_ms", "value",
        F.create_map(F.lit("mode"), F.lit("idle"), F.lit("instance"), F.lit("a")).alias("labels"))
    got = MT.cpu_busy(m, 6 * 3_600_000).collect()
    assert len(got) == 6 and all(abs(r.value) < 1e-9 for r in got)
