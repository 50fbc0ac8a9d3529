"""Two-level quantiles and distribution functions against the plain forms; sketch errors."""
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from eventide.operators import drift as DR
from eventide.operators import quantiles as Q

QS = [0.0, 0.1, 0.25, 0.5, 0.95, 0.99, 1.0]


def sample(spark, seed, n=3000):
    rng = random.Random(seed)
    kinds = {"ties": lambda: float(rng.randrange(5)), "wide": lambda: rng.gauss(0, 1e6), "one": lambda: 7.0,
             None: lambda: rng.random(), "hot": lambda: round(rng.expovariate(0.01), 1)}
    names = list(kinds) + ["hot"] * 6
    rows = [(k := rng.choice(names), None if rng.random() < 0.05 else kinds[k]()) for _ in range(n)]
    return rows + [("empty", None)], spark.createDataFrame(rows + [("empty", None)], "g string, value double")


@pytest.mark.parametrize("seed,ranges", [(0, 64), (1, 3), (2, 1)])
def test_quantiles_equal_the_plain_form(spark, seed, ranges):
    rows, df = sample(spark, seed)
    got = {r["g"]: r["quantiles"] for r in Q.exact_quantiles(df, ["g"], "value", QS, ranges).collect()}
    groups = {g for g, v in rows if v is not None}
    assert set(got) == groups
    for g in groups:
        assert np.allclose(got[g], np.quantile([v for h, v in rows if h == g and v is not None], QS), rtol=1e-12, atol=1e-12)


@pytest.mark.parametrize("ranges", [64, 4, 1])
def test_running_sums_equal_a_whole_window(spark, ranges):
    _, df = sample(spark, 5)
    counts = Q.value_counts(df, ["g"], "value").withColumn("m", F.col("n") * 2)
    w = Window.partitionBy("g").orderBy("value")
    want = counts.select("g", "value", F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum_n"),
                         F.sum("m").over(Window.partitionBy("g")).alias("tot_m"), F.lead("value").over(w).alias("next_value"))
    got = Q.running_sums(counts, ["g"], "value", ["n", "m"], ranges).select(*want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_no_task_orders_a_whole_column(spark):
    """Every window over values is partitioned by a range of them, too."""
    _, df = sample(spark, 6, 200)
    long = df.withColumnRenamed("g", "column")
    plan = DR.ks(long, long)._jdf.queryExecution().optimizedPlan().toString()
    over_values = [line for line in plan.splitlines() if "Window [" in line and "value#" in line.split("windowspecdefinition")[1]]
    assert over_values and all("_range#" in line.split("windowspecdefinition")[1].split("value#")[0] for line in over_values)


def test_distances_of_shifted_samples(spark):
    rng = np.random.default_rng(3)
    ref, cur = rng.normal(size=800).round(2), rng.normal(0.5, 1, 500).round(2)
    frame = lambda v: spark.createDataFrame([("x", float(a)) for a in v], "column string, value double")
    at = np.unique(np.concatenate((ref, cur)))
    gaps = np.abs(np.searchsorted(np.sort(ref), at, "right") / 800 - np.searchsorted(np.sort(cur), at, "right") / 500)
    assert DR.ks(frame(ref), frame(cur)).first()["ks"] == pytest.approx(gaps.max())
    assert DR.wasserstein(frame(ref), frame(cur)).first()["wasserstein"] == pytest.approx((gaps[:-1] * np.diff(at)).sum())


def test_merged_sketches_keep_the_stated_error(spark):
    rng = np.random.default_rng(8)
    v = rng.lognormal(size=60000)
    df = spark.createDataFrame([(int(i % 24), float(x)) for i, x in enumerate(v)], "hour int, value double")
    parts = Q.sketches(df, ["hour"], "value")
    got = Q.sketch_quantiles(Q.merged(parts.withColumn("day", F.lit(1)), ["day"]), QS).first()["quantiles"]
    ranks = np.searchsorted(np.sort(v), got) / len(v)
    assert np.abs(ranks - np.array(QS)).max() <= 2 * Q.rank_error()
    assert max(len(r["sketch"]) for r in parts.collect()) < 20_000
