"""The forest as arrays against the model's own transform; batches of distinct users;
neighbours and histories without a window over a user."""
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from eventide.operators import features as FE
from eventide.operators import forest as FO
from eventide.operators import score as SC
from eventide.operators import windows as WN


@pytest.fixture(scope="module")
def trained(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1200, 4)).round(2)
    y = ((x[:, 0] + x[:, 1] ** 2 > 0.8) ^ (rng.random(1200) < 0.1)).astype(float)
    rows = [(int(i), f"u{i % 90}", int(i * 7 % 1200), *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "event_id long, user_id string, timestamp_ms long, " + ", ".join(f"{c} double" for c in FE.FEATURES)
                               + ", target double")
    return SC.train_forest(df), df


def test_scores_equal_transform(spark, trained):
    model, df = trained
    forest = FO.Forest.of(model, spark)
    assert len(forest.roots) == SC.RF_TREES
    want = {r["event_id"]: r["score"] for r in SC.score_model(model, df).select("event_id", "score").collect()}
    got = {r["event_id"]: r["score"] for r in FO.score_forest(df, forest).select("event_id", "score").collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)
    # a value on a threshold goes left, as in the model
    edge = np.tile(np.median(forest.threshold[np.isfinite(forest.threshold)]), (1, 4))
    assert 0 <= forest.score(edge)[0] <= 1


def plain_batches(events, size):
    out, firsts = [], []
    for e in events:
        if e[0] not in [f[0] for f in firsts]:
            firsts.append(e)
        if len(firsts) == size:
            out.append(firsts)
            firsts = []
    return out + ([firsts] if firsts else [])


@pytest.mark.parametrize("size", [1, 3, 32])
def test_batches_of_distinct_users(size):
    rng = random.Random(size)
    events = [(rng.choice("abcdefgh") if size < 32 else f"u{rng.randrange(60)}", i) for i in range(400)]
    got = list(FO.user_batches(events, size))
    assert [f for _, f, _ in got] == plain_batches(events, size)
    assert sum(sum(n) for _, _, n in got) == len(events) and [k for k, _, _ in got] == list(range(len(got)))
    assert all(len(f) == size and len({u for u, _ in f}) == size for _, f, _ in got[:-1])


def test_scoring_in_batches(spark, trained):
    model, df = trained
    forest = FO.Forest.of(model, spark)
    rows = FO.score_user_batches(df, forest, 32, 3).collect()
    want = {r["event_id"]: r["score"] for r in SC.score_model(model, df).select("event_id", "score").collect()}
    assert all(abs(r["score"] - want[r["event_id"]]) < 1e-12 for r in rows) and sum(r["n_events"] for r in rows) == df.count()
    sizes = {}
    for r in rows:
        sizes.setdefault(r["shard"], {}).setdefault(r["batch"], []).append(r["user_id"])
    for batches in sizes.values():
        assert all(len(batches[k]) == len(set(batches[k])) == 32 for k in range(max(batches)))
    assert FO.score_user_batches(df.limit(0), forest).count() == 0


def keyed_rows(spark, seed):
    rng = random.Random(seed)
    rows, t = [], 0
    for i in range(300):
        t += rng.choice([0, 0, 1, 30, 500, 5000])
        rows.append((rng.choice(["hot", "hot", "hot", "a", None]), i, None if rng.random() < 0.02 else t, rng.choice(["view", "purchase"])))
    return spark.createDataFrame(rows, "user_id string, event_id long, timestamp_ms long, event_type string")


@pytest.mark.parametrize("width", [None, 1, 100, 10**9])
def test_next_row_equals_the_plain_window(spark, width):
    df = keyed_rows(spark, 4)
    w = Window.partitionBy("user_id").orderBy("timestamp_ms", "event_id")
    want = df.select(*df.columns, F.lead("event_id").over(w).alias("next_event_id"), F.lead("event_type").over(w).alias("next_event_type"))
    got = WN.keyed_next(df, ["event_id", "event_type"], range_ms=width)
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("width", [None, 1, 700])
def test_history_of_any_length_equals_the_window_form(spark, width):
    df = keyed_rows(spark, 9).where("timestamp_ms is not null")
    as_of = df.agg(F.max("timestamp_ms")).first()[0] + 100
    for ttl in (400, 501, 5000, 10**9):
        want = FE.history_as_of(df, as_of, limit=10**9, ttl_ms=ttl).select("user_id", "event_id")
        got = FE.unexpired_history(df, as_of, ttl, range_ms=width).select("user_id", "event_id")
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_no_window_spans_a_user(spark):
    df = keyed_rows(spark, 2)
    plans = [SC.label_next_purchase(df, 1000, range_ms=50), FE.unexpired_history(df, 10**6, 1000, range_ms=50)]
    for p in plans:
        text = p._jdf.queryExecution().optimizedPlan().toString()
        for line in text.splitlines():
            if "Window [" in line and "event_id#" in line.split("windowspecdefinition", 1)[1]:
                assert "_rng#" in line.split("windowspecdefinition", 1)[1].split("ASC")[0]
