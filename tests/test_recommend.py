"""Top items by factors: exact against all pairs, hashed buckets by recall, ids by table."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from eventide.operators import recommend as RC


def factors(spark, n, rank, seed, scale=1.0):
    x = np.random.default_rng(seed).normal(size=(n, rank)).astype(np.float32)
    x *= np.float32(scale) ** np.random.default_rng(seed + 1).random((n, 1)).astype(np.float32)
    return x, spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id int, features array<float>")


def test_exact_top_items(spark):
    u, users = factors(spark, 90, 8, 1)
    i, items = factors(spark, 300, 8, 2)
    got = {}
    for r in RC.exact_topk(users, items, 5).collect():
        got.setdefault(r["u"], []).append((-r["score"], r["i"]))
    want = np.argsort(-(u @ i.T), axis=1, kind="stable")[:, :5]
    assert {k: [x for _, x in sorted(v)] for k, v in got.items()} == {k: w.tolist() for k, w in enumerate(want)}
    few = RC.exact_topk(users, items.limit(3), 5).groupBy("u").count().collect()
    assert {r["count"] for r in few} == {3} and RC.exact_topk(users, items.limit(0), 5).count() == 0


@pytest.mark.parametrize("scale", [1.0, 5.0])
def test_recall_of_hashed_buckets(spark, scale):
    """Every item is indexed; nine in ten of the true top items are found, also where norms differ."""
    u, users = factors(spark, 120, 8, 3)
    i, items = factors(spark, 2000, 8, 4, scale)
    rows = RC.hashed_topk(users, items, 10).collect()
    found = {}
    for r in rows:
        found.setdefault(r["u"], set()).add(r["i"])
        assert r["score"] == pytest.approx(float(u[r["u"]] @ i[r["i"]]), abs=1e-4)
    true = np.argsort(-(u @ i.T), axis=1)[:, :10]
    assert np.mean([len(found[k] & set(t.tolist())) / 10 for k, t in enumerate(true)]) >= 0.9
    assert all(len(v) == 10 for v in found.values())


def test_numbers_without_gaps_and_ids_by_table(spark):
    df = spark.createDataFrame([(f"{c}_1", f"{p}_7") for c in "abc" for p in "xy" for _ in range(2)] + [(None, "x_7"), ("a_1", None)],
                               "user_id string, product_id string")
    got = RC.numbered(df, "user_id", "n").collect()
    assert sorted(r["n"] for r in got) == [0, 1, 2] and {r["user_id"] for r in got} == {"a_1", "b_1", "c_1"}
    recs = RC.als_topk(df, 2).collect()
    assert {r["user_id"] for r in recs} == {"a_1", "b_1", "c_1"} and {r["product_id"] for r in recs} == {"x_7", "y_7"}


def test_same_lists_as_the_model_s_own(spark):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(f"u{rng.integers(40)}", f"p{rng.integers(30)}") for _ in range(1500)], "user_id string, product_id string")
    both = [{(r["user_id"], r["rank"]): r["score"] for r in RC.als_topk(df, 4, send_bytes=b).collect()} for b in (1 << 20,)]
    assert len(both[0]) == 160
    hashed = RC.als_topk(df, 4, send_bytes=0).groupBy("user_id").agg(F.count("*").alias("n"))
    assert hashed.count() == 40
