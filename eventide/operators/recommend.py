"""Popularity, cold start, click-through and collaborative recommendations."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir

TOP_K = 10
NUMBER_BUCKETS = 256
#: Largest item matrix that is sent to every task.
SEND_BYTES = 32 << 20


def top_items(events: DataFrame, k: int = TOP_K, by: str = "category",
              item: str = "product_id") -> DataFrame:
    """K1: the ``k`` most frequent items per group (ties: lower item id first).
    ``row_number() <= k`` runs as a window group limit, so each map partition
    sends at most ``k`` rows per group to the shuffle."""
    pop = events.groupBy(by, item).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(by).orderBy(F.col("n").desc(), F.col(item).asc())
    return pop.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def cold_start(events: DataFrame, as_of_ms: int, k: int = TOP_K, key: str = "user_id") -> DataFrame:
    """Users without any event before ``as_of`` get the top-``k`` items of
    the category of their first later event, popularity counted before ``as_of``.
    A category without earlier events (or null) takes the overall top list."""
    before = events.filter(F.col("timestamp_ms") < as_of_ms)
    after = events.filter(F.col("timestamp_ms") >= as_of_ms)
    cold = after.join(before.select(key).distinct(), key, "left_anti")
    # first later event per user: an aggregate (map-side partial), not a window
    first = cold.groupBy(key).agg(
        F.min_by("category", F.struct("timestamp_ms", "event_id")).alias("category"))
    top = top_items(before, k).where(F.col("category").isNotNull())
    most = before.groupBy("product_id").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "product_id").limit(k)
    overall = most.select(F.lit(None).cast("string").alias("category"), "product_id", "n",
                          F.row_number().over(Window.orderBy(F.col("n").desc(), "product_id")).alias("rank"))  # k rows
    lists = top.unionByName(overall).withColumnRenamed("category", "_list")
    known = top.select("category", F.col("category").alias("_own")).distinct()
    return (first.join(known, "category", "left").join(lists, F.col("_own").eqNullSafe(F.col("_list")))
            .select(key, "category", "rank", "product_id", "n"))


def ctr(events: DataFrame, by: str = "category") -> DataFrame:
    """Click-through rate = clicks / views per group, and lift = group CTR /
    overall CTR (our definition; the source names only the business goal)."""
    g = events.groupBy(by).agg(F.count_if(F.col("event_type") == "click").alias("clicks"),
                               F.count_if(F.col("event_type") == "view").alias("views"))
    overall = g.agg((F.sum("clicks") / F.sum("views")).alias("overall")).scalar()
    return (g.withColumn("ctr", F.when(F.col("views") > 0, F.col("clicks") / F.col("views")))
             .withColumn("lift", F.col("ctr") / overall))


def numbered(df: DataFrame, col: str, out: str) -> DataFrame:
    """(col, out): the distinct non-null values of a column, numbered from 0 without
    gaps: by place within a hash bucket plus the sizes of the buckets before."""
    v = df.select(col).where(F.col(col).isNotNull()).distinct().withColumn("_b", F.pmod(F.xxhash64(col), F.lit(NUMBER_BUCKETS)))
    sizes = v.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # one row a bucket
    offs = sizes.select("_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (v.join(F.broadcast(offs), "_b")
            .withColumn(out, (F.col("_off") + F.row_number().over(Window.partitionBy("_b").orderBy(col)) - 1).cast("int")).select(col, out))


def _item_matrix(items: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    rows = items.orderBy("id").collect()  # behind a check of their size
    return np.array([r["id"] for r in rows], np.int32), np.array([r["features"] for r in rows], np.float32)


def exact_topk(users: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """(u, i, score): each user's ``k`` items of largest factor product, ties by
    item; users stream past the whole item matrix, which travels with the tasks."""
    ids, matrix = _item_matrix(items)
    shared = users.sparkSession.sparkContext.broadcast((ids, matrix))

    def run(batches):
        ids, matrix = shared.value
        n = min(k, len(ids))
        for b in batches:
            own = np.asarray(b.column(1).flatten(), np.float32).reshape(b.num_rows, -1)
            for lo in range(0, b.num_rows if n else 0, 512):
                score = own[lo:lo + 512] @ matrix.T
                top = np.lexsort((np.broadcast_to(ids, score.shape), -score), axis=1)[:, :n]
                yield pa.record_batch([b.column(0).slice(lo, len(score)).take(pa.array(np.repeat(np.arange(len(score)), n))),
                                       pa.array(ids[top].ravel()), pa.array(np.take_along_axis(score, top, 1).ravel().astype(np.float64))],
                                      ["u", "i", "score"])
    return users.select(F.col("id").alias("u"), "features").mapInArrow(run, "u int, i int, score double")


def _signatures(side: DataFrame, greatest: float, planes: np.ndarray, probes: int, items: bool) -> DataFrame:
    """(table, bucket, id, features): a vector's bucket in every table of hyperplanes.
    Items get one more entry that makes all their norms equal, so the largest product
    is the smallest angle; users also probe the buckets across their nearest planes."""
    tables, bits, _ = planes.shape

    def run(batches):
        for b in batches:
            x = np.asarray(b.column(1).flatten(), np.float64).reshape(b.num_rows, -1)
            norm = (x * x).sum(axis=1)
            x = np.column_stack([x, np.sqrt(np.maximum(greatest - norm, 0)) if items else np.zeros(len(x))])
            for t in range(tables):
                at = x @ planes[t].T
                code = (at > 0) @ (1 << np.arange(bits))
                near = np.argsort(np.abs(at), axis=1)[:, :0 if items else probes]
                for j in range(near.shape[1] + 1):
                    own = code if j == 0 else code ^ (1 << near[:, j - 1])
                    yield pa.record_batch([pa.array(np.full(len(x), t, np.int32)), pa.array(own.astype(np.int32)), b.column(0), b.column(1)],
                                          ["table", "bucket", "id", "features"])
    return side.select("id", "features").mapInArrow(run, "table int, bucket int, id int, features array<float>")


def hashed_topk(users: DataFrame, items: DataFrame, k: int, tables: int = 16, bucket_items: int = 64, probes: int = 3, seed: int = 7) -> DataFrame:
    """(u, i, score): each user's ``k`` best of the items that share one of its
    buckets, for catalogues too large to send along. Every item is indexed, and no
    bucket is cut; the recall against all pairs is measured by the tests."""
    n, greatest, rank = items.agg(F.count(F.lit(1)), F.max(F.aggregate("features", F.lit(0.0), lambda s, v: s + v * v)),
                                  F.max(F.size("features"))).first()
    bits = max(1, int(np.ceil(np.log2(max(2, n / bucket_items)))))
    planes = np.random.default_rng(seed).normal(size=(tables, bits, (rank or 1) + 1))
    i = _signatures(items, greatest or 0.0, planes, 0, True).select("table", "bucket", F.col("id").alias("i"), F.col("features").alias("fi"))
    u = _signatures(users, greatest or 0.0, planes, min(probes, bits), False).select("table", "bucket", F.col("id").alias("u"), F.col("features").alias("fu"))
    dot = F.aggregate(F.zip_with("fu", "fi", lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, v: s + v)
    pairs = u.join(i, ["table", "bucket"]).select("u", "i", dot.alias("score")).groupBy("u", "i").agg(F.max("score").alias("score"))
    best = Window.partitionBy("u").orderBy(F.col("score").desc(), "i")
    return pairs.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= k).drop("_r")


def als_factors(events: DataFrame, rank: int = 8, max_iter: int = 5, seed: int = 42) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Implicit-feedback ALS on interaction counts: (user factors, item factors, users
    by number, items by number)."""
    from pyspark.ml.recommendation import ALS
    checkpoint_dir(events.sparkSession)
    users, items = numbered(events, "user_id", "u").checkpoint(), numbered(events, "product_id", "i").checkpoint()
    ratings = (events.groupBy("user_id", "product_id").agg(F.count(F.lit(1)).cast("float").alias("r"))
               .join(users, "user_id").join(items, "product_id").select("u", "i", "r"))
    model = ALS(userCol="u", itemCol="i", ratingCol="r", implicitPrefs=True, rank=rank,
                maxIter=max_iter, seed=seed, coldStartStrategy="drop", checkpointInterval=2).fit(ratings)
    return model.userFactors, model.itemFactors, users, items


def als_topk(events: DataFrame, k: int = TOP_K, rank: int = 8, max_iter: int = 5, seed: int = 42, send_bytes: int = SEND_BYTES) -> DataFrame:
    """K2: top-``k`` items per user of an ALS model. A catalogue whose factors take at
    most ``send_bytes`` goes to the tasks whole (exact); a larger one is searched by
    hashed buckets. Users and items are named by table, whatever their ids look like."""
    uf, itf, users, items = als_factors(events, rank, max_iter, seed)
    top = (exact_topk if items.count() * rank * 4 <= send_bytes else hashed_topk)(uf, itf, k)
    order = Window.partitionBy("u").orderBy(F.col("score").desc(), "i")
    return (top.withColumn("rank", F.row_number().over(order)).join(users, "u").join(items, "i")
            .select("user_id", F.col("rank").cast("int").alias("rank"), "product_id", F.col("score").cast("float").alias("score")))
