"""The trained forest as arrays, evaluated by numpy, and scoring in
batches of distinct users.

A forest's nodes are read from its saved form into a few arrays (feature,
threshold, children, share of class 1), some kB whatever the training set; they
travel with the tasks, and a batch of rows goes down all trees at once. The score
is that of ``transform``: the mean over trees of the leaf's share of class 1.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint_dir
from .cache import shard_of
from .features import FEATURES


@dataclass(frozen=True)
class Forest:
    """Trees laid end to end. A leaf is its own child on both sides."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    share: np.ndarray
    roots: np.ndarray
    depth: int

    @classmethod
    def of(cls, model, spark: SparkSession) -> Forest:
        """From an MLlib RandomForestClassificationModel of two classes and
        continuous features, by the node table of its saved form."""
        path = f"{checkpoint_dir(spark).rstrip('/')}/forest-{uuid.uuid4().hex}"
        model.write().overwrite().save(path)
        nodes = (spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
                 .select("treeID", "id", "impurityStats", "leftChild", "rightChild", F.col("split.featureIndex").alias("feature"),
                         F.col("split.leftCategoriesOrThreshold").alias("threshold"))
                 .orderBy("treeID", "id").collect())  # trees times nodes a tree: set by the model's settings
        where = {(n["treeID"], n["id"]): k for k, n in enumerate(nodes)}
        leaf = np.array([n["leftChild"] < 0 for n in nodes])
        side = lambda c: np.array([k if leaf[k] else where[n["treeID"], n[c]] for k, n in enumerate(nodes)], np.int64)
        stats = np.array([n["impurityStats"] for n in nodes], float)
        return cls(np.array([max(n["feature"], 0) for n in nodes], np.int64),
                   np.array([np.inf if leaf[k] else n["threshold"][0] for k, n in enumerate(nodes)]), side("leftChild"), side("rightChild"),
                   stats[:, 1] / stats.sum(axis=1), np.array([where[t, 0] for t in sorted({n["treeID"] for n in nodes})], np.int64),
                   int(model.getOrDefault("maxDepth")))

    def score(self, x: np.ndarray) -> np.ndarray:
        """P(class 1) of each row of x."""
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        row = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = np.where(x[row, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return self.share[at].mean(axis=1)


def score_forest(df: DataFrame, forest: Forest, out: str = "score") -> DataFrame:
    """M4: one score a row, in Arrow batches."""
    @F.pandas_udf(T.DoubleType())
    def score(*cols: pd.Series) -> pd.Series:
        return pd.Series(forest.score(np.column_stack([c.to_numpy(float) for c in cols])))
    return df.withColumn(out, score(*(F.col(c).cast("double") for c in FEATURES)))


def user_batches(events, size: int) -> Iterator[tuple[int, list[tuple], list[int]]]:
    """Batches of distinct users over events (user, ...) in order: a user's first
    event since the last batch stands for all of its events; the batch is complete
    when ``size`` users are in it, the last one may be smaller. Yields (batch
    number, first events, events of each)."""
    number, firsts, many = 0, {}, {}
    for e in events:
        user = e[0]
        if user not in firsts:
            firsts[user], many[user] = e, 0
        many[user] += 1
        if len(firsts) == size:
            yield number, list(firsts.values()), list(many.values())
            number, firsts, many = number + 1, {}, {}
    if firsts:
        yield number, list(firsts.values()), list(many.values())


_BATCH_OUT = "shard int, batch long, user_id string, event_id long, n_events long, score double"


def score_user_batches(df: DataFrame, forest: Forest, size: int = 32, shards: int = 1, key: str = "user_id") -> DataFrame:
    """The model called once for every ``size`` distinct users of a worker
    (shard), on each user's first event since the call before. ``df`` has the key,
    event_id, timestamp_ms and the features. One row a user and batch.

    A worker's events stream past in time order; a task holds one batch of users.
    """
    def run(batches):
        def events():
            for b in batches:
                yield from zip(*(c.to_pylist() for c in b.columns), strict=True)

        def out(rows):
            cols = list(zip(*rows, strict=True))
            types = (pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64())
            return pa.record_batch([pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                                   ["shard", "batch", "user_id", "event_id", "n_events", "score"])

        import itertools
        for shard, own in itertools.groupby(events(), key=lambda e: e[0]):
            for number, firsts, many in user_batches((e[1:] for e in own), size):
                scores = forest.score(np.array([e[2:] for e in firsts], float)).tolist()
                yield out([(shard, number, e[0], e[1], n, s) for e, n, s in zip(firsts, many, scores, strict=True)])

    rows = df.select(shard_of(key, shards).alias("shard"), F.col(key).alias("user_id"), "event_id", "timestamp_ms",
                     *(F.col(c).cast("double").alias(c) for c in FEATURES))
    rows = rows.repartition("shard").sortWithinPartitions("shard", "timestamp_ms", "event_id")
    return rows.select("shard", "user_id", "event_id", *FEATURES).mapInArrow(run, _BATCH_OUT)


def split_flag(id_col: str = "event_id", share: int = 80) -> Column:
    """M2: repeatable split by a hash of the row id that any engine can compute."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint"), F.lit(100)) < share
