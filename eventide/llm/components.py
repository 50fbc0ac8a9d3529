"""Connected components of a large edge table by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import discard, stored


def _least(edges: DataFrame, name: str) -> DataFrame:
    return edges.groupBy(F.col("u").alias("_u")).agg(F.least(F.min("v"), F.col("_u")).alias(name))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours move to its smallest neighbour (or itself)."""
    both = edges.union(edges.select("v", "u")).toDF("u", "v")
    m = _least(both, "m")
    return both.where("v > u").join(m, F.col("u") == F.col("_u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours move to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    m = _least(down, "m")
    moved = down.join(m, F.col("u") == F.col("_u"))
    out = moved.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                         F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*")
    return out.where("u <> v").distinct()


def _print(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def connected_components(edges: DataFrame) -> DataFrame:
    """node, root (smallest node of its component) of the nodes that have edges
    (u, v). Only sums reach the driver; each round is written to the shared
    folder, and the one before it removed. The number of rounds is logarithmic in the longest path."""
    now = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "edges")
    mark = _print(now)
    while mark[0]:
        before, now = now, stored(_small_star(_large_star(now)), "edges")
        discard(before)
        new = _print(now)
        if new == mark:
            break
        mark = new
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
