"""Distribution drift between a reference and a current sample.

Inputs are long tables ``(column, value)`` (reference) and
``(*by, column, value)`` (current). Every statistic is a distance (it grows
with drift), built from pre-aggregated counts:

* PSI over reference-decile bins, epsilon 1e-4 for empty bins;
* two-sample KS (max gap between the empirical CDFs);
* chi-square of current counts against reference shares (few-valued columns);
* Wasserstein-1 between the empirical distributions, divided by the
  reference standard deviation (population, floor 0.001).

Dataset drift: at least half the columns drift (normalized Wasserstein >= 0.1);
the score is then the largest column score, else 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .quantiles import exact_quantiles, running_sums

EPS = 1e-4
N_BINS = 10
COLUMN_DRIFT = 0.1
DATASET_SHARE = 0.5
ALERT_SCORE = 0.2


def to_long(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    by = by or []
    arr = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
    return df.select(*by, F.explode(arr).alias("x")).select(*by, "x.column", "x.value")


def bin_edges(ref: DataFrame, n_bins: int = N_BINS) -> DataFrame:
    """Reference deciles per column (exact, linear interpolation); no task holds a column."""
    return exact_quantiles(ref, ["column"], "value", [i / n_bins for i in range(1, n_bins)]).withColumnRenamed("quantiles", "edges")


def with_bin(df: DataFrame, edges: DataFrame) -> DataFrame:
    """bin = number of reference edges strictly below the value (equi-join on column)."""
    return (df.join(edges, "column")
              .withColumn("bin", F.size(F.filter("edges", lambda e: e < F.col("value"))).cast("bigint"))
              .drop("edges"))


def aligned_bins(ref: DataFrame, cur: DataFrame, n_bins: int = N_BINS) -> DataFrame:
    """Reference and current counts side by side per (column, bin), full outer join."""
    edges = bin_edges(ref, n_bins)
    r = with_bin(ref, edges).groupBy("column", "bin").agg(F.count(F.lit(1)).alias("ref_count"))
    c = with_bin(cur, edges).groupBy("column", "bin").agg(F.count(F.lit(1)).alias("cur_count"))
    return (r.join(c, ["column", "bin"], "full")
             .select("column", "bin", F.coalesce("ref_count", F.lit(0)).alias("ref_count"),
                     F.coalesce("cur_count", F.lit(0)).alias("cur_count")))


def _psi_term(c, r):
    return (c - r) * F.log(c / r)


def psi(ref: DataFrame, cur: DataFrame, by: list[str] | None = None, n_bins: int = N_BINS) -> DataFrame:
    """PSI per (*by, column).

    For grouped current data the reference bins absent from a group must still
    count (as epsilon shares). PSI = sum over all reference bins of
    term(eps, r) + sum over the group's bins of [term(c, r|eps) - term(eps, r)
    when the bin is in the reference]; only equi-joins on (column, bin).
    """
    by = by or []
    edges = bin_edges(ref, n_bins)
    rb = with_bin(ref, edges).groupBy("column", "bin").agg(F.count(F.lit(1)).alias("_rn"))
    rtot = Window.partitionBy("column")
    rs = rb.withColumn("r", F.col("_rn") / F.sum("_rn").over(rtot)).drop("_rn")
    base = rs.groupBy("column").agg(F.sum(_psi_term(F.lit(EPS), F.col("r"))).alias("_base"))
    cb = with_bin(cur, edges).groupBy(*by, "column", "bin").agg(F.count(F.lit(1)).alias("_cn"))
    ctot = Window.partitionBy(*by, "column")
    cs = cb.withColumn("c", F.greatest(F.col("_cn") / F.sum("_cn").over(ctot), F.lit(EPS))).drop("_cn")
    j = cs.join(rs, ["column", "bin"], "left")
    delta = F.when(F.col("r").isNull(), _psi_term(F.col("c"), F.lit(EPS))).otherwise(
        _psi_term(F.col("c"), F.col("r")) - _psi_term(F.lit(EPS), F.col("r")))
    per = j.groupBy(*by, "column").agg(F.sum(delta).alias("_d"))
    return per.join(base, "column").select(*by, "column", (F.col("_base") + F.col("_d")).alias("psi"))


def _cdfs(ref: DataFrame, cur: DataFrame) -> DataFrame:
    """Both empirical CDFs at every distinct value of either sample, per column, in
    ranges of values: no task orders a whole column."""
    both = (ref.select("column", "value", F.lit(1).alias("r"), F.lit(0).alias("c"))
            .unionByName(cur.select("column", "value", F.lit(0).alias("r"), F.lit(1).alias("c"))))
    j = both.where("value is not null").groupBy("column", "value").agg(F.sum("r").alias("rn"), F.sum("c").alias("cn"))
    return (running_sums(j, ["column"], "value", ["rn", "cn"])
            .withColumn("fr", F.col("cum_rn") / F.col("tot_rn")).withColumn("fc", F.col("cum_cn") / F.col("tot_cn")))


def ks(ref: DataFrame, cur: DataFrame) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic per column."""
    return _cdfs(ref, cur).groupBy("column").agg(F.max(F.abs(F.col("fr") - F.col("fc"))).alias("ks"))


def wasserstein(ref: DataFrame, cur: DataFrame) -> DataFrame:
    """Wasserstein-1 distance per column and its value normalized by the reference std."""
    d = _cdfs(ref, cur).groupBy("column").agg(
        F.sum(F.abs(F.col("fr") - F.col("fc")) * (F.col("next_value") - F.col("value"))).alias("wasserstein"))
    sd = ref.groupBy("column").agg(F.greatest(F.stddev_pop("value"), F.lit(0.001)).alias("_sd"))
    return d.join(sd, "column").withColumn("wasserstein_norm", F.col("wasserstein") / F.col("_sd")).drop("_sd")


def chi2(ref: DataFrame, cur: DataFrame) -> DataFrame:
    """D3: chi-square of the current counts against reference shares (epsilon floor)."""
    r = ref.groupBy("column", "value").agg(F.count(F.lit(1)).alias("rn"))
    c = cur.groupBy("column", "value").agg(F.count(F.lit(1)).alias("cn"))
    tot = Window.partitionBy("column")
    j = (r.join(c, ["column", "value"], "full").fillna(0, ["rn", "cn"])
          .withColumn("share", F.greatest(F.col("rn") / F.sum("rn").over(tot), F.lit(EPS)))
          .withColumn("expected", F.col("share") * F.sum("cn").over(tot)))
    return j.groupBy("column").agg(
        F.sum(F.pow(F.col("cn") - F.col("expected"), 2) / F.col("expected")).alias("chi2"),
        F.count(F.lit(1)).alias("n_values"))


def dataset_drift(scores: DataFrame, score: str = "wasserstein_norm",
                  limit: float = COLUMN_DRIFT, share: float = DATASET_SHARE) -> DataFrame:
    """Share of drifted columns and the dataset score (max column score, 0 when no drift)."""
    out = scores.agg(F.count(F.lit(1)).alias("n_columns"),
                     F.count_if(F.col(score) >= limit).alias("n_drifted"),
                     F.max(score).alias("_max"))
    out = out.withColumn("drift_share", F.col("n_drifted") / F.col("n_columns"))
    out = out.withColumn("dataset_drift", F.col("drift_share") >= share)
    return out.withColumn("drift_score", F.when(F.col("dataset_drift"), F.col("_max")).otherwise(F.lit(0.0))).drop("_max")


def max_drift(scores: DataFrame, score: str = "wasserstein_norm") -> DataFrame:
    """K4: the column with the largest drift score."""
    return scores.agg(F.max_by("column", score).alias("column"), F.max(score).alias("score"))
