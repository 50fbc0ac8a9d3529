"""Run-validation and service-level queries.

All statistics are aggregates with map-side partial aggregation. Percentiles are
exact (linear interpolation) and come from value counts in ranges, so no task
holds a group's values (:mod:`quantiles`, which also has mergeable sketches).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .quantiles import exact_quantiles
from .windows import join_null_safe

SLA_P95_MS = 75.0
LOSS_TOLERANCE_PCT = 1.0
HIST_BINS = 30
STATS = ["p50", "p95", "p99", "mean", "min", "max"]


PERCENTILES = {"p50": 0.5, "p95": 0.95, "p99": 0.99}


def _statistics(df: DataFrame, by: list[str], v: Column) -> DataFrame:
    """n, mean, percentiles, min and max of the non-null values of each group."""
    rows = df.select(*by, v.cast("double").alias("_v"))
    plain = rows.groupBy(*by).agg(F.count("_v").alias("n"), F.avg("_v").alias("mean"), F.min("_v").alias("min"), F.max("_v").alias("max"))
    qs = exact_quantiles(rows, by, "_v", list(PERCENTILES.values())).select(
        *by, *(F.col("quantiles")[k].alias(p) for k, p in enumerate(PERCENTILES)))
    return join_null_safe(plain, qs, by, "left").select(*by, "n", "mean", *PERCENTILES, "min", "max")


def latency_stats(df: DataFrame, by: list[str], v: str = "latency_ms") -> DataFrame:
    """Count, mean, p50/p95/p99, min, max per group."""
    return _statistics(df, by, F.col(v))


def latency_sla(df: DataFrame, by: list[str], v: str = "latency_ms",
                limit: float = SLA_P95_MS) -> DataFrame:
    """Positive latencies only; pass when p95 < limit; null verdict without data."""
    out = _statistics(df, by, F.when(F.col(v) > 0, F.col(v))).select(*by, F.col("n").alias("n_positive"), "p95")
    return out.withColumn("sla_pass", F.when(F.col("n_positive") > 0, F.col("p95") < limit))


def latency_components(df: DataFrame, components: dict[str, Column], total: str) -> DataFrame:
    """Mean, p95 and band of each component's latency (by its p95), and which
    component, the ``total`` aside, is the offender: the slowest one above "low"."""
    from ..functions.expr import latency_band
    long = df.select(F.explode(F.array(*(F.struct(F.lit(k).alias("component"), v.cast("double").alias("v"))
                                         for k, v in components.items()))).alias("x")).select("x.component", "x.v")
    s = _statistics(long, ["component"], F.col("v")).select("component", "n", "mean", "p95").withColumn("band", latency_band("p95"))
    worst = F.max(F.when(F.col("component") != total, F.col("p95"))).over(Window.partitionBy(F.lit(0)))  # one row a component
    own = (F.col("component") != total) & (F.col("band") != "low") & (F.col("p95") == worst)
    return s.withColumn("offender", own)


def late_rate(df: DataFrame, by: list[Column | str], late: str = "is_late_arrival") -> DataFrame:
    """100 * late / total per group (0 for an empty group)."""
    return (df.groupBy(*by)
            .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(late)).alias("n_late"))
            .withColumn("late_rate", F.when(F.col("n") > 0, F.col("n_late") * 100.0 / F.col("n"))
                        .otherwise(F.lit(0.0))))


def data_loss(sent: DataFrame, received: DataFrame, id_col: str = "event_id",
              tolerance_pct: float = LOSS_TOLERANCE_PCT) -> DataFrame:
    """Sent, received, lost (sent ids never received, i.e. the anti join)
    and loss % with its verdict. Both sides meet in one shuffle on the id; a
    repeated delivery counts once."""
    tagged = (sent.select(id_col, F.lit(True).alias("_s"), F.lit(False).alias("_r"))
              .unionByName(received.select(id_col, F.lit(False).alias("_s"), F.lit(True).alias("_r"))))
    per_id = tagged.groupBy(id_col).agg(F.max("_s").alias("_s"), F.max("_r").alias("_r"))
    out = per_id.agg(F.count_if("_s").alias("sent"), F.count_if("_r").alias("received"),
                     F.count_if(F.col("_s") & ~F.col("_r")).alias("lost"))
    pct = F.when(F.col("sent") > 0, (F.col("sent") - F.col("received")) * 100.0 / F.col("sent"))
    return out.withColumn("loss_pct", pct).withColumn("passed", F.col("loss_pct") <= tolerance_pct)


def first_n(df: DataFrame, n: int, order: str = "event_id") -> DataFrame:
    """K3: the first ``n`` outputs (a top-k: partial top-k per partition, one small merge)."""
    return df.orderBy(order).limit(n)


def late_check(df: DataFrame, late: str = "is_late") -> DataFrame:
    """Share of late rows; passes when any late row came through, no verdict
    (null) without rows."""
    return (df.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(late)).alias("n_late"))
            .withColumn("late_share", F.when(F.col("n") > 0, F.col("n_late") / F.col("n")))
            .withColumn("passed", F.when(F.col("n") > 0, F.col("n_late") > 0)))


def before_after(df: DataFrame, phase: str, v: str = "latency_ms") -> DataFrame:
    """Each statistic before and after, improvement % = (before-after)/before*100."""
    wide = _statistics(df, [phase], F.when(F.col(v) > 0, F.col(v)))
    long = wide.select(phase, F.explode(F.array(*[
        F.struct(F.lit(s).alias("statistic"), F.col(s).cast("double").alias("v")) for s in STATS])).alias("x"))
    flat = long.select(phase, "x.statistic", "x.v")
    piv = flat.groupBy("statistic").agg(
        F.max(F.when(F.col(phase) == "before", F.col("v"))).alias("before"),
        F.max(F.when(F.col(phase) == "after", F.col("v"))).alias("after"))
    return piv.withColumn("improvement_pct", F.when(F.col("before") != 0,
                                                   (F.col("before") - F.col("after")) / F.col("before") * 100))


def throughput(df: DataFrame, by: list[str], v: str = "latency_ms") -> DataFrame:
    """Events per second of event time and model calls per second (1000 / mean ms)."""
    pos = F.when(F.col(v) > 0, F.col(v).cast("double"))
    out = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"),
                              ((F.max("timestamp_ms") - F.min("timestamp_ms")) / 1000.0).alias("elapsed_s"),
                              F.avg(pos).alias("mean_latency_ms"))
    return (out.withColumn("events_per_s", F.when(F.col("elapsed_s") > 0, F.col("n") / F.col("elapsed_s")))
               .withColumn("model_rps", F.when(F.col("mean_latency_ms") > 0, 1000.0 / F.col("mean_latency_ms"))))


def histogram(df: DataFrame, series: str, v: str, bins: int = HIST_BINS) -> DataFrame:
    """Equal-width bins over each series' own min..max (last bin closed), all bins listed."""
    rng = df.groupBy(series).agg(F.min(v).cast("double").alias("lo"), F.max(v).cast("double").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    b = F.when(F.col("hi") == F.col("lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col(v) - F.col("lo")) / width), F.lit(bins - 1)))
    counted = (df.join(rng, series).withColumn("bin", b.cast("bigint"))
               .groupBy(series, "bin").agg(F.count(F.lit(1)).alias("n")))
    grid = rng.select(series, "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    grid = grid.withColumn("bin", F.col("bin").cast("bigint"))
    return (grid.join(counted, [series, "bin"], "left")
            .select(series, "bin", (F.col("lo") + width * F.col("bin")).alias("bin_lo"),
                    (F.col("lo") + width * (F.col("bin") + 1)).alias("bin_hi"),
                    F.coalesce("n", F.lit(0)).cast("bigint").alias("n")))
