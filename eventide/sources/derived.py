"""Derived inputs built by Spark from the test tables.

The test tables hold clean events only. The monitoring, loss and validation
operators need arrival times, processing times, a received lane and faulty
messages; each is a deterministic column expression over ``events`` so its size
grows with the table and both engines (Spark, DuckDB) can rebuild it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Late arrival = 300 + (event_id * 37 % 301) seconds for late rows.
LATE_BASE_S = 300
LATE_SPREAD = 301
LATE_MULT = 37
# A message is lost on the way when event_id % 97 == 0.
LOSS_MOD = 97
# Scoring fails when the model input is out of range (value >= 200).
FAIL_VALUE = 200.0
# The model is down for users whose id ends in 7 from 2024-01-10 to 2024-01-15 (UTC, the
# end excluded): long enough for four failures in a row, so dead letters exist at every scale.
OUTAGE_USERS, OUTAGE_FROM_MS, OUTAGE_TO_MS = "7", 1704844800000, 1705276800000


def scoring_fails(value: str = "value") -> Column:
    """Input out of range, or an event of the outage; false where a field is null."""
    ts = F.col("timestamp_ms").cast("string").try_cast("long")
    down = F.col("user_id").endswith(OUTAGE_USERS) & (ts >= OUTAGE_FROM_MS) & (ts < OUTAGE_TO_MS)
    return F.coalesce(F.col(value) >= FAIL_VALUE, F.lit(False)) | F.coalesce(down, F.lit(False))


def arrival_ms(df: DataFrame) -> Column:
    delay = F.when(F.col("is_late"),
                   (LATE_BASE_S + (F.col("event_id") * LATE_MULT) % LATE_SPREAD) * 1000).otherwise(0)
    return F.col("timestamp_ms") + delay


def processing_ms() -> Column:
    """Processing time = event time + (value*10 as bigint) % 100 ms."""
    return F.col("timestamp_ms") + (F.col("value") * 10).cast("bigint") % 100


def load_scenario() -> Column:
    r = F.col("event_id") % 10
    return (F.when(r <= 5, F.lit("normal_load"))
            .when(r <= 8, F.lit("peak_load"))
            .otherwise(F.lit("late_data")))


def received(df: DataFrame) -> DataFrame:
    """Events that reached the output topic (the rest were lost)."""
    return df.filter(F.col("event_id") % LOSS_MOD != 0)


def monitored(df: DataFrame) -> DataFrame:
    """Events with arrival, processing time and load scenario."""
    return (df.withColumn("arrival_ms", arrival_ms(df))
              .withColumn("processing_time", processing_ms())
              .withColumn("load_scenario", load_scenario()))


# Fixed fault-injection table: event_id % 101 -> producer fault.
#  1 user_id ''            2 product_id null         3 timestamp_ms '0'
#  4 ts '4102444800001'    5 ts '-<ms>'              6 ts 'abc'
#  7 ts '<ms>.5'           8 ts ' <ms> '             9 event_type null
# 10 user_id null and event_type ''                 11 ts '4102444800000'
# 12 ts '1e3'             13 event_type 'user_id_x' 14 category null
FAULT_MOD = 101


def raw_events(df: DataFrame) -> DataFrame:
    """Canonical events as a producer would send them, with faults injected.

    timestamp_ms is text; every row is kept (faults change values, never drop rows).
    """
    r = F.col("event_id") % FAULT_MOD
    ms = F.col("timestamp_ms").cast("string")
    ts = (F.when(r == 3, F.lit("0"))
          .when(r == 4, F.lit("4102444800001"))
          .when(r == 5, F.concat(F.lit("-"), ms))
          .when(r == 6, F.lit("abc"))
          .when(r == 7, F.concat(ms, F.lit(".5")))
          .when(r == 8, F.concat(F.lit(" "), ms, F.lit(" ")))
          .when(r == 11, F.lit("4102444800000"))
          .when(r == 12, F.lit("1e3"))
          .otherwise(ms))
    user = (F.when(r == 1, F.lit("")).when(r == 10, F.lit(None).cast("string"))
            .otherwise(F.col("user_id")))
    product = F.when(r == 2, F.lit(None).cast("string")).otherwise(F.col("product_id"))
    etype = (F.when(r == 9, F.lit(None).cast("string")).when(r == 10, F.lit(""))
             .when(r == 13, F.lit("user_id_x")).otherwise(F.col("event_type")))
    cat = F.when(r == 14, F.lit(None).cast("string")).otherwise(F.col("category"))
    return df.select("event_id", user.alias("user_id"), product.alias("product_id"),
                     cat.alias("category"), etype.alias("event_type"), ts.alias("timestamp_ms"),
                     "is_late", "value", F.col("timestamp_ms").alias("sent_ms"))
