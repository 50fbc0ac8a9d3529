"""Event sources: the fixed event schema, JSON parsing, and the test-table adapter.

The production input is a stream of JSON messages; :func:`parse_events` turns a
``value`` string column into the canonical columns under a fixed schema (unknown
fields ignored, missing fields null). :func:`events_from_tables` builds the same
canonical columns from the parquet test tables so every operator can be checked
on them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Canonical event: four strings and the event time in epoch milliseconds.
EVENT_SCHEMA = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("timestamp_ms", T.LongType()),
])

# Optional producer fields kept for dedup, late rate and loss checks.
EXTRA_FIELDS = [
    T.StructField("event_id", T.LongType()),
    T.StructField("is_late", T.BooleanType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("load_scenario", T.StringType()),
]

# Raw form used before validation: timestamp_ms stays text so the
# "must be integer" rule can see what was sent.
RAW_EVENT_SCHEMA = T.StructType(
    [T.StructField(f.name, T.StringType()) if f.name == "timestamp_ms" else f
     for f in EVENT_SCHEMA.fields] + EXTRA_FIELDS)

CORRUPT_COL = "_corrupt_record"

# Fixed values of the test-data adapter: the category list indexed by k % 5.
CATEGORIES = ["electronics", "books", "clothing", "home", "sports"]


def parse_events(df: DataFrame, value_col: str = "value", raw: bool = False,
                 keep: list[str] | None = None) -> DataFrame:
    """Parse JSON text into event columns under a fixed schema.

    Malformed text keeps its raw string in ``_corrupt_record`` (null when the
    message parsed), so callers can route it to a dead-letter lane instead of
    silently getting a row of nulls.
    """
    base = RAW_EVENT_SCHEMA if raw else T.StructType(EVENT_SCHEMA.fields + EXTRA_FIELDS)
    schema = T.StructType(base.fields + [T.StructField(CORRUPT_COL, T.StringType())])
    parsed = F.from_json(F.col(value_col), schema,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COL})
    keep = keep or []
    return df.select(*keep, parsed.alias("_e")).select(*keep, "_e.*")


def read_events_json(spark: SparkSession, path: str, raw: bool = False) -> DataFrame:
    """Batch read of newline-delimited JSON events (one message per line)."""
    text = spark.read.text(path)
    return parse_events(text, "value", raw=raw)


def _k(props: Column) -> Column:
    return F.get_json_object(props, "$.k")


def event_ms(ts: Column) -> Column:
    """TIMESTAMP_NTZ -> epoch milliseconds, independent of the session time zone."""
    return F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def events_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical events from ``events.parquet`` (adapter of the test tables).

    Columns: event_id, user_id, product_id, category, event_type, timestamp_ms,
    is_late, value. Only the columns a caller keeps are read (Catalyst prunes
    the parquet scan to them).
    """
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    k = _k(F.col("props"))
    cats = F.array(*[F.lit(c) for c in CATEGORIES])
    return ev.select(
        "event_id",
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("user_id"),
        F.concat(F.lit("product_"), k).alias("product_id"),
        F.element_at(cats, (k.cast("int") % 5 + 1).cast("int")).alias("category"),
        "event_type",
        event_ms(F.col("ts")).alias("timestamp_ms"),
        (F.col("event_id") % 10 == 0).alias("is_late"),
        "value",
    )


def event_time(ms: Column | str = "timestamp_ms") -> Column:
    """Epoch ms -> TIMESTAMP event time (usable by withWatermark / window)."""
    ms = F.col(ms) if isinstance(ms, str) else ms
    return F.timestamp_millis(ms)


def to_json_value(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Serialize rows as one JSON message per row (the Kafka ``value``)."""
    cols = cols or df.columns
    return df.select(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("value"))
