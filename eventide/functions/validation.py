"""Event validation as Catalyst expressions (no Python UDF).

Rules, evaluated in order, one message per broken rule:
1. required fields user_id, product_id, event_type, timestamp_ms; null, empty
   text and a timestamp equal to 0 count as missing;
2. a present timestamp must be an integer (else "Timestamp must be integer"),
   inside 0 .. 4102444800000 inclusive (else "Invalid timestamp");
3. a present event_type must be one of the known types.
``category`` is never checked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values (must equal the original rules).
REQUIRED_FIELDS = ["user_id", "product_id", "event_type", "timestamp_ms"]
VALID_EVENT_TYPES = ["view", "click", "add_to_cart", "purchase"]
MAX_TIMESTAMP_MS = 4102444800000
MSG_MISSING = "Missing required field: "
MSG_NOT_INT = "Timestamp must be integer: "
MSG_RANGE = "Invalid timestamp: "
MSG_TYPE = "Invalid event_type: "
INT_PATTERN = r"^[ ]*[+-]?[0-9]+[ ]*$"

ERROR_STRUCT = "struct<rule:int,field:string,value:string,message:string>"


def ts_is_int(ts: Column) -> Column:
    return F.coalesce(ts.rlike(INT_PATTERN), F.lit(False))


def ts_value(ts: Column) -> Column:
    """Integer value of a textual timestamp; null when not an integer (or overflowing)."""
    return F.when(ts_is_int(ts), F.trim(ts).try_cast("bigint"))


def is_missing(name: str) -> Column:
    c = F.col(name)
    miss = c.isNull() | (c.cast("string") == "")
    if name == "timestamp_ms":
        miss = miss | F.coalesce(ts_value(c.cast("string")) == 0, F.lit(False))
    return miss


def error_array() -> Column:
    """array<struct<rule, field, value, message>> of broken rules, in rule order."""
    ts = F.col("timestamp_ms").cast("string")
    et = F.col("event_type")
    items = []
    for i, f in enumerate(REQUIRED_FIELDS):
        items.append(F.when(is_missing(f), F.struct(
            F.lit(i + 1).alias("rule"), F.lit(f).alias("field"),
            F.col(f).cast("string").alias("value"),
            F.lit(MSG_MISSING + f).alias("message"))))
    ts_present = ~is_missing("timestamp_ms")
    v = ts_value(ts)
    items.append(F.when(ts_present & ~ts_is_int(ts), F.struct(
        F.lit(5).alias("rule"), F.lit("timestamp_ms").alias("field"), ts.alias("value"),
        F.concat(F.lit(MSG_NOT_INT), ts).alias("message"))))
    items.append(F.when(ts_present & ts_is_int(ts)
                        & (v.isNull() | (v < 0) | (v > MAX_TIMESTAMP_MS)), F.struct(
        F.lit(6).alias("rule"), F.lit("timestamp_ms").alias("field"), ts.alias("value"),
        F.concat(F.lit(MSG_RANGE), ts).alias("message"))))
    items.append(F.when(~is_missing("event_type") & ~et.isin(*VALID_EVENT_TYPES), F.struct(
        F.lit(7).alias("rule"), F.lit("event_type").alias("field"), et.alias("value"),
        F.concat(F.lit(MSG_TYPE), et).alias("message"))))
    # flatten(array(when(rule, [error]) else [])) keeps whole-stage codegen
    # (a lambda filter would fall back to interpreted evaluation)
    empty = F.array().cast(f"array<{ERROR_STRUCT}>")
    return F.flatten(F.array(*[F.when(F.coalesce(i.isNotNull(), F.lit(False)), F.array(i)).otherwise(empty)
                               for i in items]))


def is_valid() -> Column:
    """True when no rule is broken (a small boolean form of :func:`error_array`,
    so filters pushed to the scan stay compact and code-generated)."""
    ts = F.col("timestamp_ms").cast("string")
    v = ts_value(ts)
    present = [~is_missing(f) for f in REQUIRED_FIELDS]
    ok = present[0] & present[1] & present[2] & present[3]
    return ok & ts_is_int(ts) & v.between(0, MAX_TIMESTAMP_MS) & F.col("event_type").isin(*VALID_EVENT_TYPES)


def computed_once(df: DataFrame) -> DataFrame:
    """Optimizer barrier: the columns of ``df`` are computed once per row.

    Validation reads every field several times; without the barrier Catalyst
    pushes the validity filter below the projection that derives the fields
    (JSON extraction, time conversion) and copies those expressions into the
    filter once per reference, where no common-subexpression elimination
    applies. A nondeterministic column (the partition id) that the filter also
    references keeps the filter above the projection.
    """
    return df.withColumn("_barrier", F.spark_partition_id())


def barrier() -> Column:
    # not foldable (an isnotnull on the never-null partition id would be
    # simplified to true, and the barrier pruned away)
    return F.col("_barrier") >= 0


def with_errors(raw: DataFrame) -> DataFrame:
    """Adds ``errors`` (array of broken rules) to raw events."""
    return computed_once(raw).withColumn("errors", error_array())


def valid_only(checked: DataFrame) -> DataFrame:
    """Rows without broken rules, with timestamp_ms parsed to BIGINT."""
    cond = is_valid() & barrier() if "_barrier" in checked.columns else is_valid()
    return (checked.filter(cond).drop("errors", "_barrier")
            .withColumn("timestamp_ms", ts_value(F.col("timestamp_ms").cast("string"))))


def validation_errors(checked: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per broken rule: the validation_errors lane, and the columns ``keep``.

    ``explode_outer`` + a null filter above it: a plain ``explode`` makes the
    optimizer infer ``size(errors) > 0`` and push it to the scan, copying the
    whole rule tree into the filter.
    """
    ts = F.col("timestamp_ms").cast("string")
    return (checked
            .select("event_id", "user_id", ts_value(ts).alias("timestamp"), *keep,
                    F.explode_outer("errors").alias("e"))
            .filter(F.col("e").isNotNull())
            .select("event_id", "user_id", F.col("e.field").alias("field"),
                    F.col("e.value").alias("value"), F.col("e.message").alias("validation_rule"),
                    "timestamp", F.col("e.rule").alias("rule_no"), *keep))


def field_from_message(msg: Column) -> Column:
    """Parity mode: field attributed by substring of the message, first match wins
    (user_id > product_id > event_type > timestamp, else 'unknown')."""
    return (F.when(msg.contains("user_id"), F.lit("user_id"))
            .when(msg.contains("product_id"), F.lit("product_id"))
            .when(msg.contains("event_type"), F.lit("event_type"))
            .when(msg.contains("timestamp"), F.lit("timestamp_ms"))
            .otherwise(F.lit("unknown")))
