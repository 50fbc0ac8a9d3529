"""Scalar column expressions (projections, flags, time and key formatting)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MS_PER_MIN = 60_000
EPOCH_NTZ = "1970-01-01 00:00:00"
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS"
SQL_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Event-type groups of the feature definitions.
CLICK_TYPES = ["click", "view"]
PURCHASE_TYPE = "purchase"
CART_TYPE = "add_to_cart"
# Cold-start feature vector and fallback score.
DEFAULT_FEATURES = (0.0, 0.0, 0.0, 1440.0)
FALLBACK_SCORE = 0.5
UNKNOWN = "unknown"


def c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def is_click(et: Column | str = "event_type") -> Column:
    return c(et).isin(*CLICK_TYPES)


def is_purchase(et: Column | str = "event_type") -> Column:
    return c(et) == PURCHASE_TYPE


def is_cart(et: Column | str = "event_type") -> Column:
    return c(et) == CART_TYPE


def ms_to_ntz(ms: Column | str) -> Column:
    """Epoch ms -> TIMESTAMP_NTZ (wall clock in UTC, independent of the session zone)."""
    return F.timestamp_add("MILLISECOND", c(ms), F.lit(EPOCH_NTZ).cast("timestamp_ntz"))


def ntz_to_ms(ts: Column | str) -> Column:
    return F.timestamp_diff("MILLISECOND", F.lit(EPOCH_NTZ).cast("timestamp_ntz"), c(ts))


def iso_time(ms: Column | str) -> Column:
    """Epoch ms -> ISO-8601 text with milliseconds (UTC)."""
    return F.date_format(ms_to_ntz(ms), ISO_FORMAT)


def parse_iso(s: Column | str) -> Column:
    """ISO-8601 text -> epoch ms."""
    return ntz_to_ms(F.to_timestamp_ntz(c(s), F.lit(ISO_FORMAT)))


def truncate_to_second_ms(ms: Column | str) -> Column:
    """The documented SQL form TO_TIMESTAMP(FROM_UNIXTIME(ms/1000)) drops milliseconds."""
    return F.floor(c(ms) / 1000) * 1000


def latency_ms(processing: Column | str = "processing_time",
               event: Column | str = "timestamp_ms") -> Column:
    """processing - event time; null unless both are present."""
    return F.when(c(processing).isNotNull() & c(event).isNotNull(), c(processing) - c(event))


def is_late(arrival: Column | str, event: Column | str = "timestamp_ms",
            limit_s: int = 300) -> Column:
    """Late when the arrival is more than ``limit_s`` seconds after the event (strict)."""
    return (c(arrival) - c(event)) > limit_s * 1000


def latency_band(v: Column | str, high: float = 30, medium: float = 15) -> Column:
    return (F.when(c(v) > high, F.lit("high")).when(c(v) > medium, F.lit("medium"))
            .otherwise(F.lit("low")))


def key(prefix: str, n: Column | str) -> Column:
    return F.concat(F.lit(prefix + "_"), c(n).cast("string"))


def score_linear(a: Column | str, clicks: Column | str, purchases: Column | str,
                 recency: Column | str) -> Column:
    """Documented logistic score over the four features (an exact, SQL-checkable model).

    1/(1+exp(-(-1 + 0.02*avg_time_category + 0.05*click_count
               + 0.4*purchase_count - 0.0005*recency)))
    """
    z = (F.lit(-1.0) + F.lit(0.02) * c(a) + F.lit(0.05) * c(clicks)
         + F.lit(0.4) * c(purchases) - F.lit(0.0005) * c(recency))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def r6(x: Column | str) -> Column:
    """Doubles are compared at 6 decimals."""
    return F.round(c(x).cast("double"), 6)
