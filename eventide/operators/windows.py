"""Event-time windows, sessions, late-data lanes, dedup and global order
(X2, X3, X4, A15, U2, W9).

Operators that need an order over *all* rows (the monitor's count window, the
arrival-ordered late-data classifier) never use an unpartitioned window, which
would pull every row into one task. They split the order key into quantile
ranges, number or aggregate inside each range, and add per-range offsets from
a table with one row per range (broadcast; its size is the range count).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import ms_to_ntz

MINUTE_MS = 60_000


def _parts(df: DataFrame, n: int | None) -> int:
    return n or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` in which null keys meet: no row is lost for a null key or time."""
    names = {k: f"_r_{k}" for k in keys}
    cond = [F.col(k).eqNullSafe(F.col(r)) for k, r in names.items()]
    return left.join(right.withColumnsRenamed(names), cond, how).drop(*names.values())


def order_bucket(df: DataFrame, col: str, n: int | None = None, rel_err: float = 0.001,
                 out: str = "_b") -> DataFrame:
    """Adds ``out``: the deterministic range bucket of ``col`` (number of
    quantile bounds <= value).

    The bounds come from ``approxQuantile`` (one small driver-side list of
    ``n - 1`` numbers); the bucket is a pure function of the row, so every
    recomputation (a lost executor, a second branch of the plan) agrees on it.
    The lookup is MLlib's ``Bucketizer`` (a binary search in the JVM).
    """
    from pyspark.ml.feature import Bucketizer
    n = _parts(df, n)
    qs = [i / n for i in range(1, n)]
    bounds = sorted(set(df.approxQuantile(col, qs, rel_err))) if n > 1 else []
    if not bounds:
        return df.withColumn(out, F.lit(0))
    splits = [float("-inf")] + [float(b) for b in bounds] + [float("inf")]
    tmp = df.withColumn("_bv", F.col(col).cast("double"))
    # right-closed at each bound, so a value equal to a bound goes above it
    return (Bucketizer(splits=splits, inputCol="_bv", outputCol=out, handleInvalid="keep").transform(tmp)
            .withColumn(out, F.col(out).cast("int")).drop("_bv"))


KEYED_RANGE_MS = 60_000


def time_bucket(col: str, width_ms: int = KEYED_RANGE_MS) -> Column:
    """Fixed-width event-time bucket: a pure column expression (no job, no extra
    pass). Used to cut a key's rows into ordered pieces: a key holding a third
    of all rows is split into one piece per ``width_ms`` of event time."""
    return F.floor(F.col(col) / width_ms).cast("long")


def global_index(df: DataFrame, order: list[str], n: int | None = None, out: str = "gidx") -> DataFrame:
    """0-based position of every row in ``order`` (W9's global row number).

    Rows are bucketed by ranges of the first order column, numbered inside
    their bucket by a window partitioned on the bucket, and shifted by the
    running total of the sizes of the buckets before (a table with one row per
    bucket, broadcast).
    """
    b = order_bucket(df, order[0], n)
    local = b.withColumn("_local", F.row_number().over(Window.partitionBy("_b").orderBy(*order)) - 1)
    sizes = b.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    offs = sizes.select("_b", (F.sum("_n").over(Window.orderBy("_b")) - F.col("_n")).alias("_off"))
    return (local.join(F.broadcast(offs), "_b")
                 .withColumn(out, F.col("_off") + F.col("_local"))
                 .drop("_b", "_local", "_off"))


def prior_max(df: DataFrame, order: list[str], value: str, n: int | None = None,
              out: str = "prior_max", start: int | None = None) -> DataFrame:
    """Max of ``value`` over all rows strictly before each row in ``order``;
    ``start`` is the max over rows before the whole of ``df`` (earlier batches)."""
    b = order_bucket(df, order[0], n)
    per = b.groupBy("_b").agg(F.max(value).alias("_pmax"))
    before = per.select("_b", F.max("_pmax").over(
        Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)).alias("_carry"))
    w = Window.partitionBy("_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = b.withColumn("_in", F.max(value).over(w))
    return (inside.join(F.broadcast(before), "_b")
                  .withColumn(out, F.greatest("_in", "_carry", F.lit(start).cast("bigint")))
                  .drop("_b", "_in", "_carry"))


def keyed_order(df: DataFrame, key: str = "user_id", ts: str = "timestamp_ms", gap_ms: int | None = None,
                inclusive: bool = False, range_ms: int = KEYED_RANGE_MS) -> DataFrame:
    """Per-key position and gap sessions without a per-key window.

    Adds ``_pos`` (1-based position of the row in its key, by ts then
    event_id), ``_prev_ts`` (the key's previous event time) and, with
    ``gap_ms``, ``_sess`` (1-based session number; a session breaks when the gap
    to the previous row is > gap_ms, or >= with ``inclusive``).

    Rows are cut into fixed event-time ranges of ``range_ms`` (see
    :func:`time_bucket`), so a key holding a third of all rows is split into
    one piece per range. One window over (key, range) gives local positions
    and breaks; a (key, range) table gives each range its row offset, the
    previous range's last ts and the breaks before it. Rows with a null key are
    one key; a null time comes first in its key, as a session of its own.
    """
    b = df.withColumn("_rng", time_bucket(ts, range_ms))
    w = Window.partitionBy(key, "_rng").orderBy(ts, "event_id")
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    prev = F.lag(ts).over(w)

    def brk(gap: Column) -> Column:
        return (gap >= gap_ms) if inclusive else (gap > gap_ms)

    local = b.withColumn("_lpos", F.row_number().over(w)).withColumn("_lprev", prev)
    if gap_ms is not None:
        local = local.withColumn("_lb", F.when(F.col("_lprev").isNotNull() & brk(F.col(ts) - F.col("_lprev")), 1)
                                 .otherwise(0))
        local = local.withColumn("_lcum", F.sum("_lb").over(run))
    aggs = [F.count(F.lit(1)).alias("_n"), F.min(ts).alias("_first"), F.max(ts).alias("_last")]
    if gap_ms is not None:
        aggs.append(F.max("_lcum").alias("_inner"))
    per = local.groupBy(key, "_rng").agg(*aggs)
    ordr = Window.partitionBy(key).orderBy("_rng")
    before = ordr.rowsBetween(Window.unboundedPreceding, -1)
    per = (per.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
              .withColumn("_prev_last", F.lag("_last").over(ordr)))
    keep = [key, "_rng", "_off", "_prev_last"]
    if gap_ms is not None:
        fb = F.when(F.col("_prev_last").isNull() | brk(F.col("_first") - F.col("_prev_last")), 1).otherwise(0)
        per = per.withColumn("_fb", fb).withColumn(
            "_boff", F.coalesce(F.sum(F.col("_fb") + F.col("_inner")).over(before), F.lit(0)))
        keep += ["_fb", "_boff"]
    j = join_null_safe(local, per.select(*keep), [key, "_rng"])
    j = (j.withColumn("_pos", F.col("_off") + F.col("_lpos"))
          .withColumn("_prev_ts", F.coalesce(F.col("_lprev"), F.col("_prev_last"))))
    if gap_ms is not None:
        j = j.withColumn("_sess", F.col("_boff") + F.col("_fb") + F.col("_lcum"))
    return j.drop("_rng", "_lpos", "_lprev", "_lb", "_lcum", "_off", "_prev_last", "_fb", "_boff")


#: Rows that one piece of a key may hold if the key had all rows (see :func:`piece_width`).
PIECE_ROWS = 1_000_000


def piece_width(df: DataFrame, ts: str = "timestamp_ms", rows: int = PIECE_ROWS) -> int:
    """Width of event-time pieces of which none would hold many more than ``rows``
    rows even if all rows were one key's (for times spread evenly): small tables are
    one piece a key, large ones are cut finely. One pass for three numbers."""
    lo, hi, n = df.agg(F.min(ts), F.max(ts), F.count(F.lit(1))).first()
    return max(1, (hi - lo) // max(1, -(-n // rows)) + 1) if lo is not None else 1


def keyed_next(df: DataFrame, columns: list[str], key: str = "user_id", ts: str = "timestamp_ms", order: str = "event_id",
               range_ms: int | None = None) -> DataFrame:
    """Each row with ``next_<column>`` of its key's next row by (ts, order), without
    a window over a key.

    Inside an event-time piece the next row is a window of (key, piece) away. The
    last row of a piece takes the first row of the key's next piece, from a table of
    one row a (key, piece): a forward link across pieces. Rows with a null key are
    one key; rows without a time come first.
    """
    b = df.withColumn("_rng", time_bucket(ts, range_ms or piece_width(df, ts)))
    w = Window.partitionBy(key, "_rng").orderBy(ts, order)
    row = F.struct(*(F.col(c) for c in columns))
    local = b.withColumn("_next", F.lead(row).over(w))
    firsts = b.groupBy(key, "_rng").agg(F.min_by(row, F.struct(ts, order)).alias("_first"))
    later = firsts.select(key, "_rng", F.lead("_first").over(Window.partitionBy(key).orderBy("_rng")).alias("_later"))
    out = join_null_safe(local, later, [key, "_rng"]).withColumn("_next", F.coalesce("_next", "_later"))
    return out.select(*df.columns, *(F.col(f"_next.{c}").alias(f"next_{c}") for c in columns))


def count_windows(df: DataFrame, order: list[str], size: int = 100) -> DataFrame:
    """Consecutive chunks of ``size`` rows in ``order`` (``chunk`` = gidx // size)."""
    return global_index(df, order).withColumn("chunk", F.floor(F.col("gidx") / size).cast("bigint"))


def late_lanes(df: DataFrame, arrival: str = "arrival_ms", event: str = "timestamp_ms",
               bound_ms: int = 5 * MINUTE_MS, allowed_ms: int = 5 * MINUTE_MS, seen_ms: int | None = None) -> DataFrame:
    """on_time / allowed / too_late against the watermark of the rows that
    arrived before (max event time seen minus ``bound_ms``); too-late rows are
    kept and tagged, never dropped. ``seen_ms``: the max event time of all
    earlier batches, when ``df`` is a batch of a stream."""
    m = prior_max(df, [arrival, "event_id"], event, out="_seen", start=seen_ms)
    t, seen = F.col(event), F.col("_seen")
    lane = (F.when(seen.isNull() | (t >= seen - bound_ms), F.lit("on_time"))
            .when(t >= seen - (bound_ms + allowed_ms), F.lit("allowed"))
            .otherwise(F.lit("too_late")))
    return m.withColumn("lane", lane).withColumn("watermark_ms", seen - bound_ms).drop("_seen")


def tumble(df: DataFrame, size_ms: int, key: str = "user_id", ts: str = "timestamp_ms") -> DataFrame:
    """Event-time tumbling windows per key; start/end in epoch ms."""
    start = F.col(ts) - F.pmod(F.col(ts), F.lit(size_ms))
    return df.withColumn("window_start_ms", start).withColumn("window_end_ms", start + size_ms)


def tumble_counts(df: DataFrame, size_ms: int, key: str = "user_id") -> DataFrame:
    return (tumble(df, size_ms, key).groupBy(key, "window_start_ms", "window_end_ms")
            .agg(F.count(F.lit(1)).alias("n_events")))


def session_events(df: DataFrame, size_ms: int = MINUTE_MS, key: str = "user_id") -> DataFrame:
    """(category, event_type) list per key and tumbling window, in event order."""
    items = F.collect_list(F.struct("timestamp_ms", "event_id", "category", "event_type"))
    return (tumble(df, size_ms, key).groupBy(key, "window_start_ms", "window_end_ms")
            .agg(F.array_sort(items).alias("_items"))
            .withColumn("items", F.array_join(F.transform(
                "_items", lambda x: F.concat_ws(":", x["category"], x["event_type"])), ","))
            .drop("_items"))


def sessions(df: DataFrame, gap_ms: int, key: str = "user_id", ts: str = "timestamp_ms") -> DataFrame:
    """Gap sessions per key. Events exactly ``gap_ms`` apart stay in one
    session; a session ends ``gap_ms`` after its last event (the semantics of
    ``session_window``, expressed on the batch table). Session numbers come
    from :func:`keyed_order`, and the per-session aggregate combines map-side,
    so a hot key is never one task."""
    s = keyed_order(df, key, ts, gap_ms, inclusive=False).withColumnRenamed("_sess", "session_no")
    return (s.groupBy(key, "session_no")
            .agg(F.min(ts).alias("session_start_ms"), (F.max(ts) + gap_ms).alias("session_end_ms"),
                 F.count(F.lit(1)).alias("n_events")))


def sessions_streaming(df: DataFrame, gap: str, key: str = "user_id") -> DataFrame:
    """X4 for a stream: Spark's ``session_window`` on the event-time column."""
    return (df.groupBy(key, F.session_window("event_time", gap).alias("s"))
            .agg(F.count(F.lit(1)).alias("n_events"))
            .select(key, F.unix_millis(F.col("s.start")).alias("session_start_ms"),
                    F.unix_millis(F.col("s.end")).alias("session_end_ms"), "n_events"))


def dedup(df: DataFrame, id_col: str = "event_id", order: str = "arrival_ms") -> DataFrame:
    """Keep the first delivery of each id (earliest ``order``, then the
    smallest remaining columns, so the choice is deterministic).

    An aggregate, not a window: ``min(struct(order, ...))`` combines map-side,
    so even an id delivered millions of times ships one row per map partition.
    """
    rest = [c for c in df.columns if c not in (id_col, order)]
    first = F.min(F.struct(F.col(order), *[F.col(c) for c in rest])).alias("_first")
    return df.groupBy(id_col).agg(first).select(id_col, "_first.*").select(*df.columns)


def redeliveries(df: DataFrame, every: int = 7, delay_ms: int = 90_000) -> DataFrame:
    """At-least-once delivery of the test events: every ``every``-th message is
    delivered twice, the copy ``delay_ms`` later (adds rows, drops none)."""
    copies = df.filter(F.col("event_id") % every == 0).withColumn(
        "arrival_ms", F.col("arrival_ms") + delay_ms)
    return df.unionByName(copies)


def event_time_text(ms: Column) -> Column:
    return F.date_format(ms_to_ntz(ms), "yyyy-MM-dd HH:mm:ss")
