"""Properties: skew-safe forms equal the plain forms; lanes partition the input; A1's last = A2."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from eventide.operators import features as FE
from eventide.operators import lanes as LN
from eventide.operators import windows as WN
from eventide.sources import derived as D
from eventide.sources.events import events_from_tables


def _rows(df, cols):
    return sorted(tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in df.select(*cols).collect())


def test_blocked_frame_equals_single_block(spark):
    ev = events_from_tables(spark, SF_SMALL)
    cols = ["event_id", "hist_session", "gap_minutes"] + FE.FEATURES
    small = FE.features_online(ev, limit=5, block=7)      # many blocks, context rows in play
    big = FE.features_online(ev, limit=5)
    assert _rows(small, cols) == _rows(big, cols)


def test_keyed_order_independent_of_ranges(spark):
    ev = events_from_tables(spark, SF_SMALL)
    cols = ["event_id", "_pos", "_prev_ts", "_sess"]
    one = WN.keyed_order(ev, gap_ms=6 * 3600 * 1000, range_ms=10**13)
    many = WN.keyed_order(ev, gap_ms=6 * 3600 * 1000, range_ms=3_600_000)
    assert _rows(one, cols) == _rows(many, cols)


def test_running_count_last_equals_user_counts(spark):
    ev = events_from_tables(spark, SF_SMALL)
    last = FE.running_count(ev, range_ms=3_600_000).groupBy("user_id").agg(F.max("event_count").alias("event_count"))
    assert _rows(last, ["user_id", "event_count"]) == _rows(FE.user_counts(ev), ["user_id", "event_count"])


def test_retry_route_independent_of_ranges(spark):
    ev = events_from_tables(spark, SF_SMALL)
    f = F.col("event_type") == "error"
    cols = ["event_id", "retry_count", "route"]
    assert _rows(LN.retry_route(ev, f, range_ms=10**13), cols) == _rows(LN.retry_route(ev, f, range_ms=600_000), cols)


def test_lanes_partition_the_input(spark):
    raw = D.raw_events(events_from_tables(spark, SF_SMALL))
    lanes = LN.fanout_lanes(raw, D.scoring_fails())
    assert all(not lane.isEmpty() for lane in lanes.values())
    routed = {r.event_id for name in ("success", "dlq", "retry") for r in lanes[name].select("event_id").collect()}
    invalid = {r.event_id for r in lanes["validation_errors"].select("event_id").distinct().collect()}
    all_ids = {r.event_id for r in raw.select("event_id").collect()}
    assert routed.isdisjoint(invalid)
    assert routed | invalid == all_ids


def test_next_expiry_independent_of_pieces(spark):
    from eventide.operators import score as SC
    ev = events_from_tables(spark, SF_SMALL)
    ttl = 12 * 3600 * 1000
    a = SC.next_expiry(ev, ttl, range_ms=10**13)       # one piece per user
    b = SC.next_expiry(ev, ttl, range_ms=3_600_000)    # hourly pieces
    assert _rows(a, ["event_id", "nxt"]) == _rows(b, ["event_id", "nxt"])
