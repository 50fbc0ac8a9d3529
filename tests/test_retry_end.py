"""W8 on events so dense that retries are pending when the input ends."""
from pyspark.sql import functions as F

from eventide.operators import lanes as LN
from eventide.plans.queries import q_retry_replay, q_retry_state
from eventide.sources.events import events_from_tables


def test_retries_pending_at_the_end_are_replayed(spark, tmp_path):
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet").limit(300)
    kind = e.schema["ts"].dataType
    dense = (F.timestamp_seconds(F.lit(1706000000) + F.col("event_id") % 200)).cast(kind)
    e.withColumn("ts", dense).withColumn("event_type", F.when(F.col("event_id") % 2 == 0, "error").otherwise("view")) \
        .coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    d = str(tmp_path)
    want = LN.retry_route(events_from_tables(spark, d), F.col("event_type") == "error")
    pending = {r["user_id"]: r["n"] for r in want.where("route = 'retry'").groupBy("user_id").agg(F.count("*").alias("n")).collect()}
    got = {r["user_id"]: r["n"] for r in q_retry_replay(spark, d).collect()}
    assert got == pending and pending
    assert q_retry_state(spark, d).count() == want.count()
