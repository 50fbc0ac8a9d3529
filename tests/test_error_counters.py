"""A5 counts by the whole rule, the value it names included, as the monitor's labels do."""
from collections import Counter

from pyspark.sql import functions as F

from eventide.plans.queries import fanout, q_error_counters


def test_counted_by_the_whole_rule(spark, tmp_path):
    spark.range(400).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(F.lit(1706000000) + F.col("id")).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 7).alias("user_id"), F.element_at(F.array(*map(F.lit, ("view", "error", "signup"))), (F.col("id") % 3 + 1).cast("int")).alias("event_type"),
        (F.col("id") % 50).cast("double").alias("value"), F.format_string('{"k": %d}', F.col("id") % 9).alias("props"),
    ).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    d = str(tmp_path)
    want = Counter((r.field, r.validation_rule) for r in fanout(spark, d)["validation_errors"].collect())
    got = {(r.label_a, r.label_b): r.n for r in q_error_counters(spark, d).where("counter = 'validation_errors_total'").collect()}
    assert got == want
    assert len({rule for _, rule in got if rule.startswith("Invalid event_type")}) > 1
