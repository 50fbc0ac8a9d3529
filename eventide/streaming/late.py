"""X3 on a stream: late rows as a side output, tagged and kept.

Spark's own watermark drops late rows without a trace. Here every micro-batch is
classified against the greatest event time of all rows that arrived before, which
is carried from batch to batch in the manifests of a committed folder: state and
output appear together, and a replayed batch changes neither.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.windows import MINUTE_MS, late_lanes
from ..sources.commits import CommittedFolder


class LateLanes:
    """A ``foreachBatch`` sink with the lanes on_time, allowed and too_late."""

    def __init__(self, spark: SparkSession, root: str, bound_ms: int = 5 * MINUTE_MS, allowed_ms: int = 5 * MINUTE_MS,
                 arrival: str = "arrival_ms", event: str = "timestamp_ms"):
        self.folder = CommittedFolder(spark, root)
        self.bound_ms, self.allowed_ms, self.arrival, self.event = bound_ms, allowed_ms, arrival, event
        self.schema: T.StructType | None = None

    def merge(self, batch: DataFrame, batch_id: int) -> None:
        """Classify a micro-batch (rows in any order; arrival order decides)."""
        self.schema = batch.schema
        if self.folder.is_committed(batch_id):
            return
        seen = (self.folder.before(batch_id) or {}).get("seen_ms")
        lanes = late_lanes(batch, self.arrival, self.event, self.bound_ms, self.allowed_ms, seen_ms=seen)
        self.folder.write(lanes, batch_id, ["lane"])
        newest = [x for x in (seen, batch.agg(F.max(self.event)).first()[0]) if x is not None]
        self.folder.commit(batch_id, {"seen_ms": max(newest, default=None)})

    def read(self) -> DataFrame:
        """All rows of committed batches with ``lane`` and ``watermark_ms``."""
        schema = T.StructType([*self.schema.fields, T.StructField("watermark_ms", T.LongType()), T.StructField("lane", T.StringType())])
        return self.folder.read(schema)
