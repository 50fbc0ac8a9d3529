"""The per-user history store, kept up to date batch by batch.

The store holds the newest ``limit`` events of every user, in buckets by a hash of
the user. A micro-batch is merged into the buckets it touches and no others: the
touched buckets' rows and the batch's (trimmed to ``limit`` a user before they are
shuffled, so a hot user ships ``limit`` rows a partition) are trimmed again and
written as those buckets' new version. The batch's manifest names the current
version of every bucket and the greatest event time so far.

A history expires ``ttl_ms`` after its last write: rows before a gap of ``ttl_ms``
belong to an older, expired history. An event that is late within ``late_ms`` may
still fall into a gap and bridge it, so a row is dropped for a gap only once no
such event can come; readers apply the rest of the rule (``history``).
So the store's content after any batches, in any order of arrival within
``late_ms``, is what the batch window gives over the same events.

A replayed batch that is committed is skipped; an attempt killed before its commit
leaves files that nobody reads and that the replay replaces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.features import HISTORY_LIMIT, HISTORY_TTL_MS, history_as_of, last_n
from ..sources.commits import CommittedFolder

BUCKETS = 64
LATE_MS = 10 * 60_000


class HistoryStore:
    """The store under ``root``. ``columns`` are kept of each event besides
    user_id, event_id and timestamp_ms."""

    def __init__(self, spark: SparkSession, root: str, columns: tuple[str, ...] = ("event_type", "category"), buckets: int = BUCKETS,
                 limit: int = HISTORY_LIMIT, ttl_ms: int = HISTORY_TTL_MS, late_ms: int = LATE_MS):
        self.spark, self.folder = spark, CommittedFolder(spark, root)
        self.columns, self.buckets, self.limit, self.ttl_ms, self.late_ms = columns, buckets, limit, ttl_ms, late_ms
        self.schema = T.StructType([T.StructField("user_id", T.StringType()), T.StructField("event_id", T.LongType()),
                                    T.StructField("timestamp_ms", T.LongType()), *(T.StructField(c, T.StringType()) for c in columns),
                                    T.StructField("bucket", T.IntegerType())])

    def _versions(self, versions: dict[str, int], touched: list[int] | None = None) -> DataFrame:
        """The current rows of buckets (of the touched ones only, if given)."""
        wanted = versions if touched is None else {str(b): versions[str(b)] for b in touched if str(b) in versions}
        paths = [f"{self.folder.batch_dir(v)}/in_bucket={b}" for b, v in sorted(wanted.items())]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def merge(self, batch: DataFrame, batch_id: int) -> None:
        """``foreachBatch`` function: events (user_id, event_id, timestamp_ms, ...) into the store."""
        if self.folder.is_committed(batch_id):
            return
        known = self.folder.before(batch_id) or {"versions": {}, "newest_ms": None}
        rows = batch.where(F.col("timestamp_ms").isNotNull()).select(
            "user_id", "event_id", "timestamp_ms", *self.columns,
            F.pmod(F.hash("user_id"), F.lit(self.buckets)).alias("bucket"))
        found = rows.groupBy("bucket").agg(F.max("timestamp_ms").alias("newest")).collect()  # at most one row a bucket
        touched = sorted(r["bucket"] for r in found)
        times = [r["newest"] for r in found] + ([known["newest_ms"]] if known["newest_ms"] is not None else [])
        newest = max(times, default=None)
        versions = {b: v for b, v in known["versions"].items() if int(b) not in touched}
        if touched:
            both = self._versions(known["versions"], touched).unionByName(last_n(rows, self.limit).drop("pos"))
            self.folder.write(self._trimmed(both.repartition("bucket"), newest - self.late_ms).withColumn("in_bucket", F.col("bucket")),
                              batch_id, ["in_bucket"])
            versions |= {str(b): batch_id for b in self._written(batch_id)}
        self.folder.commit(batch_id, {"versions": versions, "newest_ms": newest})
        self._vacuum(batch_id)

    def _written(self, batch_id: int) -> list[int]:
        """Buckets of which a batch's version holds rows."""
        fs, path = self.folder._fs, self.folder._path
        names = [s.getPath().getName() for s in fs.listStatus(path(self.folder.batch_dir(batch_id)))]
        return [int(n.partition("=")[2]) for n in names if n.startswith("in_bucket=")]

    def _trimmed(self, rows: DataFrame, settled_ms: int) -> DataFrame:
        """The newest ``limit`` rows of each user, less those before a settled gap,
        and without users whose history has expired for good. ``rows`` are
        partitioned by bucket, so neither window moves them."""
        newest_first = Window.partitionBy("bucket", "user_id").orderBy(F.col("timestamp_ms").desc(), F.col("event_id").desc())
        upto = newest_first.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        newer = F.lag("timestamp_ms").over(newest_first)
        gap = (newer - F.col("timestamp_ms") >= self.ttl_ms) & (newer <= settled_ms)
        gone = newer.isNull() & (F.lit(settled_ms) - F.col("timestamp_ms") >= self.ttl_ms)
        return (rows.withColumn("_pos", F.row_number().over(newest_first)).where(F.col("_pos") <= self.limit)
                .withColumn("_cut", F.coalesce(gap | gone, F.lit(False)).cast("int")).withColumn("_cuts", F.max("_cut").over(upto))
                .where("_cuts = 0").drop("_pos", "_cut", "_cuts"))

    def _vacuum(self, batch_id: int) -> None:
        """Remove versions that neither this manifest nor the one before names."""
        last = [b for b in self.folder.committed() if b <= batch_id][-2:]
        named = {(int(v), int(b)) for k in last for b, v in self.folder.facts(k)["versions"].items()}
        fs, path = self.folder._fs, self.folder._path
        where = path(f"{self.folder.root}/data")
        for s in fs.listStatus(where) if fs.exists(where) else ():
            v = int(s.getPath().getName().partition("=")[2])
            own = self._written(v) if v <= batch_id else []
            dead = [b for b in own if (v, b) not in named]
            for b in dead:
                self.folder.remove(f"{self.folder.batch_dir(v)}/in_bucket={b}")
            if v < batch_id and len(dead) == len(own):
                self.folder.remove(self.folder.batch_dir(v))

    def rows(self) -> DataFrame:
        """All rows of the store as of its last committed batch."""
        done = self.folder.committed()
        return self._versions(self.folder.facts(done[-1])["versions"] if done else {}).drop("bucket")

    def history(self, as_of_ms: int) -> DataFrame:
        """Each user's history at ``as_of_ms`` (not before the last event)."""
        return history_as_of(self.rows(), as_of_ms, self.limit, self.ttl_ms)
