"""A folder of micro-batch outputs in which a batch counts once its manifest is there.

Spark may run a micro-batch more than once (a restart, a lost driver) and may die
in the middle of one. Each batch writes its own sub-folder, replacing whatever an
earlier attempt left there, and then appears at once, by renaming a manifest file.
Readers take committed batches only: what a killed attempt has written is not seen,
and a replayed batch that is committed already is not written again. A manifest may
carry small facts for the next batch (the greatest event time so far, the current
version of each bucket), so such state moves with the data, all or nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class CommittedFolder:
    """Batches under ``root`` on any file system that Spark knows."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def batch_dir(self, batch_id: int) -> str:
        return f"{self.root}/data/batch={batch_id}"

    def _manifest(self, batch_id: int) -> str:
        return f"{self.root}/manifests/{batch_id}.json"

    def committed(self) -> list[int]:
        """Ids of the committed batches, ascending."""
        where = self._path(f"{self.root}/manifests")
        if not self._fs.exists(where):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(where)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def is_committed(self, batch_id: int) -> bool:
        return self._fs.exists(self._path(self._manifest(batch_id)))

    def facts(self, batch_id: int) -> dict:
        """What the manifest of a committed batch carries."""
        stream = self._fs.open(self._path(self._manifest(batch_id)))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def before(self, batch_id: int) -> dict | None:
        """The facts of the last committed batch before this one; None if it is the first."""
        earlier = [b for b in self.committed() if b < batch_id]
        return self.facts(earlier[-1]) if earlier else None

    def write(self, df: DataFrame, batch_id: int, partition_by: Iterable[str] = ()) -> None:
        """The batch's files; they do not count until ``commit``."""
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(self.batch_dir(batch_id))

    def commit(self, batch_id: int, facts: dict | None = None) -> None:
        """Make the batch visible, in one step."""
        temp = self._path(f"{self.root}/manifests/.{batch_id}-{uuid.uuid4().hex}")
        out = self._fs.create(temp, True)
        out.write(bytearray(json.dumps(facts or {}, sort_keys=True).encode()))
        out.close()
        if not self._fs.rename(temp, self._path(self._manifest(batch_id))):
            self._fs.delete(temp, False)
            if not self.is_committed(batch_id):
                raise OSError(f"cannot commit batch {batch_id} under {self.root}")

    def remove(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def read(self, schema: T.StructType) -> DataFrame:
        """The rows of all committed batches; ``batch`` is the batch id."""
        paths = [self.batch_dir(b) for b in self.committed()]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/data").parquet(*paths)


def exactly_once(spark: SparkSession, root: str, partition_by: Iterable[str] = (), between=None):
    """A ``foreachBatch`` function that adds each micro-batch to a committed folder
    exactly once. ``between(batch_id)`` runs after the files are written and before
    they count (tests kill the run there)."""
    folder = CommittedFolder(spark, root)

    def write(batch: DataFrame, batch_id: int) -> None:
        if folder.is_committed(batch_id):
            return
        folder.write(batch, batch_id, partition_by)
        if between is not None:
            between(batch_id)
        folder.commit(batch_id)
    return write
