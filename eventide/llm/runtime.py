"""Session helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a local master (tests) may run without the setting; it gets a fresh
    folder of its own. On a cluster a missing setting is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        known = spark.sparkContext.getCheckpointDir()
        if known:
            return known.replace("file:/", "file:///", 1) if known.startswith("file:/") and known[6] != "/" else known
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="llm-shared-")
        spark.sparkContext.setCheckpointDir(base)
        return base
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(base)
    return base


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder; the caller writes it."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


#: Paths that the open scope removes at its end, then those of the scopes around it.
_OPEN: contextvars.ContextVar[tuple[list[str], ...]] = contextvars.ContextVar("open_scopes", default=())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system, whatever the file system."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextlib.contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Tables that ``stored`` writes inside are removed at the end, but for those
    that outlive it: they belong to the scope around, or to the caller. An operator
    whose steps are tables stores its output so and leaves nothing else behind."""
    held: list[str] = []
    token = _OPEN.set((held, *_OPEN.get()))
    try:
        yield
    finally:
        _OPEN.reset(token)
        for path in held:
            remove(spark, path)


def stored(df: DataFrame, name: str, outlives: bool = False) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: cuts the
    lineage, and survives the loss of any executor."""
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    owner = _OPEN.get()[1:] if outlives else _OPEN.get()
    if owner:
        owner[0].append(path)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(df: DataFrame) -> None:
    """Remove a table that ``stored`` returned, once nothing reads it any more."""
    path = df._stored_at
    for held in _OPEN.get():
        if path in held:
            held.remove(path)
    remove(df.sparkSession, path)


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns the operators need, under fixed names; other columns
    of the input, whatever their names, play no part. Null text becomes empty."""
    return docs.select(F.col(id_col).alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def held_out(doc_id) -> F.Column:
    """Rows kept out of training: crc32 of the id as text, mod 5, is 0.
    A null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
