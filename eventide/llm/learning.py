"""What the two classifiers share: labelled rows, a bounded training sample and
statistics of texts.

Labels come only from rows whose id is not held out. Where the training rows are
more than ``max_rows`` (a parameter), the ones with the smallest hash of the id
are used; scoring always covers every row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import held_out, texts_of

#: Bound of the training sample, in documents.
MAX_ROWS = 12_000


def training_rows(docs: DataFrame, labels: DataFrame, target: str, max_rows: int = MAX_ROWS) -> DataFrame:
    """doc_id, text, label (0.0 or 1.0), part (0 to 9, by hash of the id) of the
    training sample. Of several labels of an id the largest counts, of several
    texts each is a row; null ids and null labels are left out of training."""
    lab = (labels.select(F.col("doc_id"), F.col(target).alias("label"))
           .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("doc_id")))
           .groupBy("doc_id").agg(F.max("label").cast("double").alias("label"))
           .withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(10)))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    # at most max_rows rows of two numbers
    return texts_of(docs).join(F.broadcast(lab), "doc_id")


def class_counts(rows: DataFrame) -> tuple[int, int]:
    got = rows.agg(F.count("*"), F.sum("label")).first()
    return int(got[0]), int(got[1] or 0)
