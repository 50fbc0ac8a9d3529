"""The corpus pipeline: quality rules, near duplicates, repeated passages,
benchmark passages, token digests. Each stage reads what the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm import bpe, chunkdedup, decontam, jaccard, repetition
from eventide.llm.runtime import discard, stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    return repetition.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component: the smallest id, rows without an id last, then
    the smallest text hash. Rows go by a key of their own (id and two hashes of the
    text), so rows that repeat an id, or have none, count by their texts; empty texts
    have no group and stay. Only keys are written, no texts."""
    text = F.coalesce("text", F.lit(""))
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.xxhash64(text).alias("h"),
                   F.xxhash64(F.lit("second"), text).alias("g"))
    groups = jaccard.jaccard_components(docs.select(key.alias("doc_id"), "text"))
    # a component's id is the smallest key in it; copies: rows with that key
    chosen = (groups.where("n_shingles = 0 or doc_id = component_id").groupBy("doc_id")
              .agg(F.count("*").alias("copies"), F.first("n_shingles").alias("words")).select("doc_id.*", "copies", "words"))
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"), key.alias("key")).select("doc", "key.*")

    def rows_of(keys: DataFrame) -> DataFrame:
        k = keys.select(*(F.col(c).alias(f"k_{c}") for c in ("id", "h", "g")))
        return whole.join(k, F.col("id").eqNullSafe(F.col("k_id")) & (F.col("h") == F.col("k_h")) & (F.col("g") == F.col("k_g")), "left_semi")

    repeated = F.expr("copies > 1 and words > 0")
    kept = rows_of(chosen.where(~repeated)).unionByName(rows_of(chosen.where(repeated)).dropDuplicates(["id", "h", "g"]))
    return kept.select("doc.*")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that stand earlier in the corpus; a document of
    which no word is left goes."""
    done = chunkdedup.dedup_substrings(docs).where("n_removed = 0 or text rlike '[^\\\\x20\\\\x09-\\\\x0D]'")
    left = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        left["n_chars"] = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("doc.n_chars")).cast("long")
    return done.select(*(left[c] if c in left else F.col(f"doc.`{c}`") for c in docs.columns)).toDF(*docs.columns)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    return decontam.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_digests(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of what is left."""
    return bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("quality rules", quality_rules), ("n-gram Jaccard join", near_duplicates), ("substring dedup", repeated_passages),
          ("benchmark decontamination", benchmark_passages), ("byte-level BPE", token_digests)]

#: Suffix arrays, similarity components and BPE are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; a stage's table is removed when the next one is written."""
    docs, written = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            before, docs = written, stored(docs, f"stage{k + 1}")
            written = docs
            if before is not None:
                discard(before)
    return docs
