"""The registered queries of the operators, and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, chunkdedup, crosstoken, decontam, htmltext, idpack, jaccard, licenses, quality, repetition, toxicity, whitening
from .runtime import documents


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(documents(spark, sf_dir), _table(spark, sf_dir, "labels"))


def op2_idpack(spark: SparkSession, sf_dir: str) -> DataFrame:
    out_dir, manifest = idpack.write_shards(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"),
                                            public_tokenizers.PATTERN, end_id=2, special_as_text=False)
    return idpack.read_documents(spark, out_dir, manifest)


def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_join(documents(spark, sf_dir))


def op4_chunkdedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a document: what is left of its text, and the removed spans."""
    done = chunkdedup.dedup_substrings(documents(spark, sf_dir).select("doc_id", "text"))
    return done.select("doc.doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "spans",
                       F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(documents(spark, sf_dir), _table(spark, sf_dir, "labels"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.range(1).select(F.explode(F.array(
        *(F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(k).cast("long").alias("turn"), F.lit(role).alias("role"),
                   F.lit(said).alias("text")) for k, role in enumerate(("user", "assistant"))))).alias("r")).select("r.*")
    return chat.read_back(chat.format_conversations(rows.unionByName(more)))


def op8_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.quality_rules(documents(spark, sf_dir))


def op9_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(documents(spark, sf_dir), _table(spark, sf_dir, "benchmark"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(documents(spark, sf_dir))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op12_crosstoken(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosstoken.alignment_digests(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"),
                                        public_tokenizers.PATTERN, public_tokenizers.path("piece_bpe_32k.model"))


def op13_htmltext(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.main_text(_table(spark, sf_dir, "pages"))


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_idpack, op3_jaccard, op4_chunkdedup, op5_quality, op6_bpe, op7_chat,
                                   op8_repetition, op9_decontam, op10_licenses, op11_whitening,
                                   op12_crosstoken, op13_htmltext)}

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

_OP9 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS size,
          array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS v
        FROM b, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM win),
spots AS (SELECT r, size, i, array_to_string(w[i:i + size - 1], ' ') AS v
          FROM d, sizes, unnest(range(1, len(w) - size + 2)) AS t(i) WHERE len(w) >= size),
hits AS (SELECT r, s.i, s.size, item_id FROM spots s JOIN win USING (size, v)),
places AS (SELECT r, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + size)) AS t(p) GROUP BY r),
items AS (SELECT r, count(DISTINCT item_id) AS n_items,
            string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM hits GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (r) LEFT JOIN items USING (r)
"""

_CONTROL = r"(/?s>|/?SYS\]|/?INST\]|TURN |/TURN\])"
_OP7 = rf"""
WITH t AS (SELECT conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
m AS (SELECT *, CASE role WHEN 'user' THEN ' [/INST]' WHEN 'system' THEN ' [/SYS]' WHEN 'assistant' THEN ' </s>' ELSE ' [/TURN]' END AS close,
  CASE role WHEN 'user' THEN 10 WHEN 'system' THEN 6 WHEN 'assistant' THEN 1 ELSE 10 + length(role) END AS opens FROM t),
e AS (SELECT *, CASE WHEN position(close IN text) > 0 OR regexp_matches(text, '[<\[]\\+{_CONTROL}')
  THEN len(regexp_extract_all(text, '[<\[]\\*{_CONTROL}')) ELSE 0 END AS more FROM m)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  CAST(sum(opens + length(text) + more + length(close)) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

ORACLE = {"op7_chat": _OP7, "op9_decontam": _OP9}
