"""Benchmark decontamination (operator 9), in DataFrame functions only.

The distinct normalised windows of the benchmark (10 words; a shorter item is
one window) become a hash set that every task holds. Each window of a training
text is hashed and looked up; a hit is verified against the window's words. The
set is held in tasks only up to ``MAX_SET`` windows, which is counted first;
beyond it the hashes of all text windows are joined by shuffle instead.

Defined results: null or empty text has no words and no hits; an item without
words has no windows; an item with a null id can hit words but is not listed;
repeated rows are scanned row by row; an empty benchmark hits nothing; other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import texts_of

WINDOW = 10
#: Largest number of benchmark windows held as a set in every task.
MAX_SET = 100_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Lower-cased (A-Z) words of a text."""
    return F.filter(F.split(F.translate(text, _UPPER, _LOWER), _GAP), lambda w: w != "")


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """item_id, size, window (words with single spaces), h of all item windows."""
    w = benchmark.select("item_id", words(F.coalesce("text", F.lit(""))).alias("w")).where(F.size("w") > 0)
    size = F.least(F.size("w"), F.lit(WINDOW))
    each = F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - size + 1), lambda i: F.slice("w", i, size)))
    return (w.select("item_id", each.alias("v")).distinct()
            .select("item_id", F.size("v").alias("size"), F.array_join("v", " ").alias("window"), F.xxhash64("v").alias("h")))


def _hits_in_set(by_size: dict[int, list]) -> Column:
    """Array of (at, size, window) of the hits of column ``w``; at counts from 1."""
    parts = []
    for size, rows in sorted(by_size.items()):
        # plain numbers as SQL text: one set in the plan, not one call a window
        numbers = ",".join(f"{r['h']}L" if r["h"] != -(1 << 63) else "-9223372036854775807L - 1L" for r in rows)
        parts.append(f"""transform(filter(if(size(w) >= {size}, sequence(1, size(w) - {size - 1}), array()),
            i -> xxhash64(slice(w, i, {size})) in ({numbers})),
            i -> struct(i as at, {size} as size, array_join(slice(w, i, {size}), ' ') as window))""")
    return F.expr(f"concat({', '.join(parts)})")


def _all_windows(size: int) -> Column:
    """Array of (at, size, h, window) of all windows of column ``w``; at counts from 1."""
    spots = F.when(F.size("w") >= size, F.sequence(F.lit(1), F.size("w") - (size - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(spots, lambda i: F.struct(
        i.alias("at"), F.lit(size).alias("size"), F.xxhash64(F.slice("w", i, size)).alias("h"),
        F.array_join(F.slice("w", i, size), " ").alias("window")))


def find_hits(docs: DataFrame, benchmark: DataFrame, max_set: int = MAX_SET) -> DataFrame:
    """One row a document: doc_id, text_hash, n_words, hit_words (places of hit words from 0,
    ascending), item_ids (sorted as strings)."""
    wins = benchmark_windows(benchmark)
    known = wins.select("size", "h").distinct()
    base = texts_of(docs).select("doc_id", F.xxhash64("text").alias("text_hash"),
                                 F.monotonically_increasing_id().alias("row"), words(F.col("text")).alias("w"))
    if known.count() <= max_set:
        by_size: dict[int, list] = {}
        for r in known.collect():  # at most max_set rows of two numbers
            by_size.setdefault(r["size"], []).append(r)
        empty = F.expr("cast(array() as array<struct<at:int,size:int,window:string>>)")
        found = base.select("doc_id", "text_hash", "row", F.size("w").alias("n_words"),
                            (_hits_in_set(by_size) if by_size else empty).alias("hits"))
        each = found.select("doc_id", "text_hash", "row", "n_words", F.explode_outer("hits").alias("hit"))
    else:
        sizes = [r[0] for r in known.select("size").distinct().collect()]
        spots = F.flatten(F.array(*map(_all_windows, sizes)))
        spread = base.select("doc_id", "text_hash", "row", F.size("w").alias("n_words"), F.explode_outer(spots).alias("hit"))
        hashes = known.select(F.col("size").alias("_s"), F.col("h").alias("_h")).withColumn("_known", F.lit(True))
        each = (spread.join(hashes, (F.col("hit.size") == F.col("_s")) & (F.col("hit.h") == F.col("_h")), "left")
                .groupBy("doc_id", "text_hash", "row", "n_words")
                .agg(F.collect_list(F.when(F.col("_known"), F.struct("hit.at", "hit.size", "hit.window"))).alias("hits"))
                .select("doc_id", "text_hash", "row", "n_words", F.explode_outer("hits").alias("hit")))
    # the words themselves decide; the items of one window are gathered once
    items = wins.groupBy("window").agg(F.collect_set(F.col("item_id").cast("string")).alias("ids"))
    # rows without a hit get a key of their own that nothing matches, so they stay spread out
    each = each.withColumn("key", F.coalesce("hit.window", F.concat(F.lit("\n"), F.col("row").cast("string"))))
    hit = (each.join(items, F.col("key") == F.col("window"), "left")
           .select("doc_id", "text_hash", "row", "n_words", F.when(F.col("ids").isNotNull(), F.col("hit")).alias("hit"), "ids"))
    spans = F.transform(F.collect_list(F.struct("hit.at", "hit.size")),
                        lambda s: F.when(s["at"].isNotNull(), F.sequence(s["at"] - 1, s["at"] + s["size"] - 2)))
    return (hit.groupBy("doc_id", "text_hash", "row", "n_words")
            .agg(F.array_sort(F.array_distinct(F.flatten(F.filter(spans, lambda s: s.isNotNull())))).alias("hit_words"),
                 F.array_sort(F.array_distinct(F.flatten(F.collect_set("ids")))).alias("item_ids"))
            .select("doc_id", "text_hash", "n_words", "hit_words", "item_ids"))


def contamination(docs: DataFrame, benchmark: DataFrame, max_set: int = MAX_SET) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document."""
    return find_hits(docs, benchmark, max_set).select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), F.size("hit_words").cast("long").alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hit_words") > 0).alias("contaminated"))


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, with all their columns, that hold no window of the benchmark."""
    bad = (find_hits(docs, benchmark).where(F.size("hit_words") > 0)
           .select(F.col("doc_id").alias("_bad_id"), F.col("text_hash").alias("_bad_text")).distinct())
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_bad_id"])
                     & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == bad["_bad_text"]), "left_anti")


def without_spans(text: Column, hit_words: Column) -> Column:
    """The text without the given words (places from 0) and what stands between
    two that follow each other."""
    piece = F.regexp_extract_all(text, F.lit(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), F.lit(0))
    odd = F.when(text.rlike(r"^[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"), 1).otherwise(0)

    def kept(p, k):
        at = F.floor((k - odd) / 2).cast("int")
        is_word = F.pmod(k - odd, F.lit(2)) == 0
        gone = F.array_contains(hit_words, at)
        return F.when(is_word, ~gone).otherwise(~(gone & F.array_contains(hit_words, at + 1)))
    return F.array_join(F.filter(piece, kept), "")
