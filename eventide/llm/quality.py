"""Quality classifier (operator 5): a sparse rule ensemble.

A forest of shallow trees is grown on text statistics; every path from a root
to a node is a conjunctive rule. Logistic weights of the rules are fitted with a
lasso penalty, and the rules that keep a weight are compiled into one Spark
column expression over the statistics.

Defined results: null or empty text has all statistics 0 and is scored like any
other; rows with null ids are scored; without training rows of both labels the
score is the share of label 1 (0 if none); repeated rows are scored row by row;
other columns are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .learning import MAX_ROWS, class_counts, training_rows
from .repetition import by_row, duplicate_lines
from .runtime import held_out, stored, texts_of
from .words import LOWER, SPACE_WORDS, mix, span_hashes, text_chunks, word_spans

STATS = ["log_words", "mean_word", "symbol_share", "marked_words", "capital_share", "shouted_share", "exclaims",
         "pipes", "digit_share", "dup_line_share", "words_a_line", "ended_lines", "distinct_share", "repeat_share",
         "short_words", "long_words", "comma_rate", "accent_share"]
#: (statistic, is it the upper side, threshold)
Condition = tuple[str, bool, float]


def statistics(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """rows x STATS of a run of texts."""
    start, end, first = word_spans(data, off, SPACE_WORDS)
    n = np.diff(first)
    row = np.repeat(np.arange(len(n)), n)
    per = lambda x: x / np.maximum(n, 1)
    inside = SPACE_WORDS[data]
    chars = np.maximum(by_row(inside, off), 1)
    upper = (data >= 0x41) & (data <= 0x5A)
    lower = (data >= 0x61) & (data <= 0x7A)
    symbol = np.isin(data, np.frombuffer(b"#*$%&|<>@^~=_{}\\", np.uint8))
    count = lambda flags: np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    up, low, sym = count(upper), count(lower), count(symbol)
    shouted = (up[end] - up[start] > 1) & (low[end] == low[start])
    marked = sym[end] > sym[start]
    lines, dups = duplicate_lines(data, off, inside)
    closes = np.isin(data, np.frombuffer(b".!?:;\"", np.uint8))
    at_end = np.zeros(len(data), dtype=bool)
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[off] = True
    at_end[:-1] = (data[1:] == 0x0A) | edge[1:len(data)]
    at_end[-1:] = True
    words = span_hashes(LOWER[data], start, end)
    key = mix(words + row.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    _, one = np.unique(key, return_index=True)
    pair = mix(key[:-1] * np.uint64(3) + key[1:]) if len(key) > 1 else key[:0]
    same = row[:-1] == row[1:] if len(key) > 1 else np.zeros(0, dtype=bool)
    pairs = np.bincount(row[:-1][same], minlength=len(n)) if len(pair) else np.zeros(len(n), np.int64)
    _, fresh = np.unique(pair[same], return_index=True)
    distinct_pairs = np.bincount(row[:-1][same][fresh], minlength=len(n)) if len(pair) else pairs
    size = end - start
    cols = [np.log1p(n), per(by_row(size, first)), by_row(symbol, off) / chars, per(by_row(marked, first)),
            by_row(upper, off) / chars, per(by_row(shouted, first)), per(by_row(data == 0x21, off)),
            per(by_row(data == 0x7C, off)), by_row((data >= 0x30) & (data <= 0x39), off) / chars,
            dups / np.maximum(lines, 1), n / np.maximum(lines, 1), by_row(closes & at_end, off) / np.maximum(lines, 1),
            per(np.bincount(row[one], minlength=len(n))), (pairs - distinct_pairs) / np.maximum(pairs, 1),
            per(by_row(size <= 3, first)), per(by_row(size > 12, first)), per(by_row(data == 0x2C, off)),
            by_row(data >= 0x80, off) / chars]
    return np.stack([np.asarray(c, dtype=np.float64) for c in cols], axis=1)


def statistics_frame(docs: DataFrame) -> DataFrame:
    """docs with ``text`` replaced by the statistics."""
    kept = [c for c in docs.columns if c != "text"]

    def run(batches):
        for b in batches:
            for lo, hi, data, off in text_chunks(b.column(b.schema.get_field_index("text"))):
                x = statistics(data, off)
                yield pa.record_batch([*(b.column(b.schema.get_field_index(c)).slice(lo, hi - lo) for c in kept),
                                       *(pa.array(np.ascontiguousarray(c)) for c in x.T)], [*kept, *STATS])

    types = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in kept)
    return docs.mapInArrow(run, types + ", " + ", ".join(f"{f} double" for f in STATS))


_SPLIT = re.compile(r"^( *)(?:If|Else) \(feature (\d+) (<=|>) ([-+0-9.eE]+)\)$")


def tree_rules(debug: str) -> list[tuple[Condition, ...]]:
    """The paths to all nodes of the trees that Spark prints, each as the
    conditions along it; doubled conditions on one side keep the tighter one."""
    rules, path = {}, []
    for line in debug.splitlines():
        if m := _SPLIT.match(line):
            depth = len(m[1])
            path = [p for p in path if p[0] < depth] + [(depth, (STATS[int(m[2])], m[3] == ">", float(m[4])))]
            tight: dict[tuple[str, bool], float] = {}
            for _, (name, above, at) in path:
                old = tight.get((name, above))
                tight[name, above] = at if old is None else (max if above else min)(old, at)
            rules[tuple(sorted((*k, v) for k, v in tight.items()))] = None
        elif line.lstrip().startswith("Tree "):
            path = []
    return list(rules)


def rule_column(rule: tuple[Condition, ...]) -> Column:
    out = F.lit(True)
    for name, above, at in rule:
        out = out & ((F.col(name) > at) if above else (F.col(name) <= at))
    return out


class RuleEnsemble:
    """Intercept and the rules with a weight."""

    def __init__(self, intercept: float, weighted: list[tuple[tuple[Condition, ...], float]]):
        self.intercept, self.weighted = intercept, weighted

    def score(self) -> Column:
        z = F.lit(self.intercept)
        for rule, weight in self.weighted:
            z = z + F.when(rule_column(rule), weight).otherwise(0.0)
        return 1 / (1 + F.exp(-z))


def fit_rules(known: DataFrame, n_trees: int = 24, depth: int = 3, lasso: float = 0.002) -> RuleEnsemble:
    """From rows with STATS and label: grow the forest, take its paths as rules
    and fit the lasso logistic weights."""
    vec = VectorAssembler(inputCols=STATS, outputCol="x")
    forest = RandomForestClassifier(featuresCol="x", labelCol="label", numTrees=n_trees, maxDepth=depth,
                                    subsamplingRate=0.7, featureSubsetStrategy="onethird", seed=3).fit(vec.transform(known))
    rules = tree_rules(forest.toDebugString)
    if not rules:
        n, good = class_counts(known)
        return RuleEnsemble(float(np.log((good + 0.5) / (n - good + 0.5))), [])
    flags = known.select("label", *(rule_column(r).cast("double").alias(f"r{k}") for k, r in enumerate(rules)))
    flags = VectorAssembler(inputCols=[f"r{k}" for k in range(len(rules))], outputCol="r").transform(flags).select("label", "r")
    lasso_fit = LogisticRegression(featuresCol="r", labelCol="label", elasticNetParam=1.0, regParam=lasso, maxIter=60,
                                   standardization=False).fit(flags)
    weights = lasso_fit.coefficients.toArray()
    return RuleEnsemble(float(lasso_fit.intercept), [(r, float(w)) for r, w in zip(rules, weights) if abs(w) > 1e-6])


def score_quality(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """One row a document: doc_id, held_out, score, predicted (score >= 0.3)."""
    sample = training_rows(docs, labels, "quality", max_rows)
    known = stored(statistics_frame(sample.select("text", "label").repartition(6)), "quality-sample")
    base = texts_of(docs).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    n, good = class_counts(known)
    if good in (0, n):
        scored = base.withColumn("score", F.lit(good / n if n else 0.0))
    else:
        scored = statistics_frame(base).withColumn("score", fit_rules(known).score())
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
