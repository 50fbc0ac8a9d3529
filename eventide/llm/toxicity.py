"""Toxicity (operator 1): gradient-boosted trees over dense features, calibrated
with isotonic regression.

The lexicon is learned: of the training rows' words and word beginnings of 4 to
6 bytes those that toxic rows have far more often than others (at most
``LEXICON_SIZE``, so its broadcast is bounded). Features of a text are densities
of lexicon hits, their nearness to second-person words, hits that show only
after common obfuscations are undone, capitals, punctuation and odd spellings.
Trees are fitted on seven tenths of the sample, the calibration on the rest.

Defined results: null or empty text has all features 0 and is scored like any
other; rows with null ids are scored (not held out unless crc32 of "" says so);
without training rows of both labels the score is the share of label 1 (0 if
none); repeated rows are scored row by row; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .learning import MAX_ROWS, class_counts, training_rows
from .repetition import by_row
from .runtime import held_out, stored, texts_of
from .words import LOWER, PLAIN_WORDS, span_hashes, text_chunks, word_spans

LEXICON_SIZE = 400
#: A stem must be in so many toxic rows, at such odds against the others.
MIN_ROWS, MIN_ODDS = 8, 6.0
STEMS = (4, 5, 6)
SECOND_PERSON = ("you", "your", "yours", "yourself", "u", "ur", "tu", "te", "ti", "toi", "ton", "ta", "tes", "vous",
                 "votre", "vos", "du", "dich", "dir", "dein", "deine", "ihr", "euch", "usted", "ustedes", "vosotros")
FEATURES = ["hits", "hit_density", "distinct_hits", "near_second_person", "second_person_density", "hidden_hits",
            "capital_share", "shouted_share", "exclaims", "questions", "punctuation_share", "inner_symbols",
            "inner_digits", "stretched", "lone_letters", "mean_word", "log_words"]

#: Obfuscations undone: digits and signs that stand for letters.
_CLEAR = LOWER.copy()
for _a, _b in zip(b"013457@$!", b"oieastasi", strict=True):
    _CLEAR[_a] = _b
_CLEAR_WORDS = PLAIN_WORDS.copy()
_CLEAR_WORDS[list(b"@$!")] = True


def _stem_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    """Hashes of the whole words and of their first 4, 5 and 6 bytes (0 if the
    word has no more bytes than that)."""
    out = [span_hashes(data, start, end)]
    for k in STEMS:
        h = span_hashes(data, start, np.minimum(start + k, end)) ^ np.uint64(k)
        h[end - start <= k] = 0
        out.append(h)
    return out


def _isin(h: np.ndarray, known: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
    return known[at] == h if len(known) else np.zeros(len(h), dtype=bool)


def _hits(data: np.ndarray, start: np.ndarray, end: np.ndarray, lexicon: np.ndarray) -> np.ndarray:
    got = np.zeros(len(start), dtype=bool)
    for h in _stem_hashes(data, start, end):
        got |= _isin(h, lexicon)
    return got


def features(data: np.ndarray, off: np.ndarray, lexicon: np.ndarray) -> np.ndarray:
    """rows x FEATURES of a run of texts."""
    low = LOWER[data]
    start, end, first = word_spans(data, off, PLAIN_WORDS)
    n = np.diff(first)
    row = np.repeat(np.arange(len(n)), n)
    per = lambda x: x / np.maximum(n, 1)
    chars = np.maximum(by_row(PLAIN_WORDS[data], off), 1)
    words = span_hashes(low, start, end)
    hit = _hits(low, start, end, lexicon)
    hits = by_row(hit, first)
    person = _isin(words, _second_person())
    near = np.zeros(len(words), dtype=bool)
    for k in (1, 2, 3):
        near[k:] |= person[:-k] & (row[k:] == row[:-k])
        near[:-k] |= person[k:] & (row[k:] == row[:-k])
    distinct = np.zeros(len(n))
    if hit.any():
        pairs = np.unique(np.stack((row[hit].astype(np.uint64), words[hit])), axis=1)
        distinct += np.bincount(pairs[0].astype(np.int64), minlength=len(n))
    s2, e2, f2 = word_spans(data, off, _CLEAR_WORDS)
    hidden = np.maximum(by_row(_hits(_CLEAR[data], s2, e2, lexicon), f2) - hits, 0)
    upper = (data >= 0x41) & (data <= 0x5A)
    letter = upper | ((data >= 0x61) & (data <= 0x7A))
    ups = np.concatenate(([0], np.cumsum(upper, dtype=np.int64)))
    shouted = (ups[end] - ups[start] == end - start) & (end - start > 1)
    same = np.zeros(len(data), dtype=bool)
    same[2:] = (data[2:] == data[1:-1]) & (data[1:-1] == data[:-2]) & letter[2:]
    punct = ~PLAIN_WORDS[data] & (data > 0x20) & (data < 0x7F)
    inner = np.zeros(len(data), dtype=bool)
    inner[1:-1] = letter[:-2] & letter[2:]
    digit = (data >= 0x30) & (data <= 0x39)
    cols = [np.log1p(hits), per(hits), np.log1p(distinct), per(by_row(hit & near, first)), per(by_row(person, first)),
            np.log1p(hidden), by_row(upper, off) / chars, per(by_row(shouted, first)), per(by_row(data == 0x21, off)),
            per(by_row(data == 0x3F, off)), by_row(punct, off) / chars, per(by_row(inner & punct & (data != 0x27), off)),
            per(by_row(inner & digit, off)), per(by_row(same, off)), per(by_row(end - start == 1, first)),
            per(by_row(end - start, first)), np.log1p(n)]
    return np.stack([np.asarray(c, dtype=np.float64) for c in cols], axis=1)


def _second_person() -> np.ndarray:
    made = [np.frombuffer(w.encode(), np.uint8) for w in SECOND_PERSON]
    return np.sort(np.concatenate([span_hashes(m, np.array([0]), np.array([len(m)])) for m in made]))


def learn_lexicon(rows: DataFrame, size: int = LEXICON_SIZE) -> np.ndarray:
    """Sorted hashes of the stems that mark toxic rows, from (text, label)."""
    def run(batches):
        for b in batches:
            label = np.array(b.column(1).to_pylist())
            for lo, _, data, off in text_chunks(b.column(0)):
                start, end, first = word_spans(data, off, PLAIN_WORDS)
                stems = _stem_hashes(LOWER[data], start, end)
                for k in range(len(off) - 1):
                    one = np.unique(np.concatenate([h[first[k]:first[k + 1]] for h in stems]))
                    one = one[one != 0].view(np.int64)
                    yield pa.record_batch([pa.array(one), pa.array(np.full(len(one), label[lo + k]))], ["stem", "label"])

    n, toxic = class_counts(rows)
    counts = (rows.select("text", "label").mapInArrow(run, "stem long, label double")
              .groupBy("stem").agg(F.sum("label").alias("t"), F.sum(1 - F.col("label")).alias("o")))
    odds = (F.col("t") / max(toxic, 1)) / ((F.col("o") + 0.5) / max(n - toxic, 1))
    best = (counts.where((F.col("t") >= MIN_ROWS) & (odds >= MIN_ODDS))
            .orderBy((odds * F.sqrt("t")).desc(), "stem").limit(size).collect())
    return np.sort(np.array([r["stem"] for r in best], dtype=np.int64).view(np.uint64))


def feature_frame(docs: DataFrame, lexicon: np.ndarray) -> DataFrame:
    """docs with ``text`` replaced by the feature columns."""
    kept = [c for c in docs.columns if c != "text"]

    def run(batches):
        for b in batches:
            text = b.column(b.schema.get_field_index("text"))
            for lo, hi, data, off in text_chunks(text):
                x = features(data, off, lexicon)
                yield pa.record_batch([*(b.column(b.schema.get_field_index(c)).slice(lo, hi - lo) for c in kept),
                                       *(pa.array(np.ascontiguousarray(c)) for c in x.T)], [*kept, *FEATURES])

    types = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in kept)
    return docs.mapInArrow(run, types + ", " + ", ".join(f"{f} double" for f in FEATURES))


def score_toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """One row a document: doc_id, held_out, score, predicted."""
    sample = training_rows(docs, labels, "toxic", max_rows)
    sample = stored(sample.select("text", "label", "part").repartition(6), "toxic-sample")
    fit, rest = sample.where("part < 7"), sample.where("part >= 7")
    base = texts_of(docs).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    sizes = [class_counts(x) for x in (fit, rest)]
    if any(t == 0 or t == n for n, t in sizes):
        n, t = map(sum, zip(*sizes))
        scored = base.drop("text").withColumn("score", F.lit(t / n if n else 0.0))
    else:
        lexicon = learn_lexicon(fit)
        vec = VectorAssembler(inputCols=FEATURES, outputCol="x")
        known = vec.transform(stored(feature_frame(sample, lexicon), "toxic-features"))
        trees = GBTClassifier(featuresCol="x", labelCol="label", maxIter=20, maxDepth=3, stepSize=0.2, seed=1,
                              cacheNodeIds=False).fit(known.where("part < 7"))
        raw = vector_to_array("probability")[1]
        calibrated = IsotonicRegression(featuresCol="p", labelCol="label", predictionCol="score").fit(
            trees.transform(known.where("part >= 7")).select(raw.alias("p"), "label"))
        out = trees.transform(vec.transform(feature_frame(base, lexicon)))
        scored = calibrated.transform(out.select("doc_id", "held_out", raw.alias("p")))
    score = F.least(F.greatest(F.col("score"), F.lit(0.0)), F.lit(1.0))
    return scored.select("doc_id", "held_out", score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))
