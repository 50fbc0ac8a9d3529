"""Operators 1 and 5: held-out accuracy, what may be learned from, and edges."""
import zlib

import numpy as np
import pyarrow.parquet as pq

from eventide.llm import quality, toxicity
from eventide.llm.queries import op1_toxicity, op5_quality

from .conftest import EDGE


def labels(sf):
    t = pq.read_table(f"{sf}/labels.parquet").to_pylist()
    return {r["doc_id"]: (r["toxic"], r["quality"]) for r in t}


def auc(score, label):
    order = np.argsort(score)
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    for s in np.unique(score):
        rank[score == s] = rank[score == s].mean()
    p = label.sum()
    return (rank[label == 1].sum() - p * (p + 1) / 2) / (p * (len(label) - p))


def held(d):
    return zlib.crc32(str(d).encode()) % 5 == 0


def check(df, sf, which, limit, least):
    got = {r["doc_id"]: r for r in df.collect()}
    known = labels(sf)
    assert all(r["held_out"] == held(d) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= limit) for d, r in got.items())
    test = [d for d in got if held(d) and d in known]
    value = auc(np.array([got[d]["score"] for d in test]), np.array([known[d][which] for d in test]))
    assert value >= least, value


def test_op1_held_out(spark):
    sf = "/root/testdata/sf0.1"
    check(op1_toxicity(spark, sf), sf, 0, 0.5, 0.80)


def test_op5_held_out(spark):
    sf = "/root/testdata/sf0.1"
    check(op5_quality(spark, sf), sf, 1, 0.3, 0.90)


def test_edges_without_usable_labels(spark, edge, nothing):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(d, 1, 0) for d in (1, 2, 4, 5, 6)] + [(None, 1, 1), (7, None, None), (7, 1, 0)], "doc_id long, quality int, toxic int")
    for lab, want in ((none, (0.0, 0.0)), (one, (0.0, 1.0))):
        for f, score in ((toxicity.score_toxicity, want[0]), (quality.score_quality, want[1])):
            rows = f(edge, lab).collect()
            assert len(rows) == len(EDGE) and {r["score"] for r in rows} == {score}
            assert f(nothing, lab).count() == 0


def test_edges_with_labels(spark, frame):
    rows = [(i, "you idiot clown " * 3 + f"word{i}" if i % 4 == 0 else f"fine text number {i} it's good.") for i in range(400)]
    rows += [(10_000 + k, t) for k, (_, t) in enumerate(EDGE)] + [(None, None)]
    lab = spark.createDataFrame([(i, int(i % 4 != 0), int(i % 4 == 0)) for i in range(400)], "doc_id long, quality int, toxic int")
    for f, side in ((toxicity.score_toxicity, 1), (quality.score_quality, 0)):
        got = f(frame(rows), lab).collect()
        assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
        by = {r["doc_id"]: r["score"] for r in got}
        bad, fine = np.mean([by[i] for i in range(0, 400, 4)]), np.mean([by[i] for i in range(1, 400, 4)])
        assert (bad > 0.9 and fine < 0.1) if side else (bad < 0.1 and fine > 0.9)


def test_rules_of_printed_trees():
    text = """RandomForestClassificationModel: uid=x, numTrees=1
  Tree 0 (weight 1.0):
    If (feature 0 <= 2.5)
     If (feature 1 <= 0.5)
      Predict: 0.0
     Else (feature 1 > 0.5)
      Predict: 1.0
    Else (feature 0 > 2.5)
     Predict: 1.0
"""
    a, b = quality.STATS[:2]
    assert set(quality.tree_rules(text)) == {((a, False, 2.5),), ((a, False, 2.5), (b, False, 0.5)), ((a, False, 2.5), (b, True, 0.5)), ((a, True, 2.5),)}


def test_features_of_empty_rows():
    data, off = np.zeros(0, np.uint8), np.array([0, 0, 0])
    assert toxicity.features(data, off, np.zeros(0, np.uint64)).shape == (2, len(toxicity.FEATURES))
    assert (quality.statistics(data, off) == 0).all()
