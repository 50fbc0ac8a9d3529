"""All five stages in turn on rows with null ids, null texts, odd column names, and on no rows."""
import random

import corpus_pipeline
from eventide.llm.runtime import stored

from .test_dedup import prose

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `a.b` string, `_row` string, `key` string, `h` long"


def through(spark, docs, sf):
    outputs = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.columns
        docs = stored(stage(spark, docs, sf), f"edge{k}")
        assert k == 4 or docs.columns == before
        outputs.append(docs)
    return outputs


def test_null_ids_and_clashing_names_pass_all_stages(spark, sf):
    rng = random.Random(31)
    a, b, c = (prose(rng, 80) for _ in range(3))
    rows = [(1, a), (2, a + " end"), (None, b), (None, b), (None, None), (3, ""), (4, c), (5, prose(rng, 60000))]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or ""), "dot", "mine", "k", 7) for d, t in rows], SCHEMA)
    outputs = through(spark, docs, sf)
    last = outputs[3].collect()
    assert sorted((r["doc_id"] or 0) for r in last) == [0, 1, 4, 5]
    assert {r["a.b"] for r in last} == {"dot"} and {r["_row"] for r in last} == {"mine"} and {r["h"] for r in last} == {7}
    assert outputs[4].count() == 4


def test_no_rows_pass_all_stages(spark, sf):
    docs = spark.createDataFrame([], SCHEMA)
    assert [o.count() for o in through(spark, docs, sf)] == [0] * 5
