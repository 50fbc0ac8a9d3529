"""The near-duplicate stage decides by row, whatever the ids."""
import random

import corpus_pipeline

from .test_dedup import prose


def test_near_duplicates_keep_one_row_of_each_group(spark, frame, sf):
    rng = random.Random(21)
    a, b, c, d, e = (prose(rng, 60) for _ in range(5))
    near = a + " tail"
    rows = [(5, a), (3, near), (None, a),  # one group, one without an id
            (7, b), (7, b), (7, b),  # a shard read twice
            (None, c), (None, c), (None, c),  # no ids at all
            (9, d), (9, near),  # an id on two texts: only the near copy goes
            (None, e), (11, ""), (11, ""), (None, None)]
    df = frame(rows)
    got = corpus_pipeline.near_duplicates(spark, df, sf)
    assert got.columns == df.columns
    left = sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str)
    assert left == sorted([(3, near), (7, b), (None, c), (9, d), (None, e), (11, ""), (11, ""), (None, None)], key=str)
