import os
import tempfile

import pytest


@pytest.fixture()
def frame(spark):
    """Rows of (doc_id, text) with columns whose names the operators also use."""
    def make(rows, extra=True):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        if extra:
            from pyspark.sql import functions as F
            for name in ("cls", "token", "th", "k", "row", "w", "n", "score", "label", "digest", "root", "hit", "_id"):
                df = df.withColumn(name, F.lit("x"))
        return df
    return make


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def texts(sf):
    import pyarrow.parquet as pq
    t = pq.read_table(os.path.join(sf, "documents.parquet"), columns=["doc_id", "text"]).to_pydict()
    return dict(zip(t["doc_id"], t["text"]))


@pytest.fixture(scope="session")
def temp():
    return tempfile.mkdtemp(prefix="llm-test-")


EDGE = [(None, "null id here and five more words"), (1, None), (2, ""), (2, ""), (3, " \t\n"), (4, "one"),
        (4, "one"), (5, "é ü 漢字 text with odd spaces x²  it's 'tis don't"), (6, "a " * 9 + "b " * 40000),
        (7, "x" * 70000), (8, "Same words again and again and again."), (9, "Same words again and again and again.")]


@pytest.fixture()
def edge(frame):
    return frame(EDGE)


@pytest.fixture()
def nothing(frame):
    return frame([])
