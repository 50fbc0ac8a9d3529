"""Operator 11 against plain integers and numpy."""
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventide.llm import whitening
from eventide.llm.queries import op11_whitening

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows):
    """vec_id -> (x vector) of usable rows, n, S, covariance of the distinct ones."""
    kept = [(i, tuple(math.floor(64 * float(c)) + 1_000_000 for c in v)) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({x for _, x in kept})
    n = len(fit)
    s = [sum(c) for c in zip(*fit)]
    m = np.array([[n * c - t for c, t in zip(x, s)] for x in fit], dtype=float) / n
    return kept, n, s, m.T @ m / n


def check(rows, out):
    kept, n, s, cov = brute(rows)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(16, len(s))
    got = sorted((r["vec_id"], r["component"]) for r in out)
    assert got == sorted((i, c) for i, _ in kept for c in range(1, k + 1))
    exact = {}
    for i, x in kept:
        exact.setdefault(i, []).append((sum((n * c - t) ** 2 for c, t in zip(x, s)), np.array([n * c - t for c, t in zip(x, s)], float) / n))
    for c in range(1, k + 1):
        own = [r for r in out if r["component"] == c]
        w = np.array([r["whitened"] for r in own])
        want = np.array([float(exact[r["vec_id"]][0][1] @ vectors[:, c - 1]) / math.sqrt(values[c - 1]) for r in own])
        assert np.allclose(w, want, atol=1e-6) or np.allclose(w, -want, atol=1e-6)
        assert all(math.isclose(r["explained"], values[c - 1] / np.trace(cov), rel_tol=1e-4) for r in own)
    assert all(r["n"] == n and r["deviation"] in [d for d, _ in exact[r["vec_id"]]] and r["identity_error"] <= 1e-4 for r in out)


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 5), st.integers(1, 150), st.integers(0, 60), st.integers(0, 2**32 - 1))
def test_block_scatter_is_exact(dims, n, bits, seed):
    x = np.random.default_rng(seed).integers(-(1 << bits), 1 << bits, (n, dims), endpoint=True)
    sums, cross = whitening.block_scatter(x)
    o = x.astype(object)
    assert sums.tolist() == o.sum(axis=0).tolist()
    assert (cross == o.T.dot(o)).all()


def test_whole_table(spark, sf):
    out = op11_whitening(spark, sf).collect()
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check(rows, out)


def test_edges(spark):
    """Null vectors and entries, NaN, infinity, repeated rows, clashing columns."""
    r = np.random.default_rng(3)
    rows = [(i, r.normal(size=3).round(2).tolist()) for i in range(40)]
    rows += [(100, None), (101, [1.0, None, 2.0]), (102, [1.0, float("nan"), 2.0]), (103, [float("inf"), 1.0, 2.0]),
             (5, rows[5][1]), (104, rows[6][1])]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("x", "v", "dims", "d", "e", "n", "whitened"):
        df = df.withColumn(name, F.lit("x"))
    out = whitening.whiten(df).collect()
    single = [(i, [None if c is None else float(np.float32(c)) for c in v] if v else v) for i, v in rows]
    check(single, out)
    assert sum(x["vec_id"] == 5 for x in out) == 6


def test_one_vector_lengths_and_empty(spark):
    one = whitening.whiten(spark.createDataFrame([(1, [0.5, 0.25]), (None, [0.5, 0.25]), (3, [])], SCHEMA)).collect()
    assert sorted((r["vec_id"] is None, r["component"], r["whitened"], r["deviation"], r["n"]) for r in one) == [
        (False, 1, 0.0, 0, 1), (False, 2, 0.0, 0, 1), (True, 1, 0.0, 0, 1), (True, 2, 0.0, 0, 1)]
    two = [(i, [float(i), float(i * i)]) for i in range(6)]
    three = [(10 + i, [float(i), 1.0 / (i + 1), float(i % 2)]) for i in range(7)]
    out = whitening.whiten(spark.createDataFrame(two + three, "vec_id long, embedding array<double>")).collect()
    check(two, [r for r in out if r["vec_id"] < 10])
    check(three, [r for r in out if r["vec_id"] >= 10])
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []


def test_huge_entries(spark):
    rows = [(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [0.0, 2.0])]
    out = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r["deviation"] for r in out if r["vec_id"] in (1, 2)} == {None}
    assert all(math.isfinite(r["whitened"]) for r in out)


@pytest.mark.parametrize("value,want", [(5, [(0, 5)]), (-(1 << 40) - 7, [(0, -7), (1, -256)]), (0, [])])
def test_limbs(value, want):
    assert list(whitening._limbs(value)) == want
