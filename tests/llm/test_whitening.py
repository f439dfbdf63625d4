from decimal import Decimal

import numpy as np
import pytest

from fisclake.llm.queries import QUERIES, table
from fisclake.llm.whitening import bidiagonalise, whiten_embeddings


def plain(vectors, most=32):
    """By eigenvalues of the covariance: n, deviations, whitened rows, explained shares."""
    x = np.floor(64 * np.asarray(vectors, float)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    off = (n * x - sums) / n
    values, basis = np.linalg.eigh(off.T @ off / n)
    values, basis = values[::-1], basis[:, ::-1]
    keep = [k for k in range(min(most, len(values))) if values[k] > 1e-12 * max(values[0], 1e-300)]
    deviation = [sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, sums, strict=True)) for row in x]
    return n, deviation, off @ basis[:, keep] / np.sqrt(values[keep]), values[keep] / values.sum() if keep else values[:0]


def test_query_equals_eigenvectors(spark, sf_dir):
    vectors = {r["vec_id"]: r["embedding"] for r in table(spark, sf_dir, "embeddings").collect()}
    ids = sorted(vectors)
    n, deviation, whitened, explained = plain([vectors[i] for i in ids])
    rows = sorted(QUERIES["op13_whitened_embeddings"](spark, sf_dir).collect(), key=lambda r: (r["vec_id"], r["component"]))
    assert [(r["vec_id"], r["component"], r["n"], r["deviation"]) for r in rows] == [(i, k + 1, n, d) for i, d in zip(ids, deviation, strict=True) for k in range(32)]
    found = np.array([r["whitened"] for r in rows]).reshape(n, 32)
    assert np.abs(found * np.sign((found * whitened).sum(axis=0)) - whitened).max() < 1e-9
    assert np.allclose([r["explained"] for r in rows[:32]], explained, rtol=1e-10)
    assert {r["identity_error"] for r in rows} == {rows[0]["identity_error"]} and rows[0]["identity_error"] < 1e-10


@pytest.mark.parametrize("values", [[5, 5, 5, 5], [9, 9, 4, 1], [7, 3, 0, 0], [1e4, 1, 1e-2, 1e-2], [0, 0, 0, 0]])
def test_equal_and_missing_singular_values(values):
    """The process ends early in exact arithmetic; starting anew finds every direction all the same."""
    rng = np.random.default_rng(1)
    left, right = np.linalg.qr(rng.standard_normal((50, 4)))[0], np.linalg.qr(rng.standard_normal((4, 4)))[0]
    x = left * values @ right
    v, b = bidiagonalise(lambda z: (x.T @ (x @ z), float((x @ z) @ (x @ z))), 4)
    assert np.allclose(v @ v.T, np.eye(4), atol=1e-12)
    assert np.allclose(np.linalg.svd(b)[1], sorted(values, reverse=True), atol=1e-9 * max(*values, 1))
    assert np.abs(np.tril(b, -1)).max() == 0 and np.abs(np.triu(b, 2)).max() < 1e-9 * max(*values, 1)


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    few = [(i, rng.standard_normal(5).tolist()) for i in range(3)] + [(2, [1.0, 0.0, 0.0, 0.5, 0.25])] * 2 + [(None, rng.standard_normal(5).tolist())]
    other = [(10 + i, [float(i), 2.0]) for i in range(4)]
    alone = [(20, [1.0, 2.0, 3.0])]
    odd = [(30, None), (31, []), (32, [1.0, None, 2.0, 3.0, 4.0]), (33, [1.0, float("nan"), 2.0, 3.0, 4.0]), (34, [float("inf")] * 5), (35, [1e12] * 5)]
    rows = [(*r, 1, "x", 2.0, "y") for r in few + other + alone + odd]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n int, whitened string, explained double, id string").repartition(3)
    found = whiten_embeddings(frame)
    assert found.columns == ["vec_id", "n", "deviation", "whitened", "explained", "identity_error"]
    result = found.collect()
    for part in (few, other, alone):
        n, deviation, whitened, explained = plain([v for _, v in part])
        own = [r for r in result if r["n"] == n and len(r["explained"]) == len(explained)]
        assert sorted(map(str, (r["vec_id"] for r in own))) == sorted(str(i) for i, _ in part)
        assert sorted(r["deviation"] for r in own) == sorted(map(Decimal, deviation))
        assert all(np.allclose(r["explained"], explained) and r["identity_error"] < 1e-9 for r in own)
        lengths = sorted(float((np.array(r["whitened"]) ** 2).sum()) for r in own)
        assert np.allclose(lengths, sorted((whitened**2).sum(axis=1)))
    assert len(result) == len(few) + len(other) + len(alone)
    assert whiten_embeddings(frame.limit(0)).collect() == []


def test_deviations_beyond_a_long(spark):
    frame = spark.createDataFrame([(0, [9e8]), (1, [-9e8])], "vec_id long, embedding array<double>")
    assert {r["deviation"] for r in whiten_embeddings(frame).collect()} == {Decimal((2 * 9 * 10**8 * 64) ** 2)}
    assert whiten_embeddings(frame.filter("vec_id = 0")).first()["whitened"] == []
