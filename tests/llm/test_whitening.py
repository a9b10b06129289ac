import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from posegrid.llm import whitening
from posegrid.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, x string, length string, n string"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, 0, "x", "x", "x") for i, v in vectors], SCHEMA)


def by_hand(vectors):
    """(n, exact deviations by id, eigenvalues, trace, whitened covariances) with numpy's own solver."""
    kept = {i: tuple(math.floor(64 * np.float64(np.float32(c))) + 1_000_000 for c in v) for i, v in vectors}
    fit = sorted(set(kept.values()))
    n = len(fit)
    sums = [sum(column) for column in zip(*fit)]
    deviation = {i: sum((n * a - s) ** 2 for a, s in zip(x, sums)) for i, x in kept.items()}
    y = np.array([[(n * a - s) / n for a, s in zip(x, sums)] for x in fit])
    values = np.linalg.eigvalsh(y.T @ y / n)[::-1]
    return n, deviation, values, kept, sums


def check(out, vectors):
    n, deviation, values, kept, sums = by_hand(vectors)
    rows = {}
    for r in out:
        assert r["n"] == n and r["deviation"] == deviation[r["vec_id"]]
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / values.sum(), rel=1e-9)
        assert r["identity_error"] < 1e-9
        rows.setdefault(r["vec_id"], {})[r["component"]] = r["whitened"]
    count = int((values > 1e-9 * values[0]).sum()) if values[0] > 0 else 0
    assert set(rows) == (set(kept) if count else set())
    first = {x: i for i, x in kept.items()}
    w = np.array([[rows[i][k + 1] for k in range(min(16, count))] for i in first.values()]) if count else np.empty((0, 0))
    if count:
        cov = w.T @ w / n - np.outer(w.mean(0), w.mean(0))
        assert np.abs(cov - np.eye(len(cov))).max() < 1e-9
        # the whitened columns are the projections on eigenvectors: y = sum over k of w_k sqrt(e_k) v_k up to the rest
        y = np.array([[(n * a - s) / n for a, s in zip(x, sums)] for x in first])
        v = (y.T @ w / n) / np.sqrt(values[:w.shape[1]])
        assert np.abs(y.T @ (y @ v) / n - v * values[:w.shape[1]]).max() < 1e-8 * values[0]


def test_against_numpy(spark):
    rng = np.random.default_rng(3)
    points = rng.standard_normal((500, 24)) @ rng.standard_normal((24, 24)) * 0.3
    vectors = [(i, [float(np.float32(c)) for c in p]) for i, p in enumerate(points)]
    vectors += [(1000 + i, vectors[i % 7][1]) for i in range(300)]  # repeated vectors count once
    check(whitening.whiten(frame(spark, vectors)).collect(), vectors)


@pytest.mark.parametrize("points", [
    [[0.5, 1.0]], [[0.5, 1.0], [0.5, 1.0]], [[1.0, 0.0], [0.0, 1.0]],
    [[1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0], [1.0, 1.0, 1.0]],  # equal eigenvalues
    [[2.0], [3.0], [7.0]]])
def test_few_vectors(spark, points):
    vectors = list(enumerate(points))
    check(whitening.whiten(frame(spark, vectors)).collect(), vectors)


def test_odd_rows(spark):
    good = [(i, [float(i % 5), float(i * i % 7), 1.5]) for i in range(40)]
    bad = [(100, None), (101, []), (102, [1.0, None, 2.0]), (103, [1.0, float("nan"), 2.0]),
           (104, [float("inf"), 0.0, 0.0]), (105, [3e38, 0.0, 0.0])]
    again = [(None, good[0][1]), (3, good[3][1])]
    other = [(200 + i, [float(i), -2.0 * i]) for i in range(4)]
    out = whitening.whiten(frame(spark, good + bad + again + other)).collect()
    three = [r for r in out if r["vec_id"] is not None and r["vec_id"] < 100]
    check(three, good)
    assert sum(r["vec_id"] == 3 for r in out) == 2 * 2 and sum(r["vec_id"] is None for r in out) == 2
    assert {r["vec_id"] for r in out if (r["vec_id"] or 0) >= 100} == {200, 201, 202, 203}
    check([r for r in out if (r["vec_id"] or 0) >= 200], other)
    empty = whitening.whiten(frame(spark, []))
    assert empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert empty.count() == 0 and whitening.whiten(frame(spark, bad)).count() == 0


def test_deviation_beyond_a_long_is_null():
    x = np.array([[4_000_000_000], [0]])
    got = whitening.deviations(x, 2, [4_000_000_000], [(0, 4_000_000_000)]).to_pylist()
    assert got == [None, None]
    assert whitening.deviations(np.array([[3_000_000_000], [0]]), 1, [0], [(0, 3_000_000_000)]).to_pylist() == [9 * 10**18, 0]


@pytest.mark.parametrize("matrix", [
    np.eye(20), np.diag([5.0, 5, 5, 1, 1, 1, 1e-9]), np.zeros((4, 4)), np.ones((9, 9)),
    np.kron(np.eye(2), [[2.0, 1.0], [1.0, 3.0]])])
def test_solver(matrix):
    values, vectors = whitening.leading_components(matrix)
    want = np.linalg.eigvalsh(matrix)[::-1][:16]
    want = want[want > 1e-13 * max(want[0], 0)] if want[0] > 0 else want[:0]
    assert np.allclose(values, want, rtol=1e-13, atol=0)
    assert np.allclose(vectors @ vectors.T, np.eye(len(values)), atol=1e-13)
    assert np.allclose(matrix @ vectors.T, vectors.T * values, atol=1e-13 * max(1, np.abs(matrix).max()))


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    good = [(r["vec_id"], r["embedding"]) for r in rows if r["embedding"] and all(
        c is not None and math.isfinite(c) for c in r["embedding"])]
    assert len({i for i, _ in good}) == len(good)
    out = QUERIES["op12_embedding_whitening"](spark, sf_dir)
    assert out.agg(F.countDistinct("n")).first()[0] == 1
    check(out.collect(), good)
