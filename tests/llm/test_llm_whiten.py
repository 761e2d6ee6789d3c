"""Whitening against numpy's eigenvectors and exact sums in Python."""

import numpy as np
import pyarrow.parquet as pq
import pytest

from duosync.llm.common import Scratch
from duosync.llm.queries import QUERIES
from duosync.llm.whiten import eigen, fit, orthogonal_columns, pivoted_cholesky, products, whiten_vectors

SCHEMA = "vec_id long, embedding array<float>, component string, n int"


def whole(vectors):
    return [[int(np.floor(1024 * np.float64(c))) + 100_000 for c in v] for v in vectors]


def check(rows, ids, vectors, top=8):
    """Compare all rows; returns what they explain."""
    x = whole(vectors)
    n, dims = len(x), len(x[0])
    sums = [sum(column) for column in zip(*x, strict=True)]
    centred = np.array(x, float) - np.array([s / n for s in sums])
    v = centred.T @ centred / n
    values, units = np.linalg.eigh(v)
    values, units = values[::-1], units[:, ::-1]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(row, sums, strict=True)) for row in x]
    assert len(rows) == n * min(top, dims)
    got = {}
    for r in rows:
        got.setdefault(r.component, {}).setdefault(r.vec_id, []).append(r)
    for k in range(min(top, dims)):
        mine = [got[k + 1][i][0] for i in ids]
        assert [int(r.deviation) for r in mine] == deviation
        assert {r.n for r in mine} == {n}
        w = np.array([r.whitened for r in mine])
        want = centred @ units[:, k] / np.sqrt(values[k])
        sign = np.sign(w @ want)
        assert np.allclose(w * sign, want, rtol=0, atol=1e-6)
        assert abs(mine[0].explained / (values[k] / np.trace(v)) - 1) < 1e-9
    assert {r.identity_error for r in rows} == {rows[0].identity_error}
    assert rows[0].identity_error < 1e-9


def test_given_vectors(spark):
    sf = "/root/testdata/sf0.001"
    table = pq.read_table(f"{sf}/embeddings.parquet").to_pydict()
    rows = QUERIES["op12_whitening"](spark, sf).collect()
    usable = [
        (i, v) for i, v in zip(table["vec_id"], table["embedding"], strict=True)
        if v is not None and all(c is not None and np.isfinite(c) for c in v)
    ]
    check(rows, [i for i, _ in usable], [v for _, v in usable])


def test_odd_rows_are_left_out(spark):
    rng = np.random.default_rng(3)
    good = (rng.normal(size=(40, 5)) * [9, 5, 3, 2, 1] + 50).astype(np.float32).tolist()
    odd = [None, [], [1.0] * 4, [None] * 5, [1.0, None, 1.0, 1.0, 1.0], [float("nan")] * 5,
           [float("inf")] + [0.0] * 4, [3e38] * 5]
    rows = [(i, v, "x", 1) for i, v in enumerate(good)] + [(100 + i, v, "y", 2) for i, v in enumerate(odd)]
    vectors = spark.createDataFrame(rows, SCHEMA).repartition(6)
    check(whiten_vectors(vectors, Scratch(spark)).collect(), list(range(40)), good)


def test_repeats_and_null_ids(spark):
    vectors = [(None, [1.0, 2.0]), (None, [3.0, 1.0]), (1, [0.0, 0.5]), (1, [0.0, 0.5])]
    rows = whiten_vectors(spark.createDataFrame(vectors, "vec_id long, embedding array<float>"), Scratch(spark))
    found = rows.collect()
    assert len(found) == 8 and {r.n for r in found} == {4}
    assert sorted(r.vec_id or 0 for r in found) == [0, 0, 0, 0, 1, 1, 1, 1]


@pytest.mark.parametrize("vectors", [[], [None], [[]], [[1.0, 2.0]], [[1.0, 2.0]] * 5])
def test_without_components(spark, vectors):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    found = whiten_vectors(df, Scratch(spark))
    assert found.collect() == [] and "identity_error" in found.columns


def test_rank(spark):
    rng = np.random.default_rng(5)
    flat = rng.integers(-50, 50, size=(60, 3)) @ rng.integers(-3, 4, size=(3, 9))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(flat.astype(float).tolist())], "vec_id long, embedding array<double>")
    model = fit(df)
    assert len(model.eigenvalues) == 3
    found = whiten_vectors(df, Scratch(spark)).collect()
    assert len(found) == 180 and found[0].identity_error < 1e-9


def test_strong_mean_and_small_eigenvalues():
    """Nothing is lost to a mean far from zero or to eigenvalues of very unlike sizes."""
    rng = np.random.default_rng(7)
    turn = np.linalg.qr(rng.normal(size=(12, 12)))[0]
    sizes = 10.0 ** -np.arange(12)
    v = (turn * sizes) @ turn.T
    values, units = eigen(v)
    assert np.allclose(values, sizes, rtol=1e-4)
    assert np.allclose(np.abs(units @ turn), np.eye(12), atol=1e-6)


def test_factor():
    rng = np.random.default_rng(9)
    a = rng.normal(size=(7, 4))
    factor, order = pivoted_cholesky(a @ a.T)
    assert factor.shape == (7, 4) and np.allclose(np.triu(factor, 1), 0)
    assert np.allclose(factor @ factor.T, (a @ a.T)[order][:, order])
    assert (np.diff(np.diag(factor)) <= 1e-12).all()
    columns = orthogonal_columns(factor)
    gram = columns.T @ columns
    assert np.allclose(gram, np.diag(np.diag(gram)), atol=1e-12)


def test_products_are_exact_at_any_size():
    for most in (1 << 10, 1 << 30, 1 << 52):
        d = np.array([[most, -most + 1], [3, most - 7]], np.int64)
        want = [[sum(int(r[i]) * int(r[j]) for r in d) for j in range(2)] for i in range(2)]
        assert products(d).tolist() == want


def test_large_entries(spark):
    vectors = [(1, [2.0**40, 1.0]), (2, [-(2.0**40), 2.0]), (3, [5.0, 2.0**41]), (4, [1.0, 1.0])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    check(whiten_vectors(df, Scratch(spark)).collect(), [1, 2, 3, 4], [v for _, v in vectors])
