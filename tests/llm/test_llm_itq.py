import math

import numpy as np
import pytest

import duosync.llm.itq as itq
from duosync.llm.common import Scratch
from duosync.llm.itq import Codes, forest, link_vectors

SCHEMA = "vec_id long, embedding array<double>, label int, node string, n string, bucket string"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(i, v and [x if x is None else float(x) for x in v], 1, "a", "b", "c") for i, v in rows], schema).repartition(3)


def brute(rows, cosine=0.9):
    """(links, component) by comparing all rows."""
    good = [
        (k, np.array(v, float))
        for k, (_, v) in enumerate(rows)
        if v and None not in v and np.isfinite(v).all() and any(v)
    ]
    links, u, v = np.zeros(len(rows), int), [], []
    for a, (i, x) in enumerate(good):
        for j, y in good[a + 1 :]:
            x1, y1 = x / np.abs(x).max(), y / np.abs(y).max()
            if len(x) == len(y) and x1 @ y1 >= cosine * np.linalg.norm(x1) * np.linalg.norm(y1):
                links[[i, j]] += 1
                u.append(i)
                v.append(j)
    label = forest(np.array(u, int), np.array(v, int), len(rows))
    ids = np.array([i for i, _ in rows])
    return [(i, links[k], min(ids[label == label[k]])) for k, i in enumerate(ids)]


def check(spark, rows, schema=SCHEMA):
    got = link_vectors(frame(spark, rows, schema), Scratch(spark)).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == sorted(brute(rows))
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


@pytest.mark.parametrize("block, dims", [(16, 24), (512, 64)])
def test_against_brute_force(spark, monkeypatch, block, dims):
    monkeypatch.setattr(itq, "BLOCK", block)
    draw = np.random.default_rng(block)
    base = draw.standard_normal((40, dims))
    rows = [list(b) for b in base]
    for k, size in enumerate([120, 30, 5, 2]):  # groups of near copies, some scaled
        rows += [
            list((base[k] + 0.15 * draw.standard_normal(dims)) * draw.uniform(0.1, 9))
            for _ in range(size)
        ]
    rows += [rows[3]] * 4 + [list(2 * base[3])]
    odd = [None, [], [0.0] * dims, [1.0, None, 2.0], [math.nan] * dims, [math.inf, 1.0]]
    odd += [[1e308] * dims, [1e308] * dims, [1e-300] * dims, [1.0, 2.0], [2.0, 4.0], [5.0]]
    order = draw.permutation(len(rows) + len(odd))
    rows = [(int(i), v) for i, v in zip(order, rows + odd, strict=True)]
    check(spark, rows)


def test_floats_and_given_vectors(spark):
    given = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()
    rows = [(r.vec_id, list(r.embedding)) for r in given]
    check(spark, rows, SCHEMA.replace("double", "float"))


def test_shared_ids_and_empty(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (None, [0.0, 2.0]), (None, [5.0, -9.0]), (4, [3.0, 0.0])]
    got = link_vectors(frame(spark, rows), Scratch(spark)).collect()
    assert sorted(str(tuple(r)) for r in got) == sorted(
        map(str, [(1, 1, 1, True), (1, 1, 1, True), (None, 1, 1, False), (None, 0, None, True), (4, 1, 1, False)])
    )
    assert link_vectors(frame(spark, []), Scratch(spark)).count() == 0
    assert link_vectors(frame(spark, [(1, None)]), Scratch(spark)).collect()[0].kept


def test_recall_at_the_threshold():
    """Pairs at a cosine just over 0.9 in a large index share a table and lie within the radius."""
    draw = np.random.default_rng(2)
    a = draw.standard_normal((4000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = draw.standard_normal((4000, 64))
    side -= (side * a).sum(axis=1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    b = 0.905 * a + math.sqrt(1 - 0.905**2) * side
    for vectors in (50_000, 5_000_000):
        codes = Codes(a, vectors)
        x, y = codes(a), codes(b)
        apart = np.bitwise_count(x ^ y).sum(axis=1)
        found = (x == y).any(axis=1) & (apart <= codes.radius)
        assert found.mean() >= 0.95


def test_codes_are_balanced():
    data = np.random.default_rng(1).standard_normal((3000, 32)) * np.linspace(3, 0.5, 32) + 1.0
    units = data / np.linalg.norm(data, axis=1, keepdims=True)
    codes = Codes(units, 100_000)
    ones = ((units - codes.mean) @ codes.planes >= 0).mean(axis=0)
    assert (np.abs(ones - 0.5) < 0.1).all()


def strong_mean(draw, n, mean, dims=64):
    """Unit vectors whose mean has about this norm, and vectors at cosine 0.905 of them."""
    side = draw.standard_normal((n, dims))
    side[:, 0] = 0
    a = math.sqrt(1 - mean**2) * side / np.linalg.norm(side, axis=1, keepdims=True)
    a[:, 0] = mean
    side = draw.standard_normal((n, dims))
    side -= (side * a).sum(axis=1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    return a, 0.905 * a + math.sqrt(1 - 0.905**2) * side


@pytest.mark.parametrize("mean", [0.7, 0.85])
def test_recall_with_a_strong_mean(mean):
    a, b = strong_mean(np.random.default_rng(4), 2000, mean)
    for vectors in (51_282, 5_000_000):
        codes = Codes(a, vectors)
        x, y = codes(a), codes(b)
        apart = np.bitwise_count(x ^ y).sum(axis=1)
        assert ((x == y).any(axis=1) & (apart <= codes.radius)).mean() >= 0.95


def test_strong_mean_against_brute_force(spark):
    a, b = strong_mean(np.random.default_rng(5), 400, 0.85)
    rows = [(i, list(v)) for i, v in enumerate(np.concatenate([a, b]))]
    got = link_vectors(frame(spark, rows), Scratch(spark)).collect()
    want = sum(links for _, links, _ in brute(rows))
    assert want >= 800 and 0.97 * want <= sum(r.n_links for r in got) <= want


def test_mean_near_the_threshold_still_gives_an_index():
    """Nearly all pairs are links: short substrings, not endless tables."""
    a, b = strong_mean(np.random.default_rng(6), 500, 0.97)
    codes = Codes(a, 5_000_000)
    assert codes.tables <= 2000
    assert (codes(a) == codes(b)).any(axis=1).mean() >= 0.95
