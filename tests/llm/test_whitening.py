import math
from collections import defaultdict

import numpy as np
import pytest

from docketmill.llm import whitening as W
from docketmill.llm.spectral import eigenvectors, polar

SCHEMA = "vec_id bigint, embedding array<float>, label int, entries string, dims int"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, 0, "x", 1) for i, v in vectors], SCHEMA)


def rotation(n, seed):
    return np.linalg.qr(np.random.default_rng(seed).normal(size=(n, n)))[0]


@pytest.mark.parametrize("values", [
    np.linspace(1, 9, 9), np.ones(5), np.zeros(4), 10.0 ** -np.arange(0, 18, 1.5),
    np.array([5.0] * 6 + [2.0] * 7 + [0.0] * 3), np.array([-3.0, -3.0, 1e-12, 3.0]), np.array([2.0])])
def test_eigenvectors_are_those_of_the_library(values):
    q = rotation(len(values), 1)
    a = q @ np.diag(values) @ q.T
    got, vectors = eigenvectors(a)
    size = max(np.abs(values).max(), 1e-300)
    assert np.allclose(got, np.linalg.eigvalsh((a + a.T) / 2)[::-1], atol=1e-13 * size)
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-13
    assert np.abs(a @ vectors - vectors * got).max() <= 1e-13 * size


def test_polar_factor_is_the_sign():
    q = rotation(6, 2)
    values = np.array([-5.0, -1e-3, 1e-9, 0.1, 2.0, 7.0])
    u = polar(q @ np.diag(values) @ q.T)
    assert np.abs(u - q @ np.diag(np.sign(values)) @ q.T).max() < 1e-6


def expected(vectors, components=8):
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for _, v in vectors], dtype=np.int64)
    n, s = len(x), x.sum(axis=0)
    z = x - s / n
    cov = z.T @ z / n
    values, columns = np.linalg.eigh(cov)
    values, columns = values[::-1][:components], columns[:, ::-1][:, :components]
    return n, ((n * x - s) ** 2).sum(axis=1), z @ columns / np.sqrt(values), values / np.trace(cov)


def checked(rows, vectors, components):
    n, deviation, white, explained = expected(vectors, components)
    by_id = {v[0]: k for k, v in enumerate(vectors)}
    signs = defaultdict(set)
    assert len(rows) == len(vectors) * components
    for r in rows:
        k, c = by_id[r["vec_id"]], r["component"] - 1
        assert r["n"] == n and r["deviation"] == deviation[k]
        assert abs(r["explained"] / explained[c] - 1) < 1e-9 and r["identity_error"] < 1e-9
        assert abs(abs(r["whitened"]) - abs(white[k, c])) < 1e-8
        if abs(white[k, c]) > 1e-6:
            signs[c].add(np.sign(r["whitened"] * white[k, c]))
    assert all(len(s) == 1 for s in signs.values())


def test_whitening_against_the_library(spark):
    random = np.random.default_rng(3)
    mix = random.normal(size=(12, 12)) * np.linspace(3, 0.05, 12)
    vectors = [(i, (random.normal(size=12) @ mix).tolist()) for i in range(400)]
    checked(W.whiten(table(spark, vectors)).collect(), vectors, 8)
    checked(W.whiten(table(spark, vectors), components=3).collect(), vectors, 3)


def test_given_embeddings(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    vectors = [(r["vec_id"], list(r["embedding"])) for r in rows.collect()]
    checked(W.whiten(rows).collect(), vectors, 8)


def test_odd_rows_are_dropped(spark):
    random = np.random.default_rng(5)
    good = [(i, random.normal(size=3).tolist()) for i in range(40)]
    bad = [(100, None), (101, []), (102, [1.0, None, 2.0]), (103, [1.0, float("nan"), 2.0]),
           (104, [float("inf"), 0.0, 0.0]), (105, [0.0, -float("inf"), 0.0]), (106, [1.0, 2.0]), (107, [1e30, 0.0, 0.0])]
    checked(W.whiten(table(spark, bad[:4] + good + bad[4:])).collect(), good, 3)


def test_ids_that_repeat_or_lack_keep_their_rows(spark):
    vectors = [(None, [1.0, 2.0]), (1, [3.0, 1.0]), (1, [3.0, 1.0]), (2, [0.0, 5.0]), (None, [-1.0, 0.5])]
    rows = W.whiten(table(spark, vectors)).collect()
    assert sorted(str(r["vec_id"]) for r in rows) == sorted(2 * [str(i) for i, _ in vectors])
    assert {r["n"] for r in rows} == {5}


@pytest.mark.parametrize("vectors", [[], [(1, [1.0, 2.0])], [(i, [4.0, 4.0]) for i in range(5)], [(1, None)]])
def test_without_variance_there_are_no_components(spark, vectors):
    out = W.whiten(table(spark, vectors))
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert out.collect() == []


def test_lacking_rank_gives_fewer_components(spark):
    vectors = [(i, [float(i), 2.0 * i, 4.0 * i]) for i in range(1, 30)]
    rows = W.whiten(table(spark, vectors)).collect()
    assert {r["component"] for r in rows} == {1} and abs(rows[0]["explained"] - 1) < 1e-12


def test_large_entries_are_exact(spark):
    vectors = [(i, [1e6 + i, -2e4 * i]) for i in range(20)]
    x = [[math.floor(1024 * c) + 100000 for c in v] for _, v in vectors]
    sums = [sum(column) for column in zip(*x, strict=True)]
    exact = [sum((20 * a - s) ** 2 for a, s in zip(v, sums, strict=True)) for v in x]
    assert min(exact) > 1 << 53 and max(exact) > 1 << 63
    rows = W.whiten(table(spark, vectors)).where("component = 1").collect()
    assert {r["vec_id"]: r["deviation"] for r in rows} == {i: d if d < 1 << 63 else None for i, d in enumerate(exact)}
    far = [(0, [0.0, 1.0]), (1, [4e12, 0.0]), (2, [1.0, 2.0])]
    assert all(r["deviation"] is None for r in W.whiten(table(spark, far)).collect())


def test_vectors_are_not_shuffled(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    vectors = W.clean(rows)
    plan = W.whitened(vectors, W.fit(vectors))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
