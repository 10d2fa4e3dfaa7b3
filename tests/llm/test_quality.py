import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from docketmill.llm import quality as Q

SF = "/root/testdata/sf0.01"


def pooled(total, ones):
    """Isotonic fit by its min-max formula."""
    at = np.flatnonzero(total)
    t, o = total[at], ones[at]
    n = len(at)
    mean = lambda i, j: o[i : j + 1].sum() / t[i : j + 1].sum()
    values = [max(min(mean(i, j) for j in range(k, n)) for i in range(k + 1)) for k in range(n)]
    return np.interp(np.arange(len(total)), at, values)


@pytest.mark.parametrize("seed", range(5))
def test_isotonic(seed):
    random = np.random.default_rng(seed)
    total = random.integers(0, 6, 40).astype(float)
    ones = np.array([random.integers(0, n + 1) for n in total], dtype=float)
    assert Q.isotonic(total, ones) == pytest.approx(pooled(total, ones))


def test_fourier_features_approximate_the_kernel(monkeypatch):
    monkeypatch.setattr(Q, "FEATURES", 20_000)
    x = np.random.default_rng(3).normal(size=(6, len(Q.STATISTICS))) / 2
    f = Q.fourier(x)[:, :-1]
    kernel = np.exp(-((x[:, None] - x) ** 2).sum(axis=2) / (2 * Q.WIDTH**2))
    assert np.abs(f @ f.T - kernel).max() < 0.05


def test_ridge_is_that_of_all_rows(spark):
    random = np.random.default_rng(1)
    x = random.normal(size=(300, len(Q.STATISTICS)))
    y = (x[:, 0] + x[:, 1] ** 2 > 0.7).astype(float)
    rows = [(i, i % Q.FOLDS, float(y[i]), x[i].tolist()) for i in range(300)]
    model = Q.fit(spark.createDataFrame(rows, "doc_id bigint, fold int, label double, stats array<double>"))
    f = Q.fourier((x - x.mean(axis=0)) / x.std(axis=0))
    gram = f.T @ f
    weights = np.linalg.solve(gram + Q.RIDGE * 300 / Q.FEATURES * np.eye(len(gram)), f.T @ y)
    assert model.weights == pytest.approx(weights, rel=1e-4, abs=1e-6)


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = Q.scores(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    tested = [(truth[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert sum(a == b for a, b in tested) / len(tested) > 0.95


def test_held_out_labels_are_not_learned(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    flipped = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = Q.train(docs, labels), Q.train(docs, flipped)
    assert np.array_equal(a.weights, b.weights) and np.array_equal(a.cells, b.cells)


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame(
        [(1, 1), (1, 1), (5, 0), (7, 0), (9, 1), (None, 1), (3, None), (99, 1)], "doc_id bigint, quality int")
    rows = Q.scores(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (2, 3)}) == 1
    assert {r["score"] for r in Q.scores(odd_docs, labels.where("false")).collect()} == {0.5}
    assert Q.scores(no_docs, labels).collect() == []
    kept = Q.accepted(odd_docs, labels.where("false"))
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()
