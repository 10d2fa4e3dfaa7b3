"""Whitening of embeddings by spectral projectors.

Entries become whole numbers first, so that sums over the table are exact in any
order.  One pass sums the vectors, a second one the products of centred vectors,
each a partial sum by task; the covariance, a number of dimensions squared, is all
that the driver gets.  Its eigenvectors come from QDWH spectral divide and conquer
(`spectral`), and the whitening matrix, dimensions times components, goes to the
tasks of a third pass.  A last aggregate over the whitened rows tells how far their
covariance is from the identity.

Defined cases: rows whose vector is NULL, or holds a NULL or non-finite entry, or
one beyond `LARGEST` (its whole number would not be exact), are dropped; so are
empty vectors and those of another length than most rows have (the longer, if two
are as frequent).  Rows without an id, and rows that repeat one, are rows like any
other.  Components without variance (to rounding) are no components: equal vectors,
a single one or an empty table give no rows.  A deviation beyond a long is NULL.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketmill.llm.common import materialized
from docketmill.llm.spectral import eigenvectors

#: Whole numbers are floor(SCALE * entry) + OFFSET.
SCALE = 1024
OFFSET = 100_000
LARGEST = float(1 << 42)
COMPONENTS = 8
#: Entries of the vectors that a task works on at once.
_ENTRIES = 1 << 20


@dataclass
class Fit:
    """Exact sums, and the eigenvalues and unit eigenvectors of the covariance."""

    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    vectors: np.ndarray

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.trace


def clean(rows: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(key, entries) of the rows whose vectors can be whitened."""
    entries = F.col(vector).cast("array<double>")
    good = F.forall(entries, lambda c: F.coalesce(F.abs(c) <= LARGEST, F.lit(False)) & ~F.isnan(c))
    return rows.select(F.col(key), entries.alias("entries")).where(
        F.coalesce(good, F.lit(False)) & (F.size("entries") > 0))


def _vectors(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and whole-number vectors, those of one length at a time and in bounded pieces."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        step = max(1, _ENTRIES // size)
        for at in range(0, len(rows), step):
            some = rows[at : at + step]
            entries = flat[starts[some][:, None] + np.arange(size)]
            yield some, np.floor(SCALE * entries).astype(np.int64) + OFFSET


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(dims, i, n, total) of a task: vectors of each length, and their sums; totals as text."""
    totals: dict[int, list] = {}
    for batch in batches:
        for _, x in _vectors(batch.column(0)):
            # Sums of a piece fit in 64 bits; those of a task may not.
            n, total = totals.get(x.shape[1], (0, np.zeros(x.shape[1], dtype=object)))
            totals[x.shape[1]] = [n + len(x), total + x.sum(axis=0).astype(object)]
    for size, (n, total) in totals.items():
        yield pa.RecordBatch.from_pydict({
            "dims": pa.array([size] * size, pa.int32()), "i": pa.array(range(size), pa.int32()),
            "n": pa.array([n] * size, pa.int64()), "total": pa.array([str(t) for t in total], pa.string())})


def sums(vectors: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors of the commonest length, and their sums by dimension."""
    parts = vectors.select("entries").mapInArrow(_sums, "dims int, i int, n bigint, total string")
    by_length = parts.where("i = 0").groupBy("dims").agg(F.sum("n").alias("n"))
    most = by_length.orderBy(F.desc("n"), F.desc("dims")).first()
    if most is None:
        return 0, []
    found = parts.where(F.col("dims") == most["dims"]).groupBy("i").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()  # one row a dimension
    return most["n"], [int(r["total"]) for r in sorted(found, key=lambda r: r["i"])]


def _centre(x: np.ndarray, n: int, means: np.ndarray, rests: np.ndarray) -> np.ndarray:
    """Vectors minus their mean; the whole part of the mean goes first, so nothing is rounded away."""
    return (x - means) - rests / n


def _mean(n: int, total: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Whole part of the mean and what is left of the sum."""
    parts = [divmod(t, n) for t in total]
    return np.array([p[0] for p in parts], dtype=np.int64), np.array([p[1] for p in parts], dtype=np.int64)


def covariance(vectors: DataFrame, n: int, total: list[int]) -> np.ndarray:
    """Covariance with divisor `n`, of vectors that are centred before they are multiplied."""
    size = len(total)
    means, rests = _mean(n, total)
    upper = np.triu_indices(size)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums_ = np.zeros((size, size))
        for batch in batches:
            for _, x in _vectors(batch.column(0)):
                z = _centre(x, n, means, rests)
                sums_ += z.T @ z
        yield pa.RecordBatch.from_arrays(
            [pa.array(upper[0].astype(np.int32)), pa.array(upper[1].astype(np.int32)), pa.array(sums_[upper])],
            ["i", "j", "v"])

    parts = vectors.where(F.size("entries") == size).select("entries").mapInArrow(products, "i int, j int, v double")
    found = parts.groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()  # dimensions squared, halved
    cov = np.zeros((size, size))
    i, j = found["i"].to_numpy(), found["j"].to_numpy()
    cov[i, j] = cov[j, i] = found["v"].to_numpy() / n
    return cov


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Fit:
    """The first components of the cleaned vectors."""
    n, total = sums(vectors)
    if not n:
        return Fit(0, [], 0.0, np.empty(0), np.empty((0, 0)))
    cov = covariance(vectors, n, total)
    values, columns = eigenvectors(cov)
    rounding = len(total) * np.finfo(np.float64).eps * max(float(values[0]), 0.0)
    kept = min(components, int(np.count_nonzero(values > rounding)))
    return Fit(n, total, float(np.trace(cov)), values[:kept], columns[:, :kept])


def whitened(vectors: DataFrame, model: Fit, key: str = "vec_id") -> DataFrame:
    """(key, deviation, whitened) of every fitted row; `whitened` has a number for each component.

    `deviation` is the exact sum of (n * x - S)^2, where S are the sums.
    """
    size, n = len(model.sums), model.n
    means, rests = _mean(n, model.sums) if n else (np.empty(0), np.empty(0))
    matrix = model.vectors / np.sqrt(model.values)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in _vectors(batch.column(1)):
                z = _centre(x, n, means, rests) @ matrix
                far = (n * (x - means).astype(np.float64) - rests) ** 2
                fits = far.sum(axis=1) < 2.0**63 * (1 - 1e-9)
                spread = n * np.where(fits[:, None], x - means, 0) - rests
                deviation = (spread * spread).sum(axis=1)
                ends = np.arange(len(z) + 1, dtype=np.int32) * z.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows)), pa.array(deviation, pa.int64(), mask=~fits),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(z.ravel()))],
                    [key, "deviation", "whitened"])

    kind = vectors.schema[key].dataType.simpleString()
    some = vectors.where((F.size("entries") == size) & F.lit(len(model.values) > 0))
    return some.select(key, "entries").mapInArrow(apply, f"`{key}` {kind}, deviation bigint, whitened array<double>")


def identity_error(rows: DataFrame, components: int) -> float:
    """Largest absolute entry of the covariance of `whitened` minus the identity."""
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    if not pairs:
        return 0.0
    w = F.col("whitened")
    cov = rows.agg(*[F.covar_pop(w[i], w[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max((abs((v or 0.0) - (i == j)) for v, (i, j) in zip(cov, pairs, strict=True)), default=0.0)


def whiten(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error) of every row and component."""
    vectors = clean(rows, key, vector)
    model = fit(vectors, components)
    done = materialized(whitened(vectors, model, key), "whitened")
    error = identity_error(done, len(model.values))
    parts = F.array(*[F.lit(float(v)) for v in model.explained]).cast("array<double>")
    long = done.select(key, "deviation", F.posexplode("whitened").alias("at", "value"))
    return long.select(
        key, (F.col("at") + 1).alias("component"), F.lit(model.n).cast("bigint").alias("n"), "deviation",
        F.col("value").alias("whitened"), F.get(parts, F.col("at")).alias("explained"),
        F.lit(float(error)).alias("identity_error"))
