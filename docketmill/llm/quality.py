"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

Statistics of a whole text (`STATISTICS`) are standardised and mapped to random
cosine features, which approximate a Gaussian kernel.  Ridge weights come from
normal equations that every partition sums for its rows and fold; the raw scores
of each fold, from weights fitted without it, are calibrated by isotonic
regression over a fixed grid of scores, so that a score is the share of label 1.

The fit sees at most `MAX_ROWS` labelled rows, the first by a hash of the id;
what is collected is bounded by the number of features, folds and grid cells.

Defined cases: a NULL text is an empty text and gets a score; rows without a
label or with a NULL label or id are not learned from, and a repeated label row
counts again; a text is scored by itself, so repeated rows get equal scores;
without labelled rows of both classes the score is the mean label, or 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketmill.llm import arrowtext as A
from docketmill.llm.common import crc_of_id

STATISTICS = (
    "log_bytes", "log_words", "mean_word_bytes", "upper", "digit", "sentence_marks", "other_marks",
    "line_breaks", "non_ascii", "repeated_next", "distinct_words", "short_words", "long_words",
    "markless_words", "log_words_per_line", "repeated_lines")

#: Labelled rows of a fit at most.
MAX_ROWS = 20_000
FEATURES = 256
#: Width of the Gaussian kernel, in standard deviations of a statistic.
WIDTH = 3.0
RIDGE = 1e-3
FOLDS = 4
#: Cells of the score grid of the calibration.
GRID = 512
SEED = 20_250_1
#: Partitions of the fit; fixed, so that sums do not depend on the cluster.
_PARTS = 8

_UPPER = A.byte_class((0x41, 0x5A))
_DIGIT = A.byte_class((0x30, 0x39))
_SENTENCE = A.byte_class(*[(ord(c), ord(c)) for c in ".,;:?'\"-"])
_MARK = A.byte_class((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E)) & ~_SENTENCE
_BREAK = A.byte_class((0x0A, 0x0A))
_HIGH = A.byte_class((0x80, 0xFF))
_LETTER = A.byte_class((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))


def _per_text(mask: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Number of set positions of `mask` in each text."""
    return np.diff(np.searchsorted(np.flatnonzero(mask), bounds)).astype(np.float64)


def _distinct(owner: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """Number of distinct hashes of each owner."""
    order = np.lexsort((hashes, owner))
    o, h = owner[order], hashes[order]
    fresh = np.ones(len(o), dtype=bool)
    fresh[1:] = (o[1:] != o[:-1]) | (h[1:] != h[:-1])
    return np.bincount(o[fresh], minlength=n).astype(np.float64)


def statistics(block: A.Block) -> np.ndarray:
    """One row of `STATISTICS` for each text of a block."""
    n, data, bounds = block.n_texts, block.data, block.bounds
    size = np.diff(bounds).astype(np.float64)
    w = A.words(block.lowered(), A.NOT_SPACE)
    count = np.bincount(w.owner, minlength=n).astype(np.float64)
    length = w.ends - w.starts
    some, words = np.maximum(size, 1), np.maximum(count, 1)

    def of_words(mask: np.ndarray) -> np.ndarray:
        return np.bincount(w.owner[mask], minlength=n) / words

    same = np.zeros(len(w.owner), dtype=bool)
    same[1:] = (w.owner[1:] == w.owner[:-1]) & (w.hashes[1:] == w.hashes[:-1])
    letters = np.searchsorted(np.flatnonzero(_LETTER[data]), np.stack([w.starts, w.ends]))
    lines = A.words(block, ~_BREAK)
    n_lines = np.maximum(np.bincount(lines.owner, minlength=n), 1)
    return np.column_stack([
        np.log1p(size), np.log1p(count), size / words,
        *[_per_text(mask[data], bounds) / some for mask in (_UPPER, _DIGIT, _SENTENCE, _MARK, _BREAK, _HIGH)],
        of_words(same), _distinct(w.owner, w.hashes, n) / words, of_words(length <= 3), of_words(length >= 12),
        of_words(letters[1] == letters[0]), np.log1p(count / n_lines),
        1 - _distinct(lines.owner, lines.hashes, n) / n_lines])


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def _statistics(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        rows = [statistics(block) for block in A.blocks(texts)]
        values = np.concatenate(rows) if rows else np.empty((0, len(STATISTICS)))
        yield pa.ListArray.from_arrays(
            pa.array(np.arange(len(values) + 1, dtype=np.int32) * len(STATISTICS)), pa.array(values.ravel()))


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cells: np.ndarray  # calibrated score by grid cell

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return fourier((stats - self.mean) / self.scale) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return calibrated(self.raw(stats), self.cells)


def _directions() -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(SEED)
    return (random.normal(scale=1 / WIDTH, size=(len(STATISTICS), FEATURES)),
            random.uniform(0, 2 * np.pi, FEATURES))


def fourier(standard: np.ndarray) -> np.ndarray:
    """Random cosine features of standardised statistics, and a constant."""
    directions, phases = _directions()
    waves = np.sqrt(2 / FEATURES) * np.cos(np.clip(standard, -8, 8) @ directions + phases)
    return np.hstack([waves, np.ones((len(waves), 1))])


def _cell(raw: np.ndarray) -> np.ndarray:
    """Cell of the raw score on a grid from -0.5 to 1.5."""
    return np.clip(((raw + 0.5) / 2 * GRID).astype(np.int64), 0, GRID - 1)


def calibrated(raw: np.ndarray, cells: np.ndarray) -> np.ndarray:
    return np.clip(cells[_cell(raw)], 0.0, 1.0)


def isotonic(total: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Non-decreasing fit of ones / total by pooling adjacent violators.

    Cells without rows lie on the line between their neighbours.
    """
    pools: list[list[float]] = []  # ones, total, first cell, last cell
    for cell in np.flatnonzero(total).tolist():
        pools.append([ones[cell], total[cell], cell, cell])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            one, n, _, last = pools.pop()
            pools[-1] = [pools[-1][0] + one, pools[-1][1] + n, pools[-1][2], last]
    at = [c for p in pools for c in (p[2], p[3])]
    values = [p[0] / p[1] for p in pools for _ in range(2)]
    return np.interp(np.arange(len(total)), at, values)


def _sums(stats: list[str]) -> T.StructType:
    return T.StructType([T.StructField("fold", T.IntegerType())] + [T.StructField(s, T.BinaryType()) for s in stats])


def _matrix(rows: pd.Series) -> np.ndarray:
    return np.stack(rows.to_numpy()) if len(rows) else np.empty((0, len(STATISTICS)))


def sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, max_rows: int = MAX_ROWS) -> DataFrame:
    """(fold, label, stats) of at most `max_rows` labelled documents that `learn` admits."""
    chosen = (
        labels.select(F.col("doc_id").cast("bigint"), F.col(label).cast("double").alias("label"))
        .where(learn & F.col("doc_id").isNotNull() & F.col("label").isNotNull())
        .orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id", "label").limit(max_rows))
    # At most max_rows rows of 20 bytes.
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return found.select(
        "doc_id", F.pmod(F.xxhash64(F.lit(SEED + 1), "doc_id"), F.lit(FOLDS)).cast("int").alias("fold"),
        "label", _statistics(F.col("text").cast("string")).alias("stats"))


def fit(rows: DataFrame) -> Model:
    """The model of rows (doc_id, fold, label, stats)."""
    n = len(STATISTICS)
    spread = rows.repartition(_PARTS, "doc_id").sortWithinPartitions("doc_id", "label").persist()
    try:
        moments = spread.select(F.posexplode("stats").alias("i", "x")).groupBy("i").agg(
            F.avg("x").alias("mean"), F.stddev_pop("x").alias("scale")).collect()
        mean, scale = np.zeros(n), np.ones(n)
        for m in moments:
            mean[m["i"]], scale[m["i"]] = m["mean"], m["scale"] if m["scale"] > 1e-9 else 1.0

        def normal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            gram = np.zeros((FOLDS, FEATURES + 1, FEATURES + 1))
            right = np.zeros((FOLDS, FEATURES + 1))
            for frame in frames:
                x = fourier((_matrix(frame["stats"]) - mean) / scale)
                y, fold = frame["label"].to_numpy(), frame["fold"].to_numpy()
                for k in range(FOLDS):
                    gram[k] += x[fold == k].T @ x[fold == k]
                    right[k] += x[fold == k].T @ y[fold == k]
            yield pd.DataFrame({
                "fold": range(FOLDS), "gram": [g.tobytes() for g in gram], "right": [r.tobytes() for r in right]})

        gram, right = np.zeros((FOLDS, FEATURES + 1, FEATURES + 1)), np.zeros((FOLDS, FEATURES + 1))
        for part in spread.mapInPandas(normal, _sums(["gram", "right"])).toLocalIterator():
            gram[part["fold"]] += np.frombuffer(part["gram"]).reshape(FEATURES + 1, -1)
            right[part["fold"]] += np.frombuffer(part["right"])

        def solved(g: np.ndarray, r: np.ndarray) -> np.ndarray:
            return np.linalg.solve(g + RIDGE * max(1.0, g[-1, -1]) / FEATURES * np.eye(len(g)), r)

        held_out = [solved(gram.sum(0) - gram[k], right.sum(0) - right[k]) for k in range(FOLDS)]

        def on_grid(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                x = fourier((_matrix(frame["stats"]) - mean) / scale)
                fold = frame["fold"].to_numpy()
                raw = np.empty(len(frame))
                for k in range(FOLDS):
                    raw[fold == k] = x[fold == k] @ held_out[k]
                yield pd.DataFrame({"cell": _cell(raw), "label": frame["label"]})

        total, ones = np.zeros(GRID), np.zeros(GRID)
        for r in spread.mapInPandas(on_grid, "cell int, label double").groupBy("cell").agg(
                F.count("*").alias("n"), F.sum("label").alias("ones")).collect():
            total[r["cell"]], ones[r["cell"]] = r["n"], r["ones"]
    finally:
        spread.unpersist()
    cells = isotonic(total, ones) if total.any() else np.full(GRID, 0.5)
    return Model(mean, scale, solved(gram.sum(0), right.sum(0)), cells)


def _scorer(model: Model):
    @F.arrow_udf(T.DoubleType())
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = [model.score(statistics(block)) for block in A.blocks(texts)]
            yield pa.array(np.concatenate(parts) if parts else np.empty(0))

    return score


def score(model: Model, text: str = "text") -> Column:
    """Score from 0 to 1 of a text column; NULL is empty."""
    return _scorer(model)(F.col(text).cast("string"))


def held_out() -> Column:
    return crc_of_id() % 3 == 1


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_ROWS) -> Model:
    """The model of the labelled documents that are not held out."""
    return fit(sample(docs, labels, label, ~held_out(), max_rows))


def scores(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """doc_id, held_out, score and predicted label of every document."""
    model = train(docs, labels, label)
    found = docs.select("doc_id", held_out().alias("held_out"), score(model).alias("score"))
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = 0.5) -> DataFrame:
    """The documents whose score reaches the threshold."""
    model = train(docs, labels, label)
    return docs.where(score(model) >= threshold)
