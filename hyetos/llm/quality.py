"""A quality classifier: regularised quadratic discriminant of document statistics.

A text is described by ``len(STATISTICS)`` numbers: sizes as logarithms, shares as smoothed
log odds, so that each is near normal within a class. Counts, means and products of both
classes are summed over all labelled rows; only these sums reach the driver. Each class
covariance is shrunk towards the common one (``POOL``) and that towards a multiple of the
identity (``ROUND``), then factored once; a score is the logistic function of the difference of the
classes' log densities, Mahalanobis distances taken by forward substitution with the factors.

Texts are read once: their statistics are written to a table, which both the fit and the
scores use. No sample is taken.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructType

from hyetos.llm.common import slices, stored

POOL = 0.3
ROUND = 0.2
THRESHOLD = 0.3
#: Variance added to every statistic, so that constant ones have a density too.
LEAST_VARIANCE = 1e-3

STATISTICS = (
    "characters", "words", "word length", "longest word", "words in a line", "letters",
    "capitals among letters", "digits", "marks", "spaces", "different words", "different lines",
    "most frequent word", "words of letters alone", "short words",
)
LETTER, CAPITAL, DIGIT, SPACE, MARK = range(5)


def _kinds() -> np.ndarray:
    """The kind of every code point of the basic plane; any beyond it counts as a letter."""
    kinds = np.full(1 << 16, MARK, np.uint8)
    for code in range(1 << 16):
        character = chr(code)
        if character.isalpha():
            kinds[code] = CAPITAL if character.isupper() else LETTER
        elif character.isdigit():
            kinds[code] = DIGIT
        elif character.isspace():
            kinds[code] = SPACE
    return kinds


_table: list[np.ndarray] = []


def _count_kinds(text: str) -> list[int]:
    if not _table:
        _table.append(_kinds())
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    near = codes[codes < 1 << 16]
    counts = np.bincount(_table[0][near], minlength=5)
    counts[LETTER] += len(codes) - len(near)
    return counts.tolist()


def _odds(part: float, whole: float) -> float:
    """Log odds of a share, smoothed; 0 where there is nothing to share."""
    return math.log((part + 0.5) / (whole - part + 0.5))


def statistics(text: str) -> list[float]:
    """The numbers that describe a whole text; an empty one has them too."""
    letters, capitals, digits, spaces, marks = _count_kinds(text)
    letters += capitals
    words = text.split()
    lines = [line for line in text.split("\n") if line]
    counts = Counter(words)
    n, size = len(words), len(text)
    lengths = np.fromiter(map(len, words), np.int64, n)
    return [
        math.log1p(size),
        math.log1p(n),
        math.log1p(lengths.sum() / max(n, 1)),
        math.log1p(lengths.max(initial=0)),
        math.log1p(n / max(len(lines), 1)),
        _odds(letters, size),
        _odds(capitals, letters),
        _odds(digits, size),
        _odds(marks, size),
        _odds(spaces, size),
        _odds(len(counts), n),
        _odds(len(set(lines)), len(lines)),
        _odds(max(counts.values(), default=0), n),
        _odds(sum(k for w, k in counts.items() if w.isalpha()), n),
        _odds(int((lengths <= 3).sum()), n),
    ]


def described(docs: DataFrame, name: str = "statistics") -> DataFrame:
    """``docs`` with the statistics of ``text`` in an array; ``text`` itself goes, all else stays.

    A NULL text counts as empty. A column called ``name`` is replaced.
    """
    kept = [c for c in docs.columns if c not in ("text", name)]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [statistics(t or "") for t in batch.column("text").to_pylist()]
            columns = [batch.column(c) for c in kept]
            array = pa.array(rows, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*columns, array], names=[*kept, name])

    schema = StructType([docs.schema[c] for c in kept]).add(name, ArrayType(DoubleType()))
    return docs.mapInArrow(apply, schema)


@dataclass
class Model:
    """Log odds of the classes, and for each its mean, factor and log determinant.

    Without classes (``means`` empty) the model is the constant ``odds``.
    """

    odds: float
    means: list[np.ndarray]
    factors: list[np.ndarray]
    logs: list[float]

    def raw(self, x: np.ndarray) -> np.ndarray:
        """Log density of class 1 less that of class 0, plus the log odds, for rows of ``x``."""
        total = np.full(len(x), self.odds)
        for sign, mean, factor, log in zip((-1, 1), self.means, self.factors, self.logs, strict=False):
            left = (x - mean).T
            solved = np.zeros_like(left)
            for i in range(len(left)):  # forward substitution, all rows at once
                solved[i] = (left[i] - factor[i, :i] @ solved[:i]) / factor[i, i]
            total += sign * (-0.5 * (solved**2).sum(axis=0) - log)
        return total

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))


def _moments(labelled: DataFrame) -> list[tuple[int, int, float]]:
    """(label, place, sum) of 1, the statistics and their products, over all rows."""
    d = len(STATISTICS)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((2, 1 + d + d * d))
        for batch in slices(batches, 4096):
            x = np.array(batch.column(0).to_pylist(), float).reshape(-1, d)
            labels = batch.column(1).to_numpy(zero_copy_only=False)
            for label in (0, 1):
                own = x[labels == label]
                sums = [[len(own)], own.sum(axis=0), (own.T @ own).ravel()]
                totals[label] += np.concatenate(sums)
        label, place = np.indices(totals.shape)
        arrays = [label.ravel().astype(np.int32), place.ravel().astype(np.int32), totals.ravel()]
        yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=["label", "place", "total"])

    sums = labelled.mapInArrow(add, "label int, place int, total double")
    return sums.groupBy("label", "place").agg(F.sum("total").alias("total")).collect()


def fit(counts: np.ndarray, sums: np.ndarray, products: np.ndarray) -> Model:
    """The model of two classes, given their row counts, sums and summed products."""
    odds = float(np.log((counts[1] + 1) / (counts[0] + 1)))
    if counts.min() < 2:
        return Model(odds, [], [], [])
    d = sums.shape[1]
    means = sums / counts[:, None]
    scatter = [products[k] - counts[k] * np.outer(means[k], means[k]) for k in (0, 1)]
    factors, logs = [], []
    for k in (0, 1):
        weight = (1 - POOL) * counts[k] + POOL * counts.sum()
        shrunk = ((1 - POOL) * scatter[k] + POOL * (scatter[0] + scatter[1])) / weight
        shrunk = (1 - ROUND) * shrunk + (ROUND * np.trace(shrunk) / d + LEAST_VARIANCE) * np.eye(d)
        factors.append(np.linalg.cholesky((shrunk + shrunk.T) / 2))
        logs.append(float(np.log(np.diag(factors[k])).sum()))
    return Model(odds, [means[0], means[1]], factors, logs)


def train(vectors: DataFrame, labels: DataFrame, name: str = "statistics") -> Model:
    """Fit on the rows of ``vectors`` (doc_id and statistics) with a label in ``labels``.

    ``labels`` has doc_id and quality. Labels other than 0 and 1 and NULL doc_ids teach
    nothing; repeated labels count as often as they are there. With fewer than two rows of
    either class the model is a constant, the smoothed share of class 1.
    """
    known = labels.where("quality in (0, 1) and doc_id is not null").select(
        "doc_id", F.col("quality").cast("int").alias("label")
    )
    labelled = vectors.select("doc_id", F.col(name).alias("x")).join(known, "doc_id")
    d = len(STATISTICS)
    totals = np.zeros((2, 1 + d + d * d))
    for row in _moments(labelled.select("x", "label")):  # 2 x (1 + d + d²) numbers
        totals[row.label, row.place] = row.total
    return fit(totals[:, 0], totals[:, 1 : 1 + d], totals[:, 1 + d :].reshape(2, d, d))


def score(
    vectors: DataFrame,
    model: Model,
    names: tuple[str, str] = ("score", "predicted"),
    name: str = "statistics",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Replace the statistics by a score from 0 to 1, and 1 where it reaches ``threshold``."""
    shared = vectors.sparkSession.sparkContext.broadcast(model)  # two means, two factors
    kept = [c for c in vectors.columns if c not in (*names, name)]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            x = np.array(batch.column(name).to_pylist(), float).reshape(-1, len(STATISTICS))
            found = shared.value.scores(x)
            predicted = (found >= threshold).astype(np.int32)
            columns = [*[batch.column(c) for c in kept], pa.array(found), pa.array(predicted)]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, *names])

    schema = StructType([vectors.schema[c] for c in kept])
    schema = schema.add(names[0], DoubleType()).add(names[1], IntegerType())
    return vectors.mapInArrow(apply, schema)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, score and predicted of every row of ``docs``, learnt from ``labels``."""
    vectors = stored(described(docs.select("doc_id", "text")), "quality-statistics")
    return score(vectors, train(vectors, labels))
