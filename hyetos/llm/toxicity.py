"""A toxicity classifier with counterfactual regularisation.

Features are the words of a text and the five-letter pieces inside them, hashed; a text
has a feature or has it not. From a bounded sample of labelled texts the features whose
share of toxic texts stands out are chosen, at least the ``LEAST_FEATURES`` best however
few texts there are, then a logistic regression is fitted. For
each sample text with identity terms a copy is made with every term swapped for another
of its group, and the squared change of the raw score is part of the loss: a neutral
mention of a group then moves no score, whichever labels the mentions happened to have.

``SAMPLE_ROWS`` bounds the labelled rows the fit sees, ``MAX_FEATURES`` the model. Scoring
covers every row and whole texts, and needs the model alone.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructType

from hyetos.llm.common import full_text, slices, stored

SAMPLE_ROWS = 20_000
MAX_FEATURES = 4_000
LEAST_Z = 3.0
#: So many of the best features are chosen even if they do not reach ``LEAST_Z``.
LEAST_FEATURES = 200
BUCKETS = 1 << 20
GRAM = 5
BLOCK = 1024
#: Tasks that the sample is spread over.
SPREAD = 32
MAX_CACHED = 400_000

#: Terms of one group can stand for each other in a neutral sentence.
IDENTITY_GROUPS = [
    ["women", "men"],
    ["woman", "man"],
    ["female", "male"],
    ["muslim", "christian", "jewish", "hindu", "buddhist", "atheist"],
    ["muslims", "christians", "jews", "hindus", "buddhists", "atheists"],
    ["black", "white", "asian", "latino", "arab"],
    ["gay", "lesbian", "bisexual", "straight", "transgender"],
    ["immigrants", "refugees", "foreigners", "natives"],
    ["femmes", "hommes"],
    ["musulmans", "chrétiens", "juifs"],
    ["frauen", "männer"],
    ["muslime", "christen", "juden"],
    ["mujeres", "hombres"],
    ["musulmanes", "cristianos", "judíos"],
]
_WORD = re.compile(r"[^\W\d_]+")


def words(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def swaps(groups: list[list[str]] = IDENTITY_GROUPS) -> dict[str, str]:
    """Each term and the next of its group."""
    return {a: b for group in groups for a, b in zip(group, group[1:] + group[:1], strict=True)}


def word_features(word: str) -> list[int]:
    """Hashed features of one word: itself and its padded pieces."""
    padded = f"^{word}$"
    pieces = {padded[i : i + GRAM] for i in range(len(padded) - GRAM + 1)}
    return [zlib.crc32(p.encode()) % BUCKETS for p in {f"={word}", *pieces}]


@dataclass
class Model:
    bias: float
    weights: dict[int, float] = field(default_factory=dict)
    #: Log odds of a text without a word: those of the training texts.
    base: float | None = None

    def scorer(self):
        """A function from text to score that remembers the features of words."""
        known: dict[str, tuple[int, ...]] = {}

        def score(text: str) -> float:
            if len(known) > MAX_CACHED:
                known.clear()
            present: set[int] = set()
            found = words(text)
            for word in found:
                own = known.get(word)
                if own is None:
                    own = tuple(f for f in word_features(word) if f in self.weights)
                    known[word] = own
                if own:
                    present.update(own)
            raw = self.bias + sum(self.weights[f] for f in sorted(present))
            if not found and self.base is not None:
                raw = self.base
            return float(1 / (1 + np.exp(-np.clip(raw, -30, 30))))

        return score


def _flat(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The owner and the number of every feature of some rows, four bytes each."""
    owner = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r) for r in rows])
    return owner, np.concatenate([*rows, np.zeros(0, np.int32)]).astype(np.int32)


def fit(
    rows: list[np.ndarray],
    swapped: list[np.ndarray],
    labels: np.ndarray,
    size: int,
    penalty: float = 1.0,
    ridge: float = 3e-5,
    steps: int = 400,
) -> tuple[float, np.ndarray]:
    """Logistic regression on rows of feature numbers below ``size``.

    ``swapped`` holds the rows after the swap; where they differ, ``penalty`` times the
    squared difference of the raw scores is added to the loss. Adam, full batches, added
    up over blocks of ``BLOCK`` rows.
    """
    n = len(labels)
    differ = [i for i in range(n) if not np.array_equal(rows[i], swapped[i])]
    blocks = [(i, _flat(rows[i : i + BLOCK])) for i in range(0, n, BLOCK)]
    pairs = [
        (_flat([rows[i] for i in part]), _flat([swapped[i] for i in part]), len(part))
        for part in (differ[i : i + BLOCK] for i in range(0, len(differ), BLOCK))
    ]
    theta = np.zeros(size + 1)
    base = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    theta[-1] = np.log(base / (1 - base))
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        weights = theta[:-1]
        gradient = np.append(ridge * weights, 0.0)
        for start, (owner, feature) in blocks:
            own = labels[start : start + BLOCK]
            raw = theta[-1] + np.bincount(owner, weights[feature], len(own))
            error = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - own) / n
            gradient[:-1] += np.bincount(feature, error[owner], size)
            gradient[-1] += error.sum()
        for (from_owner, from_feature), (to_owner, to_feature), count in pairs:
            gap = np.bincount(from_owner, weights[from_feature], count)
            gap -= np.bincount(to_owner, weights[to_feature], count)
            pull = 2 * penalty * gap / n
            gradient[:-1] += np.bincount(from_feature, pull[from_owner], size)
            gradient[:-1] -= np.bincount(to_feature, pull[to_owner], size)
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        theta -= 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
    return float(theta[-1]), theta[:-1]


def least_texts(toxic_texts: int) -> int:
    """Texts a feature must be in: one in 50 of the toxic ones, from 2 to 8."""
    return min(8, max(2, -(-toxic_texts // 50)))


def sample_of(labels: DataFrame, rows: int) -> DataFrame:
    """About ``rows`` labelled rows, surely at most a quarter more, chosen by hash of doc_id."""
    known = labels.where("toxic in (0, 1) and doc_id is not null").select("doc_id", "toxic")
    share = min(1.0, rows / max(1, known.count()))
    spread = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30))
    return known.where(spread < int(share * (1 << 30))).limit(rows + rows // 4)


def train(
    docs: DataFrame,
    labels: DataFrame,
    penalty: float = 1.0,
    groups: list[list[str]] = IDENTITY_GROUPS,
    rows: int = SAMPLE_ROWS,
) -> Model:
    """Fit on the texts of ``docs`` whose doc_id has a label in ``labels`` (doc_id, toxic).

    Without labelled texts, or with one class only, the model is a constant near the share
    of toxic texts, and near 0.05 if there are none. Labels other than 0 and 1 and NULL doc_ids
    teach nothing; repeated labels count as often as they are there. Where many rows have one
    doc_id, about 2 x ``rows`` of all labelled rows are taken.
    Two classes whose texts share no feature are an error.
    """
    chosen = F.broadcast(sample_of(labels, rows))  # at most 1.25 x ``rows`` rows
    found = docs.select("doc_id", full_text().alias("text")).join(chosen, "doc_id")
    matches = docs.select("doc_id").join(chosen, "doc_id").count()
    if matches > 2 * rows:
        draw = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 30))
        found = found.where(draw < int(2 * rows / matches * (1 << 30)))
    sample = found.select("text", F.col("toxic").cast("int").alias("toxic"))
    sample = stored(sample.repartition(SPREAD), "toxicity-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((2, BUCKETS), np.int64)
        for batch in slices(batches):
            pairs = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            for text, toxic in pairs:
                own = {f for word in words(text) for f in word_features(word)}
                totals[toxic, list(own)] += 1
        used = np.flatnonzero(totals.sum(axis=0) > 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(totals[0, used]), pa.array(totals[1, used])],
            names=["feature", "clean", "toxic"],
        )

    n, toxic_texts = sample.agg(F.count("*"), F.sum("toxic")).first()
    toxic_texts = toxic_texts or 0
    rate = (toxic_texts + 1) / (n + 20)
    constant = Model(float(np.log(rate / (1 - rate))))
    if toxic_texts in (0, n):
        return constant
    share = toxic_texts / n
    texts = F.col("clean") + F.col("toxic")
    z = (F.col("toxic") - texts * share) / F.sqrt(texts * share * (1 - share))
    ranked = (
        sample.mapInArrow(count, "feature long, clean long, toxic long")
        .groupBy("feature")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .where(texts >= least_texts(toxic_texts))
        .select("feature", F.abs(z).alias("z"))
        .orderBy(F.desc("z"), "feature")
        .limit(MAX_FEATURES)
        .collect()
    )
    picked = [r.feature for i, r in enumerate(ranked) if i < LEAST_FEATURES or r.z >= LEAST_Z]
    numbers = {feature: i for i, feature in enumerate(picked)}
    if not numbers:
        raise ValueError("toxic and other texts are labelled, but no word or piece is in two of them")
    swap = swaps(groups)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(found: Iterable[str]) -> bytes:
            own = {numbers[f] for w in found for f in word_features(w) if f in numbers}
            return np.array(sorted(own), np.int32).tobytes()

        for batch in slices(batches):
            found = [words(t) for t in batch.column(0).to_pylist()]
            plain = [row(w) for w in found]
            other = [row({swap.get(x, x) for x in w}) if w & swap.keys() else None for w in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(plain, pa.binary()), pa.array(other, pa.binary()), batch.column(1)],
                names=["plain", "other", "toxic"],
            )

    # the bounded sample: four bytes a feature, the swapped row only where there is one
    taken = sample.mapInArrow(features, "plain binary, other binary, toxic int").toPandas()
    plain = [np.frombuffer(p, np.int32) for p in taken["plain"]]
    other = [p if o is None else np.frombuffer(o, np.int32) for p, o in zip(plain, taken["other"], strict=True)]
    bias, weights = fit(plain, other, taken["toxic"].to_numpy(float), len(numbers), penalty)
    return Model(bias, {f: float(weights[i]) for f, i in numbers.items()}, constant.bias)


def score(
    docs: DataFrame, model: Model, names: tuple[str, str] = ("score", "predicted")
) -> DataFrame:
    """Add a score from 0 to 1, and 1 where it is at least 0.5, to every row, under ``names``.

    NULL texts count as empty. Columns of these names are replaced; all others stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most MAX_FEATURES weights
    kept = [c for c in docs.columns if c not in names]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = shared.value.scorer()
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            scores = [scorer(t or "") for t in texts]
            columns = [batch.column(c) for c in kept]
            predicted = [int(s >= 0.5) for s in scores]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(scores, pa.float64()), pa.array(predicted, pa.int32())],
                names=[*kept, *names],
            )

    schema = StructType([docs.schema[c] for c in kept])
    schema = schema.add(names[0], DoubleType()).add(names[1], IntegerType())
    return docs.mapInArrow(apply, schema)


def fold(doc_id: str, parts: int) -> Column:
    """crc32 of the doc_id as text, modulo ``parts``; a NULL doc_id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % parts
