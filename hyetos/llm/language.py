"""Language of texts and of the spans inside them.

Letters are grouped into scripts by code-point ranges; a word's script leaves only the
languages that use it. Each word gets a score per language, the sum of the log
probabilities of its letters with their two neighbours, learned from labelled texts. A
Viterbi pass with a penalty for each switch then labels the words, and so the spans. The
text as a whole gets the language that most of its letters have.

The counts cover every labelled text given. The model has one row per hashed letter triple
and language: it is broadcast, and more than ``MAX_LANGUAGES`` languages are refused.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructType

from hyetos.llm.common import slices

GRAMS = 1 << 15
MAX_LANGUAGES = 500
CHUNK = 200_000
#: First code points of scripts; each runs up to the next entry, ``other`` stands between.
SCRIPT_STARTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"),
    (0x0590, "hebrew"), (0x0600, "arabic"), (0x0700, "other"), (0x0900, "devanagari"),
    (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B00, "other"),
    (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"),
    (0x0D80, "sinhala"), (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"),
    (0x1000, "burmese"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"),
    (0x13A0, "other"), (0x1780, "khmer"), (0x1800, "mongolian"), (0x18B0, "other"),
    (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x2C60, "latin"),
    (0x2C80, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3130, "hangul"),
    (0x3190, "other"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"),
    (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB10, "other"),
    (0xFF21, "latin"), (0xFF66, "kana"), (0xFFA0, "other"), (0x20000, "han"),
    (0x32000, "other"),
]
SCRIPTS = sorted({name for _, name in SCRIPT_STARTS})
_STARTS = np.array([start for start, _ in SCRIPT_STARTS])
_NUMBERS = np.array([SCRIPTS.index(name) for _, name in SCRIPT_STARTS])
_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    """For each code point whether it is a letter; built once per process."""
    if not _letters:
        _letters.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    return _letters[0]


def chunks(text: str) -> Iterator[str]:
    """The text in parts of about ``CHUNK`` characters, cut at white space where there is any."""
    at = 0
    while len(text) - at > CHUNK:
        blank = re.compile(r"\s").search(text, at + CHUNK)
        stop = min(blank.start() if blank else len(text), at + 2 * CHUNK)
        yield text[at:stop]
        at = stop
    yield text[at:]


def letter_grams(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed triple and script of each letter, and where among them each word starts."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _is_letter()[points]
    own = np.zeros(len(points) + 2, np.uint32)
    own[1:-1] = np.where(letter, points, 0)
    mixed = own[:-2] * np.uint32(0x9E3779B1) + own[1:-1] * np.uint32(0x85EBCA6B)
    mixed += own[2:] * np.uint32(0xC2B2AE35)
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0x2C1B3C6D)
    at = np.flatnonzero(letter)
    grams = mixed[at] >> np.uint32(32 - GRAMS.bit_length() + 1)
    scripts = _NUMBERS[np.searchsorted(_STARTS, points[at], "right") - 1]
    starts = np.flatnonzero(np.diff(at, prepend=-2) > 1)
    return grams, scripts, starts


def count_grams(labelled: DataFrame) -> DataFrame:
    """Counts per language, triple and script of (text, lang): lang, gram, n.

    Scripts stand behind the triples, from ``GRAMS`` on. Summed inside each task first.
    NULL texts and rows without lang teach nothing.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}

        def rows() -> Iterator[pa.RecordBatch]:
            for lang, total in totals.items():
                used = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(used), pa.string()), pa.array(used, pa.int32()),
                     pa.array(total[used])],
                    names=["lang", "gram", "n"],
                )
            totals.clear()

        for batch in slices(batches):
            pairs = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            for text, lang in pairs:
                if lang not in totals:
                    if len(totals) >= 100:
                        yield from rows()
                    totals[lang] = np.zeros(GRAMS + len(SCRIPTS), np.int64)
                for part in chunks(text):
                    grams, scripts, _ = letter_grams(part)
                    totals[lang] += np.bincount(grams, minlength=GRAMS + len(SCRIPTS))
                    totals[lang][GRAMS:] += np.bincount(scripts, minlength=len(SCRIPTS))
        yield from rows()

    known = labelled.where("text is not null and lang is not null").select("text", "lang")
    counted = known.mapInArrow(count, "lang string, gram int, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray  # log probability by triple and language
    allowed: np.ndarray  # which languages a script leaves
    penalty: float

    def word_scores(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Scores of each word in each language, and the letters of each word."""
        scores, sizes = [], []
        for part in chunks(text):
            grams, scripts, starts = letter_grams(part)
            if len(starts):
                own = np.add.reduceat(self.scores[grams], starts, axis=0)
                own[~self.allowed[scripts[starts]]] -= 1e4
                scores.append(own)
                sizes.append(np.diff(starts, append=len(grams)))
        if not scores:
            return np.zeros((0, len(self.languages)), np.float32), np.zeros(0, np.int64)
        return np.concatenate(scores), np.concatenate(sizes)

    def label(self, scores: np.ndarray) -> np.ndarray:
        """The language of each word: the best path, each switch costing ``penalty``."""
        scores = scores.astype(np.float64)
        best = int(scores.sum(axis=0).argmax())
        # A stretch in another language must gain more than the switch into it costs. If no
        # stretch of any single language does, a path with a stretch in the best one gains
        # nothing; one without any gains at most ``away``, less one switch.
        gains = scores - scores[:, [best]]
        away = np.delete(gains, best, axis=1).max(axis=1, initial=-np.inf).sum()
        gains = np.cumsum(gains, axis=0)
        lows = np.minimum(0, np.minimum.accumulate(gains, axis=0))
        lows = np.vstack([np.zeros(scores.shape[1]), lows[:-1]])
        if max(away, (gains - lows).max(initial=0)) <= self.penalty:
            return np.full(len(scores), best)
        back, totals = [], [0.0] * len(self.languages)
        for row in scores.tolist():
            top = max(range(len(totals)), key=totals.__getitem__)
            switch = totals[top] - self.penalty
            back.append([i if t >= switch else top for i, t in enumerate(totals)])
            totals = [(t if t >= switch else switch) + s for t, s in zip(totals, row, strict=True)]
        state = max(range(len(totals)), key=totals.__getitem__)
        path = np.zeros(len(scores), np.int64)
        for at in range(len(scores) - 1, -1, -1):
            path[at] = state
            state = back[at][state]
        return path

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        """Language, first word and number of words of each span."""
        path = self.label(self.word_scores(text)[0])
        edges = [0, *(np.flatnonzero(np.diff(path)) + 1).tolist(), len(path)]
        return [(self.languages[path[a]], a, b - a)
                for a, b in zip(edges, edges[1:], strict=False) if b > a]

    def predict(self, text: str) -> tuple[str, float]:
        """The language of most letters (of equal ones the first) and its share of them."""
        scores, sizes = self.word_scores(text)
        if not len(sizes) or not self.languages:
            return "und", 0.0
        letters = np.bincount(self.label(scores), sizes, len(self.languages))
        best = int(letters.argmax())
        return self.languages[best], float(letters[best] / letters.sum())


def train(labelled: DataFrame, penalty: float = 12.0, least_share: float = 0.005) -> Model:
    """Learn from (text, lang). A script leaves the languages that it has at least
    ``least_share`` of the letters of; a script that no language has leaves all."""
    rows = count_grams(labelled).limit(MAX_LANGUAGES * (GRAMS + len(SCRIPTS)) + 1).toPandas()
    languages = sorted(rows["lang"].unique())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    counts = np.zeros((GRAMS + len(SCRIPTS), len(languages)))
    counts[rows["gram"], np.searchsorted(languages, rows["lang"])] = rows["n"]
    grams = counts[:GRAMS] + 0.5
    shares = counts[GRAMS:] / np.maximum(1, counts[GRAMS:].sum(axis=0))
    allowed = shares >= least_share
    allowed[~allowed.any(axis=1)] = True
    return Model(languages, np.log(grams / grams.sum(axis=0)).astype(np.float32), allowed, penalty)


def identify(docs: DataFrame, model: Model, with_spans: bool = False) -> DataFrame:
    """Add ``lang_pred`` and ``score`` (and ``spans``) to every row; the text alone counts.

    ``und`` and 0.0 for NULL texts, texts without letters, and if nothing was learned.
    Columns of these names are replaced; all others stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    added = ["lang_pred", "score"] + ["spans"] * with_spans
    kept = [c for c in docs.columns if c not in added]
    span = pa.list_(
        pa.struct([("lang", pa.string()), ("first_word", pa.int64()), ("words", pa.int64())])
    )

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in slices(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            found = [own.predict(t) for t in texts]
            arrays = [batch.column(c) for c in kept]
            arrays.append(pa.array([f[0] for f in found], pa.string()))
            arrays.append(pa.array([f[1] for f in found], pa.float64()))
            if with_spans:
                rows = [[dict(zip(("lang", "first_word", "words"), s, strict=True))
                         for s in own.spans(t)] if own.languages else [] for t in texts]
                arrays.append(pa.array(rows, span))
            yield pa.RecordBatch.from_arrays(arrays, names=[*kept, *added])

    schema = StructType([docs.schema[c] for c in kept])
    schema = schema.add("lang_pred", StringType()).add("score", DoubleType())
    if with_spans:
        kind = StructType().add("lang", StringType()).add("first_word", LongType())
        schema = schema.add("spans", ArrayType(kind.add("words", LongType())))
    return docs.mapInArrow(apply, schema)
