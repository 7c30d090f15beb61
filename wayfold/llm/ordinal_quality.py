"""Quality by ordinal regression (cumulative link) on hashed text.

Grades 0 to k share one weight vector over hashed trigrams of bytes (their share in a text) and hashed words
(present or not); ordered thresholds cut the score into grades: P(grade >= j) = sigmoid(score - threshold j). That gives an expected grade and
the probability of the upper tail, by which texts are selected.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .linear import Rows, adam, sampled, sigmoid
from .words import LETTERS_DIGITS, NOT_SPACE, distinct, mix, runs

TRIGRAMS, WORDS = 1 << 16, 1 << 18
FEATURES = TRIGRAMS + WORDS
# Bytes of a word's beginning, which stands for all its endings.
BEGINNING = 4
# Graded texts to train on.
SAMPLE_TEXTS = 6_000
PENALTY = 1e-5
# Words as frequent in two neighbouring grades, within so many standard errors, teach nothing.
STANDARD_ERRORS = 3.0
# Values are occurrences per so many bytes.
PER = 30.0


@dataclass
class Ordinal:
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one per grade above 0

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= j) for j = 1, 2, ..."""
        return sigmoid(score[:, None] - self.thresholds[None, :])


def fit_ordinal(rows: Rows, grade: np.ndarray) -> Ordinal:
    """Maximum likelihood with a penalty, each grade with the same weight; thresholds are a first one and positive steps."""
    grades = max(int(grade.max(initial=0)), 1)
    texts = np.bincount(grade, minlength=grades + 1)
    weight = 1 / (np.maximum(texts, 1)[grade] * max((texts > 0).sum(), 1))
    rows, active = _telling(rows, grade, grades)
    w, first, steps = np.zeros(len(active)), np.zeros(1), np.zeros(grades - 1)

    def thresholds():
        return first[0] + np.concatenate([[0.0], np.cumsum(np.exp(steps))])

    def gradients():
        score = rows.times(w)
        t = thresholds()
        upper = np.concatenate([t, [np.inf]])[grade]  # P(grade) = F(upper - score) - F(lower - score)
        lower = np.concatenate([[-np.inf], t])[grade]
        a, b = sigmoid(upper - score), sigmoid(lower - score)
        share = np.maximum(a - b, 1e-12)
        da, db = a * (1 - a) / share * weight, b * (1 - b) / share * weight
        dt = np.bincount(grade, -da, minlength=grades + 1)[:grades] + np.bincount(grade, db, minlength=grades + 1)[1:]
        dsteps = np.array([dt[j + 1 :].sum() * np.exp(steps[j]) for j in range(grades - 1)])
        return [rows.back(da - db, len(active)) + PENALTY * w, dt.sum(keepdims=True), dsteps]

    adam([w, first, steps], gradients, steps=200, rate=0.1)
    full = np.zeros(FEATURES)
    full[active] = w
    return Ordinal(full, thresholds())


def _telling(rows: Rows, grade: np.ndarray, grades: int) -> tuple[Rows, np.ndarray]:
    """The rows with trigrams and words that tell neighbouring grades apart, numbered anew, and what those are."""
    of = np.repeat(grade, np.diff(rows.begin))
    keep = np.arange(FEATURES) < TRIGRAMS
    for j in range(1, grades + 1):
        low, high = (np.bincount(rows.index[of == g], minlength=FEATURES) for g in (j - 1, j))
        n_low, n_high = (grade == j - 1).sum(), (grade == j).sum()
        if n_low and n_high:
            share = n_high / (n_low + n_high)
            both = low + high
            keep |= (both >= 3) & (np.abs(high - share * both) > STANDARD_ERRORS * np.sqrt(both * share * (1 - share)))
    active = np.flatnonzero(keep)
    kept = keep[rows.index]
    upto = np.concatenate([[0], np.cumsum(kept)])
    return Rows(np.searchsorted(active, rows.index[kept]), rows.value[kept], upto[rows.begin]), active


def _trigrams(column: pa.Array):
    """First row, feature of each trigram, and where each text's begin."""
    for run in runs(column, NOT_SPACE):
        b = run.data.astype(np.uint64)
        spans = np.maximum(np.diff(run.offsets) - 2, 0)
        begin = np.concatenate([[0], np.cumsum(spans)])
        at = np.arange(begin[-1]) + np.repeat(run.offsets[:-1] - begin[:-1], spans)
        packed = (b[:-2] << np.uint64(16)) | (b[1:-1] << np.uint64(8)) | b[2:] if len(b) > 2 else b[:0]
        feature = ((packed * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(np.int64)
        yield run.first, feature[at], begin


def _words(column: pa.Array):
    """First row, feature of each different word and beginning of a word of a text, and where each text's begin."""
    for run in runs(column, LETTERS_DIGITS):
        both = np.stack([run.hashes(), mix(run.hashes(BEGINNING))], axis=1).ravel()
        values, begin = distinct(both % np.uint64(WORDS), 2 * run.number)
        yield run.first, values.astype(np.int64) + TRIGRAMS, begin


def _features(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    shares, words = [], []
    for _, feature, begin in _trigrams(column):
        for a, b in zip(begin[:-1], begin[1:]):
            index, count = np.unique(feature[a:b], return_counts=True)
            shares.append((index, count * (PER / max(b - a, 1))))
    for _, feature, begin in _words(column):
        words += [feature[a:b] for a, b in zip(begin[:-1], begin[1:])]
    return [(np.concatenate([i, w]), np.concatenate([x, np.ones(len(w))])) for (i, x), w in zip(shares, words)]


def fit(documents: DataFrame, ratings: DataFrame, sample_texts: int = SAMPLE_TEXTS) -> Ordinal:
    """A model of graded (doc_id, grade), grades 0, 1, ...; at most about `sample_texts` texts are looked at."""
    rows, known = sampled(documents, ratings, ["grade"], sample_texts, _features)
    return fit_ordinal(rows, np.rint(known["grade"]).astype(np.int64))


def graded(documents: DataFrame, model: Ordinal, select_from: int = 1, least: float = 0.5) -> DataFrame:
    """Adds expected_grade, tail (probability of grade `select_from` or more) and selected (tail >= least).

    Null texts and texts of under three bytes are not selected; without words their score is 0. Repeated rows are graded
    alike, very long texts as a whole; an empty table gives an empty result. A tail equal to `least` (a tie) is
    selected. Rows and other columns stay; columns of these names are replaced.
    """
    names = ["expected_grade", "tail", "selected"]
    documents = documents.drop(*names)

    def of(batches):
        for batch in batches:
            score = np.zeros(batch.num_rows)
            some = np.zeros(batch.num_rows, bool)
            for first, feature, begin in _trigrams(batch.column("text")):
                n = np.diff(begin)
                upto = np.concatenate([[0.0], np.cumsum(model.weights[feature])])
                score[first : first + len(n)] = PER * (upto[begin[1:]] - upto[begin[:-1]]) / np.maximum(n, 1)
                some[first : first + len(n)] = n > 0
            for first, feature, begin in _words(batch.column("text")):
                upto = np.concatenate([[0.0], np.cumsum(model.weights[feature])])
                score[first : first + len(begin) - 1] += upto[begin[1:]] - upto[begin[:-1]]
            tails = model.tails(score)
            tail = tails[:, select_from - 1] if select_from <= tails.shape[1] else np.zeros(len(score))
            columns = [pa.array(tails.sum(axis=1)), pa.array(tail), pa.array((tail >= least) & some)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *names])

    kinds = [T.DoubleType(), T.DoubleType(), T.BooleanType()]
    schema = T.StructType([*documents.schema, *(T.StructField(n, k) for n, k in zip(names, kinds))])
    return documents.mapInArrow(of, schema)


def grades(labels: DataFrame) -> DataFrame:
    """(doc_id, grade) of (doc_id, quality, toxic): 0 poor, 1 good but toxic, 2 good."""
    grade: Column = F.col("quality") * (2 - F.coalesce("toxic", F.lit(0)))
    return labels.where("quality is not null").select("doc_id", grade.alias("grade"))
