"""Toxicity by a classifier chain of logistic regressions on hashed words and word beginnings.

Categories are predicted one after the other: each model sees the words of a text and the
probabilities of the categories before it. In training those are out-of-fold predictions, so a
later model learns from probabilities as good as those it will meet.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .linear import Rows, adam, sampled, sigmoid
from .words import LETTERS_DIGITS, distinct, mix, runs

FEATURES = 1 << 18
# Bytes of a word's beginning, which stands for all its endings.
BEGINNING = 4
# Labelled texts to train on.
SAMPLE_TEXTS = 6_000
FOLDS = 3
# Words whose share of texts in the category is within so many standard errors of all texts' teach nothing.
STANDARD_ERRORS = 3.0
PENALTY = 1e-4


@dataclass
class Chain:
    categories: list[str]
    weights: list[np.ndarray] = field(default_factory=list)
    earlier: list[np.ndarray] = field(default_factory=list)  # of the logits of the categories before
    bias: list[float] = field(default_factory=list)
    cut: list[float] = field(default_factory=list)  # probability from which a text counts as in the category

    def probabilities(self, words: Rows) -> np.ndarray:
        found = np.zeros((len(words), 0))
        for w, e, b in zip(self.weights, self.earlier, self.bias):
            found = np.column_stack([found, sigmoid(words.times(w) + _logits(found) @ e + b)])
        return found


def _logits(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-3, 1 - 1e-3)
    return np.log(p / (1 - p))


def _fit_one(words: Rows, earlier: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    texts = np.bincount(words.index, minlength=FEATURES)
    share = label.mean() if len(label) else 0.0
    more = np.bincount(words.index, np.repeat(label, np.diff(words.begin)), minlength=FEATURES) - share * texts
    common = (texts >= 3) & (np.abs(more) > STANDARD_ERRORS * np.sqrt(texts * share * (1 - share)))
    active = np.flatnonzero(common)
    place = np.full(FEATURES, -1)
    place[active] = np.arange(len(active))
    keep = common[words.index]
    upto = np.concatenate([[0], np.cumsum(keep)])
    small = Rows(place[words.index[keep]], words.value[keep], upto[words.begin])
    w, e, b = np.zeros(len(active)), np.zeros(earlier.shape[1]), np.zeros(1)

    def gradients():
        error = (sigmoid(small.times(w) + earlier @ e + b) - label) / len(label)
        return [small.back(error, len(active)) + PENALTY * w, earlier.T @ error + PENALTY * e, error.sum(keepdims=True)]

    adam([w, e, b], gradients, steps=300)
    full = np.zeros(FEATURES)
    full[active] = w
    return full, e, float(b[0])


def fit_chain(words: Rows, labels: dict[str, np.ndarray], doc_id: np.ndarray, categories: list[str]) -> Chain:
    """A chain over the categories in the given order; labels are 0 or 1."""
    chain = Chain(categories)
    fold = np.asarray(doc_id) % FOLDS
    before = np.zeros((len(words), 0))
    for category in categories:
        label = labels[category].astype(float)
        out = np.zeros(len(words))
        for k in range(FOLDS):
            rest = fold != k
            if rest.all() or not rest.any():
                continue
            w, e, b = _fit_one(words.take(rest), _logits(before[rest]), label[rest])
            own = ~rest
            out[own] = sigmoid(words.take(own).times(w) + _logits(before[own]) @ e + b)
        w, e, b = _fit_one(words, _logits(before), label)
        chain.weights.append(w)
        chain.earlier.append(e)
        chain.bias.append(b)
        chain.cut.append(_best_cut(out, label))
        before = np.column_stack([before, out])
    return chain


def _best_cut(p: np.ndarray, label: np.ndarray) -> float:
    """The cut with the best F1 on out-of-fold predictions; half-way to the next lower one."""
    order = np.argsort(-p)
    hits = np.cumsum(label[order])
    if not len(p) or not hits[-1]:
        return 0.5
    best = int(np.argmax(2 * hits / (np.arange(1, len(p) + 1) + hits[-1])))
    low = p[order[best + 1]] if best + 1 < len(p) else 0.0
    return float(np.clip((p[order[best]] + low) / 2, 0.05, 0.95))


def _runs_of_words(column: pa.Array):
    for run in runs(column, LETTERS_DIGITS):
        both = np.stack([run.hashes(), mix(run.hashes(BEGINNING))], axis=1).ravel()
        yield run.first, distinct(both % np.uint64(FEATURES), 2 * run.number)


def _features(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    out = []
    for _, (values, begin) in _runs_of_words(column):
        parts = [values[a:b] for a, b in zip(begin[:-1], begin[1:])]
        out += [(x, np.ones(len(x))) for x in parts]
    return out


def fit(documents: DataFrame, labels: DataFrame, categories: list[str], sample_texts: int = SAMPLE_TEXTS) -> Chain:
    """A chain from 0/1 label columns of (doc_id, ...); at most about `sample_texts` texts are looked at."""
    words, known = sampled(documents, labels, categories, sample_texts, _features)
    return fit_chain(words, known, known["doc_id"], categories)


def scored(documents: DataFrame, chain: Chain) -> DataFrame:
    """Adds p_<category> and is_<category> for each category of the chain to (text, ...).

    Null and empty texts have no words: their probabilities are those of the biases and they are in
    no category. Rows and other columns stay; columns of these names are replaced.
    """
    names = [f"{kind}_{c}" for c in chain.categories for kind in ("p", "is")]
    documents = documents.drop(*names)

    def of(batches):
        for batch in batches:
            found = np.zeros((batch.num_rows, len(chain.categories)))
            some = np.zeros(batch.num_rows, bool)
            for first, (values, begin) in _runs_of_words(batch.column("text")):
                words = Rows(values.astype(np.int64), np.ones(len(values)), begin)
                found[first : first + len(words)] = chain.probabilities(words)
                some[first : first + len(words)] = np.diff(begin) > 0
            columns = []
            for i, cut in enumerate(chain.cut):
                columns += [pa.array(found[:, i]), pa.array((found[:, i] >= cut) & some)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *names])

    kinds = [T.DoubleType(), T.BooleanType()] * len(chain.categories)
    schema = T.StructType([*documents.schema, *(T.StructField(n, k) for n, k in zip(names, kinds))])
    return documents.mapInArrow(of, schema)
