"""Language identification by a byte convolutional network, trained in NumPy.

Filters of several widths run over the bytes of a window; each filter's largest response over the
window goes to a softmax over languages. A text is cut into windows of fixed length, all of them are
scored in batches, and the text's language is that of the largest mean probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8
# Labelled texts to train on, shared out evenly over languages, and windows of each.
SAMPLE_TEXTS = 2_400
WINDOWS = 4
# Windows are scored when those held are more than so many bytes.
HELD_BYTES = 1 << 21
UNKNOWN = "und"

_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_LETTER = np.array([chr(b).isalpha() for b in range(128)] + [False] * 128)


@dataclass
class Model:
    languages: list[str]
    tables: list[np.ndarray]  # per width: (width, 256, FILTERS)
    bias: list[np.ndarray]
    out: np.ndarray  # (filters, languages)
    out_bias: np.ndarray

    def responses(self, windows: np.ndarray) -> list[np.ndarray]:
        """Per width: (windows, places, FILTERS)."""
        found = []
        for table in self.tables:
            width = len(table)
            places = windows.shape[1] - width + 1
            total = table[0][windows[:, :places]]
            for k in range(1, width):
                total += table[k][windows[:, k : k + places]]
            found.append(total)
        return found

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        pooled = [np.maximum(x.max(axis=1) + b, 0) for x, b in zip(self.responses(windows), self.bias)]
        return _softmax(np.concatenate(pooled, axis=1) @ self.out + self.out_bias)


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], epochs: int = 4, seed: int = 5) -> Model:
    """Adam on cross entropy; the gradient of a maximum goes to the place it was taken from."""
    rng = np.random.default_rng(seed)
    n = len(languages)
    model = Model(
        languages,
        [rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS],
        [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
        rng.normal(0, 0.3, (FILTERS * len(WIDTHS), n)).astype(np.float32),
        np.zeros(n, np.float32),
    )
    params = [*model.tables, *model.bias, model.out, model.out_bias]
    first = [np.zeros_like(p) for p in params]
    second = [np.zeros_like(p) for p in params]
    step, size = 0, 64
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for a in range(0, len(order), size):
            x, y = windows[order[a : a + size]], labels[order[a : a + size]]
            rows, places, pooled = np.arange(len(x)), [], []
            for response, b in zip(model.responses(x), model.bias):
                at = response.argmax(axis=1)
                places.append(at)
                pooled.append(np.take_along_axis(response, at[:, None], 1)[:, 0] + b)
            hidden = np.maximum(np.concatenate(pooled, axis=1), 0)
            error = _softmax(hidden @ model.out + model.out_bias)
            error[rows, y] -= 1
            error /= len(x)
            back = (error @ model.out.T) * (hidden > 0)
            grads = []
            for w, width in enumerate(WIDTHS):
                own = back[:, w * FILTERS : (w + 1) * FILTERS]
                grad = np.zeros_like(model.tables[w])
                for k in range(width):
                    np.add.at(grad[k], (x[rows[:, None], places[w] + k], np.arange(FILTERS)[None]), own)
                grads.append(grad)
            grads += [back[:, w * FILTERS : (w + 1) * FILTERS].sum(axis=0) for w in range(len(WIDTHS))]
            grads += [hidden.T @ error, error.sum(axis=0)]
            step += 1
            for p, g, m, v in zip(params, grads, first, second):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= 0.02 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
    return model


def _texts(column: pa.Array) -> Iterator[tuple[int, bytes]]:
    for i, value in enumerate(column):
        yield i, (value.as_py() or "").encode() if value.is_valid else b""


def _has_letter(text: bytes) -> bool:
    return bool(_LETTER[np.frombuffer(text, np.uint8)].any()) or any(map(str.isalpha, text.decode()))


def with_letters(documents: DataFrame) -> DataFrame:
    """The rows whose text has a letter: those that a model would give a language."""

    def of(batches):
        for batch in batches:
            yield batch.filter(pa.array([_has_letter(text) for _, text in _texts(batch.column("text"))], pa.bool_()))

    return documents.mapInArrow(of, documents.schema)


def _cut(data: np.ndarray) -> np.ndarray:
    """Windows of a text; the last one is filled up with zeros."""
    n = max(1, -(-len(data) // WINDOW))
    padded = np.zeros(n * WINDOW, np.uint8)
    padded[: len(data)] = _LOWER[data]
    return padded.reshape(n, WINDOW)


def _training_windows(rows: DataFrame) -> DataFrame:
    """(lang, windows): some windows of each text, some of them cut short as short texts are."""

    def of(batches):
        for batch in batches:
            langs, found = [], []
            for (i, text), lang in zip(_texts(batch.column("text")), batch.column("lang").to_pylist()):
                rng = np.random.default_rng(len(text))
                data = np.frombuffer(text, np.uint8)
                for k in range(WINDOWS):
                    length = WINDOW if k else int(rng.integers(12, WINDOW))
                    at = int(rng.integers(0, max(1, len(data) - length + 1)))
                    langs.append(lang)
                    found.append(_cut(data[at : at + length])[0].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(found, pa.binary())], ["lang", "window"])

    return rows.select("text", "lang").mapInArrow(of, "lang string, window binary")


def fit(labelled: DataFrame, sample_texts: int = SAMPLE_TEXTS) -> Model | None:
    """A model of (doc_id, text, lang); at most about `sample_texts` texts are looked at, chosen by hash.

    Rows without text or lang teach nothing; None if there are no others. `lang` has to have few
    distinct values: one number for each comes to the driver.
    """
    usable = labelled.where("text is not null and lang is not null")
    counts = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    each = sample_texts / len(counts)
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, each / n))).otherwise(share)
    turn = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 20))
    sample = usable.where(turn < share * (1 << 20)).limit(2 * sample_texts)
    rows = sorted((r["lang"], bytes(r["window"])) for r in _training_windows(sample).collect())
    languages = sorted({lang for lang, _ in rows})
    windows = np.stack([np.frombuffer(w, np.uint8) for _, w in rows])
    return train(windows, np.array([languages.index(lang) for lang, _ in rows]), languages)


def predicted(documents: DataFrame, model: Model | None) -> DataFrame:
    """Adds lang_pred and score (the mean probability of that language) to `documents`.

    Texts that are null or have no letter, and all texts where there is no model, are "und" with
    score 0. Rows and other columns stay; columns named lang_pred or score are replaced.
    """
    documents = documents.drop("lang_pred", "score")

    def of(batches):
        for batch in batches:
            found = [(UNKNOWN, 0.0)] * batch.num_rows
            rows, parts, held = [], [], 0

            def score():
                windows = np.concatenate(parts)
                sizes = np.array([len(p) for p in parts])
                each = [model.probabilities(windows[a : a + 512]) for a in range(0, len(windows), 512)]
                starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
                means = np.add.reduceat(np.concatenate(each), starts, axis=0) / sizes[:, None]
                for row, mean in zip(rows, means):
                    best = int(mean.argmax())
                    found[row] = (model.languages[best], min(1.0, float(mean[best])))

            for i, text in _texts(batch.column("text")):
                data = np.frombuffer(text, np.uint8)
                if model is None or not _has_letter(text):
                    continue
                rows.append(i)
                parts.append(_cut(data))
                held += len(data)
                if held > HELD_BYTES:
                    score()
                    rows, parts, held = [], [], 0
            if rows:
                score()
            langs, scores = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                [*batch.schema.names, "lang_pred", "score"],
            )

    schema = T.StructType([*documents.schema, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return documents.mapInArrow(of, schema)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))
