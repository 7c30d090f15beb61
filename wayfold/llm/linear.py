"""Rows of hashed features and linear models on them, in NumPy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Rows:
    """Sparse rows: features of row i are index[begin[i]:begin[i + 1]], with their values."""

    index: np.ndarray
    value: np.ndarray
    begin: np.ndarray

    def __len__(self) -> int:
        return len(self.begin) - 1

    def times(self, weights: np.ndarray) -> np.ndarray:
        upto = np.concatenate([[0.0], np.cumsum(weights[self.index] * self.value)])
        return upto[self.begin[1:]] - upto[self.begin[:-1]]

    def back(self, errors: np.ndarray, features: int) -> np.ndarray:
        return np.bincount(self.index, np.repeat(errors, np.diff(self.begin)) * self.value, minlength=features)

    def take(self, keep: np.ndarray) -> Rows:
        sizes = np.diff(self.begin)
        of = np.repeat(keep, sizes)
        return Rows(self.index[of], self.value[of], np.concatenate([[0], np.cumsum(sizes[keep])]))


def adam(params: list[np.ndarray], gradients, steps: int = 150, rate: float = 0.1) -> None:
    """Moves the parameters down the gradients that `gradients()` gives, full batch."""
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        for p, g, m, v in zip(params, gradients(), first, second):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def sampled(documents: DataFrame, labels: DataFrame, columns: list[str], texts: int, features) -> tuple[Rows, dict]:
    """Hashed features and labels of at most about `texts` labelled documents, chosen by hash.

    `features` turns an Arrow column of texts into lists of (indexes, values) arrays, one per text.
    Rows without id, text or labels teach nothing. Labels are averaged where a doc_id repeats.
    """
    known = labels.select("doc_id", *columns).dropna().groupBy("doc_id").agg(*(F.avg(c).alias(c) for c in columns))
    n = known.count()
    turn = F.pmod(F.xxhash64("doc_id", F.lit(23)), F.lit(1 << 20))
    chosen = known.where(turn < min(1.0, 0.9 * texts / max(n, 1)) * (1 << 20)).limit(texts)
    # The sample is bounded, so it can be sent to every task.
    rows = documents.where("text is not null").select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def of(batches):
        for batch in batches:
            found = features(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *(batch.column(c) for c in columns),
                    pa.array([x.astype(np.int32) for x, _ in found], pa.list_(pa.int32())),
                    pa.array([x.astype(np.float32) for _, x in found], pa.list_(pa.float32())),
                ],
                ["doc_id", *columns, "index", "value"],
            )

    kinds = ", ".join(f"{c} double" for c in columns)
    table = (
        rows.select("doc_id", "text", *columns)
        .mapInArrow(of, f"doc_id long, {kinds}, index array<int>, value array<float>")
        .limit(2 * texts)
        .toArrow()
        .sort_by("doc_id")
    )
    index, value = (table.column(c).combine_chunks() for c in ("index", "value"))
    begin = index.offsets.to_numpy() - index.offsets[0].as_py() if len(index) else np.zeros(1, np.int64)
    found = Rows(index.flatten().to_numpy(), value.flatten().to_numpy().astype(float), begin)
    return found, {c: table.column(c).to_numpy() for c in ["doc_id", *columns]}
