"""Hard negatives of anchors: other labels' vectors whose scores lie in windows below the positives' scores.

Slots. A positive with score p takes negatives from its lower limit up to its upper limit, both shares of p.
The upper limits of an anchor's positives, in descending order, cut the scores into disjoint slots; what
lies in slot s is open to the windows of positives 1 to s. Every task keeps the best rows of each slot, the
merge keeps them again, and a window's answer is the best of its slot and the slots below it (a suffix), above
its lower limit. So one pass answers windows that overlap, with at most (positives x wanted) rows kept per anchor.

Anchors are packed into blocks of bounded size and rows into small pieces; every block meets every piece in a task
that holds one block and streams the pieces. Rows are dealt to `parts` tasks a block, whatever their label.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import saved
from .vectors import matrices

# Vectors of one packed piece; anchors of one block; anchors that are compared with a piece at once.
PIECE, BLOCK, AT_ONCE = 1024, 65_536, 1024
_PIECES = "length int, block int, part int, ids binary, labels binary, whole binary, low binary, high binary"


@dataclass(frozen=True)
class Mining:
    """positives and wanted: how many a list holds at most. Limits are low/den and high/den of the positive's score."""

    positives: int = 5
    wanted: int = 10
    low: int = 30
    high: int = 90
    den: int = 100
    scale: int = 256


def _packed(plan: Mining, parts: int, limits: bool):
    """Packs rows (block, vec_id, label, vector[, low, high]) into pieces."""
    piece = PIECE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block, ids, labels = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            for places, matrix in matrices(batch.column(3)):
                whole = np.floor(plan.scale * matrix)
                small = np.abs(whole).max() <= 32767
                for b in np.unique(block[places]).tolist():
                    mine = np.flatnonzero(block[places] == b)
                    for at in range(0, len(mine), piece):
                        some = mine[at : at + piece]
                        rows = places[some]
                        values = whole[some].astype(np.int16) if small else whole[some]
                        columns = [
                            [matrix.shape[1]],
                            [b],
                            # The piece's place among the parts: by its first row, so that a second try deals it likewise.
                            [int(ids[rows[0]]) * 2654435761 % parts],
                            [ids[rows].astype(np.int64).tobytes()],
                            [labels[rows].astype(np.int64).tobytes()],
                            [values.tobytes()],
                            *([[np.array(batch.column(c).take(pa.array(rows)).to_pylist(), float).tobytes()] for c in (4, 5)] if limits else [[None], [None]]),
                        ]
                        kinds = [pa.int32()] * 3 + [pa.binary()] * 5
                        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], _PIECES.replace(",", "").split()[::2])

    return run


class _Block:
    """The anchors of a block and the best rows of their slots so far."""

    def __init__(self, pieces: list, length: int, slots: int, wanted: int, same: bool, at_once: int):
        self.at_once = at_once
        self.ids, self.labels = (np.concatenate([p[i] for p in pieces]) for i in (0, 1))
        self.whole = np.concatenate([p[2] for p in pieces])
        n = len(self.ids)
        if same:
            self.low, self.high = np.full((n, 1), -np.inf), np.full((n, 1), np.inf)
        else:
            self.low, self.high = (np.concatenate([p[i].reshape(-1, slots) for p in pieces]) for i in (3, 4))
        self.same, self.wanted, self.length = same, wanted, length
        self.most = float(np.abs(self.whole).max())
        # Rows that are not there yet score minus infinity.
        self.score = np.full((n, self.low.shape[1], wanted), -np.inf)
        self.found = np.full((n, self.low.shape[1], wanted), np.iinfo(np.int64).max)

    def _kind(self, whole: np.ndarray) -> type:
        """The narrowest kind of number whose products and sums are exact."""
        bound = self.most * float(np.abs(whole).max()) * self.length
        if bound >= 2**53:
            raise ValueError("scores beyond 53 bits: scale the vectors down")
        return np.float32 if bound < 2**24 else np.float64

    def meet(self, ids: np.ndarray, labels: np.ndarray, whole: np.ndarray) -> None:
        kind = self._kind(whole)
        right = whole.astype(kind).T
        for at in range(0, len(self.ids), self.at_once):
            own = slice(at, at + self.at_once)
            scores = self.whole[own].astype(kind) @ right
            match = self.labels[own][:, None] == labels
            if self.same:
                match &= self.ids[own][:, None] != ids
            else:
                match = ~match
            for s in range(self.low.shape[1]):
                # Limits beyond what scores can be stay so in single precision.
                least = np.maximum(self.low[own, s], self.score[own, s, -1]).astype(kind)
                most = self.high[own, s].astype(kind)
                open_ = match & (scores >= least[:, None]) & (scores <= most[:, None])
                if open_.any():
                    self._enter(at, s, open_, scores, ids)

    def _enter(self, at: int, s: int, open_: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        k = self.wanted
        if open_.sum() > 4 * k * len(open_) and open_.shape[1] > k:
            # Only rows as good as the k-th of this piece can enter.
            there = np.where(open_, scores, -np.inf)
            open_ &= scores >= np.partition(there, -k, axis=1)[:, -k][:, None]
        row, column = np.nonzero(open_)
        some = np.unique(row)
        old_score, old_id = self.score[at + some, s], self.found[at + some, s]
        owner = np.concatenate([row, np.repeat(some, k)])
        score = np.concatenate([scores[row, column].astype(float), old_score.ravel()])
        who = np.concatenate([ids[column], old_id.ravel()])
        order = np.lexsort((who, -score, owner))
        owner, score, who = owner[order], score[order], who[order]
        begin = np.searchsorted(owner, some)
        best = begin[:, None] + np.arange(k)
        self.score[at + some, s], self.found[at + some, s] = score[best], who[best]

    def result(self) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(self.ids), self.at_once):
            a, s, k = np.nonzero(self.score[at : at + self.at_once] > -np.inf)
            columns = [self.ids[at + a], s.astype(np.int32), self.found[at + a, s, k], self.score[at + a, s, k].astype(np.int64)]
            yield pa.record_batch([pa.array(c) for c in columns], ["anchor_id", "slot", "other_id", "score"])


def _met(plan: Mining, same: bool):
    """Streams pieces by (length, block, part), a block's anchors (side 0) first."""
    slots, wanted = (1, plan.positives) if same else (plan.positives, plan.wanted)
    at_once = AT_ONCE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, anchors, block = None, [], None
        for batch in batches:
            for row in batch.to_pylist():
                if (now := (row["length"], row["block"], row["part"])) != key:
                    if block is not None:
                        yield from block.result()
                    key, anchors, block = now, [], None
                ids, labels = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels"))
                kind = np.int16 if len(row["whole"]) == 2 * len(ids) * row["length"] else np.float64
                whole = np.frombuffer(row["whole"], kind).reshape(len(ids), -1)
                if row["side"] == 0:
                    limits = () if same else (np.frombuffer(row["low"]), np.frombuffer(row["high"]))
                    anchors.append((ids, labels, whole, *limits))
                elif anchors:
                    if block is None:
                        block = _Block(anchors, row["length"], slots, wanted, same, at_once)
                    block.meet(ids, labels, whole)
        if block is not None:
            yield from block.result()

    return run


def _best(anchors: DataFrame, pieces: DataFrame, plan: Mining, blocks: int, parts: int, same: bool) -> DataFrame:
    """(anchor_id, slot, other_id, score): the best rows of each anchor's slots."""
    packed = anchors.repartition("block").mapInArrow(_packed(plan, parts, not same), _PIECES)
    left = packed.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).withColumn("side", F.lit(0))
    right = pieces.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("side", F.lit(1))
    at = ["length", "block", "part"]
    met = left.unionByName(right).repartition(*at).sortWithinPartitions(*at, "side")
    found = met.mapInArrow(_met(plan, same), "anchor_id bigint, slot int, other_id bigint, score bigint")
    best = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "other_id")
    return found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= (plan.positives if same else plan.wanted))


def hard_negatives(
    embeddings: DataFrame, is_anchor, plan: Mining = Mining(), column: str = "embedding", parts: int | None = None
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of anchors among `embeddings`.

    Rows are (vec_id, label, `column`), vec_id and label whole numbers. Components become floor(scale * x), a score
    is the inner product of two rows of one length, higher scores come first, ties by smaller vec_id. An anchor's
    positives are its first other rows with its label, its negatives rows with another label that score from low/den
    to high/den of the positive's score, both included. rank counts from 1. Windows of positives below 0 are empty.

    Rows with a null vec_id, label or vector, an empty vector, or null or non-finite components take no part.
    Repeated rows are rows of their own as positives and negatives; a row is no positive of an anchor with its own
    vec_id; of anchors that agree in vec_id the one with the smallest label and vector is taken. Other columns are
    not read. An empty table, or one without anchors, gives an empty result. Scores have to be below 2 to the 53.
    """
    spark = embeddings.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = embeddings.select("vec_id", F.col("label").cast("long").alias("label"), F.col(column).alias("vector"))
    rows = rows.where("vec_id is not null and label is not null and vector is not null")
    one = F.min(F.struct("label", "vector"))
    anchors = rows.where(is_anchor).groupBy("vec_id").agg(one.alias("one")).select("vec_id", "one.*")
    blocks = max(1, math.ceil(rows.where(is_anchor).count() / BLOCK))
    anchors = anchors.select(F.pmod(F.hash("vec_id"), F.lit(blocks)).alias("block"), "vec_id", "label", "vector")
    pieces = rows.select(F.lit(0).alias("block"), "vec_id", "label", "vector")
    pieces = saved(pieces.mapInArrow(_packed(plan, parts, False), _PIECES))
    positives = _best(anchors, pieces, plan, blocks, parts, True)
    positives = saved(
        positives.select(
            "anchor_id", (F.col("place") - 1).alias("slot"), F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score")
        )
    )
    # Limits of the slots: down to the next positive's upper limit, and no lower than their own positive's lower one.
    p = F.col("positive_score")
    after = Window.partitionBy("anchor_id").orderBy("slot")
    high = F.floor(plan.high * p / plan.den)
    low = F.ceil(plan.low * p / plan.den)
    limits = (
        positives.where("positive_score >= 0")
        .withColumns({"high": high, "low": low})
        .withColumn("next", F.lead("high").over(after))
        .withColumn("low", F.greatest("low", F.col("next") + 1))
        .groupBy("anchor_id")
        .agg(F.sort_array(F.collect_list(F.struct("slot", "low", "high"))).alias("s"))
    )

    def padded(name: str, empty: float):
        missing = F.array_repeat(F.lit(empty), plan.positives - F.size("s"))
        return F.concat(F.transform("s", lambda x: x[name].cast("double")), missing).alias(name)

    bounded = anchors.join(limits.withColumnRenamed("anchor_id", "vec_id"), "vec_id").select(
        "block", "vec_id", "label", "vector", padded("low", math.inf), padded("high", -math.inf)
    )
    negatives = _best(bounded, pieces, plan, blocks, parts, False).select(
        "anchor_id", F.col("slot").alias("below"), F.col("other_id").alias("negative_id"), F.col("score").alias("negative_score")
    )
    # A window's answer: the best of its own slot and those below it.
    opened = positives.join(negatives, "anchor_id").where(
        (F.col("below") >= F.col("slot")) & (plan.low * p <= plan.den * F.col("negative_score"))
    )
    ranks = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("negative_score"), "negative_id")
    return (
        opened.withColumn("rank", F.row_number().over(ranks))
        .where(F.col("rank") <= plan.wanted)
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
