"""Best-fit packing of documents into sequences of a fixed number of tokens, in bulk rounds.

Pieces are sorted by length, longest first, and gaps by size. As sizes are whole numbers up to the
sequence length, pieces of one length and gaps of one size are runs, and a table of at most that many
runs stands for all of them. A round takes the next length: its run is matched with the successor
gaps (the smallest that hold it), run by run; who gets which is settled by rank, the n-th piece of a
run taking the n-th sequence of the gap; the gaps shrink, and the next round starts. What finds no
gap opens sequences. The rounds only move interval ends; the pieces themselves are ranked and placed
by Spark, in parallel, each by looking up its rank.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import saved
from .tokens import default_path, tokenizer

CAPACITY = 2048
END = 0


def pieces(documents: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, block, rank): each text's ids and END, cut where longer.

    `rank` counts the pieces of a length within `block` (a task's part of the table).
    """

    def of(batches):
        own = tokenizer(path)
        block = TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        end = END.to_bytes(4, "little")
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = own.ids(text.as_py()) + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    length = len(part) // 4
                    rows.append((doc, piece, at // 4, length, zlib.crc32(part), block, seen[length]))
                    seen[length] += 1
            if rows:
                kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 5]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "block", "rank"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
        own.rest()

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, block long, rank long"
    return documents.select("doc_id", "text").mapInArrow(of, schema)


def rounds(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Rows (length, rank, sequence, offset): pieces of `length` from `rank` on go to the sequences from `sequence` on."""
    moves: list[tuple[int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # size: runs (first sequence, count)
    sizes: list[int] = []  # of the gaps, ascending
    opened = 0

    def add(size: int, first: int, count: int) -> None:
        if size and count:
            if size not in gaps:
                gaps[size] = []
                insort(sizes, size)
            gaps[size].append((first, count))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect_left(sizes, length)
            if at == len(sizes):
                break
            size = sizes[at]
            first, count = gaps[size].pop()
            taken = min(left, count)
            moves.append((length, rank, first, capacity - size))
            if taken < count:
                gaps[size].append((first + taken, count - taken))
            if not gaps[size]:
                del gaps[size]
                del sizes[at]
            add(size - length, first, taken)
            rank, left = rank + taken, left - taken
        if left:
            fit = capacity // length
            full, rest = divmod(left, fit)
            for slot in range(fit):
                n = full + (slot < rest)
                if n:
                    moves.append((length, rank, opened, slot * length))
                    rank += n
            add(capacity - fit * length, opened, full)
            if rest:
                add(capacity - rest * length, opened + full, 1)
            opened += full + (rest > 0)
    return np.array(moves, np.int64).reshape(-1, 4)


def packed(documents: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of each piece of (doc_id, text).

    Null and empty texts are the id END alone. Repeated rows are packed each; an empty table gives
    an empty result; other columns are ignored.
    """
    cut = saved(pieces(documents, path or default_path(), capacity))
    runs = cut.groupBy("length", "block").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    runs = saved(runs.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))))
    # At most `capacity` rows.
    counts = {r["length"]: r["n"] for r in runs.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    moves = rounds(counts, capacity)
    # Places are looked up by length and rank in one array.
    shift = np.int64(1) << 50
    keys = moves[:, 0] * shift + moves[:, 1]
    order = np.argsort(keys)
    keys, moves = keys[order], moves[order]

    def of(batches):
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            move = moves[np.searchsorted(keys, length * shift + rank, "right") - 1]
            columns = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            columns += [pa.array(move[:, 2] + rank - move[:, 1]), pa.array(move[:, 3])]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays(columns, names)

    ranked = cut.join(runs.select("length", "block", "before"), ["length", "block"]).withColumn(
        "rank", F.col("rank") + F.col("before")
    )
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(of, schema)
