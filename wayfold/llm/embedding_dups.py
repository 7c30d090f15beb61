"""Near copies among embeddings of one label: sign hashes of random hyperplanes, exact cosines, components.

Vectors are hashed in several tables: a table's key is the side of each of its hyperplanes that the vector
lies on. Vectors that share a label and a key are compared, and linked where their cosine is large
enough. Equal vectors are hashed once, with the number of their copies. Bits and tables follow from the
number of vectors: few strangers share a key at any size, and a pair just at the threshold is found with
the probability RECALL, closer ones with more.

A bucket goes in blocks of about BLOCK vectors, and every two blocks are compared in one task, which returns
counts and a tree of links, never pairs. A pair of blocks meets in each table that its vectors share,
but a link counts in the first of them only. The work of a group of near copies (not of equal vectors,
which are one) is the square of its size, spread over the pairs of blocks.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import saved
from .components import components
from .vectors import binaries, element_type, matrices, stacked

BLOCK = 1024
RECALL = 0.999
# Up to so many vectors of a bucket are compared pair by pair, many buckets at once.
FEW = 24
# Rows that are gathered before their buckets are compared.
ROWS = 20_000
SEED = 20_113


@dataclass(frozen=True)
class Hashing:
    bits: int
    tables: int
    threshold: float

    def planes(self, length: int) -> np.ndarray:
        drawn = np.random.default_rng([SEED, length]).standard_normal((self.tables * self.bits, length))
        return drawn.T

    def keys(self, unit: np.ndarray) -> np.ndarray:
        """Keys of unit vectors, a column a table."""
        sides = (unit @ self.planes(unit.shape[1]) >= 0).reshape(len(unit), self.tables, self.bits)
        return sides @ (np.int64(1) << np.arange(self.bits, dtype=np.int64))


def hashing(vectors: int, threshold: float, recall: float = RECALL) -> Hashing:
    """Bits and tables for the largest label's number of vectors.

    Sixteen times as many keys as vectors keep strangers apart; tables follow from the chance that a pair
    with a cosine at the threshold shares a key.
    """
    bits = min(60, max(8, math.ceil(math.log2(max(vectors, 2))) + 4))
    shared = (1 - math.acos(threshold) / math.pi) ** bits
    tables = max(1, math.ceil(math.log(1 - recall) / math.log1p(-shared)))
    return Hashing(bits, tables, threshold)


def _units(matrix: np.ndarray) -> np.ndarray:
    """The vectors with length one; components as large or small as doubles can be don't overflow."""
    scaled = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


def _prepared(kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, labels, column = batch.columns
            vectors, keys = {}, {}
            there = labels.is_valid().to_numpy(zero_copy_only=False) & ids.is_valid().to_numpy(zero_copy_only=False)
            for places, matrix in matrices(column):
                use = there[places] & (matrix != 0).any(axis=1)
                rows = matrix[use].astype(kind)
                for i, row in zip(places[use].tolist(), rows):
                    vectors[i] = row.tobytes()
                    keys[i] = hashlib.blake2b(vectors[i] + str(labels[i]).encode(), digest_size=16).digest()
            n = len(batch)
            yield pa.record_batch([ids, labels, binaries(vectors, n), binaries(keys, n)], ["vec_id", "label", "vec", "key"])

    return run


def _hashed(kind: str, plan: Hashing):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            signs = {}
            for places, matrix in stacked(batch.column("vec"), kind):
                for i, row in zip(places.tolist(), plan.keys(_units(matrix.astype(float)))):
                    signs[i] = row.tobytes()
            yield pa.record_batch([*batch.columns, binaries(signs, len(batch))], [*batch.schema.names, "signs"])

    return run


def _buckets(tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = len(batch)
            signs = np.frombuffer(b"".join(batch.column("signs").to_pylist()), np.int64)
            of = pa.array(np.repeat(np.arange(n), tables))
            yield pa.record_batch(
                [
                    batch.column("node").take(of),
                    batch.column("label").take(of),
                    pa.array(np.tile(np.arange(tables, dtype=np.int32), n)),
                    pa.array(signs),
                ],
                ["node", "label", "tab", "bits"],
            )

    return run


def _roots(n: int, a: np.ndarray, b: np.ndarray, node: np.ndarray) -> np.ndarray:
    """Smallest node that each of n rows reaches by the links a, b."""
    root = node.copy()
    while len(a):
        before = root.copy()
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        if (root == before).all():
            break
    return root


class _Links:
    """Counts and roots of the rows of whole groups of blocks."""

    def __init__(self, kind: str, plan: Hashing):
        self.kind, self.plan = kind, plan

    def few(self, begin: np.ndarray, size: np.ndarray, side: np.ndarray, unit: np.ndarray):
        """Linked pairs of many small groups."""
        found = []
        for n in np.unique(size).tolist():
            first = begin[size == n]
            i, j = np.triu_indices(n, 1)
            a, b = (first[:, None] + i).ravel(), (first[:, None] + j).ravel()
            for at in range(0, len(a), 1 << 16):
                x, y = a[at : at + (1 << 16)], b[at : at + (1 << 16)]
                close = np.einsum("ij,ij->i", unit[x], unit[y]) >= self.plan.threshold
                found.append((x[close], y[close]))
        a, b = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, int), np.zeros(0, int))
        across = side[a] | side[b]
        keep = (across == 0) | (side[a] != side[b])
        return a[keep], b[keep]

    def block(self, begin: int, size: int, side: np.ndarray, unit: np.ndarray):
        own = np.arange(begin, begin + size)
        if not side[own].any():
            a, b = np.nonzero(np.triu(unit[own] @ unit[own].T >= self.plan.threshold, 1))
            return own[a], own[b]
        left, right = own[side[own] == 1], own[side[own] == 2]
        a, b = np.nonzero(unit[left] @ unit[right].T >= self.plan.threshold)
        return left[a], right[b]

    def __call__(self, rows: pa.Table) -> Iterator[pa.RecordBatch]:
        """Rows (group columns..., side, node, copies, vec, signs), group by group.

        side is 0 in a block that meets itself, else 1 or 2 for the block that a row belongs to.
        """
        column = {c: rows[c].combine_chunks() for c in rows.column_names}
        node, copies, tab, side = (column[c].to_numpy(zero_copy_only=False) for c in ("node", "copies", "tab", "side"))
        signs = np.frombuffer(b"".join(column["signs"].to_pylist()), np.int64).reshape(len(node), -1)
        for places, matrix in stacked(column["vec"], self.kind):
            unit = _units(matrix.astype(float))
            group = column["group"].take(pa.array(places)).to_numpy(zero_copy_only=False)
            begin = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
            size = np.diff(np.append(begin, len(group)))
            small = size <= FEW
            links = [self.few(begin[small], size[small], side[places], unit)]
            links += [self.block(b, s, side[places], unit) for b, s in zip(begin[~small].tolist(), size[~small].tolist())]
            a, b = (np.concatenate(x) for x in zip(*links))
            if not len(a):
                continue
            # A link counts in the first table that has it.
            table, sign = tab[places][a], signs[places]
            first = np.ones(len(a), bool)
            for t in range(self.plan.tables):
                late = (table > t) & first
                first[late] &= sign[a[late], t] != sign[b[late], t]
            own, weight = node[places], copies[places]
            linked = np.zeros(len(own), np.int64)
            np.add.at(linked, a[first], weight[b[first]])
            np.add.at(linked, b[first], weight[a[first]])
            root = _roots(len(own), a, b, own)
            told = (linked > 0) | (root != own)
            yield pa.record_batch(
                [pa.array(own[told]), pa.array(linked[told]), pa.array(root[told])], ["node", "links", "root"]
            )


def _verified(kind: str, plan: Hashing):
    """Gathers the rows of whole groups; groups are next to each other."""
    enough = ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links, waiting = _Links(kind, plan), []
        count, last = 0, None  # number of groups so far, key of the last
        for batch in batches:
            if not len(batch):
                continue
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("label", "tab", "bits", "lo", "hi"))))
            group = np.empty(len(keys), np.int64)
            for i, key in enumerate(keys):
                if key != last:
                    count, last = count + 1, key
                group[i] = count
            kept = batch.select(["tab", "side", "node", "copies", "vec", "signs"])
            waiting.append(pa.table([*kept.columns, pa.array(group)], [*kept.schema.names, "group"]))
            if sum(map(len, waiting)) >= enough:
                rows = pa.concat_tables(waiting)
                ended = int(np.searchsorted(rows["group"].to_numpy(), count))
                if ended:
                    yield from links(rows.slice(0, ended))
                waiting = [rows.slice(ended)]
        if waiting:
            yield from links(pa.concat_tables(waiting))

    return run


@dataclass(frozen=True)
class Found:
    """Classes of equal vectors, and what links them.

    `rows` (vec_id, key): key is null for vectors that take no part. `classes` (node, key, label, vec, copies,
    first_id, signs): one row per label and vector. `links` (node, links, root): per pair of blocks how many
    vectors a class is linked with, and a class that it is connected with.
    """

    rows: DataFrame
    classes: DataFrame
    links: DataFrame


def linked(embeddings: DataFrame, threshold: float = 0.98, column: str = "embedding") -> Found:
    """Equal vectors as classes, and their links."""
    kind = element_type(embeddings, column)
    counts = embeddings.where("label is not null").groupBy("label").count().agg(F.max("count").alias("n"))
    plan = hashing(counts.first().n or 0, threshold)
    label = embeddings.schema["label"].dataType.simpleString()
    vec_id = embeddings.schema["vec_id"].dataType.simpleString()
    rows = saved(
        embeddings.select("vec_id", "label", F.col(column).alias("vector")).mapInArrow(
            _prepared(kind), f"vec_id {vec_id}, label {label}, vec binary, key binary"
        )
    )
    grouped = (
        rows.where("vec is not null")
        .groupBy("label", "vec", "key")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first_id"))
    )
    shape = f"label {label}, vec binary, key binary, copies bigint, first_id {vec_id}, signs binary"
    classes = grouped.mapInArrow(_hashed(kind, plan), shape)
    classes = saved(classes.withColumn("node", F.monotonically_increasing_id()))
    at = ["label", "tab", "bits"]
    keys = classes.select("node", "label", "signs").mapInArrow(
        _buckets(plan.tables), f"node bigint, label {label}, tab int, bits bigint"
    )
    shared = keys.groupBy(*at).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = keys.join(shared, at).join(classes.select("node", "copies", "vec", "signs"), "node")
    # Blocks of a bucket, and each two of them that a row belongs to.
    blocks = F.ceil(F.col("n") / BLOCK)
    others = F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)
    pairs = (
        members.withColumn("blocks", blocks)
        .withColumn("own", F.pmod(F.hash("node"), "blocks"))
        .withColumn("other", F.explode(others))
        .select(
            *at,
            F.least("own", "other").alias("lo"),
            F.greatest("own", "other").alias("hi"),
            F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2).alias("side"),
            "node",
            "copies",
            "vec",
            "signs",
        )
    )
    group = [*at, "lo", "hi"]
    met = pairs.repartition(*group).sortWithinPartitions(*group)
    links = saved(met.mapInArrow(_verified(kind, plan), "node bigint, links bigint, root bigint"))
    return Found(rows, classes, links)


def near_duplicates(embeddings: DataFrame, threshold: float = 0.98, column: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of `embeddings` (vec_id, label, `column`).

    Rows are linked when their labels are equal and not null and their vectors have one length and a cosine
    of `threshold` or more. n_links counts the other rows linked with a row; component_id is the smallest vec_id
    reached by links, its own included; kept is whether that is its own. Vectors that are null, empty, all zero
    or hold null or non-finite components, and rows with a null label or vec_id, link with nothing; with a
    null vec_id component_id is null and kept is true. Repeated rows are rows of their own and link with each
    other. Texts and other columns are not read. An empty table gives an empty result.
    """
    found = linked(embeddings, threshold, column)
    root = components(found.links.where("node <> root").select("node", "root"))
    named = root.join(found.classes.select("node", "first_id"), "node")
    smallest = named.groupBy("root").agg(F.min("first_id").alias("smallest"))
    reached = root.join(smallest, "root").select("node", "smallest")
    counts = found.links.groupBy("node").agg(F.sum("links").alias("others"))
    classes = (
        found.classes.select("node", "key", "copies", "first_id")
        .join(counts, "node", "left")
        .join(reached, "node", "left")
        .where("copies > 1 or others is not null")
        .select(
            "key",
            (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("linked"),
            F.coalesce("smallest", "first_id").alias("reached"),
        )
    )
    out = found.rows.select("vec_id", "key").join(classes, "key", "left")
    component = F.coalesce("reached", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("linked", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("vec_id")).alias("kept"),
    )
