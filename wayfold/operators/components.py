"""Connected components of the links inside each trajectory."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import saved, shuffled

# Links are first solved in squares of so many nodes by so many nodes.
SQUARE_NODES = 200_000
# Keys that the links of one node are dealt to, so that no task gets all links of a hub.
SALTS = 64


def connected_components(edges: DataFrame, square_nodes: int = SQUARE_NODES) -> DataFrame:
    """(traj_id, node, root) for every node of (traj_id, u, v); root is the smallest node.

    Nodes without an edge are not listed. Nodes are numbers. Links whose ends lie in the same two ranges of
    `square_nodes` numbers are replaced by a forest, square by square; a trajectory within one range is settled
    by that. The forests of the others are contracted in rounds of joins until every node points at its root.
    A task holds the nodes of one square at most, and the links of a hub go to many tasks.
    """
    links = edges.where(F.col("u") != F.col("v")).select(
        "traj_id", F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    links, settled = saved(_forests(links, square_nodes)), []
    # Links between squares stay such links; without one, each component lies in a square, and its forest is a star.
    if links.where(_side("u", square_nodes) != _side("v", square_nodes)).take(1):
        while (open_ := _not_settled(links)).take(1):
            open_ = saved(open_)
            settled.append(links.join(open_, "traj_id", "left_anti"))
            links = saved(_small_star(_large_star(links.join(open_, "traj_id", "left_semi"))))
    stars = reduce(DataFrame.unionByName, settled, links)
    roots = stars.select("traj_id", F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return stars.select("traj_id", F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _side(node: str, square_nodes: int) -> Column:
    return F.floor(F.col(node) / square_nodes).cast("long")


def _forests(links: DataFrame, square_nodes: int) -> DataFrame:
    """The links of each square as links of its nodes to the smallest node that they reach there."""
    square = ["traj_id", "_rows", "_columns"]
    dealt = links.withColumns({"_rows": _side("u", square_nodes), "_columns": _side("v", square_nodes)})
    together = dealt.repartition(*square).sortWithinPartitions(*square)
    schema = T.StructType([links.schema["traj_id"], *(T.StructField(n, T.LongType()) for n in ("u", "v"))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting = None
        for batch in batches:
            rows = batch if waiting is None else pd.concat([waiting, batch], ignore_index=True)
            last = rows[square].iloc[-1]
            unfinished = (rows[square] == last).all(axis=1)
            waiting = rows[unfinished]
            if len(waiting) > 8 * square_nodes:
                # Nodes bound a forest; links of a square can be far more.
                waiting = _forest(waiting, square)
            if not unfinished.all():
                yield _forest(rows[~unfinished], square)[["traj_id", "u", "v"]]
        if waiting is not None:
            yield _forest(waiting, square)[["traj_id", "u", "v"]]

    return together.mapInPandas(run, schema)


def _forest(links: pd.DataFrame, square: list[str]) -> pd.DataFrame:
    """Labels sink to the smallest node of a square's component, along links and along labels."""
    columns = [links[c].to_numpy() for c in square]
    # Rows of a square are next to each other.
    starts = np.concatenate([[True], np.logical_or.reduce([c[1:] != c[:-1] for c in columns])])
    group = np.cumsum(starts) - 1
    numbers, code = np.unique(np.concatenate([links["u"].to_numpy(), links["v"].to_numpy()]), return_inverse=True)
    found, place = np.unique(np.tile(group, 2) * len(numbers) + code, return_inverse=True)
    u, v = place.reshape(2, -1)
    label = np.arange(len(found))
    while True:
        lower = np.minimum(label[u], label[v])
        sunk = label.copy()
        for at in (u, v, label[u], label[v]):
            np.minimum.at(sunk, at, lower)
        sunk = sunk[sunk]
        if np.array_equal(sunk, label):
            break
        label = sunk
    lost = np.flatnonzero(label != np.arange(len(found)))
    first = np.flatnonzero(starts)[found[lost] // len(numbers)]
    node, root = (numbers[found[x] % len(numbers)] for x in (lost, label[lost]))
    return pd.DataFrame({**{n: c[first] for n, c in zip(square, columns)}, "u": node, "v": root})


def _not_settled(links: DataFrame) -> DataFrame:
    """Trajectories in which some node does not just point at one node that points nowhere."""
    ends = links.select("traj_id", F.col("u").alias("node"), F.lit(1).alias("_out"), F.lit(0).alias("_in"))
    ends = ends.unionByName(
        links.select("traj_id", F.col("v").alias("node"), F.lit(0).alias("_out"), F.lit(1).alias("_in"))
    )
    per_node = ends.groupBy("traj_id", "node").agg(F.sum("_out").alias("_out"), F.max("_in").alias("_in"))
    return per_node.where(F.col("_out") + F.col("_in") > 1).select("traj_id").distinct()


def _with_smallest(links: DataFrame) -> DataFrame:
    """Links (traj_id, u, v) with `m`, the smallest v of u.

    Minima are taken per salt, then per node, and go back to the salts: a hub's links meet its minimum in many tasks.
    """
    salted = links.withColumn("_salt", F.pmod(F.hash("v"), F.lit(SALTS)))
    key = ["traj_id", "u", "_salt"]
    per_salt = salted.groupBy(*key).agg(F.min("v").alias("_least"))
    per_node = per_salt.groupBy("traj_id", "u").agg(F.min("_least").alias("m"))
    return salted.join(per_salt.join(shuffled(per_node), ["traj_id", "u"]).select(*key, "m"), key).drop("_salt")


def _large_star(links: DataFrame) -> DataFrame:
    """Connect each node's larger neighbours to its smallest neighbour (or itself)."""
    both = links.unionByName(links.select("traj_id", F.col("v").alias("u"), F.col("u").alias("v")))
    larger = _with_smallest(both).where(F.col("v") > F.col("u"))
    return larger.select("traj_id", F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Connect each node's smaller neighbours and the node itself to the smallest of them."""
    known = _with_smallest(links)
    moved = known.where(F.col("v") != F.col("m")).select("traj_id", F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(known.select("traj_id", "u", F.col("m").alias("v"))).distinct()
