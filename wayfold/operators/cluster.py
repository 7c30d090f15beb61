"""Spatio-temporal density clustering (ST-DBSCAN) as joins and aggregates.

A point is a core point if at least `min_pts` points, itself included, are within
`eps_space` metres and `eps_time` whole seconds. Clusters are the connected
components of core points, numbered from 1 by their first core point (the seed) in
`ord`. A point that is no core point belongs to the clusters of its core neighbours:
to the highest-numbered one whose seed is its neighbour, else to the lowest-numbered
one; without core neighbours it is noise, 0.

Points of short trajectories are compared with each other. In others work is per cell where
a cell suffices: points of a cell with `min_pts` rows are all core and all connected. Single
points are looked at in sparse cells only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import saved, shuffled
from .cells import CELL_ROWS, LEAF_ROWS, SHORT_ROWS, CellIndex, both_ways, extreme_points, near_points, near_rows
from .components import connected_components
from .ordered import BLOCK_ROWS, ranked, split_short

NOISE = 0


class _Density:
    """The saved stages that core detection and clustering share."""

    def __init__(self, df: DataFrame, cell_rows: int, leaf_rows: int) -> None:
        self.index = CellIndex(df, cell_rows, leaf_rows)
        pairs = saved(self.index.adjacent())
        both_dense = F.col("dense_a") & F.col("dense_b")
        self.dense_pairs = pairs.where(both_dense)
        # A dense cell has nothing to ask: all its points are core.
        self.sparse_pairs = both_ways(pairs.where(~both_dense)).where(~F.col("dense_a"))
        self.tested = saved(self._tested())
        self.sparse = saved(self._sparse_points())

    def _tested(self) -> DataFrame:
        """Neighbours of points in sparse cells, in cells no box decides.

        In a dense cell their number is enough; in a sparse one each is listed as `other`.
        """
        open_pairs = self.sparse_pairs.where(~F.col("all_near"))
        listed = self.index.near_pairs(open_pairs.where(~F.col("dense_b"))).select(
            "traj_id", "no_a", "no_b", "ord", F.lit(1).cast("long").alias("n"), F.col("q.ord").alias("other")
        )
        counted = self.index.near_counts(open_pairs.where("dense_b"))
        return listed.unionByName(counted.withColumn("other", F.lit(None).cast("long")))

    def _sparse_points(self) -> DataFrame:
        """Points of sparse cells with `core`. Such a cell has fewer than min_pts rows."""
        whole = (
            self.sparse_pairs.where("all_near")
            .groupBy("traj_id", F.col("no_a").alias("no"))
            .agg(F.sum("rows_b").alias("_whole"))
        )
        cells = self.index.cells.where(~F.col("dense")).select("traj_id", "no", "rows")
        known = F.col("rows") + F.coalesce("_whole", F.lit(0))
        tested = self.tested.groupBy("traj_id", "ord").agg(F.sum("n").alias("_tested"))
        columns = ["traj_id", "ord", "no", "latitude", "longitude", "t", "eps_space", "eps_time", "min_pts"]
        return (
            self.index.points.where(~F.col("dense"))
            .select(*columns)
            .join(shuffled(cells.join(shuffled(whole), ["traj_id", "no"], "left")), ["traj_id", "no"])
            .join(shuffled(tested), ["traj_id", "ord"], "left")
            .withColumn("core", known + F.coalesce("_tested", F.lit(0)) >= F.col("min_pts"))
            .drop("rows", "_whole", "_tested", "min_pts")
        )

    def core_cells(self) -> DataFrame:
        """Cells with a core point, and the first such point as `node`."""
        dense = self.index.cells.where("dense").select("traj_id", "no", F.col("no").alias("node"))
        sparse = self.sparse.where("core").groupBy("traj_id", "no").agg(F.min("ord").alias("node"))
        return dense.unionByName(sparse)


def core_points(df: DataFrame, cell_rows: int = CELL_ROWS, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """(traj_id, ord) of the core points; `df` has search limits."""
    short, df = split_short(saved(df), min(SHORT_ROWS, cell_rows), "timestamp")
    counted = near_rows(short).groupBy("traj_id", "ord", "min_pts").agg(F.count(F.lit(1)).alias("n"))
    core = counted.where(F.col("n") >= F.col("min_pts")).select("traj_id", "ord")
    if df is None:
        return core
    stages = _Density(df, cell_rows, leaf_rows)
    dense = stages.index.points.where("dense").select("traj_id", "ord")
    return core.unionByName(dense).unionByName(stages.sparse.where("core").select("traj_id", "ord"))


def st_dbscan(
    df: DataFrame,
    block_rows: int | None = BLOCK_ROWS,
    cell_rows: int = CELL_ROWS,
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """Adds `cluster_id` to points with search limits (see `with_search_limits`)."""
    df = saved(df)
    short, others = split_short(df, min(SHORT_ROWS, cell_rows), "timestamp")
    labels = _short_labels(short)
    if others is not None:
        labels = labels.unionByName(_cell_labels(others, block_rows, cell_rows, leaf_rows))
    return (
        df.join(shuffled(labels), ["traj_id", "ord"], "left")
        .withColumn("cluster_id", F.coalesce("cluster_id", F.lit(NOISE)))
        .drop("eps_space", "eps_time", "min_pts")
    )


def _short_labels(df: DataFrame) -> DataFrame:
    """(traj_id, ord, cluster_id) of the points in clusters, for trajectories whose points all meet each other."""
    ids = ["traj_id", "ord"]

    def core(end: str) -> Column:
        # Being near goes both ways, so the rows of either end are that point's neighbours.
        return F.count(F.lit(1)).over(Window.partitionBy("traj_id", end)) >= F.col("min_pts")

    met = near_rows(df).withColumn("core", core("ord")).withColumn("to_core", core("other")).where("to_core")
    met = saved(met.select(*ids, "other", "core"))
    links = met.where(F.col("core") & (F.col("ord") > F.col("other")))
    roots = connected_components(links.select("traj_id", F.col("ord").alias("u"), F.col("other").alias("v")))
    cores = met.where(F.col("ord") == F.col("other")).select("traj_id", F.col("ord").alias("node"))
    rooted = cores.join(shuffled(roots), ["traj_id", "node"], "left").select(
        "traj_id", F.col("node").alias("no"), F.coalesce("root", "node").alias("root")
    )
    clusters = _numbered(rooted, None).withColumnRenamed("no", "other")
    own = F.col("cluster_id")
    # The core neighbours of a core point are all of its cluster.
    label = F.coalesce(F.max(F.when(F.col("other") == F.col("seed"), own)), F.min(own))
    return met.join(shuffled(clusters), ["traj_id", "other"]).groupBy(*ids).agg(label.alias("cluster_id"))


def _cell_labels(df: DataFrame, block_rows: int | None, cell_rows: int, leaf_rows: int) -> DataFrame:
    """(traj_id, ord, cluster_id) of the points in clusters."""
    stages = _Density(df, cell_rows, leaf_rows)
    cell_cluster = saved(_numbered(_rooted_cells(stages), block_rows))
    in_core_cells = cell_cluster.select("traj_id", "no", "cluster_id")
    in_dense = stages.index.points_of(
        stages.index.points.where("dense").select("traj_id", "no", "ord"), in_core_cells
    ).drop("no")
    in_sparse = (
        stages.sparse.where("core")
        .join(shuffled(in_core_cells), ["traj_id", "no"])
        .select("traj_id", "ord", "cluster_id")
    )
    return in_dense.unionByName(in_sparse).unionByName(_border_labels(stages, cell_cluster))


def _rooted_cells(stages: _Density) -> DataFrame:
    """(traj_id, no, root): each core cell with the first core point of its component."""
    core_cells = saved(stages.core_cells())
    core = stages.sparse.where("core").select("traj_id", "ord")
    from_core = stages.tested.join(shuffled(core), ["traj_id", "ord"], "left_semi")
    to_sparse = from_core.where(F.col("other").isNotNull()).join(
        shuffled(core.withColumnRenamed("ord", "other")), ["traj_id", "other"], "left_semi"
    )
    edges = stages.dense_pairs.unionByName(stages.sparse_pairs).where("all_near").select("traj_id", "no_a", "no_b")
    open_pairs = stages.dense_pairs.where(~F.col("all_near"))
    if open_pairs.take(1):
        tried = _with_corner_contact(stages, open_pairs)
        edges = edges.unionByName(tried.where("touch").select("traj_id", "no_a", "no_b"))
        open_pairs = tried.where(~F.col("touch")).drop("touch")
    else:
        open_pairs = None
    for more in (from_core.where(F.col("other").isNull()), to_sparse):
        edges = edges.unionByName(more.select("traj_id", "no_a", "no_b"))
    edges = edges.distinct()
    for end, node in (("no_a", "u"), ("no_b", "v")):
        edges = edges.join(shuffled(core_cells.withColumnsRenamed({"no": end, "node": node})), ["traj_id", end])
    roots = connected_components(edges.select("traj_id", "u", "v"))
    rooted = core_cells.join(shuffled(roots), ["traj_id", "node"], "left").select(
        "traj_id", "no", F.coalesce("root", "node").alias("root")
    )
    return rooted if open_pairs is None else _joined_by_points(stages, saved(rooted), open_pairs)


def _numbered(rooted: DataFrame, block_rows: int | None) -> DataFrame:
    """(traj_id, no, seed, cluster_id): clusters counted from 1 in the order of their seeds."""
    cells = rooted.withColumnRenamed("root", "seed")
    if block_rows is None:
        number = F.dense_rank().over(Window.partitionBy("traj_id").orderBy("seed"))
        return cells.withColumn("cluster_id", number)
    cells = saved(cells)
    seeds = ranked(cells.select("traj_id", "seed").distinct(), ["traj_id"], [F.col("seed")], "cluster_id", block_rows)
    return cells.join(shuffled(seeds), ["traj_id", "seed"]).withColumn("cluster_id", F.col("cluster_id").cast("int"))


def _with_corner_contact(stages: _Density, pairs: DataFrame) -> DataFrame:
    """Dense pairs with `touch`: whether two of their extreme points are neighbours."""
    asked = pairs.select("traj_id", F.explode(F.array("no_a", "no_b")).alias("no")).distinct()
    corners = saved(extreme_points(stages.index.points_of(stages.index.points.where("dense"), asked)))
    for end in ("a", "b"):
        pairs = pairs.join(
            shuffled(corners.withColumnsRenamed({"no": f"no_{end}", "corners": f"corners_{end}"})), ["traj_id", f"no_{end}"]
        )
    space, time = F.col("limits.eps_space"), F.col("limits.eps_time")

    def contact(p, q):
        return near_points(p.latitude, p.longitude, p.t, q.latitude, q.longitude, q.t, space, time)

    any_corner = F.exists(F.col("corners_a"), lambda p: F.exists(F.col("corners_b"), lambda q: contact(p, q)))
    return saved(pairs.withColumn("touch", any_corner).drop("corners_a", "corners_b"))


def _joined_by_points(stages: _Density, rooted: DataFrame, open_pairs: DataFrame) -> DataFrame:
    """Settles dense cell pairs that neither boxes nor corners decide.

    Only those matter whose cells are in different components so far.
    """
    for end in ("a", "b"):
        open_pairs = open_pairs.join(
            shuffled(rooted.withColumnsRenamed({"no": f"no_{end}", "root": f"root_{end}"})), ["traj_id", f"no_{end}"]
        )
    open_pairs = saved(open_pairs.where(F.col("root_a") != F.col("root_b")))
    if not open_pairs.take(1):
        return rooted
    touching = stages.index.near_counts(open_pairs).select("traj_id", "no_a", "no_b").distinct()
    edges = open_pairs.join(shuffled(touching), ["traj_id", "no_a", "no_b"], "left_semi").select(
        "traj_id", F.col("root_a").alias("u"), F.col("root_b").alias("v")
    )
    merged = connected_components(edges)
    renamed = merged.select("traj_id", F.col("node").alias("root"), F.col("root").alias("_merged"))
    return rooted.join(shuffled(renamed), ["traj_id", "root"], "left").select(
        "traj_id", "no", F.coalesce("_merged", "root").alias("root")
    )


def _border_labels(stages: _Density, cell_cluster: DataFrame) -> DataFrame:
    """Labels of points that are no core point but have a core neighbour."""
    border = stages.sparse.where(~F.col("core"))
    ids = ["traj_id", "ord"]
    whole = border.select(*ids, F.col("no").alias("no_a")).join(
        shuffled(stages.sparse_pairs.where("all_near").select("traj_id", "no_a", F.col("no_b").alias("no"))),
        ["traj_id", "no_a"],
    )
    core = stages.sparse.where("core").select("traj_id", F.col("ord").alias("other"))
    tested = stages.tested.join(shuffled(border.select(*ids)), ids, "left_semi")
    listed = tested.where(F.col("other").isNotNull()).join(shuffled(core), ["traj_id", "other"], "left_semi")
    # All points of the own cell and of whole near cells are neighbours, so any core
    # point in them counts; the join below keeps the cells that have one.
    reached = border.select(*ids, "no").unionByName(whole.drop("no_a"))
    for more in (tested.where(F.col("other").isNull()), listed):
        reached = reached.unionByName(more.select(*ids, F.col("no_b").alias("no")))
    found = reached.join(shuffled(cell_cluster), ["traj_id", "no"]).select(*ids, "seed", "cluster_id").distinct()
    seeds = stages.index.points.join(
        shuffled(cell_cluster.select("traj_id", F.col("seed").alias("ord")).distinct()), ids, "left_semi"
    ).select("traj_id", F.col("ord").alias("seed"), *(F.col(c).alias(f"_{c}") for c in ("latitude", "longitude", "t")))
    at_seed = near_points(
        *(F.col(c) for c in ("latitude", "longitude", "t", "_latitude", "_longitude", "_t")),
        F.col("eps_space"),
        F.col("eps_time"),
    )
    return (
        found.join(shuffled(border.drop("no", "core")), ids)
        .join(shuffled(seeds), ["traj_id", "seed"])
        .groupBy(*ids)
        .agg(
            F.coalesce(F.max(F.when(at_seed, F.col("cluster_id"))), F.min("cluster_id")).alias("cluster_id")
        )
    )


def cluster_sizes(clustered: DataFrame) -> DataFrame:
    """Rows per trajectory and cluster; noise is cluster 0."""
    return clustered.groupBy("traj_id", "cluster_id").agg(F.count(F.lit(1)).alias("points"))
