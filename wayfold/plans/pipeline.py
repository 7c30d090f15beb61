"""The whole way from positions to clusters, with thresholds estimated from the data."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.cells import CELL_ROWS, with_search_limits
from ..operators.cluster import st_dbscan
from ..operators.curves import (
    curve,
    jump_thresholds,
    knee,
    largest_k,
    same_place_thresholds,
    temporal_k_distances,
    with_density_rule,
)
from ..operators.filters import activity_starts, filter_intervals, filter_points
from ..operators.knn import spatial_k_distances
from ..operators.layers import layer_union
from ..operators.ordered import BLOCK_ROWS, ranked
from ..operators.segments import gap_distances, jump_segments, remove_jumps, segment_context, segment_means, with_segments
from ..schemas import ALL_JSON, CLUSTERED_POSITIONS, RAW_POSITIONS
from ..session import saved
from ..sources.tables import Part, keyed, save_tables
from ..sources.timeline_json import READERS, all_rows, read_documents, rejected_documents

LABELS = ("positions", "paths", "visits", "activities")
USABLE = "usable"
TOO_SHORT = "too short"
EPS_NOT_POSITIVE = "eps not positive"


@dataclass(frozen=True)
class Cleaned:
    points: DataFrame
    jump_thresholds: DataFrame
    same_place_thresholds: DataFrame
    jumps: DataFrame


def clean_positions(points: DataFrame, block_rows: int | None = BLOCK_ROWS) -> Cleaned:
    """Estimate both thresholds per trajectory and drop the sudden jumps.

    Segment statistics are computed once: the thresholds are taken from the same
    distances that they are compared with.
    """
    gaps = saved(gap_distances(points, block_rows))
    jump = saved(jump_thresholds(gaps, block_rows))
    segmented = with_segments(gaps, jump, block_rows)
    context = saved(segment_context(segment_means(segmented), block_rows))
    same_place = same_place_thresholds(context, block_rows)
    jumps = jump_segments(context, same_place, block_rows)
    kept = remove_jumps(gaps.drop("distance_to_next", "distance_from_previous"), jumps)
    return Cleaned(kept, jump, same_place, jumps)


@dataclass(frozen=True)
class Tuned:
    points: DataFrame
    parameters: DataFrame


def density_parameters(points: DataFrame, block_rows: int | None = BLOCK_ROWS, extra_k: int = -1) -> Tuned:
    """Per trajectory: min_pts = ceil(ln n), k = min_pts + extra_k, and both eps as knees.

    `parameters` lists every trajectory, with `status` telling why one cannot be
    clustered. `points` are renumbered without holes.
    """
    ruled = saved(with_density_rule(points, block_rows, extra_k))
    per_trajectory = ruled.groupBy("traj_id").agg(*(F.max(c).alias(c) for c in ("n", "min_pts", "k")))
    long_enough = ruled.where((F.col("k") >= 1) & (F.col("n") > F.col("k")))
    max_k = max(1, largest_k(long_enough))
    spatial = spatial_k_distances(long_enough, max_k, block_rows)
    temporal = temporal_k_distances(long_enough, max_k, block_rows)
    eps_space = knee(curve(spatial, "k_distance", F.col("copies")), "eps_space", block_rows=block_rows)
    eps_time = knee(curve(temporal, F.col("k_distance").cast("double")), "eps_time", block_rows=block_rows)
    status = (
        F.when(F.col("eps_space").isNull() | F.col("eps_time").isNull(), TOO_SHORT)
        .when((F.col("eps_space") <= 0) | (F.col("eps_time") <= 0), EPS_NOT_POSITIVE)
        .otherwise(USABLE)
    )
    parameters = (
        per_trajectory.join(eps_space, "traj_id", "left")
        .join(eps_time, "traj_id", "left")
        .withColumn("status", status)
    )
    return Tuned(ruled.drop("n", "min_pts", "k"), saved(parameters))


def cluster_tuned(tuned: Tuned, block_rows: int | None = BLOCK_ROWS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """ST-DBSCAN with each trajectory's own parameters, and the `status` of the trajectory.

    Rows of unusable trajectories stay, without a cluster.
    """
    usable = tuned.parameters.where(F.col("status") == USABLE)
    rest = tuned.parameters.where(F.col("status") != USABLE).select("traj_id", "status")
    searched = tuned.points.join(usable.select("traj_id"), "traj_id", "left_semi")
    limited = with_search_limits(searched, "eps_space", "eps_time", "min_pts", usable, block_rows)
    clustered = st_dbscan(limited, block_rows, cell_rows).withColumn("status", F.lit(USABLE))
    return clustered.unionByName(tuned.points.join(rest, "traj_id"), allowMissingColumns=True)


@dataclass(frozen=True)
class Result:
    cleaned: Cleaned
    tuned: Tuned
    clustered: DataFrame


def run_pipeline(
    points: DataFrame,
    start: datetime | None = None,
    end: datetime | None = None,
    block_rows: int | None = BLOCK_ROWS,
) -> Result:
    """Positions (traj_id, point_id, timestamp, ...) -> cleaned and clustered positions."""
    if (start is None) != (end is None):
        raise ValueError("give both ends of the range, or none")
    if start is not None and end is not None:
        points = ranked(
            filter_points(points, start, end).drop("ord"),
            ["traj_id"],
            [F.col("timestamp"), F.col("point_id")],
            "ord",
            block_rows,
        )
    cleaned = clean_positions(points, block_rows)
    tuned = density_parameters(cleaned.points, block_rows)
    return Result(cleaned, tuned, saved(cluster_tuned(tuned, block_rows)))


# Which time splits a stored table into days.
DAY_OF = {t.name: "timestamp" if "timestamp" in t.columns else "start_time" for t in READERS}


def store_rows(
    spark: SparkSession, documents: DataFrame, folder: str, key: T.DataType, format: str = "parquet", strict: bool = True
) -> dict[str, dict[str, int]]:
    """Store the four tables of documents (traj_id, and the parts of `ALL_JSON`) that are parsed once.

    The parsed rows of all tables are written once, split by table, and stored from there with one commit, by
    day. Returns how many rows break each rule, by table, if not `strict`.
    """
    rows = saved(all_rows(documents, strict), split_by="table_name")
    parts = {}
    for table in READERS:
        own = keyed(table, traj_id=key)
        parts[table.name] = Part(
            rows.where(F.col("table_name") == table.name).select(own.columns), own, DAY_OF[table.name], strict
        )
    return save_tables(spark, folder, parts, format)


def store_all(
    spark: SparkSession, documents: str | list[str], folder: str, format: str = "parquet", strict: bool = True
) -> dict[str, dict[str, int]]:
    """Extract the four tables of the documents, check them and store each as `folder`/<table>, by day.

    With `strict` any bad document or row fails the run, and the tables stay as they were. Otherwise rows that break
    a rule are kept apart (`load_rejected`) and counted in the result, and documents that don't parse, or have
    a field of the wrong type in any part, give no rows and go to `folder`/<table>_unreadable.
    """
    read = read_documents(spark, documents, ALL_JSON, strict)
    if not strict:
        # The files are read and parsed once: what they hold, and what could not be read.
        read = saved(read)
        unreadable = saved(rejected_documents(read))
        for table in READERS:
            unreadable.write.mode("overwrite").parquet(f"{folder}/{table.name}_unreadable")
    return store_rows(spark, read, folder, T.StringType(), format, strict)


def store_result(result: Result, folder: str, traj_type: T.DataType, format: str = "parquet") -> None:
    """Store cleaned positions, clustered positions, and the rows of trajectories that could not be clustered.

    All three change together.
    """
    cleaned = keyed(RAW_POSITIONS, traj_id=traj_type)
    clustered = keyed(CLUSTERED_POSITIONS, traj_id=traj_type)
    known = F.col("status") == USABLE
    parts = {
        "cleaned_positions": Part(result.cleaned.points.select(cleaned.columns), cleaned),
        CLUSTERED_POSITIONS.name: Part(result.clustered.where(known).select(clustered.columns), clustered),
        "unclustered_positions": Part(result.clustered.where(~known).select(cleaned.columns), cleaned),
    }
    save_tables(result.clustered.sparkSession, folder, parts, format)


def summarize(result: Result) -> DataFrame:
    """One row per trajectory: rows kept, thresholds, parameters, clusters and noise."""
    clusters = result.clustered.groupBy("traj_id").agg(
        F.max("cluster_id").alias("clusters"),
        F.when(F.count("cluster_id") > 0, F.count_if(F.col("cluster_id") == 0)).alias("noise_rows"),
    )
    return (
        result.tuned.parameters.withColumnRenamed("n", "cleaned_rows")
        .join(result.cleaned.jump_thresholds, "traj_id", "left")
        .join(result.cleaned.same_place_thresholds, "traj_id", "left")
        .join(clusters, "traj_id", "left")
    )


def compare_sources(
    raw: DataFrame, paths: DataFrame, visits: DataFrame, activities: DataFrame, start: datetime, end: datetime
) -> DataFrame:
    """The four tables of one time range as point layers."""
    in_range = (
        filter_points(raw, start, end),
        filter_points(paths, start, end),
        filter_intervals(visits, start, end),
        activity_starts(filter_intervals(activities, start, end)),
    )
    return layer_union(dict(zip(LABELS, in_range)))
