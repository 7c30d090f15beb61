"""Gap distances, segments between large gaps, and removal of sudden jumps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import haversine
from .ordered import BLOCK_ROWS, attach, block_of, home_rows, neighbouring_rows, running_sum
from .validate import in_range

# Fixed values of the method.
MAX_JUMP_POINTS = 3
JUMP_RATE = 0.05


def gap_distances(df: DataFrame, block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """Adds the distance to the next and from the previous row of the trajectory.

    Fails at a coordinate out of range; a missing one gives missing distances.
    """
    near, by_ord = neighbouring_rows(in_range(df), 1, block_rows)
    lat, lon = F.col("latitude"), F.col("longitude")
    out = near.withColumns(
        {
            "distance_to_next": haversine(lat, lon, F.lead(lat).over(by_ord), F.lead(lon).over(by_ord)),
            "distance_from_previous": haversine(F.lag(lat).over(by_ord), F.lag(lon).over(by_ord), lat, lon),
        }
    )
    return home_rows(out, block_rows)


def distance_to_next(df: DataFrame, block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """Adds `distance_to_next`, null on the last row of a trajectory."""
    return gap_distances(df, block_rows).drop("distance_from_previous")


def with_segments(
    df: DataFrame, jump_thresholds: DataFrame | float, block_rows: int | None = BLOCK_ROWS
) -> DataFrame:
    """Adds `segment_id`, which starts at 0 and grows after each gap above the threshold.

    `jump_thresholds` is one number, or a frame (traj_id, jump_threshold).
    """
    if "distance_from_previous" not in df.columns:
        df = gap_distances(df, block_rows)
    if isinstance(jump_thresholds, DataFrame):
        df = attach(df, jump_thresholds.select("traj_id", "jump_threshold"), block_rows, "left")
    else:
        df = df.withColumn("jump_threshold", F.lit(float(jump_thresholds)))
    breaks = F.coalesce(F.col("distance_from_previous") > F.col("jump_threshold"), F.lit(False))
    return _running_by_ord(df, breaks.cast("long"), "segment_id", block_rows).drop(
        "jump_threshold", "distance_from_previous"
    )


def _running_by_ord(df: DataFrame, weight: Column, name: str, block_rows: int | None) -> DataFrame:
    """Running sum along `ord`; its blocks are known, so no cut points are sampled."""
    if block_rows is None:
        return running_sum(df, ["traj_id"], [F.col("ord")], weight, name, None)
    blocked = df.withColumn("_block", block_of(block_rows)).withColumn("_weight", weight)
    keys = ["traj_id", "_block"]
    sums = blocked.groupBy(*keys).agg(F.sum("_weight").alias("_sum"))
    before = Window.partitionBy("traj_id").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*keys, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    upto = Window.partitionBy(*keys).orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    return (
        blocked.withColumn(name, F.sum("_weight").over(upto))
        .join(offsets, keys)
        .withColumn(name, F.col(name) + F.col("_offset"))
        .drop("_block", "_weight", "_offset")
    )


def segment_means(segmented: DataFrame) -> DataFrame:
    """Mean position, number of rows and first `ord` of each segment."""
    return segmented.groupBy("traj_id", "segment_id").agg(
        F.avg("latitude").alias("mean_latitude"),
        F.avg("longitude").alias("mean_longitude"),
        F.count(F.lit(1)).alias("point_count"),
        F.min("ord").alias("first_ord"),
    )


def segment_context(means: DataFrame, block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """Adds the neighbour segments' means and the distance between them.

    The distance is rounded to a micrometre: it is later compared with a threshold
    taken from these very distances, and a mean may differ in its last bits
    when it is computed again in another order.
    """
    numbered = means.withColumn("_seg_ord", F.col("segment_id") + 1)
    near, by_segment = neighbouring_rows(numbered, 1, block_rows, "_seg_ord")
    mean = {"latitude": F.col("mean_latitude"), "longitude": F.col("mean_longitude")}
    out = near.withColumns(
        {f"prev_{n}": F.lag(c).over(by_segment) for n, c in mean.items()}
        | {f"next_{n}": F.lead(c).over(by_segment) for n, c in mean.items()}
    )
    distance = haversine(*(F.col(c) for c in ("prev_latitude", "prev_longitude", "next_latitude", "next_longitude")))
    return home_rows(
        out.withColumn("prev_next_distance", F.round(distance, 6)), block_rows, "_seg_ord"
    ).drop("_seg_ord")


def segment_head_tail(segmented: DataFrame) -> DataFrame:
    """First and last position and time of each segment."""
    point = F.struct("latitude", "longitude", "timestamp")
    ends = segmented.groupBy("traj_id", "segment_id").agg(
        F.min_by(point, "ord").alias("head"), F.max_by(point, "ord").alias("tail")
    )
    return ends.select(
        "traj_id",
        "segment_id",
        *(F.col(f"{e}.{c}").alias(f"{e}_{c}") for e in ("head", "tail") for c in ("latitude", "longitude", "timestamp")),
    )


def segment_connectors(ends: DataFrame, block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """From the last point of each segment to the first of the next; the last has none."""
    numbered = ends.withColumn("_seg_ord", F.col("segment_id") + 1)
    near, by_segment = neighbouring_rows(numbered, 1, block_rows, "_seg_ord")
    heads = ["head_latitude", "head_longitude", "head_timestamp"]
    out = near.withColumns({f"next_{c}": F.lead(c).over(by_segment) for c in heads})
    return (
        home_rows(out, block_rows, "_seg_ord")
        .where(F.col("next_head_latitude").isNotNull())
        .select(
            "traj_id",
            "segment_id",
            "tail_latitude",
            "tail_longitude",
            "tail_timestamp",
            *(f"next_{c}" for c in heads),
        )
    )


def jump_segments(
    context: DataFrame, same_place: DataFrame | float, block_rows: int | None = BLOCK_ROWS
) -> DataFrame:
    """Short segments whose neighbours lie at the same place.

    The first and last segments have no such distance and are never taken, nor
    is anything in a trajectory without a threshold. `same_place` is one number,
    or a frame (traj_id, same_place_threshold).
    """
    short = jump_candidates(context)
    if isinstance(same_place, DataFrame):
        numbered = short.withColumn("_seg_ord", F.col("segment_id") + 1)
        limits = same_place.select("traj_id", "same_place_threshold")
        short = attach(numbered, limits, block_rows, ord_col="_seg_ord").drop("_seg_ord")
    else:
        short = short.withColumn("same_place_threshold", F.lit(float(same_place)))
    return short.where(F.col("prev_next_distance") <= F.col("same_place_threshold")).select(
        "traj_id", "segment_id", "first_ord", "point_count"
    )


def jump_candidates(context: DataFrame, max_points: int | None = MAX_JUMP_POINTS) -> DataFrame:
    """Segments with both neighbours, by default the short ones only."""
    between = context.where(F.col("prev_next_distance").isNotNull())
    return between if max_points is None else between.where(F.col("point_count") <= max_points)


def remove_jumps(points: DataFrame, jumps: DataFrame) -> DataFrame:
    """Rows of `points` outside the jump segments.

    A jump segment has a handful of consecutive rows, so it is spelled out as
    their `ord`s; matching by segment would gather a long kept segment in one task.
    """
    last = F.col("first_ord") + F.col("point_count") - 1
    rows = jumps.select("traj_id", F.explode(F.sequence("first_ord", last)).alias("ord"))
    return points.join(rows, ["traj_id", "ord"], "left_anti")


def removed_positions(raw: DataFrame, cleaned: DataFrame, by: str = "ord") -> DataFrame:
    """Rows of `raw` that `cleaned` lacks.

    With by="timestamp" a removed row is hidden by a kept one of the same time.
    """
    return raw.join(cleaned.select("traj_id", by), ["traj_id", by], "left_anti")


def jump_removal_counts(raw: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Rows before, after and removed, per trajectory."""
    tagged = raw.select("traj_id", F.lit(0).alias("_kept")).unionByName(
        cleaned.select("traj_id", F.lit(1).alias("_kept"))
    )
    before = F.count(F.when(F.col("_kept") == 0, 1))
    after = F.sum("_kept")
    return tagged.groupBy("traj_id").agg(
        before.alias("before_rows"), after.alias("after_rows"), (before - after).alias("removed_rows")
    )
