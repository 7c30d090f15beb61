"""Several tables as labelled point layers, and what a replay of them shows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import BLOCK_ROWS, running_sum, unfold


def layer_union(layers: dict[str, DataFrame]) -> DataFrame:
    """(traj_id, label, latitude, longitude, timestamp); no time where a layer has none."""
    labelled = []
    for label, df in layers.items():
        time = F.col("timestamp") if "timestamp" in df.columns else F.lit(None).cast("timestamp")
        labelled.append(
            df.select("traj_id", F.lit(label).alias("label"), "latitude", "longitude", time.alias("timestamp"))
        )
    union = labelled[0]
    for more in labelled[1:]:
        union = union.unionByName(more)
    return union


def layer_extent(union: DataFrame, *by: str) -> DataFrame:
    """Smallest and largest coordinates over all layers, or per column of `by`."""
    return union.groupBy(*by).agg(
        F.min("latitude").alias("min_latitude"),
        F.max("latitude").alias("max_latitude"),
        F.min("longitude").alias("min_longitude"),
        F.max("longitude").alias("max_longitude"),
    )


def animation_frames(union: DataFrame) -> DataFrame:
    """The distinct times of a trajectory's layers."""
    timed = union.where(F.col("timestamp").isNotNull())
    return timed.select("traj_id", "timestamp").distinct()


def visible_by_time(
    union: DataFrame, labels: Sequence[str], block_rows: int | None = BLOCK_ROWS
) -> DataFrame:
    """(traj_id, timestamp, label, visible): rows shown in each frame of a replay by time.

    A timed layer shows its rows up to the frame, one without times all its rows.
    Rows are counted per time before anything is ordered.
    """
    per_time = union.groupBy("traj_id", "label", "timestamp").agg(F.count(F.lit(1)).alias("_n"))
    frame = animation_frames(union).withColumn("label", F.explode(F.array(*map(F.lit, labels))))
    counted = frame.join(per_time, ["traj_id", "label", "timestamp"], "left").withColumn(
        "_n", F.coalesce("_n", F.lit(0))
    )
    # A layer without times shows all its rows from the first frame on: they sort before all frames.
    # In a layer with times, rows without one are never shown.
    untimed_layers = per_time.groupBy("traj_id", "label").agg(F.max("timestamp").alias("_last")).where("_last is null")
    untimed = per_time.join(untimed_layers.drop("_last"), ["traj_id", "label"], "left_semi")
    shown = running_sum(
        counted.unionByName(untimed), ["traj_id", "label"], [F.col("timestamp")], F.col("_n"), "visible", block_rows
    )
    return shown.where(F.col("timestamp").isNotNull()).select("traj_id", "timestamp", "label", "visible")


def visible_by_index(union: DataFrame) -> DataFrame:
    """(traj_id, frame, label, visible) of a replay row by row: frame f shows f + 1 rows."""
    heights = union.groupBy("traj_id", "label").agg(F.count(F.lit(1)).alias("height"))
    longest = heights.groupBy("traj_id").agg((F.max("height") - 1).alias("_last"))
    layered = heights.join(longest, "traj_id").withColumn("_first", F.lit(0).cast("long"))
    return unfold(layered, "_first", "_last", "frame").select(
        "traj_id", "frame", "label", F.least(F.col("frame") + 1, F.col("height")).alias("visible")
    )
