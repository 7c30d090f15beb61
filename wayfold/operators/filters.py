"""Time-range filters with Seoul wall-clock bounds."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timeops import kst_range, utc_literal


def filter_points(df: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Rows with start <= timestamp < end; the bounds are literals, so scans can use them."""
    low, high = map(utc_literal, kst_range(start, end))
    return df.where((F.col("timestamp") >= low) & (F.col("timestamp") < high))


def filter_intervals(df: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Rows whose interval overlaps the range; they are kept whole."""
    low, high = map(utc_literal, kst_range(start, end))
    return df.where((F.col("start_time") < high) & (F.col("end_time") > low))


def activity_starts(activities: DataFrame) -> DataFrame:
    """The start of each activity as a plain point."""
    return activities.select(
        *(c for c in ("traj_id",) if c in activities.columns),
        F.col("start_latitude").alias("latitude"),
        F.col("start_longitude").alias("longitude"),
    )


def noise(clustered: DataFrame) -> DataFrame:
    return clustered.where(F.col("cluster_id") == 0)


def in_clusters(clustered: DataFrame) -> DataFrame:
    return clustered.where(F.col("cluster_id") > 0)
