"""Stays and daily travel from clustered positions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timeops import second_gap, utc_to_kst
from .filters import in_clusters
from .ordered import BLOCK_ROWS
from .segments import gap_distances


def stays(clustered: DataFrame) -> DataFrame:
    """Per cluster: start, end, whole seconds between, centre and number of points."""
    return (
        in_clusters(clustered)
        .groupBy("traj_id", "cluster_id")
        .agg(
            F.min("timestamp").alias("start_time"),
            F.max("timestamp").alias("end_time"),
            F.avg("latitude").alias("latitude"),
            F.avg("longitude").alias("longitude"),
            F.count(F.lit(1)).alias("points"),
        )
        .withColumn("dwell_seconds", second_gap(F.col("start_time"), F.col("end_time")))
    )


def daily_dwell(stays: DataFrame) -> DataFrame:
    """(traj_id, day, dwell_seconds): stays cut at midnight in Seoul; the days of a stay add up to its whole seconds."""
    start, end = (utc_to_kst(F.col(c)) for c in ("start_time", "end_time"))
    days = F.sequence(F.to_date(start), F.to_date(end))
    cut = stays.select("traj_id", start.alias("start"), end.alias("end"), F.explode(days).alias("day"))
    midnight = F.col("day").cast("timestamp")
    parts = cut.withColumn("from", F.greatest("start", midnight)).withColumn(
        "to", F.least("end", F.date_add("day", 1).cast("timestamp"))
    )
    seconds = second_gap(F.col("start"), F.col("to")) - second_gap(F.col("start"), F.col("from"))
    return parts.groupBy("traj_id", "day").agg(F.sum(seconds).alias("dwell_seconds"))


def daily_mobility(clustered: DataFrame, block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """Per trajectory and day in Seoul: travelled metres, points, stays touched, and seconds of stays.

    A gap counts on the day of the point it starts from. A day inside a stay but without points has seconds only.
    """
    gaps = gap_distances(clustered, block_rows)
    day = F.to_date(utc_to_kst(F.col("timestamp"))).alias("day")
    # First one row per cluster and day, so that no distinct count has to see all points.
    per_cluster = gaps.groupBy("traj_id", day, "cluster_id").agg(
        F.sum("distance_to_next").alias("_metres"), F.count(F.lit(1)).alias("_points")
    )
    per_day = per_cluster.groupBy("traj_id", "day").agg(
        F.sum("_metres").alias("travel_metres"),
        F.sum("_points").alias("points"),
        F.count_if(F.col("cluster_id") > 0).alias("stays"),
    )
    out = per_day.join(daily_dwell(stays(clustered)), ["traj_id", "day"], "full")
    filled = {"travel_metres": F.lit(0.0), **{c: F.lit(0) for c in ("points", "stays", "dwell_seconds")}}
    return out.select("traj_id", "day", *(F.coalesce(c, empty).alias(c) for c, empty in filled.items()))
