"""Location tables derived from the `events` table.

The given tables hold no positions. These frames place every event of a user on a
path: stays of twelve points, a move between stays, and now and then a jump away and
back. The arithmetic is fixed, so the same tables can be stated in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geo import haversine
from ..operators.ordered import BLOCK_ROWS, home_rows, measured_blocks, neighbouring_rows, ranked
from ..session import require_utc

STAY_POINTS = 12


def events(spark: SparkSession, folder: str) -> DataFrame:
    require_utc(spark)
    rows = spark.read.parquet(f"{folder}/events.parquet")
    return rows.select(
        F.col("user_id").alias("traj_id"),
        F.col("event_id").alias("point_id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def positions(
    spark: SparkSession, folder: str, limit: int = BLOCK_ROWS
) -> tuple[DataFrame, int | None]:
    """Positions in time order, and the block size that their trajectories need."""
    rows = events(spark, folder)
    block_rows = measured_blocks(rows, block_rows=limit)
    numbered = ranked(rows, ["traj_id"], [F.col("timestamp"), F.col("point_id")], "ord", block_rows)
    return place(numbered), block_rows


def place(numbered: DataFrame) -> DataFrame:
    traj, point, at = F.col("traj_id"), F.col("point_id"), F.col("ord")
    stay = F.floor((at - 1) / F.lit(STAY_POINTS))
    latitude = (
        F.lit(37.5)
        + F.lit(0.01) * (traj % 7)
        + F.lit(0.02) * stay
        + (point * 7919 % 997) / F.lit(997.0) * F.lit(0.0008)
        + F.when(at % 17 == 9, F.lit(0.25)).otherwise(F.lit(0.0))
    )
    longitude = (
        F.lit(127.0)
        + F.lit(0.01) * (traj % 5)
        + F.lit(0.015) * stay
        + (point * 104729 % 991) / F.lit(991.0) * F.lit(0.0008)
    )
    return numbered.select(
        "traj_id",
        "point_id",
        "ord",
        "timestamp",
        latitude.alias("latitude"),
        longitude.alias("longitude"),
        (3 + point % 20).alias("accuracy"),
    )


def visits(points: DataFrame) -> DataFrame:
    """One visit per stay."""
    stay = F.floor((F.col("ord") - 1) / F.lit(STAY_POINTS)).alias("stay")
    first = F.min("point_id")
    return (
        points.groupBy("traj_id", stay)
        .agg(
            F.min("timestamp").alias("start_time"),
            F.max("timestamp").alias("end_time"),
            F.round(F.avg("latitude"), 7).alias("latitude"),
            F.round(F.avg("longitude"), 7).alias("longitude"),
            first.alias("first_point"),
        )
        .select(
            "traj_id",
            "start_time",
            "end_time",
            "latitude",
            "longitude",
            F.element_at(F.array(F.lit("HOME"), F.lit("WORK"), F.lit("UNKNOWN")), (F.col("stay") % 3 + 1).cast("int")).alias(
                "semantic_type"
            ),
            ((F.col("first_point") % 100) / F.lit(100.0)).alias("probability"),
            ((F.col("first_point") * 7 % 100) / F.lit(100.0)).alias("place_probability"),
        )
    )


def activities(points: DataFrame, block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """One activity from the last point of a stay to the first point of the next."""
    near, by_ord = neighbouring_rows(points, 1, block_rows)
    following = {f"_{c}": F.lead(c).over(by_ord) for c in ("latitude", "longitude", "timestamp")}
    steps = home_rows(near.withColumns(following), block_rows).where(
        (F.col("ord") % STAY_POINTS == 0) & F.col("_timestamp").isNotNull()
    )
    rounded = {n: F.round(F.col(c), 7) for n, c in (
        ("start_latitude", "latitude"),
        ("start_longitude", "longitude"),
        ("end_latitude", "_latitude"),
        ("end_longitude", "_longitude"),
    )}
    stay = F.floor((F.col("ord") - 1) / F.lit(STAY_POINTS))
    ends = steps.withColumns(rounded)
    return ends.select(
        "traj_id",
        F.col("timestamp").alias("start_time"),
        F.col("_timestamp").alias("end_time"),
        *rounded,
        F.round(haversine(*(F.col(c) for c in rounded)), 3).alias("distance"),
        F.element_at(F.array(F.lit("WALKING"), F.lit("IN_VEHICLE")), (stay % 2 + 1).cast("int")).alias(
            "activity_type"
        ),
        ((F.col("point_id") % 100) / F.lit(100.0)).alias("probability"),
        ((F.col("point_id") * 3 % 100) / F.lit(100.0)).alias("activity_probability"),
    )


def timeline_paths(points: DataFrame) -> DataFrame:
    """All positions, as points of paths."""
    return points.select("traj_id", "point_id", "ord", "latitude", "longitude", "timestamp")
