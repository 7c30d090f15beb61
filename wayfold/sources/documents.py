"""The derived tables as location-history documents, to read back with the JSON readers.

A document holds the signals or the one segment of a stay, so no document grows with
the length of a trajectory.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .derived import STAY_POINTS


def _place(lat: str, lon: str) -> Column:
    return F.format_string("%.7f°, %.7f°", F.col(lat), F.col(lon))


def _time(name: str) -> Column:
    local = F.from_utc_timestamp(F.col(name), "Asia/Seoul")
    return F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("+09:00"))


def _stay() -> Column:
    return F.floor((F.col("ord") - 1) / F.lit(STAY_POINTS)).alias("stay")


def signal_documents(points: DataFrame) -> DataFrame:
    """(traj_id, text): the positions of a stay, each next to a signal without position."""
    position = F.struct(
        _place("latitude", "longitude").alias("LatLng"),
        F.col("accuracy").alias("accuracyMeters"),
        _time("timestamp").alias("timestamp"),
    )
    none = F.lit(None).cast("string")
    located = F.struct(position.alias("position"), none.alias("wifiScan"))
    other = F.struct(F.lit(None).cast("struct<LatLng:string,accuracyMeters:bigint,timestamp:string>").alias("position"),
                     F.lit("none").alias("wifiScan"))
    signals = points.groupBy("traj_id", _stay()).agg(F.collect_list(located).alias("located"))
    return signals.select(
        "traj_id", F.to_json(F.struct(F.concat("located", F.array(other)).alias("rawSignals"))).alias("text")
    )


def _segment_document(df: DataFrame, name: str, value: Column) -> DataFrame:
    segment = F.struct(
        _time("start_time").alias("startTime"), _time("end_time").alias("endTime"), value.alias(name)
    )
    return df.select("traj_id", F.to_json(F.struct(F.array(segment).alias("semanticSegments"))).alias("text"))


def path_documents(paths: DataFrame) -> DataFrame:
    step = F.struct(_place("latitude", "longitude").alias("point"), _time("timestamp").alias("time"))
    stays = paths.groupBy("traj_id", _stay()).agg(
        F.min("timestamp").alias("start_time"), F.max("timestamp").alias("end_time"), F.collect_list(step).alias("steps")
    )
    return _segment_document(stays, "timelinePath", F.col("steps"))


def visit_documents(visits: DataFrame) -> DataFrame:
    best = F.struct(
        F.col("semantic_type").alias("semanticType"),
        F.col("place_probability").alias("probability"),
        F.struct(_place("latitude", "longitude").alias("latLng")).alias("placeLocation"),
    )
    return _segment_document(visits, "visit", F.struct("probability", best.alias("topCandidate")))


def activity_documents(activities: DataFrame) -> DataFrame:
    best = F.struct(F.col("activity_type").alias("type"), F.col("activity_probability").alias("probability"))
    value = F.struct(
        F.struct(_place("start_latitude", "start_longitude").alias("latLng")).alias("start"),
        F.struct(_place("end_latitude", "end_longitude").alias("latLng")).alias("end"),
        F.col("distance").alias("distanceMeters"),
        "probability",
        best.alias("topCandidate"),
    )
    return _segment_document(activities, "activity", value)


def all_documents(points: DataFrame, paths: DataFrame, visits: DataFrame, activities: DataFrame) -> DataFrame:
    union = signal_documents(points)
    for more in (path_documents(paths), visit_documents(visits), activity_documents(activities)):
        union = union.unionByName(more)
    return union
