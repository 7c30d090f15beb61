"""Named queries over the given tables, one per operator.

Each takes the session and the folder of the tables. Distances are rounded to a
millimetre and times given in microseconds, so that another engine can check them.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import parsing, timeops
from ..functions.geo import haversine
from ..operators import cells, cluster, curves, filters, knn, layers, mobility, segments, validate
from ..plans import pipeline
from ..plans.pipeline import LABELS
from ..schemas import CLUSTERED_POSITIONS, RAW_POSITIONS, RAW_SIGNALS_JSON, VISITS
from ..session import saved, shared_folder
from ..sources import derived, documents, tables, timeline_json

Query = Callable[[SparkSession, str], DataFrame]

# Fixed values of the queries that do not estimate their parameters.
EPS_SPACE, EPS_TIME, MIN_PTS = 60.0, 86400.0, 4
RANGE = (datetime(2024, 1, 8), datetime(2024, 1, 22))
CITY = (37.5665, 126.978)


def _m(name: str, digits: int = 3) -> Column:
    return F.round(F.col(name), digits).alias(name)


def _us(name: str, alias: str | None = None) -> Column:
    return F.unix_micros(name).alias(alias or f"{name}_us")


def _gaps(spark, folder):
    points, blocks = derived.positions(spark, folder)
    return segments.gap_distances(points, blocks), blocks


def _segmented(spark, folder):
    gaps, blocks = _gaps(spark, folder)
    gaps = saved(gaps)
    return segments.with_segments(gaps, curves.jump_thresholds(gaps, blocks), blocks), blocks


def _context(spark, folder):
    segmented, blocks = _segmented(spark, folder)
    return segments.segment_context(segments.segment_means(segmented), blocks), blocks


# --- distances, segments, jumps -------------------------------------------------


def distance_to_next(spark, folder):
    points, blocks = derived.positions(spark, folder)
    out = segments.distance_to_next(points, blocks)
    return out.select("traj_id", "point_id", "ord", _m("distance_to_next"))


def haversine_to_city(spark, folder):
    points, _ = derived.positions(spark, folder)
    away = haversine(F.col("latitude"), F.col("longitude"), *map(F.lit, CITY))
    return points.select("point_id", F.round(away, 3).alias("metres"))


def segment_ids(spark, folder):
    segmented, _ = _segmented(spark, folder)
    return segmented.select("traj_id", "point_id", "segment_id")


def segment_means(spark, folder):
    segmented, _ = _segmented(spark, folder)
    return segments.segment_means(segmented).select(
        "traj_id", "segment_id", _m("mean_latitude", 6), _m("mean_longitude", 6), "point_count"
    )


def segment_context(spark, folder):
    context, _ = _context(spark, folder)
    neighbours = [f"{w}_{c}" for w in ("prev", "next") for c in ("latitude", "longitude")]
    return context.select(
        "traj_id", "segment_id", "point_count", *(_m(c, 6) for c in neighbours), _m("prev_next_distance")
    )


def _end_columns(*ends):
    columns = []
    for e in ends:
        columns += [_m(f"{e}_latitude", 9), _m(f"{e}_longitude", 9), _us(f"{e}_timestamp")]
    return columns


def segment_head_tail(spark, folder):
    segmented, _ = _segmented(spark, folder)
    return segments.segment_head_tail(segmented).select("traj_id", "segment_id", *_end_columns("head", "tail"))


def segment_connectors(spark, folder):
    segmented, blocks = _segmented(spark, folder)
    out = segments.segment_connectors(segments.segment_head_tail(segmented), blocks)
    return out.select("traj_id", "segment_id", *_end_columns("tail", "next_head"))


def jump_threshold(spark, folder):
    gaps, blocks = _gaps(spark, folder)
    return curves.jump_thresholds(gaps, blocks).select("traj_id", _m("jump_threshold"))


def same_place_threshold(spark, folder):
    context, blocks = _context(spark, folder)
    return curves.same_place_thresholds(context, blocks).select("traj_id", _m("same_place_threshold"))


def same_place_threshold_all(spark, folder):
    context, blocks = _context(spark, folder)
    return curves.same_place_thresholds(context, blocks, max_points=None).select(
        "traj_id", _m("same_place_threshold")
    )


def remove_jumps(spark, folder):
    points, blocks = derived.positions(spark, folder)
    return pipeline.clean_positions(points, blocks).points.select("traj_id", "point_id", "ord")


def removed_positions(spark, folder):
    points, blocks = derived.positions(spark, folder)
    points = saved(points)
    cleaned = pipeline.clean_positions(points, blocks).points
    return segments.removed_positions(points, cleaned).select("traj_id", "point_id", "ord")


def jump_removal_counts(spark, folder):
    points, blocks = derived.positions(spark, folder)
    points = saved(points)
    return segments.jump_removal_counts(points, pipeline.clean_positions(points, blocks).points)


def gap_distance_summary(spark, folder):
    gaps, blocks = _gaps(spark, folder)
    out = curves.gap_summary(saved(gaps), blocks)
    numbers = ("mean_gap", "std_gap", "min_gap", "q25_gap", "q50_gap", "q75_gap", "max_gap")
    return out.select("traj_id", "gap_count", *map(_m, numbers))


# --- knees and k-distances --------------------------------------------------------


def _event_values(spark, folder):
    rows = spark.read.parquet(f"{folder}/events.parquet").withColumnRenamed("user_id", "traj_id")
    return curves.curve(rows, "value"), derived.measured_blocks(rows)


def knee_normalized(spark, folder):
    values, blocks = _event_values(spark, folder)
    return curves.knee(values, "knee", True, blocks).select("traj_id", _m("knee"))


def knee_raw(spark, folder):
    values, blocks = _event_values(spark, folder)
    return curves.knee(values, "knee", False, blocks).select("traj_id", _m("knee"))


def _ruled(spark, folder, extra_k):
    points, blocks = derived.positions(spark, folder)
    ruled = saved(curves.with_density_rule(points, blocks, extra_k))
    return ruled, curves.largest_k(ruled), blocks


def min_pts(spark, folder):
    return curves.min_points(derived.events(spark, folder))


def temporal_k_distance(spark, folder):
    ruled, k, blocks = _ruled(spark, folder, -1)
    return curves.temporal_k_distances(ruled, k, blocks).select("traj_id", "point_id", "k", "k_distance")


def spatial_k_distance(spark, folder):
    ruled, k, blocks = _ruled(spark, folder, -1)
    found = knn.per_point(ruled, knn.spatial_k_distances(ruled, k, blocks))
    return found.select("traj_id", "point_id", "k", _m("k_distance"))


def k_distance_curve(spark, folder):
    ruled, k, blocks = _ruled(spark, folder, 0)
    places = knn.spatial_k_distances(ruled, k, blocks)
    out = curves.indexed_curve(curves.curve(places, "k_distance", F.col("copies")), blocks)
    return out.select("traj_id", "idx", _m("value"))


def temporal_k_distance_curve(spark, folder):
    ruled, k, blocks = _ruled(spark, folder, 0)
    seconds = curves.curve(curves.temporal_k_distances(ruled, k, blocks), "k_distance")
    return curves.indexed_curve(seconds, blocks)


def stdbscan_params(spark, folder):
    points, blocks = derived.positions(spark, folder)
    cleaned = pipeline.clean_positions(points, blocks).points
    parameters = pipeline.density_parameters(cleaned, blocks).parameters
    return parameters.select("traj_id", "n", "min_pts", "k", _m("eps_space"), _m("eps_time"), "status")


# --- neighbours and clusters --------------------------------------------------------


def _limited(spark, folder):
    points, blocks = derived.positions(spark, folder)
    return cells.with_search_limits(points, EPS_SPACE, EPS_TIME, MIN_PTS), blocks


def st_neighbors(spark, folder):
    points, _ = _limited(spark, folder)
    return cells.neighbour_counts(points)


def core_points(spark, folder):
    points, _ = _limited(spark, folder)
    return cluster.core_points(points)


def _clustered(spark, folder):
    points, blocks = _limited(spark, folder)
    return cluster.st_dbscan(points, blocks), blocks


def st_dbscan(spark, folder):
    clustered, _ = _clustered(spark, folder)
    return clustered.select("traj_id", "point_id", F.col("cluster_id").cast("long").alias("cluster_id"))


def noise_points(spark, folder):
    clustered, _ = _clustered(spark, folder)
    return filters.noise(clustered).select("traj_id", "point_id")


def cluster_sizes(spark, folder):
    """Clusters of positions that were not cleaned, with estimated parameters."""
    points, blocks = derived.positions(spark, folder)
    clustered = pipeline.cluster_tuned(pipeline.density_parameters(points, blocks), blocks)
    return cluster.cluster_sizes(clustered).withColumn("cluster_id", F.col("cluster_id").cast("long"))


def pipeline_summary(spark, folder):
    points, blocks = derived.positions(spark, folder)
    out = pipeline.summarize(pipeline.run_pipeline(points, block_rows=blocks))
    return out.select(
        "traj_id",
        "cleaned_rows",
        _m("jump_threshold"),
        _m("same_place_threshold"),
        "min_pts",
        _m("eps_space"),
        _m("eps_time"),
        "status",
        F.col("clusters").cast("long").alias("clusters"),
        "noise_rows",
    )


def stored_clusters(spark, folder):
    """The pipeline stored and read back; the first rows of some trajectories, copied as short ones, stay without clusters."""
    points, blocks = derived.positions(spark, folder)
    short = points.where((F.col("traj_id") % 10 == 0) & (F.col("ord") <= 2)).withColumn("traj_id", -F.col("traj_id") - 1)
    result = pipeline.run_pipeline(points.unionByName(short), block_rows=blocks)
    target = _target(spark, "result")
    kind = points.schema["traj_id"].dataType
    pipeline.store_result(result, target, kind)
    clustered = tables.load_table(spark, f"{target}/clustered_positions", tables.keyed(CLUSTERED_POSITIONS, traj_id=kind))
    left = tables.load_table(spark, f"{target}/unclustered_positions", tables.keyed(RAW_POSITIONS, traj_id=kind))
    rows = clustered.unionByName(left, allowMissingColumns=True)
    return rows.select("traj_id", _us("timestamp"), F.col("cluster_id").cast("long").alias("cluster_id"))


def pipeline_range_clusters(spark, folder):
    """The pipeline on one range of local time, as positions with clusters."""
    rows = derived.positions(spark, folder)
    out = pipeline.run_pipeline(rows[0], *RANGE, block_rows=rows[1]).clustered
    return out.select("traj_id", "point_id", F.col("cluster_id").cast("long").alias("cluster_id"))


def stays(spark, folder):
    clustered, _ = _clustered(spark, folder)
    return mobility.stays(clustered).select(
        "traj_id",
        F.col("cluster_id").cast("long").alias("cluster_id"),
        _us("start_time"),
        _us("end_time"),
        _m("latitude", 6),
        _m("longitude", 6),
        "points",
        "dwell_seconds",
    )


def daily_mobility(spark, folder):
    clustered, blocks = _clustered(spark, folder)
    return mobility.daily_mobility(clustered, blocks).select(
        "traj_id", F.col("day").cast("string").alias("day"), _m("travel_metres"), "points", "stays", "dwell_seconds"
    )


# --- documents and stored tables ------------------------------------------------------


def _parsed(texts: DataFrame, table) -> DataFrame:
    schema, flatten = next(v for t, v in timeline_json.READERS.items() if t.name == table)
    return flatten(timeline_json.parse_documents(texts, schema))


def load_raw_positions(spark, folder):
    points, _ = derived.positions(spark, folder)
    out = _parsed(documents.signal_documents(points), "raw_positions")
    return out.select("traj_id", "latitude", "longitude", "accuracy", _us("timestamp"))


def load_timeline_paths(spark, folder):
    points, _ = derived.positions(spark, folder)
    out = _parsed(documents.path_documents(derived.timeline_paths(points)), "timeline_paths")
    return out.select("traj_id", "latitude", "longitude", _us("timestamp"))


def load_visits(spark, folder):
    points, _ = derived.positions(spark, folder)
    out = _parsed(documents.visit_documents(derived.visits(points)), "visits")
    return out.select("traj_id", _us("start_time"), _us("end_time"), *VISITS.columns[2:])


def load_activities(spark, folder):
    points, blocks = derived.positions(spark, folder)
    out = _parsed(documents.activity_documents(derived.activities(points, blocks)), "activities")
    return out.select("traj_id", _us("start_time"), _us("end_time"), *out.columns[3:])


def _all_tables(spark, folder):
    points, blocks = derived.positions(spark, folder)
    points = saved(points)
    return points, derived.timeline_paths(points), derived.visits(points), derived.activities(points, blocks), blocks


def extract_counts(spark, folder):
    *four, _ = _all_tables(spark, folder)
    texts = saved(documents.all_documents(*four))
    union = None
    for name, df in timeline_json.extract_all_texts(texts).items():
        one = df.select(F.lit(name).alias("table_name"))
        union = one if union is None else union.unionByName(one)
    return union.groupBy("table_name").agg(F.count(F.lit(1)).alias("row_count"))


def rejected_documents(spark, folder):
    """Documents of which some are cut and some have a text for a number: rows of the others, and what was rejected."""
    points, _ = derived.positions(spark, folder)
    texts = documents.signal_documents(points).withColumn(
        "text",
        F.when(F.col("traj_id") % 5 == 1, F.expr("substring(text, 1, length(text) - 20)"))
        .when(F.col("traj_id") % 5 == 3, F.regexp_replace("text", '"accuracyMeters":[0-9]+', '"accuracyMeters":"abc"'))
        .otherwise(F.col("text")),
    )
    read = timeline_json.parse_documents(texts, RAW_SIGNALS_JSON, strict=False)
    rows = timeline_json.raw_positions(read, strict=False).groupBy("traj_id").agg(F.count(F.lit(1)).alias("n"))
    bad = timeline_json.rejected_documents(read).groupBy("traj_id", "reason").agg(F.count(F.lit(1)).alias("n"))
    return rows.select("traj_id", F.lit("read").alias("what"), "n").unionByName(
        bad.select("traj_id", F.col("reason").alias("what"), "n")
    )


def parse_latlng(spark, folder):
    """Coordinate text in several spellings, some of them broken."""
    points, _ = derived.positions(spark, folder)
    lat, lon = F.format_string("%.7f", "latitude"), F.format_string("%.7f", "longitude")
    kind = F.col("point_id") % 4
    text = (
        F.when(kind == 0, F.concat(lat, F.lit("°, "), lon, F.lit("°")))
        .when(kind == 1, F.concat(lat, F.lit(","), lon, F.lit(",9")))
        .when(kind == 2, lat)
        .otherwise(F.concat(F.lit("north, "), lon, F.lit("°")))
    )
    texts = points.select("point_id", text.alias("text"))
    return texts.select(
        "point_id",
        parsing.coordinate(F.col("text"), 0, strict=False).alias("latitude"),
        parsing.coordinate(F.col("text"), 1, strict=False).alias("longitude"),
    )


def parse_timestamp(spark, folder):
    """Time text with 3, 0 and 6 fractional digits; only the first is a time."""
    rows = derived.events(spark, folder)
    local = F.from_utc_timestamp("timestamp", "Asia/Seoul")
    kind = F.col("point_id") % 3
    pattern = {0: "yyyy-MM-dd'T'HH:mm:ss.SSS", 1: "yyyy-MM-dd'T'HH:mm:ss", 2: "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    text = F.coalesce(*(F.when(kind == n, F.date_format(local, p)) for n, p in pattern.items()))
    parsed = parsing.instant(F.concat(text, F.lit("+09:00")), strict=False)
    return rows.select("point_id", F.unix_micros(parsed).alias("timestamp_us"))


def kst_to_utc(spark, folder):
    rows = derived.events(spark, folder)
    return rows.select("point_id", F.unix_micros(timeops.kst_to_utc(F.col("timestamp"))).alias("utc_us"))


def utc_to_kst(spark, folder):
    rows = derived.events(spark, folder)
    return rows.select("point_id", F.unix_micros(timeops.utc_to_kst(F.col("timestamp"))).alias("kst_us"))


def _faulty(spark, folder):
    """Positions into which fixed faults are written."""
    points, _ = derived.positions(spark, folder)
    point = F.col("point_id")
    latitude = (
        F.when(point % 97 == 5, F.col("latitude") + 100)
        .when(point % 101 == 7, F.lit(float("nan")))
        .when(point % 103 == 9, F.lit(None))
        .otherwise(F.col("latitude"))
    )
    return points.select(
        "traj_id",
        "point_id",
        latitude.alias("latitude"),
        F.when(point % 109 == 3, F.col("longitude") + 200).otherwise(F.col("longitude")).alias("longitude"),
        F.when(point % 107 == 11, F.lit(-1)).otherwise(F.col("accuracy")).cast("long").alias("accuracy"),
        F.when(point % 113 != 1, F.col("timestamp")).alias("timestamp"),
    )


def validate_positions(spark, folder):
    _, rejected = validate.split_rows(_faulty(spark, folder), RAW_POSITIONS)
    return rejected.select("point_id", F.concat_ws("; ", "reasons").alias("reasons"))


def validation_report(spark, folder):
    return validate.violations(_faulty(spark, folder), RAW_POSITIONS)


def coordinate_violations(spark, folder):
    return validate.coordinate_violations(_faulty(spark, folder))


def roundtrip_positions(spark, folder):
    """Positions written as CSV with checks, and read back with checks."""
    points, _ = derived.positions(spark, folder)
    target = _target(spark, "positions")
    tables.save_table(points.select(*RAW_POSITIONS.columns), target, RAW_POSITIONS, "csv")
    back = tables.load_table(spark, target, RAW_POSITIONS, "csv")
    return back.select(_m("latitude", 9), _m("longitude", 9), "accuracy", _us("timestamp"))


def _target(spark, name):
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")


def store_all_counts(spark, folder):
    """Documents written as files, some thousand to a file, extracted and stored by one parse; rows read back."""
    *four, _ = _all_tables(spark, folder)
    texts = saved(documents.all_documents(*four))
    files, out = _target(spark, "documents"), _target(spark, "stored")
    number = F.pmod(F.xxhash64("traj_id", "text"), F.lit(1 + texts.count() // 2000))
    lists = texts.groupBy(number.alias("part")).agg(F.array_join(F.collect_list("text"), ",").alias("text"))
    lists.select("part", F.concat(F.lit("["), "text", F.lit("]")).alias("text")).write.partitionBy("part").text(files)
    pipeline.store_all(spark, f"{files}/*/*.txt", out)
    union = None
    for table in timeline_json.READERS:
        rows = tables.load_table(spark, f"{out}/{table.name}", tables.keyed(table, traj_id=T.StringType()))
        one = rows.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(table.name).alias("table_name"), "row_count")
        union = one if union is None else union.unionByName(one)
    return union


def stored_ranges(spark, folder):
    """Positions and visits stored by day and read back for one range of local time."""
    points, _ = derived.positions(spark, folder)
    points = saved(points)
    kind = points.schema["traj_id"].dataType
    out, raw, visits = _target(spark, "days"), tables.keyed(RAW_POSITIONS, traj_id=kind), tables.keyed(VISITS, traj_id=kind)
    parts = {
        "raw_positions": tables.Part(points.select(raw.columns), raw, "timestamp"),
        "visits": tables.Part(derived.visits(points).select(visits.columns), visits, "start_time"),
    }
    tables.save_tables(spark, out, parts)
    found = tables.load_range(spark, f"{out}/raw_positions", raw, *RANGE)
    spans = tables.load_range(spark, f"{out}/visits", visits, *RANGE)
    at = _us("timestamp", "start_us"), _us("timestamp", "end_us")
    return found.select("traj_id", F.lit("position").alias("what"), *at).unionByName(
        spans.select("traj_id", F.lit("visit").alias("what"), _us("start_time", "start_us"), _us("end_time", "end_us"))
    )


def stored_report(spark, folder):
    """How many rows break each rule, counted while the rows are stored."""
    out = _target(spark, "faulty")
    faulty = _faulty(spark, folder).select(RAW_POSITIONS.columns)
    counts = tables.save_tables(spark, out, {"faulty": tables.Part(faulty, RAW_POSITIONS, "timestamp", strict=False)})
    return spark.createDataFrame(sorted(counts["faulty"].items()), "rule string, bad_rows bigint")


def stored_rejected(spark, folder):
    """Rows kept apart when they were stored, and the others, read back."""
    table = tables.keyed(RAW_POSITIONS, point_id=T.LongType())
    out = _target(spark, "faulty")
    faulty = _faulty(spark, folder).select(table.columns)
    tables.save_tables(spark, out, {"faulty": tables.Part(faulty, table, "timestamp", strict=False)})
    good = tables.load_table(spark, f"{out}/faulty", table)
    bad = tables.load_rejected(spark, f"{out}/faulty", table)
    return good.select("point_id", F.lit("").alias("reasons")).unionByName(bad.select("point_id", "reasons"))


# --- ranges and layers ----------------------------------------------------------------


def filter_points(spark, folder):
    points, _ = derived.positions(spark, folder)
    return filters.filter_points(points, *RANGE).select("traj_id", "point_id", _us("timestamp"))


def filter_intervals(spark, folder):
    points, _ = derived.positions(spark, folder)
    out = filters.filter_intervals(derived.visits(points), *RANGE)
    return out.select("traj_id", _us("start_time"), _us("end_time"), "semantic_type")


def activity_start_points(spark, folder):
    points, blocks = derived.positions(spark, folder)
    return filters.activity_starts(derived.activities(points, blocks))


def _layers(spark, folder):
    points, paths, visits, activities, blocks = _all_tables(spark, folder)
    tables_ = (points, paths, visits, filters.activity_starts(activities))
    return saved(layers.layer_union(dict(zip(LABELS, tables_)))), blocks


def layer_union(spark, folder):
    union, _ = _layers(spark, folder)
    return union.select("traj_id", "label", _m("latitude", 9), _m("longitude", 9), _us("timestamp"))


def layer_extent(spark, folder):
    union, _ = _layers(spark, folder)
    extent = layers.layer_extent(union)
    return extent.select(*(_m(c, 9) for c in extent.columns))


def animation_frames(spark, folder):
    union, _ = _layers(spark, folder)
    return layers.animation_frames(union).select("traj_id", _us("timestamp"))


def visible_counts(spark, folder):
    union, blocks = _layers(spark, folder)
    out = layers.visible_by_time(union, LABELS, blocks)
    return out.select("traj_id", _us("timestamp"), "label", "visible")


def visible_counts_by_index(spark, folder):
    union, _ = _layers(spark, folder)
    return layers.visible_by_index(union)


def raw_vs_timeline(spark, folder):
    *four, _ = _all_tables(spark, folder)
    union = pipeline.compare_sources(*four, *RANGE)
    extent = layers.layer_extent(union, "traj_id", "label")
    counts = union.groupBy("traj_id", "label").agg(F.count(F.lit(1)).alias("points"))
    out = counts.join(extent, ["traj_id", "label"])
    return out.select("traj_id", "label", "points", *(_m(c, 6) for c in extent.columns[2:]))


QUERIES: dict[str, Query] = {
    "haversine": haversine_to_city,
    **{
        f.__name__: f
        for f in (
            distance_to_next,
            segment_ids,
            segment_means,
            segment_context,
            segment_head_tail,
            segment_connectors,
            jump_threshold,
            same_place_threshold,
            same_place_threshold_all,
            remove_jumps,
            removed_positions,
            jump_removal_counts,
            gap_distance_summary,
            knee_normalized,
            knee_raw,
            min_pts,
            temporal_k_distance,
            spatial_k_distance,
            k_distance_curve,
            temporal_k_distance_curve,
            stdbscan_params,
            st_neighbors,
            core_points,
            st_dbscan,
            noise_points,
            cluster_sizes,
            pipeline_summary,
            pipeline_range_clusters,
            stays,
            daily_mobility,
            load_raw_positions,
            load_timeline_paths,
            load_visits,
            load_activities,
            extract_counts,
            rejected_documents,
            stored_clusters,
            parse_latlng,
            parse_timestamp,
            kst_to_utc,
            utc_to_kst,
            validate_positions,
            validation_report,
            coordinate_violations,
            roundtrip_positions,
            store_all_counts,
            stored_ranges,
            stored_report,
            stored_rejected,
            filter_points,
            filter_intervals,
            activity_start_points,
            layer_union,
            layer_extent,
            animation_frames,
            visible_counts,
            visible_counts_by_index,
            raw_vs_timeline,
        )
    },
}
