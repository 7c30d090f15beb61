"""Splitting long trajectories into blocks must not change any result."""

import random

import pytest
from pyspark.sql import functions as F

from points import frame
from wayfold.operators import curves, segments
from wayfold.operators.ordered import attach, measured_blocks, ranked, running_sum, unfold


@pytest.fixture(scope="module")
def walk(spark):
    rnd = random.Random(1)
    trajectories = {}
    for traj, n in enumerate((1, 2, 3, 40, 400)):
        points, second = [], 0.0
        for _ in range(n):
            second += rnd.choice([0, 0.4, 10.9, 60, 3000])
            jump = 0.25 if rnd.random() < 0.05 else 0.0
            points.append((37 + rnd.gauss(0, 0.001) + jump, 127 + rnd.gauss(0, 0.001), second))
        if n > 100:  # a group of copies
            points[50:150] = [points[50][:2] + (p[2],) for p in points[50:150]]
        trajectories[traj] = points
    return frame(spark, trajectories).cache()


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def same_in_blocks(make, block_rows):
    assert rows(make(None)) == rows(make(block_rows))


def test_measured_blocks(walk):
    assert measured_blocks(walk, block_rows=400) is None
    assert measured_blocks(walk, block_rows=399) == 399


@pytest.mark.parametrize("block_rows", [7, 64])
def test_ranked(walk, block_rows):
    def make(blocks):
        shuffled = walk.drop("ord").repartition(5)
        return ranked(shuffled, ["traj_id"], [F.col("timestamp"), F.col("point_id")], "ord", blocks)

    same_in_blocks(make, block_rows)
    assert rows(make(7).select("point_id", "ord")) == rows(walk.select("point_id", "ord"))


def test_running_sum_with_totals(walk):
    def make(blocks):
        totals = {"n": ("sum", F.lit(1)), "top": ("max", F.col("point_id")), "low": ("min", F.col("point_id"))}
        return running_sum(walk, ["traj_id"], [F.col("ord")], F.col("point_id") % 5, "total", blocks, totals).select(
            "point_id", "total", "n", "top", "low"
        )

    same_in_blocks(make, 11)


def test_segments(walk):
    def make(blocks):
        gaps = segments.gap_distances(walk, blocks)
        segmented = segments.with_segments(gaps, curves.jump_thresholds(gaps, blocks), blocks)
        return segmented.select("point_id", "segment_id", "distance_to_next")

    same_in_blocks(make, 9)


def test_trajectory_without_gap_has_one_segment(walk):
    gaps = segments.gap_distances(walk, None)
    segmented = segments.with_segments(gaps, curves.jump_thresholds(gaps, None), None)
    assert rows(segmented.where("traj_id = 0").select("segment_id")) == [(0,)]


def test_thresholds_and_removal(walk):
    def make(blocks):
        gaps = segments.gap_distances(walk, blocks)
        segmented = segments.with_segments(gaps, 500.0, blocks)
        context = segments.segment_context(segments.segment_means(segmented), blocks)
        limits = curves.same_place_thresholds(context, blocks, rate=0.5)
        jumps = segments.jump_segments(context, limits, blocks)
        return segments.remove_jumps(walk, jumps).select("point_id")

    same_in_blocks(make, 5)
    assert make(None).count() < walk.count()


def test_curve_quantiles_and_knee(walk):
    gaps = segments.gap_distances(walk, None).cache()
    curve = curves.curve(gaps, "distance_to_next")
    same_in_blocks(lambda b: curves.indexed_curve(curve, b), 13)
    same_in_blocks(lambda b: curves.knee(curve, "knee", True, b), 13)
    same_in_blocks(lambda b: curves.knee(curve, "knee", False, b), 13)
    same_in_blocks(lambda b: curves.gap_summary(gaps, b).select("traj_id", "q25_gap", "q50_gap", "q75_gap"), 13)


def test_connectors_and_attach(walk):
    def make(blocks):
        segmented = segments.with_segments(walk, 500.0, blocks)
        return segments.segment_connectors(segments.segment_head_tail(segmented), blocks)

    same_in_blocks(make, 3)
    per_trajectory = walk.groupBy("traj_id").agg(F.max("point_id").alias("top"))
    same_in_blocks(lambda b: attach(walk, per_trajectory, b).select("point_id", "top"), 17)


def test_unfold_long_ranges(spark):
    ranges = spark.createDataFrame([("a", 0, 2), ("b", 5, 5), ("c", 3, 30)], "name string, first long, last long")
    got = rows(unfold(ranges, "first", "last", "i", rows=10))
    assert got == sorted([("a", i) for i in range(3)] + [("b", 5)] + [("c", i) for i in range(3, 31)], key=str)


@pytest.mark.parametrize("k, blocks", [(1, None), (4, None), (4, 6)])
def test_temporal_k_distance_matches_all_pairs(walk, k, blocks):
    got = {r.point_id: r.k_distance for r in curves.temporal_k_distances(walk.withColumn("k", F.lit(k)), k, blocks).collect()}
    times = {}
    for r in walk.collect():
        times.setdefault(r.traj_id, []).append((r.point_id, round(r.timestamp.timestamp() * 1e6)))
    for points in times.values():
        for point_id, t in points:
            gaps = sorted(abs(t - u) // 1_000_000 for _, u in points)
            assert got[point_id] == (gaps[k] if len(gaps) > k else None)
