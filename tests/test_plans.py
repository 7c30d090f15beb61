"""Physical plans that must hold at scale."""

import pytest

from wayfold.catalog.queries import QUERIES
from wayfold.operators import segments
from wayfold.sources import derived


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name", ["distance_to_next", "temporal_k_distance", "spatial_k_distance", "st_neighbors", "visible_counts"]
)
def test_no_cross_join_and_no_row_by_row_python(spark, folder, name):
    plan = _plan(QUERIES[name](spark, folder))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "PythonUDF"):
        assert word not in plan


def test_gap_distance_needs_one_shuffle_and_three_columns(spark, folder):
    points, blocks = derived.positions(spark, folder)
    assert blocks is None
    plan = _plan(segments.distance_to_next(points, blocks).select("traj_id", "distance_to_next"))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>" in plan


def test_long_trajectories_are_windowed_by_block(spark, folder):
    points, blocks = derived.positions(spark, folder, limit=20)
    assert blocks == 20
    plan = _plan(segments.distance_to_next(points.where("traj_id >= 0"), blocks))
    assert "_block" in plan
