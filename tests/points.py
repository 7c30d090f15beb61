"""Small point sets, and slow plain-Python statements of what operators compute."""

from __future__ import annotations

import math
from datetime import datetime, timedelta, timezone

BASE = datetime(2026, 8, 11, tzinfo=timezone.utc)
SCHEMA = "traj_id long, ord long, point_id long, latitude double, longitude double, timestamp timestamp"
METRE = 180 / (math.pi * 6_371_000.0)  # degrees of latitude


def frame(spark, trajectories: dict[int, list[tuple[float, float, float]]]):
    """{traj_id: [(latitude, longitude, second), ...]} in order."""
    rows = [
        (traj, i + 1, traj * 100_000 + i, float(lat), float(lon), BASE + timedelta(microseconds=round(s * 1e6)))
        for traj, points in trajectories.items()
        for i, (lat, lon, s) in enumerate(points)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def metres(p, q) -> float:
    lat1, lon1, lat2, lon2 = map(math.radians, (p[0], p[1], q[0], q[1]))
    u, v = math.sin((lat2 - lat1) / 2), math.sin((lon2 - lon1) / 2)
    a = u * u + math.cos(lat1) * math.cos(lat2) * (v * v)
    return 6_371_000.0 * (2 * math.atan2(math.sqrt(a), math.sqrt(1 - a)))


def seconds(p, q) -> int:
    return abs(round(p[2] * 1e6) - round(q[2] * 1e6)) // 1_000_000


def neighbours(points, eps_space, eps_time):
    return [
        [j for j, q in enumerate(points) if metres(p, q) <= eps_space and seconds(p, q) <= eps_time] for p in points
    ]


def labels(points, eps_space, eps_time, min_pts):
    """Clusters grown one after the other, point by point."""
    near = neighbours(points, eps_space, eps_time)
    label: list[int | None] = [None] * len(points)
    clusters = 0
    for start, around in enumerate(near):
        if label[start] is not None:
            continue
        if len(around) < min_pts:
            label[start] = 0
            continue
        clusters += 1
        stack = list(around)
        for i in around:
            label[i] = clusters
        while stack:
            reached = near[stack.pop()]
            if len(reached) >= min_pts:
                stack += [i for i in reached if label[i] is None]
                for i in reached:
                    label[i] = label[i] or clusters
    return label
