"""Neighbours, k-nearest distances and clusters against plain restatements."""

import math
import random

import pytest
from pyspark.sql import functions as F

from points import BASE, METRE, frame, labels, metres, neighbours
from wayfold.operators.cells import neighbour_counts, with_search_limits
from wayfold.operators.cluster import core_points, st_dbscan
from wayfold.operators.components import connected_components
from wayfold.operators.curves import curve, knee, nearest_quantiles
from wayfold.operators import cells, cluster, curves, knn
from wayfold.operators.knn import per_point, spatial_k_distances

PLACES = [(37.5, 127.0), (0.0, 179.9999), (89.9995, 10.0), (-45.0, -179.9997)]
EPS_SPACE, EPS_TIME = 80.0, 30


def _scattered(rnd, n):
    lat, lon = rnd.choice(PLACES)
    spread, points, second = rnd.choice([0.0005, 0.002, 0.005]), [], 0.0
    for _ in range(n):
        second += rnd.uniform(0, 20)
        at = (min(90.0, lat + rnd.gauss(0, spread)), (lon + rnd.gauss(0, spread) + 180) % 360 - 180)
        points.append((*(points[-1][:2] if points and rnd.random() < 0.1 else at), round(second, 6)))
    return points


def _crowded(rnd, n):
    """Blobs about as far apart as eps_space: dense cells that touch or just do not."""
    points, second = [], 0.0
    for _ in range(n):
        second += rnd.uniform(0, 0.4)
        lat = 37.5 + rnd.choice([0, 1, 1, 2]) * rnd.choice([0.00085, 0.0009, 0.00078]) + rnd.gauss(0, 3e-5)
        at = (lat, 127 + rnd.gauss(0, 3e-5))
        points.append((*(rnd.choice(points)[:2] if points and rnd.random() < 0.3 else at), round(second, 6)))
    return points


@pytest.fixture(scope="module")
def sets():
    rnd = random.Random(5)
    sparse = {i: _scattered(rnd, rnd.choice([1, 2, 5, 20, 40])) for i in range(150)}
    return sparse | {1000 + i: _crowded(rnd, rnd.choice([120, 200])) for i in range(10)}


@pytest.fixture(scope="module")
def limits(sets):
    rnd = random.Random(6)
    return {traj: rnd.choice([1, 2, 3, 4, 6]) if traj < 1000 else rnd.choice([3, 5, 8]) for traj in sets}


@pytest.fixture(scope="module")
def limited(spark, sets, limits):
    parameters = spark.createDataFrame(
        [(t, EPS_SPACE, float(EPS_TIME), m) for t, m in limits.items()], "traj_id long, s double, t double, m long"
    )
    return with_search_limits(frame(spark, sets), "s", "t", "m", parameters, None).cache()


# Parts and leaves so small that crowded cells are split and halved, and as they are by default.
SIZES = [{}, {"cell_rows": 7, "leaf_rows": 2}]


@pytest.mark.parametrize("sizes", SIZES)
def test_clusters(limited, sets, limits, sizes):
    got = {(r.traj_id, r.ord): r.cluster_id for r in st_dbscan(limited, None, **sizes).collect()}
    want = {
        (traj, i + 1): label
        for traj, points in sets.items()
        for i, label in enumerate(labels(points, EPS_SPACE, EPS_TIME, limits[traj]))
    }
    assert got == want


def test_clusters_do_not_depend_on_row_order(limited, sets):
    some = limited.where("traj_id % 10 = 0")
    first = {(r.traj_id, r.ord): r.cluster_id for r in st_dbscan(some, None).collect()}
    mixed = some.orderBy(F.rand(3)).repartition(3)
    assert {(r.traj_id, r.ord): r.cluster_id for r in st_dbscan(mixed, 50).collect()} == first


@pytest.mark.parametrize("sizes", SIZES)
def test_neighbour_counts_and_core_points(limited, sets, limits, sizes):
    want = {
        (traj, i + 1): len(near)
        for traj, points in sets.items()
        for i, near in enumerate(neighbours(points, EPS_SPACE, EPS_TIME))
    }
    assert {(r.traj_id, r.ord): r.neighbours for r in neighbour_counts(limited, **sizes).collect()} == want
    core = {key for key, n in want.items() if n >= limits[key[0]]}
    assert {(r.traj_id, r.ord) for r in core_points(limited, **sizes).collect()} == core


def _meridian(*offsets):
    return [(37 + m * METRE, 127.0, 0.0) for m in offsets]


_P, _Q = (37.0, 127.0, 0.0), (37.0 + 30 * METRE, 127.0, 10.9)
_APART = metres(_P, _Q)
# name -> points, eps_space, eps_time, min_pts, labels
CASES = {
    "border goes to the later seed next to it": (
        _meridian(0, 0, 0, 0, 50, 140, 230, 280, 280, 280, 280), 100, 10, 5, [1] * 5 + [2] + [2] * 5
    ),
    "border stays if the later seed is far": (
        _meridian(0, 0, 0, 0, 50, 140, 280, 230, 280, 280, 280), 100, 10, 5, [1] * 5 + [1] + [2] * 5
    ),
    "distance inclusive, seconds truncated": ([_P, _Q], _APART, 10, 2, [1, 1]),
    "a hair too far": ([_P, _Q], math.nextafter(_APART, 0), 10, 2, [0, 0]),
    "a second too late": ([_P, (*_Q[:2], 11.0)], _APART, 10, 2, [0, 0]),
    "across 180 degrees": ([(0, 179.9999, 0), (0, -179.9999, 1)], 30, 5, 2, [1, 1]),
    "across the pole": ([(89.9999, 0, 0), (89.9999, 180, 1)], 30, 5, 2, [1, 1]),
    "equal points, tiny distance": ([(1, 1, 0), (1, 1, 0), (1, 1.1, 0)], 1e-9, 5, 2, [1, 1, 0]),
    "the whole earth": ([(0, 0, 0), (0, 180, 0), (45, 90, 0)], 3e7, 5, 3, [1, 1, 1]),
}


def test_hand_cases(spark):
    parameters = spark.createDataFrame(
        [(i, float(s), float(t), m) for i, (_, s, t, m, _) in enumerate(CASES.values())],
        "traj_id long, s double, t double, m long",
    )
    df = frame(spark, {i: case[0] for i, case in enumerate(CASES.values())})
    clustered = st_dbscan(with_search_limits(df, "s", "t", "m", parameters, None), None).orderBy("ord").collect()
    got = {name: [r.cluster_id for r in clustered if r.traj_id == i] for i, name in enumerate(CASES)}
    assert got == {name: case[4] for name, case in CASES.items()}


@pytest.mark.parametrize("eps_space, eps_time, min_pts", [(0, 1, 1), (1, 0, 1), (1, 1, 0)])
def test_limits_are_checked(limited, eps_space, eps_time, min_pts):
    with pytest.raises(ValueError):
        with_search_limits(limited, eps_space, eps_time, min_pts)


@pytest.mark.parametrize("group_links", [1000, 2])
def test_components_of_a_long_chain(spark, group_links):
    edges = [(1, i, i + 1) for i in range(200)] + [(2, 5, 3), (2, 7, 5), (2, 9, 8), (2, 4, 4)]
    got = connected_components(spark.createDataFrame(edges, "traj_id long, u long, v long"), group_links)
    want = {(1, i): 0 for i in range(201)} | {(2, 3): 3, (2, 5): 3, (2, 7): 3, (2, 8): 8, (2, 9): 8}
    assert {(r.traj_id, r.node): r.root for r in got.collect()} == want


@pytest.mark.parametrize("square", [4, 50, 10**6])
def test_components_of_hubs_and_paths(spark, square):
    """A hub, larger or smaller than its neighbours, a long path, a path in mixed order, and repeated links."""
    rnd = random.Random(4)
    mixed = list(range(1000, 1120))
    rnd.shuffle(mixed)
    edges = [(1, 500, i) for i in range(400)] + [(1, 900, 901), (2, 0, 700), (2, 700, 0)]
    edges += [(2, i, i + 1) for i in range(200)] + [(3, 0, i) for i in range(1, 300)] + [(3, a, b) for a, b in zip(mixed, mixed[1:])]
    got = connected_components(spark.createDataFrame(edges, "traj_id long, u long, v long"), square)
    want = {(1, i): 0 for i in [*range(400), 500]} | {(1, 900): 900, (1, 901): 900} | {(2, i): 0 for i in [*range(201), 700]}
    want |= {(3, i): 0 for i in range(300)} | {(3, i): 1000 for i in mixed}
    assert {(r.traj_id, r.node): r.root for r in got.collect()} == want
    assert got.count() == len(want)


def test_components_of_nothing(spark):
    none = spark.createDataFrame([(1, 5, 5)], "traj_id long, u long, v long")
    assert connected_components(none).count() == 0


@pytest.mark.parametrize("blocks, cell_rows", [(None, 200_000), (25, 3)])
def test_spatial_k_distances(spark, blocks, cell_rows):
    rnd = random.Random(3)
    trajectories, ks = {}, {}
    for traj in range(25):
        n, place, points = rnd.choice([2, 5, 30, 150]), rnd.choice(PLACES), []
        for i in range(n):
            s = rnd.choice([1e-7, 1e-5, 1e-3, 0.1, 5])
            at = (max(-90.0, min(90.0, place[0] + rnd.gauss(0, s))), (place[1] + rnd.gauss(0, s) + 180) % 360 - 180)
            points.append((*(points[-1][:2] if points and rnd.random() < 0.25 else at), float(i)))
        trajectories[traj], ks[traj] = points, rnd.choice([1, 3, 6])
    df = frame(spark, trajectories)
    ruled = df.join(spark.createDataFrame(list(ks.items()), "traj_id long, k int"), "traj_id")
    found = per_point(ruled, spatial_k_distances(ruled, 6, blocks, cell_rows))
    got = {(r.traj_id, r.ord): r.k_distance for r in found.collect()}
    assert len(got) == df.count()
    for traj, points in trajectories.items():
        for i, p in enumerate(points):
            away = sorted(metres(p, q) for q in points)
            if len(away) <= ks[traj]:
                assert got[traj, i + 1] is None
            else:
                assert got[traj, i + 1] == pytest.approx(away[ks[traj]], abs=1e-6)


def test_lone_fixes_meet_few_places(spark):
    """One place in twenty lies far from a long stay: the most candidates do not follow the number of places."""
    most = []
    for n in (600, 4800):
        rnd = random.Random(9)
        near = [(37.5 + 0.002 * rnd.gauss(0, 1), 127 + 0.002 * rnd.gauss(0, 1)) for _ in range(n - n // 20)]
        lone = [(rnd.uniform(30, 45), rnd.uniform(120, 135)) for _ in range(n // 20)]
        points = near + lone
        df = spark.createDataFrame([(1, *p, 3) for p in points], "traj_id long, latitude double, longitude double, k int")
        places = knn.saved(knn._places(df, 3, None))
        found = knn.saved(knn._candidates(places, places, 64))
        most.append(found.groupBy("place").count().agg({"count": "max"}).first()[0])
        got = {(r.latitude, r.longitude): r.k_distance for r in knn.spatial_k_distances(df, 3, None, 64).collect()}
        for p in lone[:10] + near[:10]:
            assert got[p] == pytest.approx(sorted(metres(p, q) for q in points)[3], abs=1e-6)
    # Eight times the places.
    assert most[1] <= 3 * most[0] and most[1] < 1000


def test_a_sparse_cell_beside_a_crowded_one_is_asked_in_parts(spark):
    """Many points ask for a cell of two: its copies get no more than a part's points each, with the same counts."""
    rnd = random.Random(8)
    crowd = [(37 + rnd.uniform(0, 18) * METRE, 127.0, float(i % 50)) for i in range(400)]
    points = [*crowd, (37 + 45 * METRE, 127.0, 3.0), (37 + 46 * METRE, 127.0, 4.0)]
    df = with_search_limits(frame(spark, {1: points}), 40.0, 100.0, 500)
    index = cells.CellIndex(cells.saved(df), 50, 10)
    pairs = cells.saved(cells.both_ways(index.adjacent()).where("not all_near"))
    probes, hot = index._probes(pairs)
    assert hot is not None
    asked = probes.groupBy("traj_id", "no_b", "salt").count()
    assert probes.groupBy("traj_id", "no_b").count().agg({"count": "max"}).first()[0] > 4 * 50
    assert asked.agg({"count": "max"}).first()[0] <= 2 * 50
    want = [len(n) for n in neighbours(points, 40.0, 100.0)]
    got = {r.ord: r.neighbours for r in neighbour_counts(df, 50, 10).collect()}
    assert [got[i + 1] for i in range(len(points))] == want


def _values(spark, *values):
    return curve(spark.createDataFrame([(1, float(v)) for v in values], "traj_id long, v double"), "v")


def test_knee_edges(spark):
    assert knee(_values(spark, 5, 5, 5), block_rows=None).first().value == 5
    assert knee(_values(spark, 5), block_rows=None).first().value == 5
    assert knee(_values(spark, 9, 8, 7, 2, 1, 1, 1), block_rows=None).first().value == 2


def test_quantiles_by_buckets(spark, monkeypatch):
    """Heavy tails, copies, and values of any size, with slices of three values: the elements of a full sort."""
    monkeypatch.setattr(curves, "SLICE_ROWS", 3)
    rnd = random.Random(12)
    values = {t: [round(rnd.choice([1e-9, 1, 1e6, 1e12]) * rnd.random() ** 6, rnd.choice([0, 3, 12])) for _ in range(n)]
              for t, n in enumerate([1, 2, 7, 60, 400, 900])}
    values[9] = [-5.0, -5.0, 3.0, 1e15, -1e15, 0.0] * 5
    rows = [(t, v) for t, some in values.items() for v in some]
    quantiles = {"a": 0.0, "b": 0.05, "c": 0.25, "d": 0.5, "e": 0.993, "f": 1.0}
    frame_ = curve(spark.createDataFrame(rows, "traj_id long, v double"), "v")
    got = {r.traj_id: r for r in nearest_quantiles(frame_, quantiles).collect()}
    for t, some in values.items():
        want = [sorted(some)[math.floor((len(some) - 1) * q + 0.5)] for q in quantiles.values()]
        assert [got[t][n] for n in quantiles] == want
    assert nearest_quantiles(frame_.where("false"), quantiles).count() == 0


def test_nearest_quantile(spark):
    got = nearest_quantiles(_values(spark, *range(11)), {"q": 0.05, "m": 0.5}, None).first()
    assert (got.q, got.m) == (1, 5)


@pytest.mark.parametrize("short_rows", [0, 60, 256])
def test_short_trajectories_need_no_cells(spark, limited, sets, limits, monkeypatch, short_rows):
    """Labels and counts are the same by cells, by pairs of rows, and by both; short trajectories alone build no cells."""
    monkeypatch.setattr(cluster, "SHORT_ROWS", short_rows)
    monkeypatch.setattr(cells, "SHORT_ROWS", short_rows)
    some = [t for t in sets if t % 9 == 0 or t in (1001, 1002)]
    if short_rows == 256:
        monkeypatch.setattr(cluster, "_Density", None)
        monkeypatch.setattr(cells, "CellIndex", None)
    df = cells.saved(limited.where(F.col("traj_id").isin(some)))
    got = {(r.traj_id, r.ord): r.cluster_id for r in st_dbscan(df, None).collect()}
    counts = {(r.traj_id, r.ord): r.neighbours for r in neighbour_counts(df).collect()}
    for t in some:
        want = labels(sets[t], EPS_SPACE, EPS_TIME, limits[t])
        assert [got[t, i + 1] for i in range(len(want))] == want
        assert [counts[t, i + 1] for i in range(len(want))] == [len(n) for n in neighbours(sets[t], EPS_SPACE, EPS_TIME)]


def test_rows_without_time_or_trajectory_are_as_in_cells(spark, monkeypatch):
    rows = "traj_id long, ord long, timestamp timestamp, latitude double, longitude double"
    points = [(1, i + 1, None if i < 3 else BASE, 37.0, 127.0) for i in range(5)] + [(None, 1, BASE, 37.0, 127.0)]
    points += [(2, i + 1, BASE, 37.0, 127.0) for i in range(3)]
    df = cells.saved(with_search_limits(spark.createDataFrame(points, rows), 50.0, 10.0, 2))
    found = []
    for short_rows in (256, 0):
        monkeypatch.setattr(cluster, "SHORT_ROWS", short_rows)
        found.append(sorted(st_dbscan(df, None).select("traj_id", "ord", "cluster_id").collect(), key=str))
    assert found[0] == found[1] and len(found[0]) == len(points)


def test_cells_are_not_broadcast(spark, limited):
    """Cells and points grow with the input; files pack them, so that small files may hold much."""
    plan = cells.CellIndex(limited.where("traj_id < 3")).adjacent()._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_short_trajectories_need_no_grid(spark, monkeypatch):
    """k-distances of short trajectories come from their places alone: poles, the far side, copies, fewer places than k."""
    monkeypatch.setattr(knn, "_places", None)
    rnd = random.Random(14)
    sets = {t: [(rnd.uniform(-90, 90), rnd.uniform(-180, 180), 0.0) for _ in range(n)] for t, n in enumerate((1, 3, 5, 9, 60))}
    sets[5] = [(90.0, 0.0, 0.0), (90.0, 120.0, 0.0), (-90.0, 5.0, 0.0), (0.0, 180.0, 0.0), (0.0, -180.0, 0.0), (0.0, 0.0, 0.0)]
    sets[6] = [(1.0, 1.0, 0.0)] * 4 + [(1.0, 1.0 + i * 1e-7, 0.0) for i in range(1, 4)]
    for k in (1, 3, 5):
        df = frame(spark, sets).withColumn("k", F.lit(k))
        got = {(r.traj_id, r.latitude, r.longitude): r for r in spatial_k_distances(df, 5, None).collect()}
        for t, points in sets.items():
            for p in points:
                away = sorted(metres(p, q) for q in points)
                want = None if len(away) <= k else pytest.approx(away[k], abs=1e-6)
                assert got[t, p[0], p[1]].k_distance == want
                assert got[t, p[0], p[1]].copies == points.count(p)
