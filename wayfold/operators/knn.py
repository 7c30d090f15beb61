"""Distance to the k-th nearest point of the same trajectory, exactly.

1. Equal coordinates become one weighted place; a place with more than k copies is
   settled at distance 0.
2. Places are sorted along a Z-order curve. Among the k places before and after a
   place there are k other places, so the k-th smallest of these distances bounds
   the answer from above. Every point gets its own, local search radius.
3. Each place looks up the grid level whose cells are just larger than its radius, in
   the few cells that its radius touches. Other places are entered at the levels
   in use in their trajectory.
4. A place whose radius touches a crowded cell, such as a lone fix far from a long stay, goes down a
   pyramid of counts: its cells are replaced by their children, level by level. The children's boxes and counts
   give a new bound, the distance within which k + 1 rows lie for sure, and what is farther away goes. What is
   left in the end are a few cells of few rows.
5. What lies in the cells that are left is measured.

A place is a candidate of the places in nearby sparse cells only, so pairs grow
with the number of places, not with its square.

Short trajectories need steps 1 and 5 only: each place meets the others of its trajectory twice. The least squares of
some groups of them bound its radius, and what lies within is measured.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import EARTH_RADIUS_M, SLACK_M, haversine, xyz
from ..session import saved, shuffled
from .cells import SHORT_ROWS
from .ordered import BLOCK_ROWS, home_rows, neighbouring_rows, ranked, running_sum, split_short

_BITS = 42  # of one grid coordinate; the finest cells are about 3 micrometres wide
_UNIT_M = 2 * EARTH_RADIUS_M / (1 << _BITS)
_AXES = ("x", "y", "z")
# A grid cell with more places is crowded; places that touch one go down the pyramid,
CELL_ROWS = 2048
# to cells of so many places, so many levels at a time.
LEAF_ROWS, _STEP = 64, 3


def spatial_k_distances(
    df: DataFrame,
    max_k: int,
    block_rows: int | None = BLOCK_ROWS,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """(traj_id, latitude, longitude, copies, k_distance), one row per distinct place.

    `df` has a column `k` <= `max_k`, the same on all rows of a trajectory.
    `k_distance` is null where a trajectory has no k other points.
    """
    if max_k < 1:
        raise ValueError("k must be at least 1")
    short, df = split_short(df, min(SHORT_ROWS, cell_rows), "latitude", "longitude")
    places = saved(_short_places(short))
    found = _settled(places).unionByName(_search_short(_open(places), places, max_k))
    if df is None:
        return found
    places = saved(_places(df, max_k, block_rows))
    measured = _search(_open(places), places, max_k, cell_rows)
    return found.unionByName(_settled(places)).unionByName(measured)


_FOUND = ("traj_id", "latitude", "longitude", "copies", "k_distance")


def _settled(places: DataFrame) -> DataFrame:
    settled = places.where((F.col("copies") > F.col("k")) | (F.col("n") <= F.col("k")))
    return settled.withColumn("k_distance", F.when(F.col("copies") > F.col("k"), F.lit(0.0))).select(*_FOUND)


def _open(places: DataFrame) -> DataFrame:
    return places.where((F.col("copies") <= F.col("k")) & (F.col("n") > F.col("k")))


def per_point(df: DataFrame, places: DataFrame) -> DataFrame:
    """Gives every point the `k_distance` of its place."""
    found = places.select("traj_id", "latitude", "longitude", "k_distance")
    return df.join(shuffled(found), ["traj_id", "latitude", "longitude"])


def _counted(df: DataFrame) -> DataFrame:
    """Distinct places with their copies and earth-centred coordinates."""
    return (
        df.groupBy("traj_id", "latitude", "longitude")
        .agg(F.count(F.lit(1)).alias("copies"), F.max("k").cast("int").alias("k"))
        .withColumns(dict(zip(_AXES, xyz(F.col("latitude"), F.col("longitude")))))
    )


def _short_places(df: DataFrame) -> DataFrame:
    """Distinct places of short trajectories, each trajectory in one task."""
    counted = _counted(df.select("traj_id", "latitude", "longitude", "k").repartition("traj_id"))
    return counted.withColumn("n", F.sum("copies").over(Window.partitionBy("traj_id")))


def _search_short(open_places: DataFrame, places: DataFrame, max_k: int) -> DataFrame:
    """The k-distances of places that can meet all others of their trajectory."""
    groups = 2 * (max_k + 1)
    group = F.pmod(F.xxhash64("latitude", "longitude"), F.lit(groups)).alias("group")
    others = shuffled(places.select("traj_id", _candidate(), group))
    probe = open_places.select(*_ME, "copies", "k", *_AXES)
    square = _square(F.col("q.x"), F.col("q.y"), F.col("q.z"))
    # k + 1 groups whose least is within a radius hold k + 1 rows within it.
    least = F.array_sort(F.array(*(F.min(F.when(F.col("group") == g, square)) for g in range(groups))))
    bounded = probe.join(others, "traj_id").groupBy(*probe.columns).agg(least.alias("least"))
    bounded = bounded.withColumn("radius", _radius(F.get("least", F.col("k")))).drop("least")
    inside = bounded.join(others, "traj_id").where(square <= F.col("radius") * F.col("radius"))
    return _nearest(inside, max_k, _ME).select(*_FOUND)


_ME = ("traj_id", "latitude", "longitude")


def _radius(square: Column) -> Column:
    """The radius that a squared distance, null if unknown, allows for.

    Without k other places, or with a bound near the far side of the earth, where straight lines tell arcs apart
    badly, everything is looked at.
    """
    bound = F.sqrt(square) * (1 + 1e-9) + SLACK_M
    return F.when(bound < 1.9 * EARTH_RADIUS_M, bound).otherwise(F.lit(3 * EARTH_RADIUS_M))


def _places(df: DataFrame, max_k: int, block_rows: int | None) -> DataFrame:
    """Distinct places with their copies, grid coordinates and search radius."""
    grid = {f"i{a}": F.floor((F.col(a) + EARTH_RADIUS_M) / _UNIT_M) for a in _AXES}
    counted = _counted(df).withColumns(grid)
    low_bits = (1 << (_BITS // 2)) - 1
    high, low = (
        _interleave(*(half(F.col(f"i{a}")) for a in _AXES))
        for half in (lambda c: F.shiftright(c, _BITS // 2), lambda c: c.bitwiseAND(F.lit(low_bits)))
    )
    placed = ranked(
        counted.withColumns({"_high": high, "_low": low}),
        ["traj_id"],
        [F.col(c) for c in ("_high", "_low", "latitude", "longitude")],
        "place",
        block_rows,
        {"n": ("sum", F.col("copies"))},
    ).drop("_high", "_low")

    near, along = neighbouring_rows(placed, max_k, block_rows, "place")
    around = F.collect_list(F.struct(*_AXES)).over(along.rowsBetween(-max_k, max_k))
    squares = F.array_sort(F.transform(F.col("_around"), lambda q: _square(q.x, q.y, q.z)))
    radius = _radius(F.get(squares, F.col("k")))
    bounded = near.withColumn("_around", around).withColumn("radius", radius).drop("_around")
    # Every second level is enough, and halves what each place is entered at.
    level = 2 * F.greatest(F.lit(0), F.ceil((F.log2(F.col("radius") / _UNIT_M) + 1e-9) / 2)).cast("int")
    searching = (F.col("copies") <= F.col("k")) & (F.col("n") > F.col("k"))
    leveled = home_rows(bounded, block_rows, "place").withColumn("level", F.when(searching, level))
    return _with_levels(leveled, block_rows)


def _with_levels(places: DataFrame, block_rows: int | None) -> DataFrame:
    """Adds `levels`: the grid levels in use in the trajectory, one bit each."""
    bit = F.coalesce(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("level")), F.lit(0))
    return running_sum(
        places,
        ["traj_id"],
        [F.col("place")],
        F.lit(0),
        "_",
        block_rows,
        {"levels": ("bit_or", bit)},
    ).drop("_")


def _square(x: Column, y: Column, z: Column) -> Column:
    dx, dy, dz = x - F.col("x"), y - F.col("y"), z - F.col("z")
    return dx * dx + dy * dy + dz * dz


def _interleave(x: Column, y: Column, z: Column) -> Column:
    """Bits of three 21-bit numbers, taken in turn (Z-order)."""

    def spread(c: Column) -> Column:
        # Shifts and masks that put two zero bits after each bit.
        for shift, mask in (
            (32, 0x1F00000000FFFF),
            (16, 0x1F0000FF0000FF),
            (8, 0x100F00F00F00F00F),
            (4, 0x10C30C30C30C30C3),
            (2, 0x1249249249249249),
        ):
            c = c.bitwiseOR(F.shiftleft(c, shift)).bitwiseAND(F.lit(mask))
        return c

    return spread(x).bitwiseOR(F.shiftleft(spread(y), 1)).bitwiseOR(F.shiftleft(spread(z), 2))


def _candidate() -> Column:
    return F.struct("latitude", "longitude", "copies", *_AXES).alias("q")


def _cell(level: Column, *names: str) -> dict[str, Column]:
    """Coordinates of a place's cell at a level."""
    return {n: F.call_function("shiftright", F.col(f"i{a}"), level) for n, a in zip(names, _AXES)}


def _candidates(open_places: DataFrame, places: DataFrame, cell_rows: int) -> DataFrame:
    """Places to search for, each with the places `q` among which its nearest are."""
    cell = ["traj_id", "level", "cx", "cy", "cz"]
    probe = open_places.select("traj_id", "place", "latitude", "longitude", "copies", "k", *_AXES, "radius", "level")
    for axis in _AXES:
        first, last = (
            F.call_function(
                "shiftright",
                F.floor((F.col(axis) + sign * F.col("radius") + EARTH_RADIUS_M) / _UNIT_M),
                F.col("level"),
            )
            for sign in (-1, 1)
        )
        probe = probe.withColumn(f"c{axis}", F.explode(F.sequence(first, last)))

    # Cells that do not touch the sphere hold no places.
    side = F.pow(F.lit(2.0), F.col("level")) * _UNIT_M
    middle = ((F.col(f"c{a}") + 0.5) * side - EARTH_RADIUS_M for a in _AXES)
    off_sphere = F.abs(F.sqrt(sum(m * m for m in middle)) - EARTH_RADIUS_M) > side * 0.9 + 1.0
    probe = probe.where(~off_sphere)

    in_use = F.filter(
        F.sequence(F.lit(0), F.lit(_BITS + 3)),
        lambda l: F.call_function("shiftright", F.col("levels"), l).bitwiseAND(F.lit(1)) == 1,
    )
    every = places.where(F.col("levels") != 0).withColumn("level", F.explode(in_use))
    entered = every.withColumns(_cell(F.col("level"), "cx", "cy", "cz"))
    crowded = entered.groupBy(*cell).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > cell_rows)
    # At most one row per `cell_rows` entered places.
    crowded = saved(crowded.select(*cell))
    met = probe.join(shuffled(entered.select(*cell, _candidate())), cell)
    if not crowded.take(1):
        return met
    heavy = saved(probe.join(crowded, cell, "left_semi").select("traj_id", "place").distinct())
    light = probe.join(heavy, ["traj_id", "place"], "left_anti").join(shuffled(entered.select(*cell, _candidate())), cell)
    heavy = probe.join(heavy, ["traj_id", "place"], "left_semi")
    return light.select(*_PLACE, "q").unionByName(_descended(heavy, every, min(LEAF_ROWS, cell_rows)))


_PLACE = ("traj_id", "place", "latitude", "longitude", "copies", "k", *_AXES, "radius")
_CELL = ("base", "depth", "level", "cx", "cy", "cz")
_BOX = tuple(f"{end}_{axis}" for axis in _AXES for end in ("min", "max"))


def _descended(probe: DataFrame, every: DataFrame, leaf_rows: int) -> DataFrame:
    """The candidates of places that touch crowded cells.

    `every` holds each place once for each level in use in its trajectory; a search goes down from its own
    level, `base`, _STEP levels at a time.
    """
    at = ["traj_id", *_CELL]
    every = every.withColumnRenamed("level", "base")

    def inside(cells: DataFrame, depth: int) -> DataFrame:
        """Places in some cells of one depth."""
        level = F.greatest(F.lit(0), F.col("base") - _STEP * depth)
        rows = every.withColumns({"depth": F.lit(depth), "level": level})
        rows = rows.withColumns(_cell(F.col("level"), "cx", "cy", "cz"))
        return rows.join(cells.select(*at).distinct(), at, "left_semi")

    def counted(rows: DataFrame, *by: str) -> DataFrame:
        box = (f(a).alias(f"{n}_{a}") for a in _AXES for n, f in (("min", F.min), ("max", F.max)))
        return rows.groupBy(*at, *by).agg(F.count(F.lit(1)).alias("rows"), F.sum("copies").alias("weight"), *box)

    first = probe.withColumns({"base": F.col("level"), "depth": F.lit(0)})
    front = saved(_bounded(first.join(shuffled(counted(inside(first, 0))), at)))
    depth, above = 0, {f"above_{c}": F.col(c) for c in ("cx", "cy", "cz")}
    while True:
        split = (F.col("depth") == depth) & (F.col("rows") > leaf_rows) & (F.col("level") > 0)
        parents = front.where(split)
        if not parents.take(1):
            break
        depth += 1
        lower = inside(parents, depth - 1).withColumns(above).withColumn("depth", F.lit(depth))
        lower = lower.withColumn("level", F.greatest(F.lit(0), F.col("base") - _STEP * depth))
        children = counted(lower.withColumns(_cell(F.col("level"), "cx", "cy", "cz")), *above)
        down = parents.select(*_PLACE, "base", *(c.alias(n) for n, c in above.items()))
        down = down.join(shuffled(children), ["traj_id", "base", *above]).drop(*above)
        front = saved(_bounded(front.where(~split).unionByName(down)))
    found = []
    for d in range(depth + 1):
        cells = front.where(F.col("depth") == d)
        found.append(cells.join(shuffled(inside(cells, d).select(*at, _candidate())), at).select(*_PLACE, "q"))
    return reduce(DataFrame.unionByName, found)


def _bounded(front: DataFrame) -> DataFrame:
    """Lowers each place's radius to where its cells hold k + 1 rows for sure, and drops cells beyond it."""

    def squares(of) -> Column:
        away = (of(F.col(f"min_{a}") - F.col(a), F.col(a) - F.col(f"max_{a}"), a) for a in _AXES)
        return sum(d * d for d in away)

    nearest = squares(lambda low, high, a: F.greatest(F.lit(0.0), low, high))
    farthest = squares(lambda low, high, a: F.greatest(F.col(f"max_{a}") - F.col(a), F.col(a) - F.col(f"min_{a}")))
    one = Window.partitionBy("traj_id", "place")
    reached = F.sum("weight").over(one.orderBy("_far").rowsBetween(Window.unboundedPreceding, 0))
    surely = F.min(F.when(F.col("_reached") > F.col("k"), F.col("_far"))).over(one)
    bound = F.sqrt(F.col("_surely")) * (1 + 1e-9) + SLACK_M
    lower = F.when(bound < 1.9 * EARTH_RADIUS_M, F.least("radius", bound)).otherwise(F.col("radius"))
    return (
        front.withColumn("_far", farthest)
        .withColumn("_reached", reached)
        .withColumn("_surely", surely)
        .withColumn("radius", lower)
        .where(nearest <= F.col("radius") * F.col("radius"))
        .select(*_PLACE, *_CELL, "rows", "weight", *_BOX)
    )


def _search(open_places: DataFrame, places: DataFrame, max_k: int, cell_rows: int) -> DataFrame:
    inside = _candidates(open_places, places, cell_rows).where(
        _square(F.col("q.x"), F.col("q.y"), F.col("q.z")) <= F.col("radius") * F.col("radius")
    )
    return _nearest(inside, max_k, ("traj_id", "place")).select(*_FOUND)


def _nearest(inside: DataFrame, max_k: int, me: tuple[str, ...]) -> DataFrame:
    """Places, told apart by `me`, with the distance within which their candidates `q` hold k + 1 rows."""
    kept = [c for c in ("latitude", "longitude", "copies") if c not in me]
    distance = haversine(F.col("latitude"), F.col("longitude"), F.col("q.latitude"), F.col("q.longitude"))
    by_distance = Window.partitionBy(*me).orderBy("distance")
    nearest = (
        inside.select(*me, *kept, "k", distance.alias("distance"), F.col("q.copies").alias("w"))
        .withColumn("_nth", F.row_number().over(by_distance))
        .where(F.col("_nth") <= max_k + 1)
    )
    reached = F.sum("w").over(by_distance.rowsBetween(Window.unboundedPreceding, 0))
    return (
        nearest.withColumn("_reached", reached)
        .groupBy(*me)
        .agg(
            *(F.first(c).alias(c) for c in kept),
            F.min(F.when(F.col("_reached") > F.col("k"), F.col("distance"))).alias("k_distance"),
        )
    )
