"""Grid cells in space and time, and the join of points through adjacent cells.

Points lie in earth-centred x/y/z, so there is no seam. A cell has half the side
of the search distance and one time bin, which makes all points of one cell
neighbours of each other; every neighbour of a point lies in a cell whose *pair of
cells* (side = search distance) is adjacent.

Counts of whole cells stand in for their points wherever the cells' bounding boxes
prove that all pairs, or none, are near enough. Only the rest is tested point by point.
"""

from __future__ import annotations

from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import EARTH_RADIUS_M, SLACK_M, chord, haversine, xyz
from ..functions.timeops import MICROS, whole_seconds
from ..session import saved, shuffled
from .ordered import BLOCK_ROWS, attach, split_short
from .validate import located, required

# The points of a trajectory of at most so many rows are compared with each other, without cells.
SHORT_ROWS = 256
# Points of one cell that one task takes before the cell is split.
CELL_ROWS = 200_000
# Points of one box that are tested one by one.
LEAF_ROWS = 256
# Below this distance a cell cannot promise that its points are neighbours, so
# it then holds equal coordinates only.
_SMALLEST_REACH_M = 1e-4

_AXES = ("x", "y", "z")
_BOX = [f"{end}_{axis}" for axis in (*_AXES, "t") for end in ("min", "max")]
_LIMITS = ("eps_space", "eps_time", "min_pts", "reach", "half", "span")


def with_search_limits(
    df: DataFrame,
    eps_space: float | str,
    eps_time: float | str,
    min_pts: int | str,
    parameters: DataFrame | None = None,
    block_rows: int | None = BLOCK_ROWS,
) -> DataFrame:
    """Adds `eps_space`, `eps_time`, `min_pts`: numbers, or columns of (traj_id, ...) rows."""
    given = {"eps_space": eps_space, "eps_time": eps_time, "min_pts": min_pts}
    if parameters is not None:
        wanted = parameters.select("traj_id", *(F.col(c).alias(n) for n, c in given.items()))
        limited = attach(located(df), wanted, block_rows)
        ok = (F.col("eps_space") > 0) & (F.col("eps_time") > 0) & (F.col("min_pts") >= 1)
        given_here = F.concat_ws(", ", *(F.col(n).cast("string") for n in given))
        return required(limited, ok, F.concat(F.lit("search limits are missing or too small: "), given_here))
    for name, value in given.items():
        if value < 1 if name == "min_pts" else value <= 0:
            raise ValueError(f"{name} is too small: {value}")
    return located(df).withColumns(
        {
            "eps_space": F.lit(float(eps_space)),
            "eps_time": F.lit(float(eps_time)),
            "min_pts": F.lit(int(min_pts)).cast("long"),
        }
    )


def in_cells(df: DataFrame) -> DataFrame:
    """Points with search limits -> the columns that the cell joins need."""
    x, y, z = xyz(F.col("latitude"), F.col("longitude"))
    reach = chord(F.col("eps_space"))
    located = df.select(
        "traj_id",
        "ord",
        F.unix_micros("timestamp").alias("t"),
        "latitude",
        "longitude",
        x.alias("x"),
        y.alias("y"),
        z.alias("z"),
        "eps_space",
        "eps_time",
        "min_pts",
        reach.alias("reach"),
        ((reach * (1 + 1e-9) + SLACK_M) / 2).alias("half"),
        ((F.floor("eps_time") + 1) * MICROS).alias("span"),
    )
    tiny = F.col("reach") < _SMALLEST_REACH_M
    cell = F.struct(
        *(F.floor(F.col(a) / F.col("half")).alias(f"h{a}") for a in _AXES),
        F.call_function("div", F.col("t") - F.pmod(F.col("t"), F.col("span")), F.col("span")).alias("bin"),
        F.when(tiny, F.col("latitude")).otherwise(0.0).alias("cell_lat"),
        F.when(tiny, F.col("longitude")).otherwise(0.0).alias("cell_lon"),
    )
    return located.withColumn("cell", cell)


def cell_table(points: DataFrame) -> DataFrame:
    """One row per cell: rows, bounding box, limits.

    `no`, the first `ord` in the cell, names it within its trajectory.
    """
    boxes = [f(a).alias(f"{n}_{a}") for a in (*_AXES, "t") for n, f in (("min", F.min), ("max", F.max))]
    return (
        points.groupBy("traj_id", "cell")
        .agg(
            F.min("ord").alias("no"),
            F.count(F.lit(1)).alias("rows"),
            *boxes,
            *(F.first(c).alias(c) for c in _LIMITS),
        )
        .withColumn("dense", F.col("rows") >= F.col("min_pts"))
    )


def extreme_points(points: DataFrame) -> DataFrame:
    """Per cell (traj_id, no): `corners`, its outermost point along each axis and in time."""
    point = F.struct("latitude", "longitude", "t")
    outermost = [f(point, a) for a in (*_AXES, "t") for f in (F.min_by, F.max_by)]
    return points.groupBy("traj_id", "no").agg(F.array(*outermost).alias("corners"))


def near_points(lat1, lon1, t1, lat2, lon2, t2, eps_space, eps_time) -> Column:
    """The exact test: arc and whole-second gap, both inclusive."""
    return (haversine(lat1, lon1, lat2, lon2) <= eps_space) & (whole_seconds(F.abs(t1 - t2)) <= eps_time)


def near_rows(short: DataFrame) -> DataFrame:
    """(traj_id, ord, other, min_pts): the neighbours of each row, itself included.

    For trajectories of few rows: each meets all others of its trajectory, in the task that holds it.
    """
    point = ("ord", "t", "latitude", "longitude")
    rows = short.withColumn("t", F.unix_micros("timestamp"))
    here = rows.select("traj_id", "eps_space", "eps_time", "min_pts", *(F.col(c).alias(f"p_{c}") for c in point))
    there = rows.select("traj_id", *(F.col(c).alias(f"q_{c}") for c in point))
    # What a comparison of numbers rules out needs no arc.
    close = F.radians(F.abs(F.col("p_latitude") - F.col("q_latitude"))) * EARTH_RADIUS_M
    close = close <= F.col("eps_space") * (1 + 1e-9) + SLACK_M
    close = close & (whole_seconds(F.abs(F.col("p_t") - F.col("q_t"))) <= F.col("eps_time"))
    ends = (F.col(f"{e}_{c}") for e in ("p", "q") for c in ("latitude", "longitude", "t"))
    near = near_points(*ends, F.col("eps_space"), F.col("eps_time"))
    found = here.join(shuffled(there), "traj_id").where(close & near)
    return found.select("traj_id", F.col("p_ord").alias("ord"), F.col("q_ord").alias("other"), "min_pts")


class CellIndex:
    """Points and their cells, saved, with crowded cells cut into parts."""

    def __init__(self, df: DataFrame, cell_rows: int = CELL_ROWS, leaf_rows: int = LEAF_ROWS) -> None:
        self._leaf_rows, self._cell_rows = leaf_rows, cell_rows
        located = in_cells(df)
        self.cells = saved(cell_table(located))
        # At most one row per `cell_rows` points, so broadcasting it is safe.
        crowded = self.cells.where(F.col("rows") > cell_rows).select(
            "traj_id", "cell", "no", F.ceil(F.col("rows") / F.lit(cell_rows)).cast("int").alias("_parts")
        )
        self._crowded = crowded if crowded.take(1) else None
        numbered = self.cells.select("traj_id", "cell", "no", "rows", "dense")
        self.points = saved(
            self._spread_points(located, "cell")
            .join(shuffled(self._spread_cells(numbered, "cell")), ["traj_id", "cell", "part"])
            .drop("part", "cell")
        )

    def _spread_points(self, points: DataFrame, cell: str = "no") -> DataFrame:
        """Adds `part`: which part of its cell a point belongs to."""
        if self._crowded is None:
            return points.withColumn("part", F.lit(0))
        wide = points.join(self._crowded.select("traj_id", cell, "_parts"), ["traj_id", cell], "left")
        part = F.pmod(F.xxhash64("ord"), F.coalesce("_parts", F.lit(1))).cast("int")
        return wide.withColumn("part", part).drop("_parts")

    def _spread_cells(self, df: DataFrame, cell: str = "no") -> DataFrame:
        """Repeats a row that stands for a cell once per part of that cell."""
        if self._crowded is None:
            return df.withColumn("part", F.lit(0))
        wide = df.join(self._crowded.select("traj_id", cell, "_parts"), ["traj_id", cell], "left")
        return wide.withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))).drop(
            "_parts"
        )

    def points_of(self, points: DataFrame, cells: DataFrame) -> DataFrame:
        """Joins rows per cell (traj_id, no, ...) to points (traj_id, no, ord, ...)."""
        found = self._spread_points(points).join(shuffled(self._spread_cells(cells)), ["traj_id", "no", "part"])
        return found.drop("part")

    def adjacent(self) -> DataFrame:
        """Each pair of cells `a`, `b` that may hold neighbours, once, never a cell with itself.

        `all_near` says that every pair of their points is near. A cell looks at 27
        coarse places and 3 time bins at most, each of which holds at most 8 cells,
        however many points these have.
        """
        places = {f"g{a}": F.shiftright(F.col(f"cell.h{a}"), 1) for a in _AXES}
        keys = ["bin", *places]
        placed = self.cells.withColumn("bin", F.col("cell.bin")).withColumns(places)
        # The steps to itself and to half of the places around: each pair is found once.
        # They are taken by places, not by cells, and carry nothing else along.
        steps = [s for s in product((0, 1), (-1, 0, 1), (-1, 0, 1), (-1, 0, 1)) if s >= (0, 0, 0, 0)]
        step = F.array(*(F.struct(*(F.lit(d).alias(k) for k, d in zip(keys, s))) for s in steps))
        walked = placed.select("traj_id", *keys, "half").distinct().withColumn("step", F.explode(step))
        walked = walked.withColumns({f"to_{k}": F.col(k) + F.col(f"step.{k}") for k in keys})
        # Places that do not touch the sphere hold no points.
        side = F.col("half") * 2
        middle = [(F.col(f"to_{g}") + 0.5) * side for g in places]
        on_sphere = F.abs(F.sqrt(sum(m * m for m in middle)) - EARTH_RADIUS_M) <= side * 0.9 + 1.0
        stays = reduce(lambda x, y: x & y, (F.col(f"step.{k}") == 0 for k in keys))
        walked = walked.where(on_sphere).select("traj_id", *keys, *(f"to_{k}" for k in keys), stays.alias("stays"))
        shared = ("no", "rows", "dense", *_BOX)
        there = placed.select("traj_id", *(F.col(k).alias(f"to_{k}") for k in keys), F.struct(*shared).alias("b"))
        found = walked.join(shuffled(there), ["traj_id", *(f"to_{k}" for k in keys)])
        found = found.select("traj_id", *keys, "stays", "b")
        here = placed.select(
            "traj_id", *keys, F.struct(*shared, *(c for c in _LIMITS if c != "min_pts")).alias("a")
        )
        pairs = found.join(shuffled(here), ["traj_id", *keys]).where(~F.col("stays") | (F.col("b.no") > F.col("a.no")))

        def apart(axis: str) -> Column:
            return F.greatest(
                F.lit(0),
                F.col(f"b.min_{axis}") - F.col(f"a.max_{axis}"),
                F.col(f"a.min_{axis}") - F.col(f"b.max_{axis}"),
            )

        def across(axis: str) -> Column:
            return F.greatest(
                F.col(f"b.max_{axis}") - F.col(f"a.min_{axis}"), F.col(f"a.max_{axis}") - F.col(f"b.min_{axis}")
            )

        farthest = F.col("a.half") * 2
        surely = F.col("a.reach") * (1 - 1e-9) - SLACK_M
        may_touch = (sum(apart(a) * apart(a) for a in _AXES) <= farthest * farthest) & (apart("t") < F.col("a.span"))
        all_near = (
            (surely > 0)
            & (sum(across(a) * across(a) for a in _AXES) <= surely * surely)
            & (across("t") < F.col("a.span"))
        )
        ends = [F.col(f"{e}.{c}").alias(f"{c}_{e}") for e in ("a", "b") for c in ("no", "rows", "dense")]
        boxes = [F.struct(*(F.col(f"{e}.{c}").alias(c) for c in _BOX)).alias(f"box_{e}") for e in ("a", "b")]
        limits = F.struct(*(F.col(f"a.{c}").alias(c) for c in ("eps_space", "eps_time", "reach", "half", "span")))
        return pairs.where(may_touch).select(
            "traj_id", *ends, *boxes, limits.alias("limits"), all_near.alias("all_near")
        )

    def _probes(self, pairs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
        """Points `p` of each cell a that are near the box of cell b, and what splits those of one cell b.

        A cell b that more than `cell_rows` points ask for, such as a sparse one beside a crowded one, is kept in
        several copies, and the points are dealt to them by `salt`. Of the copies there is one for each `cell_rows`
        points that ask.
        """
        asked = pairs.groupBy("traj_id", "no_b").agg(F.sum("rows_a").alias("_asked"))
        copies = F.ceil(F.col("_asked") / F.lit(self._cell_rows)).cast("int")
        # At most one row per `cell_rows` asking points.
        hot = asked.where(F.col("_asked") > self._cell_rows).select("traj_id", "no_b", copies.alias("_copies"))
        slim = self.points.select("traj_id", "no", "ord", F.struct(*_POINT).alias("p"))
        left = self.points_of(slim, pairs.withColumnRenamed("no_a", "no")).where(_near_box("box_b"))
        left = left.select("traj_id", F.col("no").alias("no_a"), "no_b", "p", "limits")
        if not hot.take(1):
            return left.withColumn("salt", F.lit(0)), None
        hot = saved(hot)
        salt = F.pmod(F.xxhash64("p.ord"), F.coalesce("_copies", F.lit(1))).cast("int")
        return left.join(hot, ["traj_id", "no_b"], "left").withColumn("salt", salt).drop("_copies"), hot

    @staticmethod
    def _copied(df: DataFrame, hot: DataFrame | None) -> DataFrame:
        """Rows (traj_id, no_b, ...) once for each `salt` of their cell."""
        if hot is None:
            return df.withColumn("salt", F.lit(0))
        wide = df.join(hot, ["traj_id", "no_b"], "left")
        every = F.sequence(F.lit(0), F.coalesce("_copies", F.lit(1)) - 1)
        return wide.withColumn("salt", F.explode(every)).drop("_copies")

    def near_pairs(self, pairs: DataFrame) -> DataFrame:
        """Neighbouring points `p` of cell a and `q` of cell b; cells b must be sparse."""
        probes, hot = self._probes(pairs)
        return self._tested(probes, self.points.where(~F.col("dense")), ["no_b"], hot)

    def near_counts(self, pairs: DataFrame) -> DataFrame:
        """(traj_id, no_a, no_b, ord, n): neighbours of points of cell a in cell b, if any.

        The points of a crowded cell are not tried one by one: the cell is halved
        along every axis, again and again, and boxes that are wholly near or wholly
        out of reach are settled by their row count. A point so meets only the
        boxes on the edge of its reach, down to boxes of `leaf_rows` points.
        """
        few = F.col("rows") <= self._leaf_rows
        probes, hot = self._probes(pairs.where(F.col("rows_b") <= self._leaf_rows))
        small = self._tested(probes, self.points.where(few), ["no_b"], hot)
        counts = small.groupBy(*_PROBE).agg(F.count(F.lit(1)).alias("n"))
        crowded = pairs.where(F.col("rows_b") > self._leaf_rows)
        if not crowded.take(1):
            return counts
        parts = [counts, *self._halved(*self._probes(crowded), self.points.where(~few))]
        return reduce(DataFrame.unionByName, parts).groupBy(*_PROBE).agg(F.sum("n").alias("n"))

    def _halved(self, probes: DataFrame, hot: DataFrame | None, points: DataFrame) -> list[DataFrame]:
        counts = []
        open_boxes = probes.withColumn("ord", F.col("p.ord"))
        above: list[str] = []
        for level in range(1, _MAX_LEVEL + 1):
            key = [f"k{a}" for a in (*_AXES, "t")]
            placed = points.withColumns(_halving_key(level))
            boxes = placed.groupBy("traj_id", F.col("no").alias("no_b"), *key).agg(
                F.count(F.lit(1)).alias("rows"),
                F.struct(
                    *(f(c).alias(f"{n}_{c}") for c in (*_AXES, "t", "latitude", "longitude") for n, f in (("min", F.min), ("max", F.max)))
                ).alias("box"),
            )
            boxes = boxes.withColumns({f"above_{k}": F.shiftright(k, 1) for k in key})
            boxes = self._copied(boxes, hot)
            found = open_boxes.join(shuffled(boxes), ["traj_id", "no_b", "salt", *above]).where(_near_box("box"))
            one_place = reduce(
                lambda x, y: x & y,
                (F.col(f"box.min_{c}") == F.col(f"box.max_{c}") for c in ("t", "latitude", "longitude")),
            )
            at_place = _near("p", *(F.col(f"box.min_{c}") for c in ("latitude", "longitude", "t")))
            settled = saved(
                found.withColumn("whole", F.when(one_place, at_place).otherwise(_inside("box")))
                .where(F.col("whole") | ~one_place)
                .withColumn("leaf", (F.col("rows") <= self._leaf_rows) | F.lit(level == _MAX_LEVEL))
                .select("traj_id", "no_a", "no_b", "salt", "ord", "p", "limits", "rows", "whole", "leaf", *key)
            )
            counts.append(settled.where("whole").select(*_PROBE, F.col("rows").alias("n")))
            still = settled.where(~F.col("whole"))
            tested = self._tested(still.where("leaf").drop("rows"), placed, ["no_b", *key], hot)
            counts.append(tested.groupBy(*_PROBE).agg(F.count(F.lit(1)).alias("n")))
            open_boxes = still.where(~F.col("leaf")).select(
                "traj_id", "no_a", "no_b", "salt", "ord", "p", "limits", *(F.col(k).alias(f"above_{k}") for k in key)
            )
            above = [f"above_{k}" for k in key]
            if not open_boxes.take(1):
                break
        return counts

    def _tested(self, probes: DataFrame, points: DataFrame, keys: list[str], hot: DataFrame | None) -> DataFrame:
        """Probes with the points `q` that pass the exact test."""
        others = points.withColumnRenamed("no", "no_b").select("traj_id", *keys, F.struct(*_POINT).alias("q"))
        near = _near("p", *(F.col(f"q.{c}") for c in ("latitude", "longitude", "t")))
        met = probes.drop("ord").join(shuffled(self._copied(others, hot)), ["traj_id", "salt", *keys])
        return met.drop("salt").where(near).withColumn("ord", F.col("p.ord"))


_POINT = ("ord", "latitude", "longitude", "t", "x", "y", "z")


_PROBE = ("traj_id", "no_a", "no_b", "ord")
_MAX_LEVEL = 40


def _near(point: str, latitude: Column, longitude: Column, t: Column) -> Column:
    here = (F.col(f"{point}.{c}") for c in ("latitude", "longitude", "t"))
    return near_points(*here, latitude, longitude, t, F.col("limits.eps_space"), F.col("limits.eps_time"))


def _near_box(box: str) -> Column:
    """Whether point `p` may have a neighbour inside a box."""

    def outside(axis: str) -> Column:
        at = F.col(f"p.{axis}")
        return F.greatest(F.lit(0), F.col(f"{box}.min_{axis}") - at, at - F.col(f"{box}.max_{axis}"))

    limit = F.col("limits.half") * 2
    return (sum(outside(a) * outside(a) for a in _AXES) <= limit * limit) & (outside("t") < F.col("limits.span"))


def _inside(box: str) -> Column:
    """Whether all points of a box are surely neighbours of point `p`."""

    def farthest(axis: str) -> Column:
        at = F.col(f"p.{axis}")
        return F.greatest(F.col(f"{box}.max_{axis}") - at, at - F.col(f"{box}.min_{axis}"))

    surely = F.col("limits.reach") * (1 - 1e-9) - SLACK_M
    return (
        (surely > 0)
        & (sum(farthest(a) * farthest(a) for a in _AXES) <= surely * surely)
        & (farthest("t") < F.col("limits.span"))
    )


def _halving_key(level: int) -> dict[str, Column]:
    """Which of the 2^level slices of its cell a point is in, along each axis."""
    slices = float(1 << level)
    keys = {f"k{a}": F.floor(F.col(a) / F.col("half") * slices) for a in _AXES}
    in_bin = F.pmod(F.col("t"), F.col("span")).cast("double")
    return keys | {"kt": F.floor(in_bin / F.col("span") * slices)}


def both_ways(pairs: DataFrame) -> DataFrame:
    """Each pair of cells seen from either end."""
    swapped = {f"{c}_{e}": f"{c}_{o}" for c in ("no", "rows", "dense", "box") for e, o in (("a", "b"), ("b", "a"))}
    back = pairs.select(*(F.col(swapped.get(c, c)).alias(c) for c in pairs.columns))
    return pairs.unionByName(back)


def neighbour_counts(df: DataFrame, cell_rows: int = CELL_ROWS, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """(traj_id, ord, neighbours) for points with search limits; a point counts itself."""
    short, df = split_short(saved(df), min(SHORT_ROWS, cell_rows), "timestamp")
    counts = near_rows(short).groupBy("traj_id", "ord").agg(F.count(F.lit(1)).alias("neighbours"))
    if df is None:
        return counts
    index = CellIndex(df, cell_rows, leaf_rows)
    pairs = both_ways(saved(index.adjacent()))
    whole = pairs.where("all_near").groupBy("traj_id", F.col("no_a").alias("no")).agg(F.sum("rows_b").alias("_whole"))
    per_cell = index.cells.select("traj_id", "no", "rows").join(shuffled(whole), ["traj_id", "no"], "left")
    known = index.points_of(
        index.points.select("traj_id", "no", "ord"),
        per_cell.select("traj_id", "no", (F.col("rows") + F.coalesce("_whole", F.lit(0))).alias("n")),
    ).select("traj_id", "ord", "n")
    tested = index.near_counts(pairs.where(~F.col("all_near"))).select("traj_id", "ord", "n")
    per_point = known.unionByName(tested).groupBy("traj_id", "ord").agg(F.sum("n").alias("neighbours"))
    return counts.unionByName(per_point)
