"""Value curves per trajectory: index, knee, nearest quantiles, thresholds.

A curve is a frame (traj_id, value, copies): equal values are counted before
anything is sorted or shuffled by order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timeops import whole_seconds
from ..session import saved
from .ordered import BLOCK_ROWS, home_rows, neighbouring_rows, ranked, running_sum, unfold
from .segments import JUMP_RATE, MAX_JUMP_POINTS, jump_candidates
from .validate import in_range

# Different values that are sorted to find a quantile among them, and buckets of a round.
SLICE_ROWS, BUCKETS = 10_000, 256


def curve(df: DataFrame, value: str | Column, copies: Column | None = None) -> DataFrame:
    """Non-null values of a column with their number of copies."""
    value = F.col(value) if isinstance(value, str) else value
    weighted = df.select("traj_id", value.alias("value"), (F.lit(1) if copies is None else copies).alias("_n"))
    return (
        weighted.where(F.col("value").isNotNull())
        .groupBy("traj_id", "value")
        .agg(F.sum("_n").cast("long").alias("copies"))
    )


def indexed_curve(df: DataFrame, block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """One row per point of the curve, descending, with its 0-based index."""
    placed = _with_last_index(df, -F.col("value"), block_rows)
    ranges = placed.select(
        "traj_id", "value", (F.col("_upto") - F.col("copies")).alias("_first"), (F.col("_upto") - 1).alias("_last")
    )
    return unfold(ranges, "_first", "_last", "idx").select("traj_id", "idx", "value")


def _with_last_index(df: DataFrame, order: Column, block_rows: int | None, **totals) -> DataFrame:
    return running_sum(df, ["traj_id"], [order], F.col("copies"), "_upto", block_rows, totals)


def knee(df: DataFrame, name: str = "value", normalize: bool = True, block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """The value at the smallest index + value of the descending curve.

    Both are scaled to 0..1 if `normalize`. Equal values differ in index only, so
    the first copy stands for all. Ties go to the lowest index; a curve with one
    value, or with all values equal, gives that value.
    """
    value = F.col("value")
    scored = _with_last_index(
        df,
        -value,
        block_rows,
        _rows=("sum", F.col("copies")),
        _low=("min", value),
        _high=("max", value),
    ).withColumn("_idx", F.col("_upto") - F.col("copies"))
    if normalize:
        x = F.try_divide(F.col("_idx").cast("double"), F.col("_rows") - 1)
        y = F.try_divide((value - F.col("_low")).cast("double"), F.col("_high") - F.col("_low"))
        score = F.coalesce(x, F.lit(0.0)) + F.coalesce(y, F.lit(0.0))
    else:
        score = F.col("_idx") + value
    best = F.struct(F.round(score, 12).alias("score"), F.col("_idx"))
    return scored.groupBy("traj_id").agg(F.min_by(value, best).alias(name))


def nearest_quantiles(
    df: DataFrame, quantiles: dict[str, float], block_rows: int | None = BLOCK_ROWS
) -> DataFrame:
    """The element at 0-based ascending index floor((n - 1) * q + 0.5), per name.

    Values are not sorted as a whole. In rounds, those between the least and the largest that the element can be are
    counted in buckets, and the bucket that holds its index is kept, until few values are left; these are sorted.
    """
    values = saved(df)
    totals = values.groupBy("traj_id").agg(
        F.sum("copies").alias("n"), F.count(F.lit(1)).alias("rows"), F.min("value").alias("low"), F.max("value").alias("high")
    )
    at = {name: F.floor((F.col("n") - 1) * F.lit(q) + F.lit(0.5)) for name, q in quantiles.items()}
    wanted = F.explode(F.array(*(F.struct(F.lit(name).alias("name"), c.alias("at")) for name, c in at.items())))
    before = F.lit(0).cast("long").alias("before")
    slices = saved(totals.select("traj_id", wanted.alias("w"), "rows", "low", "high", before).select("*", "w.*").drop("w"))
    one, value = ["traj_id", "name"], F.col("value")
    many = (F.col("rows") > SLICE_ROWS) & (F.col("low") < F.col("high"))
    inside = value.between(F.col("low"), F.col("high"))
    while slices.where(many).take(1):
        share = (value - F.col("low")) / (F.col("high") - F.col("low"))
        bucket = F.least(F.floor(share * BUCKETS), F.lit(BUCKETS - 1)).alias("bucket")
        counted = (
            values.join(slices.where(many).drop("rows"), "traj_id")
            .where(inside)
            .groupBy(*one, "at", "before", bucket)
            .agg(
                F.sum("copies").alias("_copies"),
                F.count(F.lit(1)).alias("rows"),
                F.min("value").alias("low"),
                F.max("value").alias("high"),
            )
        )
        upto = F.sum("_copies").over(Window.partitionBy(*one).orderBy("bucket"))
        placed = counted.withColumn("_upto", F.col("before") + upto)
        holds = (F.col("_upto") > F.col("at")) & (F.col("_upto") - F.col("_copies") <= F.col("at"))
        found = placed.where(holds).withColumn("before", F.col("_upto") - F.col("_copies"))
        slices = saved(slices.where(~many).unionByName(found.select(slices.columns)))
    left = values.join(slices.drop("rows"), "traj_id").where(inside)
    upto = F.sum("copies").over(Window.partitionBy(*one).orderBy("value"))
    reached = F.col("before") + F.col("_upto") > F.col("at")
    picks = (F.min(F.when((F.col("name") == name) & reached, value)).alias(name) for name in quantiles)
    return left.withColumn("_upto", upto).groupBy("traj_id").agg(*picks)


def jump_thresholds(gaps: DataFrame, block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """(traj_id, jump_threshold): the knee of the gap distances."""
    return knee(curve(gaps, "distance_to_next"), "jump_threshold", block_rows=block_rows)


def same_place_thresholds(
    context: DataFrame,
    block_rows: int | None = BLOCK_ROWS,
    max_points: int | None = MAX_JUMP_POINTS,
    rate: float = JUMP_RATE,
) -> DataFrame:
    """(traj_id, same_place_threshold): a low quantile over the candidate segments.

    With max_points=None all segments with two neighbours count.
    """
    distances = curve(jump_candidates(context, max_points), "prev_next_distance")
    return nearest_quantiles(distances, {"same_place_threshold": rate}, block_rows)


def gap_summary(gaps: DataFrame, block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """Count, mean, deviation, extremes and nearest quartiles of the gap distances."""
    distance = F.col("distance_to_next")
    moments = gaps.where(distance.isNotNull()).groupBy("traj_id").agg(
        F.count(distance).alias("gap_count"),
        F.avg(distance).alias("mean_gap"),
        F.stddev_samp(distance).alias("std_gap"),
        F.min(distance).alias("min_gap"),
        F.max(distance).alias("max_gap"),
    )
    quartiles = nearest_quantiles(
        curve(gaps, distance), {"q25_gap": 0.25, "q50_gap": 0.5, "q75_gap": 0.75}, block_rows
    )
    return moments.join(quartiles, "traj_id")


def with_density_rule(df: DataFrame, block_rows: int | None = BLOCK_ROWS, extra_k: int = -1) -> DataFrame:
    """Adds dense `ord`, `n`, `min_pts` = ceil(ln n) and `k` = min_pts + extra_k per row."""
    counted = ranked(
        df.withColumnRenamed("ord", "_was") if "ord" in df.columns else df,
        ["traj_id"],
        [F.col("_was")] if "ord" in df.columns else [F.col("timestamp"), F.col("point_id")],
        "ord",
        block_rows,
        {"n": ("sum", F.lit(1).cast("long"))},
    ).drop("_was")
    min_pts = F.ceil(F.log(F.col("n").cast("double"))).cast("long")
    return counted.withColumn("min_pts", min_pts).withColumn("k", F.col("min_pts") + extra_k)


def min_points(df: DataFrame) -> DataFrame:
    """(traj_id, n, min_pts) from the row counts."""
    counts = df.groupBy("traj_id").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("min_pts", F.ceil(F.log(F.col("n").cast("double"))).cast("long"))


def temporal_k_distances(df: DataFrame, max_k: int, block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """Adds `k_distance`: whole seconds to the k-th nearest row in time, self excluded.

    `df` has a column `k` <= `max_k`; its rows are put in order of time here. The k nearest
    rows are neighbours in time order, so a window of k rows either way is enough:
    of all runs of k + 1 rows around the row, the one whose farther end is nearest.
    Null where a trajectory has no k other rows. Fails at a coordinate out of range, if there are any.
    """
    if max_k < 1:
        raise ValueError("k must be at least 1")
    if {"latitude", "longitude"} <= set(df.columns):
        df = in_range(df)
    timed = df.withColumn("_t", F.unix_micros("timestamp")).withColumnRenamed("ord", "_given")
    timed = ranked(timed, ["traj_id"], [F.col("_t"), F.col("_given")], "ord", block_rows)
    near, by_ord = neighbouring_rows(timed, max_k, block_rows)
    near = near.withColumn("_around", F.collect_list("_t").over(by_ord.rowsBetween(-max_k, max_k)))
    here, k, around = F.least(F.col("ord") - 1, F.lit(max_k)).cast("int"), F.col("k").cast("int"), F.col("_around")
    first = F.greatest(here - k, F.lit(0))
    last = F.least(here, F.size(around) - 1 - k)
    reach = F.array_min(
        F.transform(
            F.sequence(first, last),
            lambda at: F.greatest(F.col("_t") - F.get(around, at), F.get(around, at + k) - F.col("_t")),
        )
    )
    known = (k >= 1) & (F.size(around) > k)
    near = home_rows(near.withColumn("k_distance", F.when(known, whole_seconds(reach))), block_rows)
    return near.drop("_t", "_around", "ord").withColumnRenamed("_given", "ord")


def largest_k(df: DataFrame) -> int:
    """The largest `k` of a frame; it grows with the logarithm of a trajectory."""
    return int(df.agg(F.max("k")).first()[0] or 0)
