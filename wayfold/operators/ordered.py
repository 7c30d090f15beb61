"""Ordered operators on trajectories of any length.

A trajectory is a `traj_id`; `ord` numbers its rows from 1 without holes. One
trajectory may hold a large share of all rows, so an ordered step must not put a
whole trajectory into one task. Every function here takes `block_rows`:

* a number: rows are worked on in blocks of that many, partitioned by
  (trajectory, block), and what crosses a block edge is carried over;
* None: no trajectory is longer than a block (see `measured_blocks`), so plain
  windows by trajectory do, with one shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..session import saved

BLOCK_ROWS = 4_000_000
_SAMPLES_PER_CHUNK = 20


def measured_blocks(
    df: DataFrame, keys: Sequence[str] = ("traj_id",), block_rows: int = BLOCK_ROWS
) -> int | None:
    """None if every key fits into one block, else `block_rows`. Runs one count."""
    return block_rows if _oversized(df, keys, block_rows).take(1) else None


def _oversized(df: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows).select(*keys)


# --- numbering and running sums ------------------------------------------------


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    weight: Column,
    name: str,
    block_rows: int | None = BLOCK_ROWS,
    totals: dict[str, tuple[str, Column]] | None = None,
) -> DataFrame:
    """Sum of `weight` over the rows of a key up to and including this one.

    `order` is ascending and has to be unique within a key. `totals` adds values
    of the whole key to each row: name -> ("sum" | "min" | "max" | "bit_or", column).
    """
    totals = totals or {}
    if block_rows is None:
        whole = Window.partitionBy(*keys)
        upto = whole.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        out = df.withColumn(name, F.sum(weight).over(upto))
        return out.withColumns({n: getattr(F, how)(c).over(whole) for n, (how, c) in totals.items()})

    chunked = _with_chunks(saved(df), keys, order, block_rows)
    parts = [*keys, "_chunk"]
    per_chunk = chunked.groupBy(*parts).agg(
        F.sum(weight).alias("_sum"), *(getattr(F, how)(c).alias(n) for n, (how, c) in totals.items())
    )
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    offsets = per_chunk.select(
        *parts,
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"),
        *(getattr(F, how)(n).over(whole).alias(n) for n, (how, _) in totals.items()),
    )
    upto = Window.partitionBy(*parts).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        chunked.withColumn(name, F.sum(weight).over(upto))
        .join(offsets, parts)
        .withColumn(name, F.col(name) + F.col("_offset"))
        .drop("_chunk", "_offset")
    )


def ranked(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    name: str = "ord",
    block_rows: int | None = BLOCK_ROWS,
    totals: dict[str, tuple[str, Column]] | None = None,
) -> DataFrame:
    """Number the rows of each key from 1 in ascending `order`."""
    return running_sum(df, keys, order, F.lit(1).cast("long"), name, block_rows, totals)


def _with_chunks(df: DataFrame, keys: Sequence[str], order: Sequence[Column], rows: int) -> DataFrame:
    """Cut keys of more than `rows` rows into runs of about `rows` in `order`.

    The cut points come from a fixed hash sample, so a recomputed task cuts the
    same way. There is at most one oversized key per `rows` rows and one cut per
    about `rows` rows of such a key; how they are joined is left to Spark and their sizes.
    """
    position = F.struct(*order)
    oversized = _oversized(df, keys, rows)
    every = max(1, rows // _SAMPLES_PER_CHUNK)
    sampled = (
        df.join(oversized, list(keys))
        .where(F.pmod(F.xxhash64(*keys, *order), F.lit(every)) == 0)
        .select(*keys, position.alias("_at"))
    )
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy("_at"))
    cuts = (
        sampled.withColumn("_nth", nth)
        .where(F.col("_nth") % _SAMPLES_PER_CHUNK == 0)
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list("_at")).alias("_cuts"))
    )
    return (
        df.join(cuts, list(keys), "left")
        .withColumn("_chunk", F.when(F.col("_cuts").isNull(), 0).otherwise(_cuts_before("_cuts", position)))
        .drop("_cuts")
    )


def _cuts_before(cuts: str, position: Column) -> Column:
    """How many cut points are <= position: a search in halving steps."""
    steps = F.array(*(F.lit(1 << b) for b in range(23, -1, -1)))
    size = F.size(cuts)

    def take(found: Column, step: Column) -> Column:
        at = found + step
        return F.when((at <= size) & (F.get(F.col(cuts), at - 1) <= position), at).otherwise(found)

    return F.aggregate(steps, F.lit(0), take)


# --- windows that reach over a few rows ----------------------------------------


def block_of(block_rows: int | None, ord_col: str = "ord") -> Column:
    if block_rows is None:
        return F.lit(0).cast("long")
    return F.call_function("div", F.col(ord_col) - 1, F.lit(block_rows))


def neighbouring_rows(
    df: DataFrame, reach: int, block_rows: int | None, ord_col: str = "ord"
) -> tuple[DataFrame, WindowSpec]:
    """A frame and a window by trajectory in which each row sees `reach` rows around it.

    Rows near a block edge are copied into the next block; drop the copies with
    `home_rows` once the window columns are computed.
    """
    if block_rows is None:
        return df, Window.partitionBy("traj_id").orderBy(ord_col)
    if reach > block_rows:
        raise ValueError("a window cannot reach further than one block")
    home = block_of(block_rows, ord_col)
    within = (F.col(ord_col) - 1) % block_rows
    blocks = F.array(
        home,
        F.when((within < reach) & (home > 0), home - 1),
        F.when(within >= block_rows - reach, home + 1),
    )
    copied = df.withColumn("_block", F.explode(F.array_compact(blocks)))
    return copied, Window.partitionBy("traj_id", "_block").orderBy(ord_col)


def home_rows(df: DataFrame, block_rows: int | None, ord_col: str = "ord") -> DataFrame:
    if block_rows is None:
        return df
    return df.where(F.col("_block") == block_of(block_rows, ord_col)).drop("_block")


def attach(
    df: DataFrame,
    per_trajectory: DataFrame,
    block_rows: int | None,
    how: str = "inner",
    ord_col: str = "ord",
) -> DataFrame:
    """Join one row per trajectory to the rows of `df`, block by block."""
    if block_rows is None:
        return df.join(per_trajectory, "traj_id", how)
    blocked = df.withColumn("_block", block_of(block_rows, ord_col))
    blocks = blocked.select("traj_id", "_block").distinct()
    return blocked.join(blocks.join(per_trajectory, "traj_id"), ["traj_id", "_block"], how).drop("_block")


def split_short(df: DataFrame, rows: int, *known: str) -> tuple[DataFrame, DataFrame | None]:
    """The trajectories of at most `rows` rows without nulls in `known`, and the others, if any. Runs one count."""
    per_trajectory = df.groupBy("traj_id").agg(
        F.count(F.lit(1)).alias("_n"), *(F.count_if(F.col(c).isNull()).alias(f"_no_{c}") for c in known)
    )
    long = F.col("traj_id").isNull() | (F.col("_n") > rows)
    for c in known:
        long = long | (F.col(f"_no_{c}") > 0)
    others = per_trajectory.where(long).select(F.col("traj_id").alias("_long"))
    if not others.take(1):
        return df, None
    others, same = saved(others), F.col("traj_id").eqNullSafe(F.col("_long"))
    return df.join(others, same, "left_anti"), df.join(others, same, "left_semi")


# --- rows from ranges ----------------------------------------------------------

_UNFOLD_ROWS = 100_000


def unfold(df: DataFrame, first: str, last: str, name: str, rows: int = _UNFOLD_ROWS) -> DataFrame:
    """One row per number from `first` to `last`, both dropped.

    A range of more than `rows` numbers is cut and spread over tasks before it unfolds.
    """
    long = F.col(last) - F.col(first) >= rows
    pieces = (
        df.where(long)
        .withColumn("_from", F.explode(F.sequence(F.col(first), F.col(last), F.lit(rows).cast("long"))))
        .withColumn(last, F.least(F.col("_from") + (rows - 1), F.col(last)))
        .withColumn(first, F.col("_from"))
        .drop("_from")
        .repartition(first, last)
    )
    parts = df.where(~long).unionByName(pieces)
    return parts.withColumn(name, F.explode(F.sequence(first, last))).drop(first, last)
