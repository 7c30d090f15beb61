"""Checks of tables against their schema: columns, row constraints, coordinates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import Rule, Table


def check_columns(df: DataFrame, table: Table) -> DataFrame:
    """The columns must be the table's, in its order."""
    if df.columns != table.columns:
        raise ValueError(
            f"the rows for {table.name} have the columns {', '.join(df.columns)}; it takes {', '.join(table.columns)}, in this order"
        )
    return df


def _fits(actual: T.DataType, wanted: T.DataType) -> bool:
    """Whether a column type is accepted: whole numbers count as decimals, not the reverse."""
    if isinstance(wanted, T.DoubleType):
        return isinstance(actual, T.NumericType)
    if isinstance(wanted, (T.LongType, T.IntegerType)):
        return isinstance(actual, T.IntegralType)
    if isinstance(wanted, T.TimestampType):
        return isinstance(actual, (T.TimestampType, T.TimestampNTZType))
    return isinstance(actual, type(wanted))


def broken_rules(df: DataFrame, table: Table) -> dict[str, Column]:
    """Name of each rule -> whether a row breaks it (never null)."""
    rules: dict[str, Column] = {}
    for rule in table.rules:
        value = F.col(rule.name)
        fits = _fits(df.schema[rule.name].dataType, rule.type)
        if not fits:
            rules[f"{rule.name}: type"] = value.isNotNull()
        rules[f"{rule.name}: missing"] = value.isNull()
        if fits and rule.low is not None:
            rules[f"{rule.name}: range"] = F.coalesce(~_in_range(rule), F.lit(False))
    return rules


def _in_range(rule: Rule) -> Column:
    # NaN sorts above every number, so a lower bound alone would let it pass.
    value = F.col(rule.name)
    above = value >= rule.low
    if isinstance(rule.type, T.DoubleType):
        above = above & ~F.isnan(value.cast("double"))
    return above if rule.high is None else above & (value <= rule.high)


def with_reasons(df: DataFrame, table: Table) -> DataFrame:
    """Adds `reasons`, the broken rules of each row."""
    named = (F.when(broken, F.lit(name)) for name, broken in broken_rules(df, table).items())
    return df.withColumn("reasons", F.array_compact(F.array(*named)))


def split_rows(df: DataFrame, table: Table) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows with `reasons`)."""
    checked = with_reasons(df, table)
    good = F.size("reasons") == 0
    return checked.where(good).drop("reasons"), checked.where(~good)


def violations(df: DataFrame, table: Table) -> DataFrame:
    """(rule, bad_rows) over the whole table, in one pass."""
    rules = broken_rules(df, table)
    counted = df.agg(*(F.count_if(broken).alias(name) for name, broken in rules.items()))
    pairs = F.array(*(F.struct(F.lit(n).alias("rule"), F.col(f"`{n}`").alias("bad_rows")) for n in rules))
    return counted.select(F.inline(pairs))


def strict_rows(df: DataFrame, table: Table) -> DataFrame:
    """The same rows; running it fails at a row that breaks a rule."""
    check_columns(df, table)
    rules = broken_rules(df, table)
    failed = F.concat_ws(", ", *(F.when(broken, F.lit(name)) for name, broken in rules.items()))
    ok = ~reduce(lambda a, b: a | b, rules.values())
    return required(df, ok, F.concat(F.lit(f"{table.name}: "), failed))


def required(df: DataFrame, ok: Column, message: Column) -> DataFrame:
    """The same rows; running it fails at a row that is not `ok`.

    The check is a filter, which no choice of columns prunes, and needs no pass of its own.
    """
    return df.where(F.when(ok, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))


def located(df: DataFrame) -> DataFrame:
    """The same rows; running it fails at a row whose coordinates are missing or out of range."""
    ok = F.col("latitude").between(-90, 90) & F.col("longitude").between(-180, 180)
    place = F.concat_ws(", ", F.col("latitude").cast("string"), F.col("longitude").cast("string"))
    return required(df, ok, F.concat(F.lit("not a place on earth: "), place))


def in_range(df: DataFrame) -> DataFrame:
    """The same rows; running it fails at a row with a coordinate out of range. Missing coordinates pass."""
    ok = [
        F.col(name).isNull() | F.col(name).between(-limit, limit) for name, limit in (("latitude", 90), ("longitude", 180))
    ]
    place = F.concat_ws(", ", F.col("latitude").cast("string"), F.col("longitude").cast("string"))
    return required(df, ok[0] & ok[1], F.concat(F.lit("not a place on earth: "), place))


def coordinate_violations(df: DataFrame) -> DataFrame:
    """One row: how many latitudes and longitudes are out of range; missing ones pass."""
    missing = {"latitude", "longitude"} - set(df.columns)
    if missing:
        raise ValueError(f"columns are missing: {sorted(missing)}")
    return df.agg(
        F.count_if(~F.col("latitude").between(-90, 90)).alias("bad_latitude"),
        F.count_if(~F.col("longitude").between(-180, 180)).alias("bad_longitude"),
    )


def check_coordinates(df: DataFrame) -> DataFrame:
    """Raises unless all coordinates are in range. Runs one aggregate."""
    bad = coordinate_violations(df).first()
    if bad.bad_latitude:
        raise ValueError(f"{bad.bad_latitude} rows have a latitude beyond a pole")
    if bad.bad_longitude:
        raise ValueError(f"{bad.bad_longitude} rows have a longitude beyond 180 degrees")
    return df
