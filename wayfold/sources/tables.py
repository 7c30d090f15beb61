"""Validated tables on disk, as CSV or Parquet, replaced all at once and read by day.

A table `folder`/<name> is a row of versions, `folder`/<name>/version=<id>, each written once. What is current
is said by the log in `folder`/_commits: one line a commit, naming the versions that it makes current, of
one table or of several. A commit is one small file that appears whole or not at all. So a job that fails
its checks, or is killed, leaves the tables as they were, and several tables change together. Readers follow
the log. Old versions stay, for readers that began before, until `remove_old_versions`.

Two writers of one folder at a time don't mix rows: of commits with the same number the one with the larger
version wins, whole.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timeops import kst_range
from ..operators.filters import filter_intervals, filter_points
from ..operators.validate import broken_rules, check_columns, strict_rows
from ..schemas import Rule, Table

# Fixed value: how CSV files write times, to the microsecond and with the offset.
CSV_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
_CSV = {"header": True, "timestampFormat": CSV_TIME}
# Intervals that touch more days are kept once, in a folder of their own that every reader of a range opens.
MOST_DAYS = 31
_LOG = "seq bigint, swaps array<struct<name: string, version: string, by_day: string, checked: boolean>>"


@dataclass(frozen=True)
class Part:
    """Rows to store as a table. `by_day` names the timestamp column whose UTC day splits it into folders.

    With by_day = start_time rows are intervals up to end_time and are kept under each day that they touch.
    `strict` fails at a row that breaks a rule; else such rows are kept apart with their `reasons`.
    """

    rows: DataFrame
    table: Table
    by_day: str | None = None
    strict: bool = True


@dataclass(frozen=True)
class Current:
    """Where the current rows of a table are, and how they are laid out."""

    path: str
    by_day: str | None = None
    checked: bool = False


def _split(path: str) -> tuple[str, str]:
    folder, name = os.path.split(path.rstrip("/"))
    return folder, name


def _log(spark: SparkSession, folder: str) -> DataFrame | None:
    try:
        return spark.read.schema(_LOG).json(f"{folder}/_commits/log")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def current(spark: SparkSession, path: str) -> Current:
    """The current version of the table at `path`; a folder without a log is taken as it is."""
    folder, name = _split(path)
    log = _log(spark, folder)
    if log is None:
        return Current(path)
    swaps = log.select("seq", F.inline("swaps")).where(F.col("name") == name)
    last = swaps.orderBy(F.desc("seq"), F.desc("version")).first()
    return Current(f"{path}/version={last.version}", last.by_day, last.checked) if last else Current(path)


def _days() -> Column:
    """The UTC days that an interval touches, or null if there are too many; its end is outside it."""
    first = F.to_date("start_time")
    last = F.greatest(first, F.to_date(F.col("end_time") - F.expr("interval 1 microsecond")))
    # An interval without both times has no days either.
    few = F.datediff(last, first) < MOST_DAYS
    return F.when(few, F.sequence(first, last)).otherwise(F.array(F.lit(None).cast("date")))


def _laid_out(part: Part) -> DataFrame:
    if part.strict:
        rows = strict_rows(part.rows, part.table)
    else:
        check_columns(part.rows, part.table)
        rules = broken_rules(part.rows, part.table)
        reasons = F.concat_ws("; ", *(F.when(broken, F.lit(name)) for name, broken in rules.items()))
        rows = part.rows.withColumn("reasons", reasons).withColumn("rejected", F.col("reasons") != "")
    if part.by_day is None:
        return rows
    return rows.withColumn("day", F.explode(_days()) if part.by_day == "start_time" else F.to_date(part.by_day))


def save_tables(spark: SparkSession, folder: str, parts: dict[str, Part], format: str = "parquet") -> dict[str, dict[str, int]]:
    """Check and write tables, then make all of them current with one commit.

    Returns, for parts that are not strict, how many rows break each rule: counted while they are written.
    """
    log = _log(spark, folder)
    seq = (log.agg(F.max("seq")).first()[0] or 0) + 1 if log is not None else 1
    version = f"{seq:010d}-{uuid.uuid4().hex[:8]}"
    counts, swaps = {}, []
    for name, part in parts.items():
        rows, seen = part.rows, None
        if not part.strict:
            seen = Observation(f"{name}-{version}")
            rules = broken_rules(rows, part.table)
            rows = rows.observe(seen, *(F.count_if(broken).alias(rule) for rule, broken in rules.items()))
        out = _laid_out(Part(rows, part.table, part.by_day, part.strict))
        split = [*([] if part.strict else ["rejected"]), *(["day"] if part.by_day else [])]
        # Rows of a day go to few files, of which large days have more.
        writer = (out.hint("rebalance", *map(F.col, split)) if split else out).write.format(format)
        if split:
            writer = writer.partitionBy(*split)
        (writer.options(**_CSV) if format == "csv" else writer).save(f"{folder}/{name}/version={version}")
        if seen is not None:
            counts[name] = dict(seen.get)
        swap = (F.lit(name).alias("name"), F.lit(version).alias("version"), F.lit(part.by_day).cast("string").alias("by_day"))
        swaps.append(F.struct(*swap, F.lit(not part.strict).alias("checked")))
    commit = spark.range(1, numPartitions=1).select(F.lit(seq).alias("seq"), F.array(*swaps).alias("swaps"))
    commit.write.mode("append").json(f"{folder}/_commits/log")
    return counts


def save_table(
    df: DataFrame, path: str, table: Table, format: str = "parquet", by_day: str | None = None
) -> None:
    """Check columns and rows, then replace the table at `path`, and nothing else; see `Part` for `by_day`."""
    folder, name = _split(path)
    save_tables(df.sparkSession, folder, {name: Part(df, table, by_day)}, format)


def _read(spark: SparkSession, at: Current, table: Table, format: str, strict: bool) -> DataFrame:
    schema = T.StructType(list(table.struct.fields))
    if at.checked:
        schema = schema.add("reasons", T.StringType()).add("rejected", T.BooleanType())
    if at.by_day is not None:
        schema = schema.add("day", T.DateType())
    reader = spark.read.schema(schema).format(format)
    if format == "csv":
        # A row that does not parse fails here if strict, and else turns into nulls.
        reader = reader.options(**_CSV).option("mode", "FAILFAST" if strict else "PERMISSIVE")
    return reader.load(at.path)


def _kept(rows: DataFrame, at: Current) -> DataFrame:
    return rows.where(~F.col("rejected")) if at.checked else rows


def load_table(
    spark: SparkSession, path: str, table: Table, format: str = "parquet", strict: bool = True
) -> DataFrame:
    """Read a table with its own schema, never a guessed one; `strict` checks the rows."""
    at = current(spark, path)
    rows = _kept(_read(spark, at, table, format, strict), at)
    if at.by_day == "start_time":
        # An interval is kept under each of its days: take it from the first, or where it is kept once.
        rows = rows.where(F.col("day").isNull() | (F.col("day") == F.to_date("start_time")))
    rows = rows.select(*table.columns)
    return strict_rows(rows, table) if strict else rows


def load_range(
    spark: SparkSession,
    path: str,
    table: Table,
    start: datetime,
    end: datetime,
    format: str = "parquet",
    strict: bool = True,
) -> DataFrame:
    """Rows of a table in a range of Seoul wall-clock time, as `filter_points` and `filter_intervals` take them.

    Of a table kept by day only the folders of the range's UTC days are read, and each interval comes once.
    """
    at = current(spark, path)
    rows = _kept(_read(spark, at, table, format, strict), at)
    low, high = kst_range(start, end)
    first, last = low.date(), (high - timedelta(microseconds=1)).date()
    inside = F.col("day").between(F.lit(first), F.lit(last))
    if at.by_day == "start_time":
        # The first day that both the interval and the range have.
        once = F.col("day") == F.greatest(F.to_date("start_time"), F.lit(first))
        rows = rows.where((inside | F.col("day").isNull()) & (F.col("day").isNull() | once))
    elif at.by_day is not None:
        rows = rows.where(inside)
    rows = (filter_points if "timestamp" in table.columns else filter_intervals)(rows, start, end)
    rows = rows.select(*table.columns)
    return strict_rows(rows, table) if strict else rows


def load_rejected(spark: SparkSession, path: str, table: Table, format: str = "parquet") -> DataFrame:
    """The rows that broke a rule when the table was stored, with `reasons`; a table stored strictly has none."""
    at = current(spark, path)
    rows = _read(spark, at, table, format, False)
    if not at.checked:
        return rows.select(*table.columns, F.lit(None).cast("string").alias("reasons")).limit(0)
    rows = rows.where("rejected")
    if at.by_day == "start_time":
        rows = rows.where(F.col("day").isNull() | (F.col("day") == F.to_date("start_time")))
    return rows.select(*table.columns, "reasons")


def remove_old_versions(spark: SparkSession, folder: str) -> list[str]:
    """Delete the versions in `folder` that no commit makes current, and return their names as <table>/version=<id>.

    For times without writers: what a running job has written but not committed goes too.
    """
    log = _log(spark, folder)
    if log is None:
        return []
    swaps = log.select("seq", F.inline("swaps"))
    last = F.max_by("version", F.struct("seq", "version"))
    versions = {r["name"]: r["version"] for r in swaps.groupBy("name").agg(last.alias("version")).collect()}
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(folder)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = []
    for name, version in versions.items():
        for status in files.listStatus(jvm.org.apache.hadoop.fs.Path(root, name)):
            kept = status.getPath().getName()
            if kept.startswith("version=") and kept != f"version={version}":
                files.delete(status.getPath(), True)
                gone.append(f"{name}/{kept}")
    return sorted(gone)


def keyed(table: Table, **keys: T.DataType) -> Table:
    """The same table with key columns, such as traj_id, in front."""
    return Table(table.name, tuple(Rule(n, t) for n, t in keys.items()) + table.rules)
