"""Local-time ranges and whole-second gaps."""

from __future__ import annotations

from datetime import datetime, timezone, tzinfo
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

KST = ZoneInfo("Asia/Seoul")
MICROS = 1_000_000


def second_gap(a: Column, b: Column) -> Column:
    """Absolute difference of two timestamps in whole seconds, truncated."""
    return whole_seconds(F.abs(F.unix_micros(a) - F.unix_micros(b)))


def whole_seconds(micros: Column) -> Column:
    return F.call_function("div", micros, F.lit(MICROS))


def kst_to_utc(local: Column) -> Column:
    """Wall-clock time in Seoul to the same moment on the UTC clock."""
    return F.to_utc_timestamp(local, KST.key)


def utc_to_kst(moment: Column) -> Column:
    return F.from_utc_timestamp(moment, KST.key)


def _moved(start: datetime, end: datetime, read_in: tzinfo, shown_in: tzinfo) -> tuple[datetime, datetime]:
    if not start < end:
        raise ValueError(f"the range is empty: {start} to {end}")
    return start.replace(tzinfo=read_in).astimezone(shown_in), end.replace(tzinfo=read_in).astimezone(shown_in)


def kst_range(start: datetime, end: datetime) -> tuple[datetime, datetime]:
    """Two Seoul wall-clock bounds as UTC; whatever zone they carry is replaced."""
    return _moved(start, end, KST, timezone.utc)


def utc_range(start: datetime, end: datetime) -> tuple[datetime, datetime]:
    """Two UTC bounds as Seoul wall-clock times."""
    return _moved(start, end, timezone.utc, KST)


def utc_literal(moment: datetime) -> Column:
    """A timestamp literal that a file scan can be filtered on, in any session zone."""
    if moment.tzinfo is None:
        raise ValueError("the moment needs a time zone")
    text = moment.astimezone(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(f"{text}+00:00").cast("timestamp")
