"""Text fields of the location-history JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: how the documents write times (three fractional digits, offset).
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"

# What counts as a number: no suffixes, NaN or Infinity.
NUMBER = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def coordinate(text: Column, part: int, strict: bool = True) -> Column:
    """Part 0 (latitude) or 1 (longitude) of text such as "37.1°, 127.1°".

    A missing part is null and parts after the second are ignored. Text that is
    no number fails the query if `strict`, and is null otherwise.
    """
    field = F.get(F.split(text, ","), F.lit(part))
    number = F.trim(F.regexp_replace(field, "^([^°]*)°", "$1"))
    value = F.when(number.rlike(NUMBER), number.try_cast("double"))
    if not strict:
        return value
    bad = F.raise_error(F.concat(F.lit("not a coordinate: "), number)).cast("double")
    return F.when(number.isNull(), F.lit(None).cast("double")).otherwise(F.coalesce(value, bad))


def instant(text: Column, strict: bool = True) -> Column:
    parse = F.to_timestamp if strict else F.try_to_timestamp
    return parse(text, F.lit(TIME_FORMAT) if not strict else TIME_FORMAT)
