"""Readers for location-history JSON: raw positions, paths, visits and activities.

One document is one file and, being a single JSON value, one task; work is spread over
the files. Each reader parses only the part of the document that it needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parsing import coordinate, instant
from ..schemas import (
    ACTIVITIES,
    RAW_POSITIONS,
    RAW_SIGNALS_JSON,
    SEGMENT_PARTS,
    TIMELINE_PATHS,
    VISITS,
    semantic_segments_json,
)


# Holds the text of a document that does not parse or has a field of the wrong type.
_CORRUPT = "_unreadable_text"


def read_documents(spark: SparkSession, path: str | list[str], schema: str, strict: bool = True) -> DataFrame:
    """Documents under `path`, with the file as `traj_id`.

    A document that does not parse, or has a field of the wrong type, fails the query if `strict`.
    Otherwise it gives no rows, and `rejected_documents` lists it.
    """
    return from_files(spark.read, schema, strict).json(path).transform(named)


def from_files(reader, schema: str, strict: bool):
    """Sets up a batch or stream reader of documents."""
    reader = reader.option("multiLine", True)
    if strict:
        return reader.option("mode", "FAILFAST").schema(schema)
    return (
        reader.option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .schema(f"{schema}, {_CORRUPT} string")
    )


def named(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("_metadata.file_path").alias("traj_id"), *documents.columns)


def parse_documents(texts: DataFrame, schema: str, strict: bool = True) -> DataFrame:
    """The same for documents that are already a column `text` next to `traj_id`."""
    if strict:
        parsed = F.from_json("text", schema, {"mode": "FAILFAST"})
    else:
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
        parsed = F.from_json("text", f"{schema}, {_CORRUPT} string", options)
    return texts.select("traj_id", parsed.alias("_d")).select("traj_id", "_d.*")


def readable(documents: DataFrame) -> DataFrame:
    """The documents without those that did not parse whole."""
    return documents.where(F.col(_CORRUPT).isNull()) if _CORRUPT in documents.columns else documents


def rejected_documents(documents: DataFrame) -> DataFrame:
    """(traj_id, reason, entries) of the documents, read without `strict`, that give no rows.

    `entries` is how many signals or segments could be made out, -1 if none.
    """
    bad = documents.where(F.col(_CORRUPT).isNotNull())
    reason = F.when(F.try_parse_json(F.col(_CORRUPT)).isNull(), "not a JSON document").otherwise("a field of the wrong type")
    part = next(c for c in documents.columns if c not in ("traj_id", _CORRUPT))
    return bad.select("traj_id", reason.alias("reason"), F.coalesce(F.size(part), F.lit(-1)).alias("entries"))


def raw_positions(documents: DataFrame, strict: bool = True, point_ids: bool = False) -> DataFrame:
    """Signals with a position; others are skipped.

    With `point_ids`, adds the place of each signal in its document, which orders rows of
    equal time, or all rows if file order is wanted.
    """
    signal = readable(documents).select("traj_id", F.posexplode("rawSignals").alias("place", "signal"))
    position = signal.where(F.col("signal.position").isNotNull()).select("traj_id", "place", "signal.position.*")
    return position.select(
        "traj_id",
        *([F.col("place").cast("long").alias("point_id")] if point_ids else []),
        coordinate(F.col("LatLng"), 0, strict).alias("latitude"),
        coordinate(F.col("LatLng"), 1, strict).alias("longitude"),
        F.col("accuracyMeters").alias("accuracy"),
        instant(F.col("timestamp"), strict).alias("timestamp"),
    )


def _segments(documents: DataFrame, part: str) -> DataFrame:
    segment = readable(documents).select("traj_id", F.explode("semanticSegments").alias("s"))
    return segment.where(F.col(f"s.{part}").isNotNull()).select(
        "traj_id", "s.startTime", "s.endTime", F.col(f"s.{part}").alias(part)
    )


def timeline_paths(documents: DataFrame, strict: bool = True) -> DataFrame:
    """All points of the path segments; an empty path gives no points."""
    step = _segments(documents, "timelinePath").select("traj_id", F.explode("timelinePath").alias("p"))
    return step.select(
        "traj_id",
        coordinate(F.col("p.point"), 0, strict).alias("latitude"),
        coordinate(F.col("p.point"), 1, strict).alias("longitude"),
        instant(F.col("p.time"), strict).alias("timestamp"),
    )


def _times(strict: bool) -> list[Column]:
    return [
        instant(F.col("startTime"), strict).alias("start_time"),
        instant(F.col("endTime"), strict).alias("end_time"),
    ]


def visits(documents: DataFrame, strict: bool = True) -> DataFrame:
    place = F.col("visit.topCandidate.placeLocation.latLng")
    return _segments(documents, "visit").select(
        "traj_id",
        *_times(strict),
        coordinate(place, 0, strict).alias("latitude"),
        coordinate(place, 1, strict).alias("longitude"),
        F.col("visit.topCandidate.semanticType").alias("semantic_type"),
        F.col("visit.probability").alias("probability"),
        F.col("visit.topCandidate.probability").alias("place_probability"),
    )


def activities(documents: DataFrame, strict: bool = True) -> DataFrame:
    ends = {"start": F.col("activity.start.latLng"), "end": F.col("activity.end.latLng")}
    return _segments(documents, "activity").select(
        "traj_id",
        *_times(strict),
        *(
            coordinate(text, part, strict).alias(f"{end}_{name}")
            for end, text in ends.items()
            for part, name in enumerate(("latitude", "longitude"))
        ),
        F.col("activity.distanceMeters").alias("distance"),
        F.col("activity.topCandidate.type").alias("activity_type"),
        F.col("activity.probability").alias("probability"),
        F.col("activity.topCandidate.probability").alias("activity_probability"),
    )


_NOTHING = {
    "position": "struct<LatLng: string, accuracyMeters: bigint, timestamp: string>",
    "startTime": "string",
    "endTime": "string",
    "step": "struct<point: string, time: string>",
    **{part: SEGMENT_PARTS[part] for part in ("visit", "activity")},
}


def _entry(table: str, **values: Column) -> Column:
    """An entry of any table as it stands in a document."""
    columns = (values.get(n, F.lit(None)).cast(t).alias(n) for n, t in _NOTHING.items())
    return F.struct(F.lit(table).alias("table_name"), *columns)


def all_rows(documents: DataFrame, strict: bool = True) -> DataFrame:
    """Rows of all four tables from documents that were read once, with `ALL_JSON`.

    (traj_id, table_name, and the columns of all tables), where columns of other tables are null.
    """

    def segment(part: str):
        return F.transform(
            F.filter("semanticSegments", lambda s: s[part].isNotNull()),
            lambda s: _entry(TABLE_OF[part], startTime=s["startTime"], endTime=s["endTime"], **{part: s[part]}),
        )

    none = F.array().cast("array<struct<point: string, time: string>>")
    entries = (
        F.transform(
            F.filter("rawSignals", lambda s: s["position"].isNotNull()),
            lambda s: _entry(RAW_POSITIONS.name, position=s["position"]),
        ),
        F.flatten(
            F.transform(
                "semanticSegments",
                lambda s: F.transform(F.coalesce(s["timelinePath"], none), lambda p: _entry(TIMELINE_PATHS.name, step=p)),
            )
        ),
        segment("visit"),
        segment("activity"),
    )
    # One kind of entry at a time: a document without signals or segments has an empty list there.
    lists = F.array(*(F.coalesce(e, F.array().cast(f"array<struct<table_name: string, {_DDL}>>")) for e in entries))
    rows = readable(documents).select("traj_id", F.inline(F.flatten(lists)))
    place = F.coalesce("position.LatLng", "step.point", "visit.topCandidate.placeLocation.latLng")
    ends = {"start": F.col("activity.start.latLng"), "end": F.col("activity.end.latLng")}
    return rows.select(
        "traj_id",
        "table_name",
        coordinate(place, 0, strict).alias("latitude"),
        coordinate(place, 1, strict).alias("longitude"),
        F.col("position.accuracyMeters").alias("accuracy"),
        instant(F.coalesce("position.timestamp", "step.time"), strict).alias("timestamp"),
        *_times(strict),
        *(
            coordinate(text, part, strict).alias(f"{end}_{name}")
            for end, text in ends.items()
            for part, name in enumerate(("latitude", "longitude"))
        ),
        F.col("visit.topCandidate.semanticType").alias("semantic_type"),
        F.coalesce("visit.probability", "activity.probability").alias("probability"),
        F.col("visit.topCandidate.probability").alias("place_probability"),
        F.col("activity.distanceMeters").alias("distance"),
        F.col("activity.topCandidate.type").alias("activity_type"),
        F.col("activity.topCandidate.probability").alias("activity_probability"),
    )


_DDL = ", ".join(f"{n}: {t}" for n, t in _NOTHING.items())
TABLE_OF = {"visit": VISITS.name, "activity": ACTIVITIES.name}

# Table -> (what to parse of a document, how to flatten it)
READERS = {
    RAW_POSITIONS: (RAW_SIGNALS_JSON, raw_positions),
    TIMELINE_PATHS: (semantic_segments_json("timelinePath"), timeline_paths),
    VISITS: (semantic_segments_json("visit"), visits),
    ACTIVITIES: (semantic_segments_json("activity"), activities),
}


def extract_all(spark: SparkSession, path: str | list[str], strict: bool = True) -> dict[str, DataFrame]:
    """The four tables of the documents under `path`, lazily."""
    return {
        table.name: flatten(read_documents(spark, path, schema, strict), strict)
        for table, (schema, flatten) in READERS.items()
    }


def extract_all_texts(texts: DataFrame, strict: bool = True) -> dict[str, DataFrame]:
    return {
        table.name: flatten(parse_documents(texts, schema, strict), strict)
        for table, (schema, flatten) in READERS.items()
    }
