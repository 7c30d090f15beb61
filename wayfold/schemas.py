"""Table schemas, their row constraints, and the shape of the input JSON."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Rule:
    """One column of a table: its type and, for numbers, the allowed range."""

    name: str
    type: T.DataType
    low: float | None = None
    high: float | None = None


@dataclass(frozen=True)
class Table:
    name: str
    rules: tuple[Rule, ...]

    @property
    def columns(self) -> list[str]:
        return [r.name for r in self.rules]

    @property
    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(r.name, r.type) for r in self.rules])


_D, _L, _S, _TS = T.DoubleType(), T.LongType(), T.StringType(), T.TimestampType()


def _lat(name: str = "latitude") -> Rule:
    return Rule(name, _D, -90, 90)


def _lon(name: str = "longitude") -> Rule:
    return Rule(name, _D, -180, 180)


RAW_POSITIONS = Table(
    "raw_positions",
    (_lat(), _lon(), Rule("accuracy", _L, 0), Rule("timestamp", _TS)),
)
TIMELINE_PATHS = Table("timeline_paths", (_lat(), _lon(), Rule("timestamp", _TS)))
VISITS = Table(
    "visits",
    (
        Rule("start_time", _TS),
        Rule("end_time", _TS),
        _lat(),
        _lon(),
        Rule("semantic_type", _S),
        Rule("probability", _D, 0, 1),
        Rule("place_probability", _D, 0, 1),
    ),
)
ACTIVITIES = Table(
    "activities",
    (
        Rule("start_time", _TS),
        Rule("end_time", _TS),
        _lat("start_latitude"),
        _lon("start_longitude"),
        _lat("end_latitude"),
        _lon("end_longitude"),
        Rule("distance", _D, 0),
        Rule("activity_type", _S),
        Rule("probability", _D, 0, 1),
        Rule("activity_probability", _D, 0, 1),
    ),
)
CLUSTERED_POSITIONS = Table(
    "clustered_positions", RAW_POSITIONS.rules + (Rule("cluster_id", T.IntegerType(), 0),)
)

# The parts of a location-history document that the readers use, as DDL. Each reader
# asks for its own part only, so the JSON parser skips the rest.
RAW_SIGNALS_JSON = (
    "rawSignals array<struct<position: struct<"
    "LatLng: string, accuracyMeters: bigint, timestamp: string>>>"
)
SEGMENT_PARTS = {
    "timelinePath": "array<struct<point: string, time: string>>",
    "visit": (
        "struct<probability: double, topCandidate: struct<semanticType: string, "
        "probability: double, placeLocation: struct<latLng: string>>>"
    ),
    "activity": (
        "struct<start: struct<latLng: string>, `end`: struct<latLng: string>, "
        "distanceMeters: double, probability: double, "
        "topCandidate: struct<type: string, probability: double>>"
    ),
}


def semantic_segments_json(part: str) -> str:
    """Schema of the segment array with only one kind of segment."""
    return f"semanticSegments array<struct<startTime: string, endTime: string, {part}: {SEGMENT_PARTS[part]}>>"


# Everything that any reader uses, for documents that are parsed once.
ALL_JSON = (
    f"{RAW_SIGNALS_JSON}, semanticSegments array<struct<startTime: string, endTime: string, "
    + ", ".join(f"{part}: {kind}" for part, kind in SEGMENT_PARTS.items())
    + ">>"
)
