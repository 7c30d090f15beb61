"""JSON readers, checks, stored tables, time ranges, and cleaning edge cases."""

import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from points import METRE, frame
from wayfold.functions import timeops
from wayfold.functions.parsing import coordinate, instant
from wayfold.operators import curves, filters, segments, validate
from wayfold.plans import pipeline
from wayfold.schemas import ACTIVITIES, RAW_POSITIONS, VISITS
from wayfold.sources import tables, timeline_json

DOCUMENT = {
    "rawSignals": [
        {"position": {"LatLng": "37.5°, 127.1°", "accuracyMeters": 12, "timestamp": "2026-08-11T09:12:34.000+09:00", "source": "GPS"}},
        {"wifiScan": {"devices": []}},
        {"position": {"LatLng": "-1.25°, -0.5°", "accuracyMeters": 0, "timestamp": "2026-08-11T00:00:00.125+09:00"}},
    ],
    "semanticSegments": [
        {"startTime": "2026-08-11T09:00:00.000+09:00", "endTime": "2026-08-11T10:00:00.000+09:00",
         "timelinePath": [{"point": "37.1°, 127.2°", "time": "2026-08-11T09:01:00.000+09:00"}]},
        {"startTime": "2026-08-11T09:00:00.000+09:00", "endTime": "2026-08-11T10:00:00.000+09:00", "timelinePath": []},
        {"startTime": "2026-08-11T09:00:00.000+09:00", "endTime": "2026-08-11T10:00:00.000+09:00",
         "visit": {"hierarchyLevel": 0, "probability": 0.9, "topCandidate": {"semanticType": "HOME", "probability": 0.5,
                   "placeLocation": {"latLng": "37.3°, 127.4°"}}}},
        {"startTime": "2026-08-11T09:00:00.000+09:00", "endTime": "2026-08-11T10:00:00.000+09:00",
         "activity": {"start": {"latLng": "37.3°, 127.4°"}, "end": {"latLng": "37.4°, 127.5°"}, "distanceMeters": 12.5,
                      "probability": 1, "topCandidate": {"type": "WALKING", "probability": 0.25}}},
    ],
}


@pytest.fixture()
def documents(tmp_path):
    for name in ("one", "two"):
        (tmp_path / f"{name}.json").write_text(json.dumps(DOCUMENT, indent=1))
    return str(tmp_path)


def test_extract_all(spark, documents):
    out = timeline_json.extract_all(spark, documents)
    assert {name: df.count() for name, df in out.items()} == {
        "raw_positions": 4, "timeline_paths": 2, "visits": 2, "activities": 2
    }
    one = out["raw_positions"].where(F.col("traj_id").endswith("one.json"))
    rows = [(r.latitude, r.longitude, r.accuracy, r.us) for r in one.withColumn("us", F.unix_micros("timestamp")).collect()]
    assert sorted(rows) == [(-1.25, -0.5, 0, 1786374000125000), (37.5, 127.1, 12, 1786407154000000)]
    for table in (RAW_POSITIONS, VISITS, ACTIVITIES):
        df = out[table.name].drop("traj_id")
        assert validate.check_columns(df, table) is df
        assert validate.split_rows(df, table)[1].count() == 0
    visit = out["visits"].first()
    assert (visit.latitude, visit.semantic_type, visit.probability, visit.place_probability) == (37.3, "HOME", 0.9, 0.5)
    ride = out["activities"].first()
    assert (ride.end_longitude, ride.distance, ride.activity_type, ride.activity_probability) == (127.5, 12.5, "WALKING", 0.25)


def test_readers_parse_only_their_part(spark, documents):
    plan = timeline_json.extract_all(spark, documents)["visits"]._jdf.queryExecution().toString()
    assert "rawSignals" not in plan and "distanceMeters" not in plan


def test_text_fields(spark):
    texts = spark.createDataFrame([("37,127,9",), ("37",), (" 37.5° , 127.25° ",), ("x, 1",)], "t string")
    got = [tuple(r) for r in texts.select(*(coordinate(F.col("t"), i, strict=False) for i in (0, 1))).collect()]
    assert got == [(37, 127), (37, None), (37.5, 127.25), (None, 1)]
    with pytest.raises(Exception):
        texts.select(coordinate(F.col("t"), 0)).collect()
    times = spark.createDataFrame(
        [("2026-08-11T00:00:00.000+09:00",), ("2026-08-11T00:00:00+09:00",), ("2026-08-11T00:00:00.000000+09:00",)], "t string"
    )
    got = [r[0] for r in times.select(F.unix_seconds(instant(F.col("t"), strict=False))).collect()]
    assert got == [1786374000, None, None]
    with pytest.raises(Exception):
        times.select(instant(F.col("t"))).collect()


GOOD = (37.5, 127.0, 5, datetime(2026, 8, 11))
BAD = {
    "latitude: range": (91.0, 127.0, 5, datetime(2026, 8, 11)),
    "longitude: range": (37.5, float("nan"), 5, datetime(2026, 8, 11)),
    "latitude: missing": (None, 127.0, 5, datetime(2026, 8, 11)),
    "accuracy: range": (37.5, 127.0, -1, datetime(2026, 8, 11)),
    "timestamp: missing": (37.5, 127.0, 5, None),
}


def _positions(spark, *rows):
    return spark.createDataFrame(list(rows), RAW_POSITIONS.struct)


@pytest.mark.parametrize("reason", BAD)
def test_bad_rows(spark, reason):
    df = _positions(spark, GOOD, BAD[reason])
    good, rejected = validate.split_rows(df, RAW_POSITIONS)
    assert good.count() == 1
    assert [r.reasons for r in rejected.collect()] == [[reason]]
    assert {r.rule for r in validate.violations(df, RAW_POSITIONS).collect() if r.bad_rows} == {reason}
    with pytest.raises(Exception, match=reason):
        validate.strict_rows(df, RAW_POSITIONS).collect()


def test_bad_probability_and_types(spark):
    at = datetime(2026, 8, 11)
    visit = spark.createDataFrame([(at, at, 1.0, 1.0, "HOME", 1.5, 0.0)], VISITS.struct)
    assert validate.split_rows(visit, VISITS)[1].first().reasons == ["probability: range"]
    text = _positions(spark, GOOD).withColumn("latitude", F.lit("abc"))
    assert "latitude: type" in validate.with_reasons(text.select(*RAW_POSITIONS.columns), RAW_POSITIONS).first().reasons
    whole = _positions(spark, GOOD).withColumn("latitude", F.lit(37))
    assert validate.split_rows(whole, RAW_POSITIONS)[1].count() == 0


def test_columns_must_match(spark):
    df = _positions(spark, GOOD)
    for other in (df.drop("accuracy"), df.select(*reversed(df.columns))):
        with pytest.raises(ValueError):
            validate.check_columns(other, RAW_POSITIONS)


def test_coordinates_pass_nulls_but_not_nan(spark):
    assert validate.check_coordinates(_positions(spark, GOOD, BAD["latitude: missing"]))
    with pytest.raises(ValueError, match="longitude"):
        validate.check_coordinates(_positions(spark, GOOD, BAD["longitude: range"]))
    with pytest.raises(ValueError):
        validate.check_coordinates(_positions(spark, GOOD).drop("latitude"))


@pytest.mark.parametrize("format", ["csv", "parquet"])
def test_tables_round_trip(spark, tmp_path, format):
    df = _positions(spark, GOOD, (-90.0, 180.0, 0, datetime(2026, 8, 12, 1, 2, 3, 456789)))
    path = str(tmp_path / "t")
    for _ in range(2):  # the second run replaces the first
        tables.save_table(df, path, RAW_POSITIONS, format, by_day="timestamp")
    back = tables.load_table(spark, path, RAW_POSITIONS, format)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    with pytest.raises(Exception):
        tables.save_table(_positions(spark, BAD["accuracy: range"]), str(tmp_path / "u"), RAW_POSITIONS, format)


def test_range_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.save_table(_positions(spark, GOOD), path, RAW_POSITIONS)
    df = filters.filter_points(spark.read.parquet(path), datetime(2026, 8, 11), datetime(2026, 8, 12)).select("latitude", "timestamp")
    plan = df._jdf.queryExecution().toString()
    pushed = plan[plan.index("PushedFilters"):]
    assert "GreaterThanOrEqual(timestamp,2026-08-10" in pushed and "LessThan(timestamp,20" in pushed
    assert "accuracy" not in pushed[pushed.index("ReadSchema"):]


def test_kst_bounds(spark):
    low, high = timeops.kst_range(datetime(2026, 8, 11), datetime(2026, 8, 12))
    assert low == datetime(2026, 8, 10, 15, tzinfo=timezone.utc) and high.day == 11
    assert timeops.kst_range(datetime(2026, 8, 11, tzinfo=timezone.utc), datetime(2026, 8, 12, tzinfo=timezone.utc)) == (low, high)
    assert timeops.utc_range(datetime(2026, 8, 11), datetime(2026, 8, 12))[0].hour == 9
    for f in (timeops.kst_range, timeops.utc_range):
        with pytest.raises(ValueError):
            f(datetime(2026, 8, 12), datetime(2026, 8, 12))


def test_range_ends(spark):
    day = datetime(2026, 8, 11), datetime(2026, 8, 12)
    points = spark.sql(
        "SELECT explode(array(timestamp'2026-08-10 15:00:00Z', timestamp'2026-08-11 15:00:00Z', timestamp'2026-08-11 14:59:59Z')) AS timestamp"
    )
    assert filters.filter_points(points, *day).count() == 2
    spans = spark.sql(
        """SELECT * FROM VALUES (timestamp'2026-08-10 10:00:00Z', timestamp'2026-08-10 15:00:00Z'),
           (timestamp'2026-08-11 15:00:00Z', timestamp'2026-08-11 16:00:00Z'),
           (timestamp'2026-08-10 10:00:00Z', timestamp'2026-08-12 16:00:00Z') AS t(start_time, end_time)"""
    )
    assert filters.filter_intervals(spans, *day).count() == 1
    empty = filters.filter_points(points, datetime(2030, 1, 1), datetime(2030, 1, 2))
    assert empty.count() == 0 and empty.columns == ["timestamp"]


def _line(*metres_north):
    return [(37 + m * METRE, 127.0, i * 60.0) for i, m in enumerate(metres_north)]


def _cleaned(spark, points, jump, same_place):
    df = frame(spark, {1: points})
    segmented = segments.with_segments(df, jump, None)
    context = segments.segment_context(segments.segment_means(segmented), None)
    jumps = segments.jump_segments(context, same_place, None)
    return [r.ord for r in segments.remove_jumps(df, jumps).orderBy("ord").collect()]


def test_jumps(spark):
    stay = [0, 1, 2, 3]
    assert _cleaned(spark, _line(*stay, 900, *stay), 100.0, 50.0) == [1, 2, 3, 4, 6, 7, 8, 9]
    assert _cleaned(spark, _line(900, *stay), 100.0, 50.0) == [1, 2, 3, 4, 5]
    assert _cleaned(spark, _line(*stay, 900), 100.0, 50.0) == [1, 2, 3, 4, 5]
    four = _line(*stay, 900, 901, 902, 903, *stay)
    assert _cleaned(spark, four, 100.0, 50.0) == list(range(1, 13))


def test_no_candidates_removes_nothing(spark):
    df = frame(spark, {1: _line(0, 1, 2, 3, 4, 5)})
    out = pipeline.clean_positions(df, None)
    assert out.points.count() == 6 and out.same_place_thresholds.count() == 0


def test_removed_by_time_hides_equal_times(spark):
    raw = frame(spark, {1: [(1, 1, 0), (2, 2, 0), (3, 3, 1)]})
    kept = raw.where("ord = 1")
    assert [r.ord for r in segments.removed_positions(raw, kept).orderBy("ord").collect()] == [2, 3]
    assert [r.ord for r in segments.removed_positions(raw, kept, by="timestamp").collect()] == [3]


def test_short_and_still_trajectories_are_reported(spark):
    still = [(37.0, 127.0, float(i)) for i in range(30)]
    walk = [(37 + (i * 7919 % 101) * METRE, 127.0, i * 61.5 + (i % 5) ** 3) for i in range(40)]
    df = frame(spark, {1: [(1, 1, 0)], 2: [(1, 1, 0), (1, 1, 5)], 3: still, 4: walk})
    result = pipeline.run_pipeline(df, block_rows=None)
    status = {r.traj_id: r.status for r in pipeline.summarize(result).collect()}
    assert status == {1: pipeline.TOO_SHORT, 2: pipeline.TOO_SHORT, 3: pipeline.EPS_NOT_POSITIVE, 4: pipeline.USABLE}
    kept = result.clustered.groupBy("traj_id", "status").agg(F.count("cluster_id").alias("labelled"))
    assert {r.traj_id: (r.status, r.labelled > 0) for r in kept.collect()} == {t: (s, t == 4) for t, s in status.items()}


def test_k_must_be_positive(spark):
    df = frame(spark, {1: _line(0, 1, 2)}).withColumn("k", F.lit(0))
    with pytest.raises(ValueError):
        curves.temporal_k_distances(df, 0)
