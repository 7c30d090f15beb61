"""Broken input fails or is listed, checks cannot be pruned, and preconditions hold."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from test_tables import BAD, DOCUMENT, GOOD
from wayfold.functions.parsing import coordinate
from wayfold.operators import cells, curves, mobility, segments
from wayfold.plans import pipeline
from wayfold.schemas import RAW_POSITIONS, RAW_SIGNALS_JSON
from wayfold.session import require_utc
from wayfold.sources import tables, timeline_json


def _broken(kind):
    text = json.dumps(DOCUMENT)
    if kind == "cut":
        return text[:-200]
    return text.replace('"accuracyMeters": 12', f'"accuracyMeters": {kind}')


@pytest.mark.parametrize("kind, reason", [("cut", "not a JSON document"), ('"abc"', "a field of the wrong type"),
                                          ("12.5", "a field of the wrong type")])
def test_broken_documents(spark, tmp_path, kind, reason):
    (tmp_path / "good.json").write_text(json.dumps(DOCUMENT))
    (tmp_path / "bad.json").write_text(_broken(kind))
    texts = spark.createDataFrame([("good", json.dumps(DOCUMENT)), ("bad", _broken(kind))], "traj_id string, text string")
    for strict in (True, False):
        for documents in (
            timeline_json.read_documents(spark, str(tmp_path), RAW_SIGNALS_JSON, strict),
            timeline_json.parse_documents(texts, RAW_SIGNALS_JSON, strict),
        ):
            if strict:
                with pytest.raises(Exception):
                    timeline_json.raw_positions(documents).count()
            else:
                assert timeline_json.raw_positions(documents, strict=False).count() == 2
                lost = timeline_json.rejected_documents(documents).collect()
                assert [("bad" in r.traj_id, r.reason) for r in lost] == [(True, reason)]


@pytest.mark.parametrize("format", ["csv", "parquet"])
def test_strict_checks_are_not_pruned(spark, tmp_path, format):
    df = spark.createDataFrame([GOOD, BAD["latitude: range"]], RAW_POSITIONS.struct)
    writer = df.write.format(format)
    (writer.options(**tables._CSV) if format == "csv" else writer).save(str(tmp_path / "t"))
    back = tables.load_table(spark, str(tmp_path / "t"), RAW_POSITIONS, format)
    for use in (lambda d: d.count(), lambda d: d.select("longitude").collect(), lambda d: d.agg(F.max("timestamp")).collect()):
        with pytest.raises(Exception, match="latitude: range"):
            use(back)


def test_temporal_distances_in_any_row_order(spark):
    times = [0, 100, 50, 300, 20, 400]
    rows = [(1, i + 1, datetime.fromtimestamp(t), 2) for i, t in enumerate(times)]
    df = spark.createDataFrame(rows, "traj_id long, ord long, timestamp timestamp, k int")
    got = curves.temporal_k_distances(df, 2).orderBy("ord").collect()
    assert [r.k_distance for r in got] == [50, 80, 50, 200, 30, 300]


def test_preconditions(spark):
    df = spark.createDataFrame([(1, 1, 95.0, 0.0)], "traj_id long, ord long, latitude double, longitude double")
    with pytest.raises(Exception, match="not a place"):
        cells.with_search_limits(df, 60.0, 60.0, 2).collect()
    good = df.withColumn("latitude", F.lit(5.0))
    limits = spark.createDataFrame([(1, -5.0, 10.0, 0)], "traj_id long, e double, t double, m long")
    with pytest.raises(Exception, match="too small"):
        cells.with_search_limits(good, "e", "t", "m", limits).collect()
    with pytest.raises(ValueError):
        pipeline.run_pipeline(good, start=datetime(2024, 1, 8))
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Seoul")
        with pytest.raises(ValueError):
            require_utc(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_numbers_of_coordinates(spark):
    texts = spark.createDataFrame([("37.1d, 1f",), ("NaN, Infinity",), ("-1.5e1, .5",)], "t string")
    got = [tuple(r) for r in texts.select(*(coordinate(F.col("t"), i, strict=False) for i in (0, 1))).collect()]
    assert got == [(None, None), (None, None), (-15.0, 0.5)]


def test_store_all(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "good.json").write_text(json.dumps(DOCUMENT))
    (source / "cut.json").write_text(_broken("cut"))
    out = str(tmp_path / "out")
    with pytest.raises(Exception):
        pipeline.store_all(spark, str(source), out)
    pipeline.store_all(spark, str(source), out, strict=False)
    key = tables.keyed(RAW_POSITIONS, traj_id=T.StringType())
    assert tables.load_table(spark, f"{out}/raw_positions", key).count() == 2
    assert spark.read.parquet(f"{out}/raw_positions_unreadable").count() == 1


def test_coordinates_out_of_range_fail_everywhere(spark):
    """Gap distances, the cleaning that starts with them, and temporal distances; missing coordinates pass."""
    rows = [(1, i + 1, i + 1, 95.0 if i == 2 else 10.0, 5.0, datetime.fromtimestamp(60 * i), 2) for i in range(5)]
    df = spark.createDataFrame(
        rows, "traj_id long, ord long, point_id long, latitude double, longitude double, timestamp timestamp, k int"
    )
    for use in (segments.distance_to_next, lambda d: curves.temporal_k_distances(d, 2), lambda d: pipeline.clean_positions(d).points):
        with pytest.raises(Exception, match="not a place"):
            use(df).collect()
    missing = df.withColumn("latitude", F.when(F.col("latitude") < 90, F.col("latitude")))
    gaps = [r.distance_to_next for r in segments.distance_to_next(missing).orderBy("ord").collect()]
    assert gaps == [0, None, None, 0, None]


def test_dwell_by_day_adds_up(spark):
    """Stays cut at midnight in Seoul, 15:00 UTC, with fractions of seconds; whole seconds add up."""
    spans = [
        (1, 1, "2026-08-10 14:59:58.7", "2026-08-10 15:00:01.2"),
        (1, 2, "2026-08-11 01:00:00", "2026-08-11 02:00:00.9"),
        (2, 1, "2026-08-09 15:00:00", "2026-08-13 15:00:00"),
        (3, 1, "2026-08-09 15:00:00", "2026-08-09 15:00:00"),
    ]
    stays = spark.createDataFrame(spans, "traj_id long, cluster_id int, a string, b string").select(
        "traj_id", F.col("a").cast("timestamp").alias("start_time"), F.col("b").cast("timestamp").alias("end_time")
    )
    got = {(r.traj_id, str(r.day)): r.dwell_seconds for r in mobility.daily_dwell(stays).collect()}
    assert got == {
        (1, "2026-08-10"): 1, (1, "2026-08-11"): 1 + 3600,
        (2, "2026-08-10"): 86400, (2, "2026-08-11"): 86400, (2, "2026-08-12"): 86400, (2, "2026-08-13"): 86400, (2, "2026-08-14"): 0,
        (3, "2026-08-10"): 0,
    }
