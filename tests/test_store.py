"""Stored tables: replaced all at once, read by day, checked while they are written, parsed once."""

import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from test_tables import BAD, DOCUMENT, GOOD, _positions
from wayfold.operators import filters
from wayfold.operators.validate import violations
from wayfold.plans import pipeline
from wayfold.schemas import RAW_POSITIONS, VISITS
from wayfold.sources import tables


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _three(spark):
    return _positions(spark, GOOD, GOOD, (1.0, 2.0, 3, datetime(2026, 8, 12)))


@pytest.mark.parametrize("format", ["csv", "parquet"])
@pytest.mark.parametrize("by_day", [None, "timestamp"])
def test_failed_check_keeps_the_old_table(spark, tmp_path, format, by_day):
    path = str(tmp_path / "t")
    tables.save_table(_three(spark), path, RAW_POSITIONS, format, by_day)
    with pytest.raises(Exception, match="latitude: range"):
        tables.save_table(_positions(spark, GOOD, BAD["latitude: range"]), path, RAW_POSITIONS, format, by_day)
    assert tables.load_table(spark, path, RAW_POSITIONS, format).count() == 3


@pytest.mark.parametrize("format", ["csv", "parquet"])
def test_killed_job_keeps_the_old_table(spark, tmp_path, format):
    """What a job has written before its commit, whole or in part, is not read."""
    path = str(tmp_path / "t")
    tables.save_table(_three(spark), path, RAW_POSITIONS, format)
    _three(spark).write.format(format).save(f"{path}/version=0000000009-killed")
    assert tables.load_table(spark, path, RAW_POSITIONS, format).count() == 3
    tables.save_table(_positions(spark, GOOD), path, RAW_POSITIONS, format)
    assert tables.load_table(spark, path, RAW_POSITIONS, format).count() == 1
    gone = tables.remove_old_versions(spark, str(tmp_path))
    assert len(gone) == 2 and "t/version=0000000009-killed" in gone
    assert [d for d in os.listdir(path)] == [f"version={tables.current(spark, path).path.rpartition('version=')[2]}"]
    assert tables.load_table(spark, path, RAW_POSITIONS, format).count() == 1


def test_readers_of_an_old_version_go_on(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.save_table(_three(spark), path, RAW_POSITIONS)
    before = tables.load_table(spark, path, RAW_POSITIONS)
    tables.save_table(_positions(spark, GOOD), path, RAW_POSITIONS)
    assert (before.count(), tables.load_table(spark, path, RAW_POSITIONS).count()) == (3, 1)


def test_tables_change_together(spark, tmp_path):
    """The second table breaks a rule: the first one is written, but not current."""
    folder = str(tmp_path)
    good, bad = _three(spark), _positions(spark, BAD["timestamp: missing"])
    tables.save_tables(spark, folder, {n: tables.Part(good, RAW_POSITIONS) for n in ("a", "b", "c")})
    with pytest.raises(Exception, match="timestamp: missing"):
        tables.save_tables(spark, folder, {"a": tables.Part(_positions(spark, GOOD), RAW_POSITIONS), "b": tables.Part(bad, RAW_POSITIONS)})
    assert [tables.load_table(spark, f"{folder}/{n}", RAW_POSITIONS).count() for n in ("a", "b", "c")] == [3, 3, 3]
    tables.save_tables(spark, folder, {"a": tables.Part(_positions(spark, GOOD), RAW_POSITIONS)})
    assert [tables.load_table(spark, f"{folder}/{n}", RAW_POSITIONS).count() for n in ("a", "b", "c")] == [1, 3, 3]


def test_empty_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.save_table(_positions(spark, GOOD).limit(0), path, RAW_POSITIONS, by_day="timestamp")
    assert tables.load_table(spark, path, RAW_POSITIONS).count() == 0
    assert tables.load_range(spark, path, RAW_POSITIONS, datetime(2026, 8, 11), datetime(2026, 8, 12)).count() == 0


DAYS = datetime(2026, 8, 1), datetime(2026, 9, 20)


@pytest.fixture(scope="module")
def by_day(spark, tmp_path_factory):
    """Points every 5 hours, and visits of many lengths, of which some are long."""
    folder = str(tmp_path_factory.mktemp("days"))
    points = [(1.0, 2.0, i, DAYS[0] + timedelta(hours=5 * i)) for i in range(240)]
    spans = [(DAYS[0] + timedelta(hours=7 * i), timedelta(minutes=(i * i * i) % 9000)) for i in range(170)]
    spans += [(DAYS[0], timedelta(days=80)), (DAYS[0], timedelta(0)), (DAYS[0] + timedelta(days=3), timedelta(days=1)),
              (DAYS[0] - timedelta(days=400), timedelta(days=900))]
    visits = [(a, a + d, 1.0, 2.0, "HOME", 0.5, i / 1000) for i, (a, d) in enumerate(spans)]
    for format in ("csv", "parquet"):
        parts = {
            "points": tables.Part(spark.createDataFrame(points, RAW_POSITIONS.struct), RAW_POSITIONS, "timestamp"),
            "visits": tables.Part(spark.createDataFrame(visits, VISITS.struct), VISITS, "start_time"),
        }
        tables.save_tables(spark, f"{folder}/{format}", parts, format)
    return folder, spark.createDataFrame(points, RAW_POSITIONS.struct), spark.createDataFrame(visits, VISITS.struct)


@pytest.mark.parametrize("format", ["csv", "parquet"])
@pytest.mark.parametrize("first, hours", [(0, 24), (3, 24), (3, 1), (9.4, 100), (20, 24 * 20), (-100, 24), (-5, 24 * 300), (3.625, 0.001)])
def test_ranges_of_stored_tables(spark, by_day, format, first, hours):
    folder, points, visits = by_day
    span = DAYS[0] + timedelta(days=first), DAYS[0] + timedelta(days=first, hours=hours)
    for name, table, rows, keep in (
        ("points", RAW_POSITIONS, points, filters.filter_points),
        ("visits", VISITS, visits, filters.filter_intervals),
    ):
        got = tables.load_range(spark, f"{folder}/{format}/{name}", table, *span, format)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, keep(rows, *span).collect()))
        whole = tables.load_table(spark, f"{folder}/{format}/{name}", table, format)
        assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, rows.collect()))


def test_only_the_days_of_a_range_are_read(spark, by_day):
    folder, _, _ = by_day
    span = DAYS[0] + timedelta(days=9), DAYS[0] + timedelta(days=10)
    for name, table, most in (("points", RAW_POSITIONS, 2), ("visits", VISITS, 3)):
        found = tables.load_range(spark, f"{folder}/parquet/{name}", table, *span)
        plan = _plan(found)
        filters_ = plan[plan.index("PartitionFilters: [") :]
        assert "day" in filters_[: filters_.index("]")] and "PushedFilters: [" in plan
        files = found.select(F.input_file_name().alias("f")).distinct().collect()
        assert 0 < len({r.f.rpartition("/")[0] for r in files}) <= most
    # Without a range each interval comes from one folder, and nothing is sorted or shuffled for it.
    assert "Exchange" not in _plan(tables.load_table(spark, f"{folder}/parquet/visits", VISITS))


@pytest.mark.parametrize("format", ["csv", "parquet"])
def test_rules_are_counted_while_rows_are_stored(spark, tmp_path, format):
    df = _positions(spark, GOOD, GOOD, *BAD.values())
    counts = tables.save_tables(spark, str(tmp_path), {"t": tables.Part(df, RAW_POSITIONS, "timestamp", strict=False)}, format)
    assert counts["t"] == {r.rule: r.bad_rows for r in violations(df, RAW_POSITIONS).collect()}
    path = str(tmp_path / "t")
    assert tables.load_table(spark, path, RAW_POSITIONS, format).count() == 2
    rejected = tables.load_rejected(spark, path, RAW_POSITIONS, format).collect()
    assert sorted(r.reasons for r in rejected) == sorted(BAD)
    span = datetime(2026, 8, 1), datetime(2026, 9, 1)
    assert tables.load_range(spark, path, RAW_POSITIONS, *span, format).count() == 2


def test_documents_are_parsed_once(spark, tmp_path, monkeypatch):
    """One scan of the files, strict and lenient; a row that breaks a rule, and a document that can't be read."""
    source = tmp_path / "in"
    source.mkdir()
    for n in range(3):
        (source / f"{n}.json").write_text(json.dumps(DOCUMENT))
    scans = []
    read = pipeline.read_documents
    monkeypatch.setattr(pipeline, "read_documents", lambda *a: scans.append(read(*a)) or scans[-1])
    written = []
    saved = pipeline.saved
    monkeypatch.setattr(pipeline, "saved", lambda df, **k: written.append(_plan(df)) or saved(df, **k))
    out, expected = str(tmp_path / "out"), {"raw_positions": 6, "timeline_paths": 3, "visits": 3, "activities": 3}
    pipeline.store_all(spark, str(source), out)

    def stored():
        keys = {t.name: tables.keyed(t, traj_id=T.StringType()) for t in pipeline.READERS}
        return {n: tables.load_table(spark, f"{out}/{n}", t).count() for n, t in keys.items()}

    assert stored() == expected
    assert len(scans) == 1 and sum(p.count("FileScan json") for p in written) == 1
    (source / "cut.json").write_text(json.dumps(DOCUMENT)[:-30])
    with pytest.raises(Exception):
        pipeline.store_all(spark, str(source), out)
    assert stored() == expected
    far = json.dumps(DOCUMENT, ensure_ascii=False).replace("-1.25°, -0.5°", "95.25°, -0.5°")
    (source / "far.json").write_text(far)
    written.clear()
    counts = pipeline.store_all(spark, str(source), out, strict=False)
    assert sum(p.count("FileScan json") for p in written) == 1
    assert stored() == {"raw_positions": 7, "timeline_paths": 4, "visits": 4, "activities": 4}
    assert counts["raw_positions"]["latitude: range"] == 1 and not any(counts["visits"].values())
    key = tables.keyed(RAW_POSITIONS, traj_id=T.StringType())
    lost = tables.load_rejected(spark, f"{out}/raw_positions", key).collect()
    assert [(r.latitude, r.reasons) for r in lost] == [(95.25, "latitude: range")]
    assert spark.read.parquet(f"{out}/visits_unreadable").count() == 1


def test_documents_without_parts(spark, tmp_path):
    for n, text in enumerate(('{}', '{"rawSignals": []}', '{"semanticSegments": [{"timelinePath": null}]}', '{"rawSignals": [{"position": null}]}')):
        (tmp_path / f"{n}.json").write_text(text)
    (tmp_path / "good.json").write_text(json.dumps(DOCUMENT))
    read = pipeline.read_documents(spark, str(tmp_path), pipeline.ALL_JSON)
    rows = pipeline.all_rows(read)
    assert {r.table_name: r["count"] for r in rows.groupBy("table_name").count().collect()} == {
        "raw_positions": 2, "timeline_paths": 1, "visits": 1, "activities": 1
    }
