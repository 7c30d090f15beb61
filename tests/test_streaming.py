"""Documents that arrive over time end in the same tables, each row once."""

import json

from test_tables import DOCUMENT
from wayfold.schemas import RAW_POSITIONS
from wayfold.streaming.ingest import store_new_rows, stream_documents


def test_new_documents_are_appended(spark, tmp_path):
    folder, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    folder.mkdir()
    bad = json.loads(json.dumps(DOCUMENT))
    bad["rawSignals"][0]["position"]["LatLng"] = "97.5°, 127.1°"
    for name, document in (("one", DOCUMENT), ("two", bad)):
        (folder / f"{name}.json").write_text(json.dumps(document))
        query = store_new_rows(stream_documents(spark, str(folder), RAW_POSITIONS), RAW_POSITIONS, out, state)
        query.awaitTermination(120)
    good, rejected = (spark.read.parquet(f"{out}/{kind}") for kind in ("good", "rejected"))
    assert good.count() == 3
    assert [(r.latitude, r.reasons) for r in rejected.collect()] == [(97.5, ["latitude: range"])]


def test_unreadable_documents_and_another_checkpoint(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    text = json.dumps(DOCUMENT)
    (folder / "good.json").write_text(text)
    (folder / "cut.json").write_text(text[:-200])
    for state in ("first", "second"):
        store_new_rows(
            stream_documents(spark, str(folder), RAW_POSITIONS), RAW_POSITIONS, out, str(tmp_path / state)
        ).awaitTermination(120)
    # Each checkpoint takes all documents, and neither replaces the other's rows.
    assert spark.read.parquet(f"{out}/good").count() == 4
    lost = spark.read.parquet(f"{out}/unreadable").collect()
    assert [(r.traj_id.endswith("cut.json"), r.reason) for r in lost] == [(True, "not a JSON document")] * 2
