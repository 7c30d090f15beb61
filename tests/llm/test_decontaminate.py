"""Decontamination: maps of other sizes, repeated rows and clashing names."""

from collections import Counter

from pyspark.sql import functions as F

from wayfold.llm import decontaminate


# --- decontamination at other sizes and with other columns -------------------------


def test_few_places_pass_the_map_of_a_million_windows(spark):
    """The map grows with the windows: of places outside the benchmark below one in a hundred pass."""
    window = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(4)), lambda i: F.hex(F.xxhash64(F.col("id"), i))), " ")
    windows = spark.range(1_000_000).select(window.alias("window"))
    bitmap = decontaminate.window_map(windows)
    assert len(bitmap) == decontaminate.SLOTS[1]

    def passing(df):
        h = F.xxhash64(F.split("window", " "))
        probes = [F.substring(F.lit(bitmap), decontaminate._slot(h, j, len(bitmap)), F.lit(1)) == F.lit(b"\x01") for j in range(decontaminate.PROBES)]
        return df.where(probes[0] & probes[1] & probes[2]).count()

    assert passing(windows.limit(20_000)) == 20_000
    others = spark.range(2_000_000, 2_050_000).select(window.alias("window"))
    assert passing(others) < 500
    small = decontaminate.window_map(windows.limit(100))
    assert len(small) == decontaminate.SLOTS[0] and 200 < sum(small) <= 300


def test_repeated_rows_and_clashing_names(spark):
    """Each row is a document, in `hits` and in `clean`; columns with names used inside come back as they were."""
    words = [f"w{i}" for i in range(40)]
    passage = " ".join(words[:12])
    texts = [(1, "clean " * 30), (2, f"{'pad ' * 40}{passage} end"), (2, f"{'pad ' * 40}{passage} end"), (3, passage), (3, passage), (None, passage), (4, None)]
    extra = {c: F.lit(c) for c in ("_hash", "_id", "_text", "_words", "_spans", "row", "spans", "n_words", "number", "found_id", "found_hash", "hit")}
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumns(extra)
    items = spark.createDataFrame([("a", passage)], "item_id string, text string")
    got = decontaminate.hits(docs, items, 10).select("doc_id", F.size("spans").alias("n")).collect()
    assert Counter(map(tuple, got)) == Counter([(1, 0), (2, 3), (2, 3), (3, 3), (3, 3), (None, 3), (4, 0)])
    out = decontaminate.clean(docs, items, 10)
    assert out.columns == docs.columns
    rows = out.collect()
    assert Counter((r.doc_id, r.text and r.text[-8:]) for r in rows) == Counter({(1, " clean "[-8:] and ("clean " * 30)[-8:]): 1, (2, " pad end"): 2, (4, None): 1})
    assert all(r[c] == c for r in rows for c in extra)


def test_plans_do_not_spell_out_the_map(spark):
    """Spark keeps the text of every plan in the driver's memory; the map is far larger than the rest of it."""
    items = spark.createDataFrame([("a", " ".join(f"w{i}" for i in range(12))), ("b", "one two")], "item_id string, text string")
    docs = spark.createDataFrame([(1, "w0 one two " + "w3 " * 9)], "doc_id long, text string")
    found = decontaminate.hits(docs, items, 10)
    assert len(found._jdf.queryExecution().executedPlan().toString()) < decontaminate.SLOTS[0] / 4
    assert found.first()["items"] == ["b"]
