"""Benchmark decontamination in DataFrame functions only.

Benchmark texts are cut into windows of n words. A map of window hashes, whose size follows the number of
windows up to a bound, and the windows themselves go to every task. A text's windows are looked up in the map, place
by place; the few that pass are compared with the windows themselves, so every hit is exact.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import saved

# Slots (bytes) of the map: some for each window, from the first number to the second. A window takes PROBES slots,
# so that below 0.5 % of other places pass up to a million windows; more windows only let more places pass.
SLOTS, PER_WINDOW, PROBES = (1 << 18, 1 << 24), 16, 3
# Windows are broadcast up to so many bytes, beyond that joined by shuffle.
BROADCAST_BYTES = 32 << 20

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _with(value: Column, use) -> Column:
    return F.transform(F.array(value), use)[0]


def words(text: Column) -> Column:
    """Words of letters, digits and non-ASCII characters, with A-Z lowered; null has none."""
    text = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.array_remove(F.split(text, SEPARATORS), "")


def benchmark_windows(benchmark: DataFrame, n: int) -> DataFrame:
    """(window, size, items): the distinct windows of (item_id, text), with the items that have them.

    An item of fewer than n words, but not none, is one window.
    """
    items = benchmark.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    size = F.least(F.size("w"), F.lit(n))
    return (
        items.select("item_id", "w", F.explode(F.sequence(F.lit(1), F.size("w") - size + 1)).alias("i"))
        .select("item_id", F.array_join(F.slice("w", F.col("i"), size), " ").alias("window"), size.alias("size"))
        .groupBy("window", "size")
        .agg(F.collect_set(F.col("item_id").cast("string")).alias("items"))
    )



def hits(documents: DataFrame, benchmark: DataFrame, n: int = 10, key: str = "doc_id") -> DataFrame:
    """(doc_id, n_words, spans, items) of each document.

    `spans` are the sorted places [at, size] of windows (at counts words from 1), `items` the items
    found, as strings. Each row is a document, repeated rows too. Null texts have no words.
    Other columns are ignored; an empty benchmark gives no hits, an empty table no rows. A very long text is one array
    of words in one task.
    """
    windows = saved(benchmark_windows(benchmark, n))
    # At most n sizes come back.
    sizes = sorted(r["size"] for r in windows.select("size").distinct().collect())
    bitmap = window_map(windows)
    weight = windows.agg(F.sum(F.length("window") + 40 + 12 * F.size("items"))).first()[0] or 0
    table = windows.withColumnRenamed("size", "length")
    table = F.broadcast(table) if weight <= BROADCAST_BYTES else table

    docs = documents.select(
        # Numbers of rows are used within one job only, where a second try of a task gives the same.
        F.monotonically_increasing_id().alias("number"),
        F.col(key).alias("doc_id"),
        F.col("text"),
        F.xxhash64("text").alias("text_hash"),
    )
    found = docs.select(
        "number", "doc_id", "text_hash", _with(words(F.col("text")), lambda w: _candidates(w, sizes, bitmap)).alias("c")
    )
    # Texts without candidates keep one row.
    whole = ("number", "doc_id", "text_hash")
    rows = found.select(*whole, F.col("c.n_words").alias("n_words"), F.explode_outer("c.found").alias("f"))
    rows = rows.select(*whole, "n_words", F.col("f.at").alias("at"), F.col("f.window").alias("window"))
    rows = rows.join(table, "window", "left")
    return (
        rows.groupBy("number")
        .agg(
            *(F.first(c).alias(c) for c in ("doc_id", "text_hash", "n_words")),
            F.array_sort(
                F.collect_set(F.when(F.col("length").isNotNull(), F.struct("at", F.col("length").alias("size"))))
            ).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        )
        .drop("number")
    )


def window_map(windows: DataFrame) -> bytes:
    """One byte a slot: whether a window takes it. The slots are gathered as bitmaps of 4 KB."""
    slots = SLOTS[0]
    while slots < SLOTS[1] and slots < PER_WINDOW * windows.count():
        slots *= 2
    h = F.xxhash64(F.split("window", " "))
    taken = windows.select(F.explode(F.array(*(_slot(h, j, slots) for j in range(PROBES)))).alias("slot"))
    pieces = taken.groupBy(F.expr("bitmap_bucket_number(slot)").alias("piece")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(slot))").alias("bits")
    )
    out = np.zeros(slots + 1, np.uint8)
    for r in pieces.collect():
        # Piece 1 has slots 1 to 32768, and so on, the first in the lowest bit.
        bits = np.unpackbits(np.frombuffer(r["bits"], np.uint8), bitorder="little")
        first = (r["piece"] - 1) * 32768 + 1
        out[first : first + 32768] = bits[: len(out) - first]
    return out[1:].tobytes()


def _slot(h: Column, probe: int, slots: int) -> Column:
    """The slot of a hash, from 1: low bits for the first probe, steps of other bits for the next."""
    step = F.pmod(F.shiftrightunsigned(h, 32).bitwiseOR(F.lit(1)), F.lit(slots))
    return (F.pmod(F.pmod(h, F.lit(slots)) + step * probe, F.lit(slots)) + 1).cast("int")


def _candidates(w: Column, sizes: list[int], bitmap: bytes) -> Column:
    """n_words, and the places and windows that pass the map."""
    none = F.array().cast("array<struct<at:int,window:string>>")

    def passing(slots: Column) -> Column:
        return reduce(F.concat, (_passing(w, size, slots, len(bitmap)) for size in sizes), none)

    # The map is in the plan once, as each place that names it adds twice its size to all texts of the plan.
    found = _with(F.lit(bitmap), passing) if sizes else none
    return F.struct(F.size(w).cast("long").alias("n_words"), found.alias("found"))


def _passing(w: Column, size: int, slots: Column, n_slots: int) -> Column:
    places = F.when(F.size(w) >= size, F.sequence(F.lit(1), F.size(w) - size + 1)).otherwise(F.array().cast("array<int>"))
    taken = F.lit(b"\x01")

    def all_taken(h: Column) -> Column:
        probes = [F.substring(slots, _slot(h, j, n_slots), F.lit(1)) == taken for j in range(PROBES)]
        return reduce(lambda a, b: a & b, probes)

    # The hash is kept beside its place, so that it is taken once.
    hashed = F.transform(places, lambda i: F.struct(i.alias("i"), F.xxhash64(F.slice(w, i, size)).alias("h")))
    passed = F.transform(F.filter(hashed, lambda x: all_taken(x["h"])), lambda x: x["i"])
    return F.transform(
        passed, lambda i: F.struct(i.alias("at"), F.array_join(F.slice(w, i, size), " ").alias("window"))
    )


def n_hit(spans: Column) -> Column:
    """Words inside any span: sorted spans are swept, counting what lies beyond the last end."""
    start = F.struct(F.lit(0).cast("int").alias("end"), F.lit(0).cast("long").alias("n"))

    def step(s: Column, x: Column) -> Column:
        end = F.greatest(s["end"], x["at"] + x["size"] - 1)
        fresh = end - F.greatest(s["end"], x["at"] - 1)
        return F.struct(end.alias("end"), (s["n"] + fresh).cast("long").alias("n"))

    return F.aggregate(spans, start, step, lambda s: s["n"])


def clean(documents: DataFrame, benchmark: DataFrame, n: int = 10, drop_percent: int = 50) -> DataFrame:
    """The rows of `documents` without benchmark passages, with the same columns.

    Documents of whose words at least `drop_percent` percent are hit go; from others the hit
    words go, with what separates them, and the rest of the text stays as it is. Documents
    without hits, null texts among them, are untouched. n_chars, where it is a column, follows the text.
    """
    found = hits(documents, benchmark, n).where(F.size("spans") > 0)
    # Rows that agree in doc_id and text have the same spans.
    found = found.dropDuplicates(["doc_id", "text_hash"]).select(
        F.col("doc_id").alias("found_id"), F.col("text_hash").alias("found_hash"), "n_words", "spans"
    )
    # The row is one column, so that its names meet no others.
    rows = documents.select(F.struct(*documents.columns).alias("row"))
    same = F.col("row.doc_id").eqNullSafe(F.col("found_id")) & (F.xxhash64("row.text") == F.col("found_hash"))
    joined = rows.join(found, same, "left")
    hit = F.col("spans").isNotNull()
    kept = joined.where(~hit | (n_hit(F.col("spans")) * 100 < F.col("n_words") * drop_percent))
    text = F.when(hit, _without(F.col("row.text"), F.col("spans"))).otherwise(F.col("row.text"))
    out = kept.select("row", hit.alias("hit"), text.alias("text"))
    row = F.col("row").withField("text", F.col("text"))
    if "n_chars" in documents.columns:
        n_chars = F.when(F.col("hit"), F.length("text").cast("long")).otherwise(F.col("row.n_chars"))
        row = row.withField("n_chars", n_chars)
    return out.select(row.alias("row")).select("row.*")


def _without(text: Column, spans: Column) -> Column:
    """The text without the words of the spans; each word goes with the separators before it."""
    # Pieces: separators and a word each; what follows the last word stays.
    # The text is not lowered here, so A-Z are in words.
    between = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
    pieces = F.regexp_extract_all(text, F.lit(f"[{between}]*[^{between}]+"), F.lit(0))
    tail = F.regexp_extract(text, f"[{between}]*\\z", 0)
    # Merged spans, then the pieces between them.
    empty = F.array().cast("array<struct<a:int,b:int>>")

    def merge(s: Column, x: Column) -> Column:
        last = F.element_at(s, -1)
        end = x["at"] + x["size"]
        new = F.struct(x["at"].alias("a"), end.alias("b"))
        return F.when(F.size(s) == 0, F.array(new)).otherwise(
            F.when(
                x["at"] <= last["b"],
                F.concat(
                    F.slice(s, 1, F.size(s) - 1), F.array(F.struct(last["a"].alias("a"), F.greatest(last["b"], end).alias("b")))
                ),
            ).otherwise(F.concat(s, F.array(new)))
        )

    def rest(p: Column) -> Column:
        def outside(m: Column) -> Column:
            return F.array_join(
                F.transform(
                    F.sequence(F.lit(0), F.size(m)),
                    lambda i: F.array_join(
                        F.slice(
                            p,
                            F.when(i == 0, 1).otherwise(F.get(m, i - 1)["b"]),
                            F.when(i == F.size(m), F.size(p) + 1).otherwise(F.get(m, i)["a"])
                            - F.when(i == 0, 1).otherwise(F.get(m, i - 1)["b"]),
                        ),
                        "",
                    ),
                ),
                "",
            )

        return _with(F.aggregate(spans, empty, merge), outside)

    return F.concat(_with(pieces, rest), tail)
