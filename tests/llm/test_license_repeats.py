"""Notices in a row, and winnowing and alignment against plain restatements."""

import random

import numpy as np
import pytest

from wayfold.llm import license_scan


def _found(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.matches for r in license_scan.licenses(df).orderBy("doc_id").collect()]


@pytest.mark.parametrize("notice", ["Released under the MIT License.", license_scan.TEMPLATES["GPL-3.0 notice"],
                                    "This work is licensed under CC BY-NC 4.0."])
def test_notices_in_a_row_are_all_found(spark, notice):
    counts = [1, 2, 3, 5, 40, 1000]
    alone = _found(spark, [notice])[0]
    assert len(alone) == 1
    texts = [" ".join([notice] * k) for k in counts] + [" some other words ".join([notice] * 7), f"{notice} {notice} x {notice}"]
    for k, text, matches in zip([*counts, 7, 3], texts, _found(spark, texts)):
        assert len(matches) == k
        assert {m["license"] for m in matches} == {alone[0]["license"]}
        assert all(a["end"] <= b["start"] for a, b in zip(matches, matches[1:]))


def _plain_lcs(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_alignment_is_a_longest_common_subsequence():
    rnd = random.Random(2)
    for _ in range(150):
        a = np.array([rnd.randrange(4) for _ in range(rnd.randrange(1, 14))], np.uint64)
        b = np.array([rnd.randrange(5) for _ in range(rnd.randrange(1, 18))], np.uint64)
        n, first, last = license_scan.aligned(a, b, -len(a), len(b))
        assert n == _plain_lcs(a.tolist(), b.tolist())
        if n:
            # The span holds the match, and is as short as it can be at its end.
            assert _plain_lcs(a.tolist(), b[first:last].tolist()) == n
            assert b[last - 1] in a


def test_winnowing_takes_the_least_of_each_window():
    rnd = random.Random(6)
    for _ in range(100):
        values = np.array([rnd.randrange(9) for _ in range(rnd.randrange(1, 30))], np.uint64)
        got = license_scan.winnowed(values).tolist()
        w, want = license_scan.W, set()
        if len(values) <= w:
            assert set(got) <= set(range(len(values)))
            continue
        for i in range(len(values) - w + 1):
            window = values[i : i + w].tolist()
            want.add(i + max(j for j in range(w) if window[j] == min(window)))
        assert set(got) == want
