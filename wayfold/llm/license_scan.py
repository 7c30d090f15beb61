"""License scan: winnowed fingerprints of templates pick candidates, banded alignment measures them.

Templates are whole licenses and common notices, cut into passages. Texts and templates are words of
letters and digits, lowered. Hashes of K words in a row are winnowed: of each W in a row the smallest
is a fingerprint. An inverted index gives the places of a fingerprint in the passages. Hits of a
passage on about the same diagonal are a candidate, and an alignment of words within a band around it
gives matched words and their span in the text. What tells licenses apart, names and versions, has to
stand in the span word by word. Passages of a template that follow each other in the
text are one match, be it the whole license or a part of it.
"""

from __future__ import annotations

import pkgutil
import re
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .words import LETTERS_DIGITS, grams, runs

K, W = 3, 2
# Words that an alignment may be off the diagonal of a hit.
BAND = 6
LEAST_COVERAGE = 0.8
# Fewest and most words of a passage: shorter paragraphs go with the next one, longer ones are cut evenly.
PASSAGE = (16, 32)
# Words that a text may have between two passages beyond those of the template.
GAP = 100

# Whole texts, in license_texts. Of templates that fit a passage alike the earlier one is named.
WHOLE = (
    "MIT", "Apache-2.0", "GPL-3.0", "GPL-2.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "BSD-3-Clause", "BSD-2-Clause", "ISC",
    "MPL-2.0", "MPL-1.1", "CC0-1.0", "Unlicense", "LGPL-2.0", "GPL-1.0", "GFDL-1.3", "GFDL-1.2", "Artistic-1.0",
)

# Names and versions in templates: a passage matches only where all of its own stand as they are.
KEY = re.compile(
    r"Apache License \d\.\d|CC BY(?:-\w\w)* \d\.\d|CC0|Attribution(?:-\w+)* \d\.\d|(?:MIT|ISC|BSD(?: \d-Clause)?) License|"
    r"(?:Apache|Mozilla Public|GNU (?:\w+ )?General Public) License|\b[AL]?GPL\b|\b(?:version|v\.) \d+(?:\.\d+)?".replace(
        " ", r"\s+"
    ).encode(),
    re.I,
)


def _gnu_header(work: str, name: str, version: str, mark: str) -> str:
    return (
        f"This {work} is free software{mark} you can redistribute it and/or modify it under the terms of the GNU {name} "
        f"as published by the Free Software Foundation{';' if mark == ';' else ','} either version {version} of the License, "
        f"or (at your option) any later version\n\nThis {work} is distributed in the hope that it will be useful, but "
        "WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. "
        f"See the GNU {name} for more details.\n\nYou should have received a copy of the GNU {name} along with this {work}"
    )


def _creative_commons() -> dict[str, str]:
    words = {"BY": "Attribution", "SA": "ShareAlike", "NC": "NonCommercial", "ND": "NoDerivatives"}
    found = {}
    for kind in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"):
        name = "-".join(words[x] for x in kind.split("-"))
        for version, port in (("4.0", "International"), ("3.0", "Unported")):
            # No version's text depends on the port: it may be left out.
            found[f"CC-{kind}-{version} short notice"] = f"Licensed under CC BY{kind[2:]} {version}"
            found[f"CC-{kind}-{version} long notice"] = (
                f"This work is licensed under a Creative Commons {name} {version} {port} License"
            )
    for given in ("CC-BY-NC-4.0 short", "CC-BY-4.0 long", "CC-BY-SA-4.0 long"):  # listed without a form
        del found[f"{given} notice"]
    return found


# Notices and headers of public licenses, and their whole texts.
TEMPLATES = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0 header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
    "except in compliance with the License. You may obtain a copy of the License at "
    "http://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in writing, software "
    "distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
    "either express or implied. See the License for the specific language governing permissions and limitations under "
    "the License.",
    "MIT notice": "Released under the MIT License",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3",
    "GPL-3.0 header": _gnu_header("program", "General Public License", "3", ":"),
    "LGPL-2.1 header": _gnu_header("library", "Lesser General Public License", "2.1", ";"),
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0",
    "CC-BY-4.0 notice": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-SA-4.0 notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
    "License",
    "MPL-2.0 header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy "
    "of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/",
    "Unlicense notice": "This is free and unencumbered software released into the public domain",
    "Apache-2.0 short notice": "Licensed under the Apache License 2.0",
    "BSD notice": "Released under the BSD License",
    "BSD-2-Clause notice": "Released under the BSD 2-Clause License",
    "BSD-3-Clause notice": "Released under the BSD 3-Clause License",
    "ISC notice": "Released under the ISC License",
    "MPL-2.0 notice": "Licensed under the Mozilla Public License, version 2.0",
    "GPL-2.0 notice": "This work is licensed under the GNU General Public License, version 2",
    "LGPL-2.1 notice": "This work is licensed under the GNU Lesser General Public License, version 2.1",
    "LGPL-3.0 notice": "This work is licensed under the GNU Lesser General Public License, version 3",
    "AGPL-3.0 notice": "This work is licensed under the GNU Affero General Public License, version 3",
    "GPL-2.0 header": _gnu_header("program", "General Public License", "2", ";"),
    "LGPL-3.0 header": _gnu_header("library", "Lesser General Public License", "3", ":"),
    "AGPL-3.0 header": _gnu_header("program", "Affero General Public License", "3", ":"),
} | _creative_commons() | {f"{name} text": pkgutil.get_data(__package__, f"license_texts/{name}.txt").decode() for name in WHOLE}


def winnowed(values: np.ndarray) -> np.ndarray:
    """Places of the fingerprints of a row of hashes: the smallest of each W, the last of equal ones."""
    if len(values) <= W:
        return np.arange(len(values))
    windows = np.lib.stride_tricks.sliding_window_view(values, W)
    return np.unique(np.arange(len(windows)) + W - 1 - windows[:, ::-1].argmin(axis=1))


def passages(text: str) -> list[tuple[np.ndarray, list[np.ndarray]]]:
    """The words of a template, passage by passage, and the keys of each."""
    found, held, keys = [], np.zeros(0, np.uint64), []  # keys: first word and word after the last
    for run in runs(pa.array(re.split(r"\n\s*\n", text)), LETTERS_DIGITS):
        words = run.hashes()
        for i, (a, b) in enumerate(zip(run.number[:-1], run.number[1:])):
            at = run.offsets[i]
            for m in KEY.finditer(run.data[at : run.offsets[i + 1]].tobytes()):
                first, last = np.searchsorted(run.starts, [at + m.start(), at + m.end()])
                keys.append((len(held) + first - a, len(held) + last - a))
            held = np.concatenate([held, words[a:b]])
            if len(held) >= PASSAGE[0]:
                found.append((held, keys))
                held, keys = held[:0], []
    if len(held):
        before, own = found.pop() if found else (held[:0], [])
        found.append((np.concatenate([before, held]), own + [(len(before) + x, len(before) + y) for x, y in keys]))
    parts = []
    for words, keys in found:
        begin = 0
        for part in np.array_split(words, -(-len(words) // PASSAGE[1])):
            end = begin + len(part)
            parts.append((part, [words[x:y] for x, y in keys if begin <= x and y <= end]))
            begin = end
    return parts


def _stands(key: np.ndarray, words: np.ndarray) -> bool:
    at = np.flatnonzero(words[: max(0, len(words) - len(key) + 1)] == key[0])
    return any(np.array_equal(words[i : i + len(key)], key) for i in at.tolist())


class Templates:
    def __init__(self, texts: dict[str, str]):
        self.names = list(texts)
        self.of: list[int] = []  # the template of each passage
        self.begin: list[int] = []  # and its first word there
        self.words: list[np.ndarray] = []
        self.keys: list[list[np.ndarray]] = []
        self.size: list[int] = []  # words of each template
        self.index: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for t, text in enumerate(texts.values()):
            total = 0
            for own, keys in passages(text):
                self.of.append(t)
                self.begin.append(total)
                total += len(own)
                self.words.append(own)
                self.keys.append(keys)
            self.size.append(total)
        number = np.concatenate([[0], np.cumsum([len(x) for x in self.words])]).astype(np.int64)
        values, begin = grams(np.concatenate([np.zeros(0, np.uint64), *self.words]), number, K)
        # All grams of a passage are listed, winnowed or not: those of a text are winnowed.
        for p, (a, b) in enumerate(zip(begin[:-1].tolist(), begin[1:].tolist())):
            for at, value in enumerate(values[a:b].tolist()):
                self.index[value].append((p, at))
        self.known = np.array(sorted(self.index), np.uint64)

    def matches(self, words: np.ndarray, hits: list[tuple[int, int]]) -> list[tuple[str, float, int, int]]:
        """(template, coverage, first word, word after the last) of a text, from (place, gram) hits."""
        diagonals = defaultdict(set)
        for at, value in hits:
            for p, place in self.index[value]:
                diagonals[p].add(at - place)
        found = defaultdict(set)
        for p, places in diagonals.items():
            group: list[int] = []
            taken: list[tuple[int, int]] = []
            for d in [*sorted(places), None]:
                # A group is no wider than the band, so that the work of a diagonal is bounded.
                if group and (d is None or d - group[0] > BAND):
                    for n, first, last in self._repeated(p, words, group[0] - BAND, group[-1] + BAND, taken):
                        found[self.of[p]].add((first, p, last, n))
                    group = []
                group.append(d)
        joined = []
        for t, parts in found.items():
            for first, last, n in self._joined(sorted(parts)):
                joined.append((t, min(1.0, n / self.size[t]), first, last, n))
        return [(self.names[t], *rest) for t, *rest in _without_parts(joined)]

    def _repeated(self, p: int, words: np.ndarray, low: int, high: int, taken: list[tuple[int, int]]):
        """Matches of a passage in a band, one after the other; words of a match, here or in `taken`, match no more."""
        own, begin = self.words[p], max(0, low)
        end = max(begin, min(len(words), high + len(own)))
        near = words[begin:end].copy()
        # A word that the passage does not have.
        other = next(x for x in range(len(own) + 1) if not (own == np.uint64(x)).any())
        for first, last in reversed(taken):
            if last <= begin - len(own) - 2 * BAND:
                break
            near[max(0, first - begin) : max(0, last - begin)] = other
        while True:
            n, first, last = self._aligned(p, near, low - begin, high - begin)
            if n < LEAST_COVERAGE * len(own):
                return
            near[first:last] = other
            taken.append((first + begin, last + begin))
            taken.sort()
            yield n, first + begin, last + begin

    def _aligned(self, p: int, words: np.ndarray, low: int, high: int) -> tuple[int, int, int]:
        own = self.words[p]
        # Words that the text does not have there cannot match: most candidates end here.
        near = words[max(0, low) : max(0, high + len(own))]
        if np.isin(own, near).sum() < LEAST_COVERAGE * len(own):
            return 0, -1, -1
        if not all(_stands(key, near) for key in self.keys[p]):
            return 0, -1, -1
        n, first, last = aligned(own, words, low, high)
        return (n, first, last) if all(_stands(key, words[first:last]) for key in self.keys[p]) else (0, -1, -1)

    def _joined(self, parts: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int]]:
        """(first word, word after the last, matched words) of passages (first, passage, last, matched) of one template
        that follow each other in template and text."""
        first, p, last, n = np.array(parts).T
        if self.size[self.of[p[0]]] == len(self.words[p[0]]):  # a single passage
            return list(zip(first.tolist(), last.tolist(), n.tolist()))
        begin, length = np.array(self.begin)[p], np.array([len(self.words[x]) for x in p])
        # No part that begins before can be followed.
        near = np.searchsorted(first, first - self.size[self.of[p[0]]] - GAP - 2 * PASSAGE[1])
        total, before = n.copy(), np.full(len(n), -1)
        for i in range(1, len(n)):
            j = slice(near[i], i)
            gap = first[i] - last[j]
            fits = (p[j] < p[i]) & (gap >= -BAND) & (gap <= begin[i] - begin[j] - length[j] + GAP)
            best = np.where(fits, total[j], 0)
            if len(best) and best.max() > 0:
                before[i] = near[i] + int(best.argmax())
                total[i] += best.max()
        done, free = [], np.ones(len(n), bool)
        for i in np.argsort(-total, kind="stable").tolist():
            if not free[i]:
                continue
            end, matched = last[i], 0
            while i >= 0 and free[i]:
                free[i] = False
                start, matched, end = first[i], matched + n[i], max(end, last[i])
                i = before[i]
            done.append((int(start), int(end), int(matched)))
        return done


@lru_cache(maxsize=2)
def _indexed(items: tuple[tuple[str, str], ...]) -> Templates:
    """The index of some templates, once per worker."""
    return Templates(dict(items))


def aligned(template: np.ndarray, words: np.ndarray, low: int, high: int) -> tuple[int, int, int]:
    """Longest common subsequence on diagonals low to high (text place minus template place), and its span.

    Of the longest ones, that which starts latest and ends first. Runs row by row over the template.
    """
    offsets = np.arange(low, high + 1)
    best = np.zeros(len(offsets) + 1, np.int64)  # the last entry stands for no diagonal
    start = np.full(len(offsets) + 1, -1)
    top = (0, -1, -1)
    for i in range(len(template)):
        place = i + offsets
        inside = (place >= 0) & (place < len(words))
        same = np.zeros(len(offsets), bool)
        same[inside] = words[place[inside]] == template[i]
        # Row i, diagonal d follows row i - 1 at d (a match), at d + 1 (a template word left out), or d - 1 (a text word left out).
        now, began = best.copy(), start.copy()
        now[:-1] = best[1:]
        began[:-1] = start[1:]
        matched = best[:-1] + 1
        better = same & (matched >= now[:-1])
        now[:-1][better] = matched[better]
        began[:-1][better] = np.where(best[:-1] > 0, start[:-1], place)[better]
        for d in range(1, len(offsets)):
            if now[d - 1] > now[d]:
                now[d], began[d] = now[d - 1], began[d - 1]
            elif same[d] and now[d] > top[0]:
                top = (int(now[d]), int(began[d]), int(place[d]) + 1)
        if same[0] and now[0] > top[0]:
            top = (int(now[0]), int(began[0]), int(place[0]) + 1)
        best, start = now, began
    return top


def _without_parts(found: list[tuple[int, float, int, int, int]]) -> list[tuple[int, float, int, int]]:
    """Drops matches that lie by half or more in one of more matched words, as a notice inside its header.

    Of as many matched words, that with the larger coverage (in tenths) is kept, then the earlier template.
    """
    kept: list[tuple[int, float, int, int]] = []
    # Matches that are kept, by the stretches of 256 words that they touch.
    near: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for t, coverage, first, last, _ in sorted(found, key=lambda x: (-x[4], -round(x[1], 1), x[0], x[2])):
        stretches = range(first // 256, (last - 1) // 256 + 1)
        around = {y for i in stretches for y in near[i]}
        if not any(2 * (min(last, y[1]) - max(first, y[0])) >= last - first for y in around):
            kept.append((t, coverage, first, last))
            for i in stretches:
                near[i].append((first, last))
    return sorted(kept, key=lambda x: x[2])


def licenses(documents: DataFrame, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """(doc_id, n_matches, matches) of each text: matches are (license, coverage, start, end).

    Coverage is the share of the template's words, of a whole license for those named "text", that the
    text has in passages of which it has at least LEAST_COVERAGE in order within the band; start and end
    are characters of the text. A part of a license is a match with a small coverage. Null, empty and other texts without a match have none.
    Repeated rows are scanned each; an empty table gives an empty result; other columns are ignored.
    """

    def of(batches):
        index = _indexed(tuple(templates.items()))
        for batch in batches:
            out: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for run in runs(batch.column("text"), LETTERS_DIGITS):
                words = run.hashes()
                values, begin = grams(words, run.number, K)
                place = np.minimum(np.searchsorted(index.known, values), len(index.known) - 1)
                known = np.flatnonzero(index.known[place] == values)
                owner = np.searchsorted(begin, known, "right") - 1
                for i in np.unique(owner).tolist():
                    a, b = run.number[i], run.number[i + 1]
                    first = begin[i]
                    own = known[owner == i] - first
                    prints = own[np.isin(own, _fingerprints(values[first : begin[i + 1]], own))]
                    hits = [(at, int(values[first + at])) for at in prints.tolist()]
                    text = run.data[run.offsets[i] : run.offsets[i + 1]].tobytes()
                    for name, coverage, x, y in index.matches(words[a:b], hits):
                        x, y = (int(p) - int(run.offsets[i]) for p in (run.starts[a + x], run.ends[a + y - 1]))
                        start = len(text[:x].decode())
                        out[run.first + i].append(
                            {"license": name, "coverage": coverage, "start": start, "end": start + len(text[x:y].decode())}
                        )
            kind = pa.list_(
                pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("start", pa.int64()), ("end", pa.int64())])
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(list(map(len, out)), pa.int64()), pa.array(out, kind)],
                ["doc_id", "n_matches", "matches"],
            )

    schema = "doc_id long, n_matches long, matches array<struct<license:string,coverage:double,start:long,end:long>>"
    return documents.select("doc_id", "text").mapInArrow(of, schema)


def _fingerprints(values: np.ndarray, near: np.ndarray) -> np.ndarray:
    """Fingerprints of a text around some places; those farther away are not looked at."""
    if len(values) <= W:
        return np.arange(len(values))
    at = np.unique((near[:, None] + np.arange(-W + 1, 1)[None]).ravel())
    at = at[(at >= 0) & (at <= len(values) - W)]
    windows = values[at[:, None] + np.arange(W)[None]]
    return np.unique(at + W - 1 - windows[:, ::-1].argmin(axis=1))
