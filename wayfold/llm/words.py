"""Words of many texts at once, as NumPy arrays over the bytes of an Arrow column."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Texts are worked on in runs of about so many bytes; a longer text is a run of its own. Arrays of numbers
# take some 30 bytes for each byte of a run, in every worker at once.
RUN_BYTES = 1 << 19

_U = np.uint64
_MULTIPLIER = _U(0x9E3779B97F4A7C15)


def _inverse(odd: np.uint64) -> np.uint64:
    return _U(pow(int(odd), -1, 1 << 64))


_BACK = _inverse(_MULTIPLIER)
_bytes = np.arange(256)

#: Bytes inside words, by what separates them.
NOT_SPACE = ~np.isin(_bytes, [0x20, *range(0x09, 0x0E)])
LETTERS_DIGITS = (
    ((_bytes >= 0x30) & (_bytes <= 0x39)) | ((_bytes >= 0x61) & (_bytes <= 0x7A)) | ((_bytes >= 0x41) & (_bytes <= 0x5A))
) | (_bytes >= 0x80)
_LOWER = np.where((_bytes >= 0x41) & (_bytes <= 0x5A), _bytes + 0x20, _bytes).astype(np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values evenly; different values stay different."""
    x = x ^ (x >> _U(33))
    x *= _U(0xFF51AFD7ED558CCD)
    x ^= x >> _U(33)
    x *= _U(0xC4CEB9FE1A85EC53)
    x ^= x >> _U(33)
    return x


_VALUES = mix(np.arange(1, 257).astype(np.uint64) * _U(0xD6E8FEB86659FD93))[_LOWER]


@dataclass
class Run:
    """Texts `first` to `last` of a column. Words of text first + i are number[i] to number[i + 1]."""

    first: int
    last: int
    data: np.ndarray  # bytes
    offsets: np.ndarray  # of the texts in data
    starts: np.ndarray  # of the words in data
    ends: np.ndarray
    number: np.ndarray

    def hashes(self, longest: int | None = None) -> np.ndarray:
        """64-bit hashes of the words, or of their first `longest` bytes, with A-Z lowered."""
        n = len(self.data)
        ends = self.ends if longest is None else np.minimum(self.ends, self.starts + longest)
        power = np.full(n + 1, _MULTIPLIER)
        np.cumprod(power, out=power)
        upto = np.zeros(n + 1, np.uint64)
        upto[1:] = _VALUES[self.data]
        upto[1:] *= power[:n]
        np.cumsum(upto, out=upto)
        found = upto[ends] - upto[self.starts]
        # power[i] is the multiplier to the power i + 1: divide it out.
        back = power
        back.fill(_BACK)
        np.cumprod(back, out=back)
        return mix(found * back[self.starts] + (ends - self.starts).astype(np.uint64))


def runs(column: pa.Array, inside: np.ndarray = NOT_SPACE, run_bytes: int = RUN_BYTES) -> Iterator[Run]:
    """The texts of a column in runs; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + run_bytes, "right")) - 1
        last = min(max(last, first + 1), len(column))
        own = data[offsets[first] : offsets[last]]
        places = offsets[first : last + 1] - offsets[first]
        yield _run(first, last, own, places, inside)
        first = last


def _run(first: int, last: int, data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> Run:
    word = inside[data]
    begin, end = word.copy(), word.copy()
    begin[1:] &= ~word[:-1]
    end[:-1] &= ~word[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begin[edges] = word[edges]
    end[edges - 1] = word[edges - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return Run(first, last, data, offsets, starts, ends, np.searchsorted(starts, offsets))


_PLACE = mix(np.arange(1, 65).astype(np.uint64) * _U(0xA24BAED4963EE407)) | _U(1)


def grams(words: np.ndarray, number: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each n words in a row, text by text, and where each text's begin.

    `number` says where each text's words begin. Fewer than n words, but not none, are one gram.
    """
    counts = np.diff(number)
    full = np.maximum(counts - n + 1, (counts > 0).astype(counts.dtype))
    begin = np.concatenate([[0], np.cumsum(full)])
    at = np.arange(begin[-1]) + np.repeat(number[:-1] - begin[:-1], full)
    length = np.repeat(np.minimum(counts, n), full)
    padded = np.concatenate([words, np.zeros(n, np.uint64)])
    total = length.astype(np.uint64)
    short = bool((length < n).any())
    for i in range(n):
        term = padded[at + i] * _PLACE[i]
        total += np.where(length > i, term, _U(0)) if short else term
    return mix(total), begin


def distinct(values: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorts the values of each text and drops repeats."""
    values = values.copy()
    for a, b in zip(begin[:-1].tolist(), begin[1:].tolist()):
        values[a:b].sort()
    keep = np.ones(len(values), bool)
    keep[1:] = values[1:] != values[:-1]
    keep[begin[:-1][np.diff(begin) > 0]] = True
    upto = np.concatenate([[0], np.cumsum(keep)])
    return values[keep], upto[begin]
