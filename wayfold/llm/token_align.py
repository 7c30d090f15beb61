"""How the tokens of two tokenizers lie over each other, in every text and in the whole corpus.

A is a byte-level vocabulary, B one of pieces with byte fallback. Texts are cut where tokens of both end; a token
of A and one of B are linked where their byte ranges overlap, and a pair of ids counts as often as it is linked.

Identity map. `same` holds for every id of A the id of B with the same bytes. Groups of one token each that `same`
predicts are counted in a vector as long as A's vocabulary; only links of other, irregular groups are counted as pairs.

Neither tokenizer joins anything across a space that follows a character other than white space: A's word pattern
takes white space only at the front of a word, and no piece of B has a space behind another character. So a
text is a row of units, cut there, and a worker aligns each different unit once.

Counts come back to the texts in two ways. The vector and the most frequent irregular pairs, up to HOT_PAIRS of them,
are sent to all tasks. Rarer pairs are joined by shuffle, as (row, pair) of the texts that hold them; being rare
they are no hot keys.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import saved
from .tokens import _byte_letters

# Irregular pairs that are sent to all tasks: 17 bytes each.
HOT_PAIRS = 1 << 18
# Links that a worker's table of units holds before it is emptied, and characters of a text worked on at once.
TABLE_LINKS = 2_000_000
PIECE = 1 << 21
# Characters of units that are tokenized as one text.
TOGETHER = 1 << 14
# Fixed value: the word pattern of byte-level vocabularies.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SPACE = "▁"


@dataclass(frozen=True)
class Files:
    """Paths of the two vocabularies; they are installed on every machine."""

    a: str
    b: str


def default_files() -> Files:
    import public_tokenizers

    return Files(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


class Vocabularies:
    """Both tokenizers, the bytes of their ids, and `same`: B's id for the bytes of each id of A, or -1."""

    def __init__(self, files: Files):
        import json

        import sentencepiece
        import tiktoken

        with open(files.a, encoding="utf-8") as file:
            told = json.load(file)
        if told["normalizer"] or told["pre_tokenizer"]["type"] != "ByteLevel" or told["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError(f"{files.a} is no plain byte-level vocabulary")
        back = {letter: byte for byte, letter in _byte_letters().items()}
        ranks = {bytes(back[c] for c in token): i for token, i in told["model"]["vocab"].items() if all(c in back for c in token)}
        # Ids of such vocabularies are the ranks of their merges; special tokens are left out, so their strings are text.
        special = {x["id"] for x in told["added_tokens"]}
        ranks = {x: i for x, i in ranks.items() if i not in special}
        self.a = tiktoken.Encoding("a", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
        self.bytes_a = [b""] * (1 + max([*ranks.values(), *special]))
        for token, i in ranks.items():
            self.bytes_a[i] = token
        self.b = sentencepiece.SentencePieceProcessor(model_file=files.b)
        self.bytes_b, known = [], {}
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            single = self.b.is_byte(i)
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if single else piece.replace(_SPACE, " ").encode())
            if not (self.b.is_control(i) or self.b.is_unknown(i)) and not (single and self.bytes_b[i] in known):
                known[self.bytes_b[i]] = i
        self.same = np.array([known.get(x, -1) for x in self.bytes_a], np.int64)
        self.length_a = np.array([len(x) for x in self.bytes_a])
        self.length_b = np.array([len(x) for x in self.bytes_b])

    def ids(self, text: str) -> tuple[list[int], list[int], bool]:
        """Ids of space + text (B adds the space itself), and whether both are its bytes."""
        a, b, raw = self.a.encode_ordinary(" " + text), self.b.encode(text), b" " + text.encode()
        whole = b"".join([self.bytes_a[i] for i in a]) == raw == b"".join([self.bytes_b[i] for i in b])
        return a, b, whole


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """The text in pieces of about `size` characters, cut at spaces behind other characters; the space goes."""
    begin = 0
    while len(text) - begin > size:
        at = text.find(" ", begin + size)
        while at > 0 and text[at - 1].isspace():
            at = text.find(" ", at + 1)
        # What follows must not be empty: a space at the very end stays with its piece.
        if at < 0 or at == len(text) - 1:
            break
        yield text[begin:at]
        begin = at + 1
    yield text[begin:]


def units(piece: str) -> list[str]:
    """The piece cut at spaces behind characters other than white space."""
    parts = piece.split(" ")
    if not any(not p or p[-1].isspace() for p in set(parts)):
        return parts
    out, held = [], []
    for p in parts:
        held.append(p)
        if p and not p[-1].isspace():
            out.append(" ".join(held))
            held = []
    if held:
        # White space at the end stays with the last unit.
        out[-1:] = [" ".join([*out[-1:], *held])]
    return out


@dataclass
class Aligned:
    """Links of some units: those of unit i are begin[i] to begin[i + 1]. `regular` tells links of `same`."""

    ok: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    begin: np.ndarray
    a: np.ndarray
    b: np.ndarray
    regular: np.ndarray
    groups: list[str] | None


def _tokens(v: Vocabularies, some: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all units by A and by B, one after the other, and which units are whole; others give none.

    Units are tokenized many at once: a space behind other characters ends words of both, see above.
    """
    ids_a, ids_b, ok = [], [], np.ones(len(some), bool)
    first = 0
    while first < len(some):
        last, size = first, 0
        while last < len(some) and size < TOGETHER:
            size += len(some[last]) + 1
            last += 1
            if some[last - 1][-1:].isspace():
                break
        a, b, whole = v.ids(" ".join(some[first:last]))
        if whole:
            ids_a.append(a)
            ids_b.append(b)
        else:
            for i in range(first, last):
                a, b, ok[i] = v.ids(some[i])
                if ok[i]:
                    ids_a.append(a)
                    ids_b.append(b)
        first = last
    return *(np.concatenate([np.array(x, np.int64) for x in [[], *ids]]).astype(np.int64) for ids in (ids_a, ids_b)), ok


def aligned(v: Vocabularies, some: list[str], spell: bool = False) -> Aligned:
    """Aligns units. Units whose bytes are not those of their tokens are not ok and have no links."""
    a, b, ok = _tokens(v, some)
    # Units one after the other: a unit's end is an end of both, so that no group spans two units.
    end_a, end_b = np.cumsum(v.length_a[a]), np.cumsum(v.length_b[b])
    sizes = np.array([1 + len(u) if u.isascii() else 1 + len(u.encode()) for u in some], np.int64)
    unit_end = np.cumsum(np.where(ok, sizes, 0))
    n_a, n_b = (np.diff(np.searchsorted(end, np.concatenate([[0], unit_end]), "right")) for end in (end_a, end_b))
    cuts = np.intersect1d(end_a, end_b, assume_unique=True)
    n_groups = np.diff(np.searchsorted(cuts, np.concatenate([[0], unit_end]), "right"))
    group_a, group_b = np.searchsorted(cuts, end_a), np.searchsorted(cuts, end_b)
    size_a, size_b = np.bincount(group_a, minlength=len(cuts)), np.bincount(group_b, minlength=len(cuts))
    # Each place where a token of either begins is one link: of the tokens that cover it.
    start = np.union1d(end_a - v.length_a[a], end_b - v.length_b[b])
    at_a, at_b = np.searchsorted(end_a, start, "right"), np.searchsorted(end_b, start, "right")
    link_a, link_b, of = a[at_a], b[at_b], group_a[at_a]
    regular = (size_a[of] == 1) & (size_b[of] == 1) & (v.same[link_a] == link_b)
    begin = np.searchsorted(start, np.concatenate([[0], unit_end]))
    texts = _spelled(a, b, group_a, group_b, n_groups, len(cuts)) if spell else None
    return Aligned(ok, n_a, n_b, n_groups, begin, link_a, link_b, regular, texts)


def _spelled(a, b, group_a, group_b, n_groups: np.ndarray, count: int) -> list[str]:
    """The groups of each unit as text."""
    sides = []
    for ids, group in ((a, group_a), (b, group_b)):
        bounds = np.searchsorted(group, np.arange(count + 1)).tolist()
        words = list(map(str, ids.tolist()))
        sides.append([words[x] if y - x == 1 else ",".join(words[x:y]) for x, y in zip(bounds, bounds[1:])])
    groups = [f"{x}|{y}" for x, y in zip(*sides)]
    ends = np.cumsum(n_groups).tolist()
    return [";".join(groups[x:y]) for x, y in zip([0, *ends], ends)]


_vocabularies: dict[Files, Vocabularies] = {}


def vocabularies(files: Files) -> Vocabularies:
    """The worker's own vocabularies."""
    if files not in _vocabularies:
        _vocabularies[files] = Vocabularies(files)
    return _vocabularies[files]


class _Column:
    """An array that grows at its end."""

    def __init__(self, kind: type):
        self.data, self.size = np.zeros(1024, kind), 0

    def append(self, more: np.ndarray) -> None:
        if self.size + len(more) > len(self.data):
            grown = np.zeros(max(2 * len(self.data), self.size + len(more)), self.data.dtype)
            grown[: self.size] = self.data[: self.size]
            self.data = grown
        self.data[self.size : self.size + len(more)] = more
        self.size += len(more)

    @property
    def all(self) -> np.ndarray:
        return self.data[: self.size]


class _Units:
    """The different units that a task has met, and their links; `held` adds what the corpus knows of them."""

    def __init__(self, v: Vocabularies, held: Corpus | None = None, limit: int = TABLE_LINKS):
        self.v, self.held, self.limit = v, held, limit
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.groups: list[str] = []
        self.of_unit = {n: _Column(np.int64) for n in ("n_a", "n_b", "n_groups", "links", "best", "total")}
        self.ok, self.cold = _Column(bool), _Column(bool)
        self.a, self.b, self.regular = _Column(np.int64), _Column(np.int64), _Column(bool)
        self.begin = _Column(np.int64)

    @property
    def full(self) -> bool:
        return self.a.size > self.limit

    def rows(self, some: list[str]) -> list[np.ndarray]:
        """Numbers of the units of each piece."""
        cut = pc.split_pattern(pa.array(some, pa.large_string()), " ")
        coded = cut.flatten().dictionary_encode()
        parts, code = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)
        ends = cut.offsets.to_numpy().tolist()
        # Parts that end in white space belong to what follows: their pieces are cut in full.
        open_ = np.array([not p or p[-1].isspace() for p in parts], bool)
        odd = {}
        if open_.any():
            holds = np.concatenate([[0], np.cumsum(open_[code])])
            odd = {i: units(some[i]) for i, (x, y) in enumerate(zip(ends, ends[1:])) if holds[y] > holds[x]}
        known = self.number
        new = {u: None for u, held in zip(parts, open_.tolist()) if not held and u not in known}
        new |= {u: None for row in odd.values() for u in row if u not in known}
        if new:
            self._add(list(new))
        # Open parts occur in odd pieces only, whose numbers are looked up one by one.
        number = np.array([known.get(u, -1) for u in parts], np.int64)[code]
        return [
            np.array([known[u] for u in odd[i]], np.int64) if i in odd else number[x:y]
            for i, (x, y) in enumerate(zip(ends, ends[1:]))
        ]

    def _add(self, new: list[str]) -> None:
        found = aligned(self.v, new, self.held is not None)
        self.number.update(zip(new, range(len(self.number), len(self.number) + len(new))))
        links = np.diff(found.begin)
        for name, more in (("n_a", found.n_a), ("n_b", found.n_b), ("n_groups", found.n_groups), ("links", links)):
            self.of_unit[name].append(more)
        self.begin.append(found.begin[:-1] + self.a.size)
        for column, more in ((self.ok, found.ok), (self.a, found.a), (self.b, found.b), (self.regular, found.regular)):
            column.append(more)
        if self.held is not None:
            total, best, cold = _totals(found, self.held)
            self.of_unit["total"].append(total)
            self.of_unit["best"].append(best)
            self.cold.append(cold)
            self.groups += found.groups


def _steps(texts: list[str | None], most: int) -> Iterator[list[tuple[int, str]]]:
    """(number of the text, piece) of texts that are not empty, about `most` characters at once."""
    step, size = [], 0
    for i, text in enumerate(texts):
        for piece in pieces(text, most) if text else ():
            step.append((i, piece))
            size += len(piece)
            if size >= most:
                yield step
                step, size = [], 0
    if step:
        yield step


def _plain(table: _Units, text: str, most: int) -> bool:
    """Whether a text of several pieces has the bytes of its tokens."""
    for piece in pieces(text, most):
        row = table.rows([piece])[0]
        if not table.ok.all[row].all():
            return False
        if table.full:
            table.clear()
    return True


def _counted(files: Files):
    """Counts of links of the texts: (a, null, n) from the vector, (a, b, n) of irregular groups.

    Tokens that are not the text's bytes are fewer bytes, so a text is whole if all its units are.
    """
    most, limit = PIECE, TABLE_LINKS

    def told(table: _Units, times: np.ndarray) -> pa.RecordBatch:
        a, b, regular = table.a.all, table.b.all, table.regular.all
        weight = np.repeat(times, table.of_unit["links"].all)
        vector = np.zeros(len(table.v.same), np.int64)
        np.add.at(vector, a[regular], weight[regular])
        odd = ~regular & (weight > 0)
        pair, place = np.unique(a[odd] << 16 | b[odd], return_inverse=True)
        n = np.zeros(len(pair), np.int64)
        np.add.at(n, place, weight[odd])
        used = np.flatnonzero(vector)
        partner = np.concatenate([np.zeros(len(used), np.int64), pair & 0xFFFF])
        columns = [
            pa.array(np.concatenate([used, pair >> 16])),
            pa.array(partner, mask=np.arange(len(partner)) < len(used)),
            pa.array(np.concatenate([vector[used], n])),
        ]
        return pa.record_batch(columns, ["a", "b", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, times = _Units(vocabularies(files), None, limit), _Column(np.int64)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            long = {i for i, t in enumerate(texts) if t and len(t) > most}
            if long:
                # Several pieces: find out first whether the text is whole, with a table of its own.
                apart = _Units(table.v, None, limit)
                texts = [t if i not in long or _plain(apart, t, most) else None for i, t in enumerate(texts)]
            for step in _steps(texts, most):
                rows = [r for r in table.rows([piece for _, piece in step]) if table.ok.all[r].all()]
                times.append(np.zeros(table.ok.size - times.size, np.int64))
                if rows:
                    times.all[:] += np.bincount(np.concatenate(rows), minlength=times.size)
                if table.full:
                    yield told(table, times.all)
                    table.clear()
                    times = _Column(np.int64)
        if times.size:
            yield told(table, times.all)

    return run


@dataclass(frozen=True)
class Corpus:
    """Counts of pairs that tasks hold: per id of A count and whether best of its pair of `same`, and sorted frequent pairs."""

    count: np.ndarray
    best: np.ndarray
    pair: np.ndarray
    pair_count: np.ndarray
    pair_best: np.ndarray


class _Told:
    """What one text has been found to hold so far."""

    def __init__(self):
        self.sums, self.digest, self.rare, self.whole, self.begun = [0] * 6, hashlib.sha256(), {}, True, False

    def add(self, table: _Units, row: np.ndarray) -> None:
        self.whole = self.whole and bool(table.ok.all[row].all())
        if not self.whole:
            return
        names = ("n_a", "n_b", "n_groups", "links", "best", "total")
        self.sums = [x + int(table.of_unit[n].all[row].sum()) for x, n in zip(self.sums, names)]
        self.digest.update((";" * self.begun + ";".join([table.groups[i] for i in row.tolist()])).encode())
        self.begun = True
        cold = row[table.cold.all[row]]
        if len(cold):
            for pair, n in _rare(table, cold):
                self.rare[pair] = self.rare.get(pair, 0) + n

    def row(self) -> tuple:
        if not (self.whole and self.begun):
            return (0, 0, 0, 0, 0, 0, "", [], [])
        return (*self.sums, self.digest.hexdigest(), list(self.rare), list(self.rare.values()))


def _described(files: Files, corpus):
    """Per text the columns, and the pairs whose counts are not at hand, each with its number of links."""
    most, limit = PIECE, TABLE_LINKS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _Units(vocabularies(files), corpus.value, limit)
        for batch in batches:
            told = [_Told() for _ in range(len(batch))]
            for step in _steps(batch.column(1).to_pylist(), most):
                for (i, _), row in zip(step, table.rows([piece for _, piece in step])):
                    told[i].add(table, row)
                if table.full:
                    table.clear()
            columns = list(zip(*(t.row() for t in told))) or [()] * 9
            kinds = [pa.int64()] * 6 + [pa.string()] + [pa.list_(pa.int64())] * 2
            yield pa.record_batch([batch.column(0), *(pa.array(list(c), k) for c, k in zip(columns, kinds))], _COLUMNS)

    return run


_COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "rare", "rare_n"]


def _looked_up(known: Aligned, held: Corpus) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Count and best of each link, and whether they are at hand."""
    pair = known.a << 16 | known.b
    at = np.minimum(np.searchsorted(held.pair, pair), max(len(held.pair) - 1, 0))
    there = held.pair[at] == pair if len(held.pair) else np.zeros(len(pair), bool)
    count, best = held.count[known.a].copy(), held.best[known.a].copy()
    odd = ~known.regular
    count[odd] = np.where(there[odd], held.pair_count[at[odd]], 0) if len(held.pair) else 0
    best[odd] = np.where(there[odd], held.pair_best[at[odd]], False) if len(held.pair) else False
    return count, best, known.regular | there


def _totals(known: Aligned, held: Corpus) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per unit: counts at hand, best links at hand, and whether some are not at hand."""
    count, best, there = _looked_up(known, held)

    def per_unit(x: np.ndarray) -> np.ndarray:
        upto = np.concatenate([[0], np.cumsum(x.astype(np.int64))])
        return np.diff(upto[known.begin])

    return per_unit(count), per_unit(best), per_unit(~there) > 0


def _rare(table: _Units, cold: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pairs of some units that are not at hand, with their number of links."""
    unit, times = np.unique(cold, return_counts=True)
    begin, size = table.begin.all[unit], table.of_unit["links"].all[unit]
    first = np.concatenate([[0], np.cumsum(size)])[:-1]
    at = np.arange(size.sum()) + np.repeat(begin - first, size)
    pair, weight = table.a.all[at] << 16 | table.b.all[at], np.repeat(times, size)
    held = table.held.pair
    place = np.searchsorted(held, pair)
    there = held[np.minimum(place, len(held) - 1)] == pair if len(held) else np.zeros(len(pair), bool)
    odd = ~table.regular.all[at] & ~there
    return zip(pair[odd].tolist(), weight[odd].tolist())


def pair_counts(docs: DataFrame, files: Files) -> DataFrame:
    """(pair, n, best, irregular) of the corpus: pair is a * 65536 + b; best: n is the highest of its b."""
    spark = docs.sparkSession
    parts = docs.select("text").mapInArrow(_counted(files), "a bigint, b bigint, n bigint")
    counted = saved(parts.groupBy("a", "b").agg(F.sum("n").alias("n")))
    same = vocabularies(files).same
    regular = spark.createDataFrame([(a, int(b)) for a, b in enumerate(same.tolist()) if b >= 0], "a bigint, b bigint")
    vector = counted.where("b is null").select("a", "n").join(F.broadcast(regular), "a").select("a", "b", "n", F.lit(False).alias("odd"))
    odd = counted.where("b is not null").select("a", "b", "n", F.lit(True).alias("odd"))
    total = vector.unionByName(odd).groupBy("a", "b").agg(F.sum("n").alias("n"), F.max("odd").alias("irregular"))
    total = saved(total)
    highest = total.groupBy("b").agg(F.max("n").alias("most"))
    pair = F.shiftleft("a", 16).bitwiseOR(F.col("b")).alias("pair")
    return saved(total.join(highest, "b").select(pair, "n", (F.col("n") == F.col("most")).alias("best"), "irregular"))


def corpus_counts(pairs: DataFrame, files: Files, hot_pairs: int = HOT_PAIRS) -> tuple[Corpus, DataFrame]:
    """What goes to all tasks, of a bounded size, and the (pair, n, best) that do not."""
    same = vocabularies(files).same
    of_same = F.broadcast(
        pairs.sparkSession.createDataFrame([(a << 16 | b, a) for a, b in enumerate(same.tolist()) if b >= 0], "pair bigint, a bigint")
    )
    vector = pairs.join(of_same, "pair").select("a", "n", "best").toPandas()
    count, best = np.zeros(len(same), np.int64), np.zeros(len(same), bool)
    count[vector["a"].to_numpy(np.int64)] = vector["n"].to_numpy(np.int64)
    best[vector["a"].to_numpy(np.int64)] = vector["best"].to_numpy(bool)
    # Pairs by size of their counts, an eighth of a doubling each: the largest classes that fit are sent.
    irregular = pairs.where("irregular")
    size = F.floor(8 * F.log2(F.col("n").cast("double")))
    classes = irregular.groupBy(size.alias("size")).count().orderBy(F.desc("size")).collect()
    least, held = None, 0
    for c in classes:
        held += c["count"]
        if held > hot_pairs:
            break
        least = c["size"]
    hot = irregular.where(size >= least if least is not None else F.lit(False)).select("pair", "n", "best").orderBy("pair").toPandas()
    cold = irregular.where(size < least if least is not None else F.lit(True)).select("pair", "n", "best")
    return Corpus(count, best, hot["pair"].to_numpy(np.int64), hot["n"].to_numpy(np.int64), hot["best"].to_numpy(bool)), cold


def alignment(docs: DataFrame, files: Files | None = None, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """Per row of `docs` (doc_id, text): n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Space + text goes to A, text to B, which adds the space; strings of special tokens are plain text. n_links counts
    the links of the text, n_best those whose pair counts as often as any of its B id in the corpus, count_sum adds
    the pairs' counts over the links. groups_sha256 is of `a1,a2|b1;a3|b2,b3`. Texts that are null, empty, or not
    the bytes of their tokens have zeros and ''. Repeated rows are rows, and documents, of their own; doc_id may be
    null. Very long texts are worked on in pieces. Other columns are not read. An empty table gives an empty result.
    """
    files = files or default_files()
    spark = docs.sparkSession
    pairs = pair_counts(docs, files)
    corpus, cold = corpus_counts(pairs, files, hot_pairs)
    kind = docs.schema["doc_id"].dataType.simpleString()
    numbers = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint"
    shape = f"doc_id {kind}, {numbers}, groups_sha256 string, rare array<bigint>, rare_n array<bigint>"
    told = docs.select("doc_id", "text").mapInArrow(_described(files, spark.sparkContext.broadcast(corpus)), shape)
    told = saved(told.withColumn("row", F.monotonically_increasing_id()))
    rare = told.where(F.size("rare") > 0).select("row", F.explode(F.arrays_zip("rare", "rare_n")).alias("x"))
    rare = rare.select("row", F.col("x.rare").alias("pair"), F.col("x.rare_n").alias("links"))
    more = (
        rare.join(cold, "pair")
        .groupBy("row")
        .agg(
            F.sum(F.col("links") * F.col("n")).alias("more_sum"),
            F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("more_best"),
        )
    )
    out = told.drop("rare", "rare_n").join(more, "row", "left")
    return out.select(
        "doc_id",
        *("n_a", "n_b", "n_groups", "n_links"),
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )
