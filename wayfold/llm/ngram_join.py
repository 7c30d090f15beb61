"""N-gram Jaccard join: partitioned universe, pigeonhole, one-deletion neighbourhoods, exact check.

Two sets of word shingles link when `den * |both| >= num * |either|`. Sizes are cut into
bands so that linked sets lie in one band or in neighbouring ones. Each band j bounds the
number H of shingles in which linked sets can differ. The universe of shingles is cut by hash
into H + 1 segments: linked sets agree in one of them, and each segment of a set is an index
row. That is the cheapest allocation of the H + 1 units (one deletion is worth two units, but
costs as many rows as the segment has shingles), with one exception: segments that say little,
because they are empty or because a sample shows them to be frequent, are left out by the
probing set, which then searches the one-deletion neighbourhood of as many designated segments.

Sets that share a row are not paired with each other but with one leader of the row, so copies
cost as many pairs as rows. Rows whose sets are then still in several components are searched in
blocks by sketches: one bit for the parity of the shingles in each of some buckets. Two sets differ
in at least as many shingles as their sketches in bits, so most pairs are settled without a text:
first each set names its nearest one in another component, then all that may link are named. Every
pair that may link is counted exactly, on the texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import saved
from .components import components
from .words import distinct, grams, mix, runs

_U = np.uint64

# Sample that finds frequent rows. It only steers cost: which segments to leave out, which rows to split.
SAMPLE_TEXTS = 4_000
FREQUENT = 12
# Parts of a frequent row.
PARTS = 32
# A list of copies is broadcast up to so many numbers (8 bytes each), else joined by shuffle.
BROADCAST_IDS = 2_000_000
# Texts compared with a leader in one group.
GROUP = 256
# Sets of a row compared with each other in one block.
BLOCK = 1024
# Bits of a sketch per shingle, rounded up to a power of two in all.
SKETCH_BITS = 2

_PLANTED, _INDEX, _BOTH, _PROBE = 0, 1, 2, 3


@dataclass(frozen=True)
class Plan:
    """Bands and segments for shingles of `words` words and a similarity of num / den."""

    words: int = 5
    num: int = 80
    den: int = 100

    def bands(self) -> tuple[np.ndarray, np.ndarray]:
        """Lowest size of each band, and the most shingles in which linked sets can differ."""
        low = [1]
        while low[-1] < 1 << 31:
            low.append(low[-1] * self.den // self.num + 1)
        high = np.array(low[1:]) - 1
        most = (high + high * self.den // self.num) * (self.den - self.num) // (self.den + self.num)
        return np.array(low[:-1]), most


def _sets(batch: pa.RecordBatch, words: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, sorted distinct shingle hashes, and where each row's begin, of each run of texts."""
    for run in runs(batch.column("text")):
        yield run.first, *distinct(*grams(run.hashes(), run.number, words))


def fingerprints(documents: DataFrame, plan: Plan) -> DataFrame:
    """(doc_id, n_shingles, fp1, fp2): texts with equal sets have equal fingerprints (128 bits)."""

    def of(batches):
        for batch in batches:
            n, one, two = (np.zeros(batch.num_rows, np.int64), *np.zeros((2, batch.num_rows), np.uint64))
            for first, shingles, begin in _sets(batch, plan.words):
                rows = slice(first, first + len(begin) - 1)
                n[rows] = np.diff(begin)
                for out, values in ((one, shingles), (two, mix(shingles ^ _U(0x5851F42D4C957F2D)))):
                    upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values)])
                    out[rows] = upto[begin[1:]] - upto[begin[:-1]]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n), pa.array(one.view(np.int64)), pa.array(two.view(np.int64))],
                ["doc_id", "n_shingles", "fp1", "fp2"],
            )

    return documents.select("doc_id", "text").mapInArrow(of, "doc_id long, n_shingles long, fp1 long, fp2 long")


class _Signer:
    """Index and probe rows of sets."""

    def __init__(self, plan: Plan, leaders: dict[int, int]):
        self.low, self.most = plan.bands()
        self.leaders = leaders  # frequent key: its planted leader
        self.frequent = np.array(sorted(leaders), np.uint64)

    def rows(self, nodes: np.ndarray, shingles: np.ndarray, begin: np.ndarray) -> list[np.ndarray]:
        """Keys, tags (part * 4 + role) and nodes of the rows of several sets."""
        band = np.searchsorted(self.low, np.diff(begin), "right") - 1
        found = [x for back in (0, 1) for x in self._space(nodes, shingles, begin, band - back, back == 0)]
        keys, tags, owners = (np.concatenate(x) for x in zip(*found))
        if len(self.frequent):
            keys, tags, owners = self._parted(keys, tags, owners)
        return [keys, tags.astype(np.int32), owners.astype(np.int64)]

    def _known(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.frequent):
            return np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.frequent, keys), len(self.frequent) - 1)
        return self.frequent[at] == keys

    def _space(self, nodes, shingles, begin, space, own):
        """Rows in one space per set: its own band's, which it indexes and probes, or the band below, which it probes."""
        size = np.diff(begin)
        m = np.where((space >= 0) & (size > 0), self.most[np.maximum(space, 0)], 0)
        m = np.where(m > 0, m + 1, 0)  # without a difference only equal sets link
        base = np.concatenate([[0], np.cumsum(m)])
        total = int(base[-1])
        used = np.repeat(m > 0, size)
        owner = np.repeat(np.arange(len(m)), size)[used]
        shingles = shingles[used]
        local = ((shingles >> _U(32)) * m.astype(np.uint64)[owner] >> _U(32)).astype(np.int64)
        segment = base[owner] + local  # ascending, as a set's shingles are
        values = mix(shingles ^ _U(0x2545F4914F6CDD1D))
        sums = np.zeros(total, np.uint64)
        firsts = np.flatnonzero(np.diff(segment, prepend=-1))
        if len(firsts):
            sums[segment[firsts]] = np.add.reduceat(values, firsts)
        sizes = np.bincount(segment, minlength=total)
        of = np.repeat(np.arange(len(m)), m)
        where = np.arange(total) - base[of]
        place = mix(where.astype(np.uint64) + (space[of].astype(np.uint64) << _U(40)) + _U(1 << 39))
        exact = mix(sums ^ place)

        # Segments that say little are left out, for one-deletion neighbourhoods of designated ones.
        spared = np.minimum(m, 3 + m // 64)
        probe = sizes > 0
        frequent = self._known(exact) & probe
        searched = np.zeros(total, bool)
        poor = (sizes == 0) | frequent
        for i in np.unique(of[poor]).tolist():
            a, b = base[i], base[i + 1]
            free = np.flatnonzero((sizes[a : a + spared[i]] > 0) & ~frequent[a : a + spared[i]]) + a
            free = free[np.argsort(sizes[free], kind="stable")]
            empty = np.flatnonzero(sizes[a:b] == 0) + a
            spent = min(len(empty), len(free))
            probe[empty[spent:]] = True
            often = np.flatnonzero(frequent[a:b]) + a
            if len(often) <= len(free) - spent:
                probe[often] = False
                spent += len(often)
            searched[free[:spent]] = True
        if own:
            yield exact, np.where(probe, _BOTH, _INDEX), nodes[of]
        else:
            yield exact[probe], np.full(int(probe.sum()), _PROBE), nodes[of[probe]]
        fewer = sums[segment] - values
        if own:
            at = np.flatnonzero(local < spared[owner])
            yield mix(mix(fewer[at] ^ place[segment[at]]) ^ _U(7)), np.full(len(at), _INDEX), nodes[owner[at]]
        at = np.flatnonzero(searched[segment])
        yield mix(fewer[at] ^ place[segment[at]]), np.full(len(at), _PROBE), nodes[owner[at]]
        at = np.flatnonzero(searched)
        yield mix(exact[at] ^ _U(7)), np.full(len(at), _PROBE), nodes[of[at]]

    def _parted(self, keys, tags, owners):
        """Deals frequent keys out to parts; their leaders go to every part."""
        at = np.flatnonzero(self._known(keys))
        tags[at] += 4 * (1 + (mix(owners[at].astype(np.uint64)) % _U(PARTS)).astype(tags.dtype))
        own = [k for k in at.tolist() if self.leaders[int(keys[k])] == owners[k]]
        led = keys[own]
        return (
            np.concatenate([np.delete(keys, own), np.repeat(led, PARTS)]),
            np.concatenate([np.delete(tags, own), np.tile(4 * np.arange(1, PARTS + 1), len(led))]),
            np.concatenate([np.delete(owners, own), np.repeat(owners[own], PARTS)]),
        )


def signatures(sets: DataFrame, plan: Plan, leaders: dict[int, int]) -> DataFrame:
    """(key, tag, node): the rows of all texts."""

    def of(batches):
        signer = _Signer(plan, leaders)
        for batch in batches:
            nodes = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for first, shingles, begin in _sets(batch, plan.words):
                keys, tags, owners = signer.rows(nodes[first : first + len(begin) - 1], shingles, begin)
                for a in range(0, len(keys), 1 << 16):
                    rows = slice(a, a + (1 << 16))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys[rows].view(np.int64)), pa.array(tags[rows]), pa.array(owners[rows])],
                        ["key", "tag", "node"],
                    )

    return sets.select("doc_id", "text").mapInArrow(of, "key long, tag int, node long")


def _frequent(sets: DataFrame, plan: Plan, rows: int) -> dict[int, int]:
    """Frequent keys of a sample, with a leader each; at most SAMPLE_TEXTS texts are looked at."""
    if rows < FREQUENT:
        return {}
    sample = sets.sample(min(1.0, 0.8 * SAMPLE_TEXTS / rows), seed=7).limit(SAMPLE_TEXTS)
    found = (
        signatures(sample, plan, {})
        .groupBy("key")
        .agg(F.count_distinct("node").alias("n"), F.min(F.when(F.col("tag") != _PROBE, F.col("node"))).alias("leader"))
        .where((F.col("n") >= FREQUENT) & F.col("leader").isNotNull())
    )
    return {k % (1 << 64): leader for k, leader in found.select("key", "leader").toLocalIterator()}


def shared_rows(rows: DataFrame) -> DataFrame:
    """(key, node, leader) of the rows that several sets share and one of them probes.

    Of keys in parts, all rows: what a part holds does not say whether a set of another part probes.
    """

    def of(batches):
        key = leader = last = None
        waiting: list[int] = []
        for batch in batches:
            keys, tags, nodes = (batch.column(i).to_numpy() for i in range(3))
            parts = tags >> 2
            same = (keys[1:] == keys[:-1]) & (parts[1:] == parts[:-1])
            shared = np.zeros(len(keys), bool)
            shared[1:] |= same
            shared[:-1] |= same
            shared[[0, -1]] = True  # may go on in another batch
            out = []
            at = np.flatnonzero(shared)
            for k, t, node in zip(keys[at].tolist(), tags[at].tolist(), nodes[at].tolist()):
                if (k, t >> 2) != key:
                    key, leader, last, waiting = (k, t >> 2), None, None, []
                role = t & 3
                if leader is None:
                    if role != _PROBE:
                        leader = node
                    continue
                if node in (leader, last):
                    continue
                last = node
                # Needed only if a probe follows; of a key in parts the probe may be in another part.
                if role in (_PLANTED, _INDEX) and not t >> 2:
                    waiting.append(node)
                    if len(waiting) < 4096:
                        continue
                else:
                    out.append((k, node, leader))
                out += [(k, x, leader) for x in waiting]
                waiting = []
            if out:
                columns = [pa.array(c, pa.int64()) for c in zip(*out)]
                yield pa.RecordBatch.from_arrays(columns, ["key", "node", "leader"])

    part = F.shiftright("tag", 2)
    together = rows.repartition("key", part).sortWithinPartitions("key", "tag", "node")
    return together.mapInArrow(of, "key long, node long, leader long")


def compared(pairs: DataFrame, sets: DataFrame, plan: Plan) -> DataFrame:
    """(node, leader, both, either) of the distinct pairs: sizes of intersection and union.

    A leader's texts are compared in groups of at most about GROUP, so that a leader of very
    many does not meet them in one task.
    """
    pairs = pairs.select("node", "leader").distinct()
    counts = pairs.groupBy("leader").agg(F.count(F.lit(1)).alias("n"))
    grouped = pairs.join(counts, "leader").select(
        "node", "leader", F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / GROUP)).alias("part")
    )
    grouped = saved(grouped)
    wanted = saved(grouped.select(F.col("node").alias("doc_id")).union(grouped.select("leader")).distinct())
    texts = _only(sets, wanted, "left_semi").select("doc_id", "text")
    texts = saved(texts)
    members = grouped.join(texts, grouped["node"] == texts["doc_id"]).select("leader", "part", "node", "text")
    heads = (
        grouped.select("leader", "part")
        .distinct()
        .join(texts, F.col("leader") == F.col("doc_id"))
        .select("leader", "part", F.lit(None).cast("long").alias("node"), "text")
    )

    def of(batches):
        key, head = None, None
        for batch in batches:
            leaders, parts, nodes = (batch.column(c).to_pylist() for c in ("leader", "part", "node"))
            found = []
            for first, values, begin in _sets(batch, plan.words):
                for i, (a, b) in enumerate(zip(begin[:-1].tolist(), begin[1:].tolist()), first):
                    if nodes[i] is None:
                        key, head = (leaders[i], parts[i]), values[a:b]
                        continue
                    assert key == (leaders[i], parts[i])
                    both = len(np.intersect1d(head, values[a:b], assume_unique=True))
                    found.append((nodes[i], leaders[i], both, len(head) + b - a - both))
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*found)], ["node", "leader", "both", "either"]
                )

    ordered = (
        heads.unionByName(members)
        .repartition("leader", "part")
        .sortWithinPartitions("leader", "part", F.col("node").asc_nulls_first())
    )
    return ordered.mapInArrow(of, "node long, leader long, both long, either long")


def _only(sets: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Texts by a list of numbers; the list is broadcast only if it is small."""
    small = ids.count() <= BROADCAST_IDS
    return sets.join(F.broadcast(ids) if small else ids, "doc_id", how)


def sketches(sets: DataFrame, plan: Plan) -> DataFrame:
    """(node, n, bits): the number of shingles and the parity sketch of each text."""

    def of(batches):
        for batch in batches:
            nodes = batch.column("doc_id")
            for first, values, begin in _sets(batch, plan.words):
                sizes = np.diff(begin)
                found = []
                for a, b in zip(begin[:-1].tolist(), begin[1:].tolist()):
                    length = 1 << max(6, int(SKETCH_BITS * (b - a) - 1).bit_length())
                    counts = np.bincount((values[a:b] & _U(length - 1)).astype(np.int64), minlength=length)
                    found.append(np.packbits((counts & 1).astype(np.uint8)).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [nodes.slice(first, len(sizes)), pa.array(sizes), pa.array(found, pa.binary())], ["node", "n", "bits"]
                )

    return sets.select("doc_id", "text").mapInArrow(of, "node long, n long, bits binary")


def _folded(bits: np.ndarray, length: int) -> np.ndarray:
    while len(bits) > length:
        bits = bits[: len(bits) // 2] ^ bits[len(bits) // 2 :]
    return bits


def _may_link(pairs: DataFrame, known: DataFrame, plan: Plan) -> DataFrame:
    """The pairs (node, leader) whose sketches and sizes leave a link open."""

    def side(name):
        return known.select(*(F.col(c).alias(c if c == name else f"{name}_{c}") if c != "node" else F.col(c).alias(name) for c in known.columns))

    def of(batches):
        for batch in batches:
            keep = []
            for n, m, x, y in zip(*(batch.column(c).to_pylist() for c in ("node_n", "leader_n", "node_bits", "leader_bits"))):
                length = min(len(x), len(y))
                x, y = (_folded(np.frombuffer(v, np.uint8), length) for v in (x, y))
                differ = int(np.bitwise_count(x ^ y).sum())
                keep.append(
                    differ * (plan.den + plan.num) <= (n + m) * (plan.den - plan.num)
                    and min(n, m) * plan.den >= max(n, m) * plan.num
                )
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).filter(pa.array(keep)) for c in ("node", "leader")], ["node", "leader"]
            )

    both = pairs.select("node", "leader").distinct().join(side("node"), "node").join(side("leader"), "leader")
    return both.mapInArrow(of, "node long, leader long")


def _open_rows(members: DataFrame, part_of: DataFrame) -> DataFrame:
    """(key, node, part, sets): the sets of rows (keys) that are still in several components.

    Sets that agree in much share many rows; of rows with the same sets (by 128 bits) one is kept.
    """
    labelled = _labelled(members, part_of, "node", "part")
    one, two = (F.bit_xor(F.xxhash64("node", F.lit(k))) for k in (1, 2))
    keys = (
        labelled.groupBy("key")
        .agg(
            F.min("part").alias("low"),
            F.max("part").alias("high"),
            F.count(F.lit(1)).alias("sets"),
            one.alias("one"),
            two.alias("two"),
        )
        .where("low < high")
        .groupBy("sets", "one", "two")
        .agg(F.min("key").alias("key"))
    )
    return labelled.join(keys.select("key", "sets"), "key")


def _open_pairs(rows: DataFrame, known: DataFrame, plan: Plan, nearest: bool) -> DataFrame:
    """(key, node, leader): pairs in a row (key), of different parts, that sketches leave open.

    With `nearest`, each set names only its nearest one. `rows` are those of _open_rows, `known` the
    sketches. Rows are compared in blocks: each block of a key meets each other block of it in a
    task of its own.
    """
    blocks = F.ceil(F.col("sets") / BLOCK).cast("int")
    dealt = (
        rows.withColumn("own", F.pmod(F.xxhash64("node"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select("key", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "own", "node", "part")
        .join(known, "node")
    )

    def of(batches):
        key, held = None, []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("key", "a", "b", "own", "node", "part", "n", "bits")]
            found = []
            for k, a, b, *rest in zip(*columns):
                if (k, a, b) != key:
                    found += _compared_block(key, held, plan, nearest)
                    key, held = (k, a, b), []
                held.append(rest)
            if found:
                yield _pairs(found)
        found = _compared_block(key, held, plan, nearest)
        if found:
            yield _pairs(found)

    together = dealt.repartition("key", "a", "b").sortWithinPartitions("key", "a", "b", "node")
    return together.mapInArrow(of, "key long, node long, leader long")


def _pairs(found: list[tuple[int, int, int]]) -> pa.RecordBatch:
    key, one, other = np.array(found, np.int64).T
    columns = [pa.array(x) for x in (key, np.maximum(one, other), np.minimum(one, other))]
    return pa.RecordBatch.from_arrays(columns, ["key", "node", "leader"])


def _compared_block(key, held: list, plan: Plan, nearest: bool) -> list[tuple[int, int, int]]:
    """Open pairs of a block (own blocks a = b) or between two."""
    if len(held) < 2:
        return []
    own, node, part, n, bits = zip(*held)
    own, node, part, n = (np.array(x, np.int64) for x in (own, node, part, n))
    if (part == part[0]).all():
        return []
    left = np.flatnonzero(own == key[1])
    right = np.flatnonzero(own == key[2]) if key[1] != key[2] else left
    if not len(left) or not len(right):
        return []
    length = min(map(len, bits))
    sides = np.stack([_folded(np.frombuffer(x, np.uint8), length) for x in bits])
    alike = np.zeros((len(left), len(right)), np.float32)
    for c in range(0, length, 512):
        signs = 1 - 2 * np.unpackbits(sides[:, c : c + 512], axis=1).astype(np.float32)
        alike += signs[left] @ signs[right].T
    differ = (8 * length - alike) / 2
    total = n[left][:, None] + n[right][None, :]
    smaller = np.minimum(n[left][:, None], n[right][None, :])
    open_pair = (
        (differ * (plan.den + plan.num) <= total * (plan.den - plan.num))
        & (smaller * plan.den >= (total - smaller) * plan.num)
        & (part[left][:, None] != part[right][None, :])
    )
    if nearest:
        differ[~open_pair] = np.inf
        i, j = np.arange(len(left)), differ.argmin(axis=1)
        if len(right) and key[1] != key[2]:
            i, j = np.concatenate([i, differ.argmin(axis=0)]), np.concatenate([j, np.arange(len(right))])
        some = open_pair[i, j]
        i, j = i[some], j[some]
    else:
        i, j = np.nonzero(open_pair)
    return [(key[0], x, y) for x, y in zip(node[left][i].tolist(), node[right][j].tolist())]


def connected(sets: DataFrame, plan: Plan, rows: int) -> DataFrame:
    """(node, root): the components of different sets; sets without links are not listed."""
    linked = F.col("both") * plan.den >= F.col("either") * plan.num
    shared = saved(shared_rows(signatures(sets, plan, _frequent(sets, plan, rows))))
    members = saved(
        shared.select("key", "node").union(shared.select("key", F.col("leader").alias("node"))).distinct()
    )
    wanted = saved(members.select(F.col("node").alias("doc_id")).distinct())
    known = saved(sketches(_only(sets, wanted, "left_semi"), plan))

    found = saved(compared(_may_link(shared, known, plan), sets, plan).where(linked).select("node", "leader"))
    part_of = components(found)
    for nearest in (True, False):
        asked = saved(_open_pairs(_open_rows(members, part_of), known, plan, nearest))
        if not asked.take(1):
            break
        more = saved(compared(asked, sets, plan).where(linked).select("node", "leader"))
        if more.take(1):
            found = found.unionByName(more)
            part_of = components(found)
        # A set that neither names nor is named has no open pair in this row.
        members = saved(asked.select("key", "node").union(asked.select("key", F.col("leader").alias("node"))).distinct())
    return part_of


def _labelled(rows: DataFrame, part_of: DataFrame, node: str, label: str) -> DataFrame:
    parts = part_of.select(F.col("node").alias(node), F.col("root").alias(label))
    return rows.join(parts, node, "left").withColumn(label, F.coalesce(label, node))


def jaccard_components(documents: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """(doc_id, n_shingles, class_id, component_id) of each row of (doc_id, text).

    class_id is the smallest doc_id with the same set, component_id the smallest doc_id that
    links reach. Texts that are null or have no words have no shingles and are alone; texts with
    fewer words than a shingle have one shingle, all their words. Rows without doc_id take part
    with null ids unless an equal text has one. Repeated rows each give a row; doc_id is taken to
    name one text. An empty table gives an empty result. Other columns are ignored.
    """
    documents = documents.select("doc_id", "text")
    prints = saved(fingerprints(documents, plan))
    full = prints.where("n_shingles > 0")
    classes = saved(full.groupBy("fp1", "fp2", "n_shingles").agg(F.min("doc_id").alias("class_id")))
    _, most = plan.bands()
    low = int(plan.bands()[0][np.flatnonzero(most)[0]])
    # Copies, and sets so small that only equal ones link, need no search.
    no_search = prints.join(
        classes.where(F.col("n_shingles") >= low).select(F.col("class_id").alias("doc_id")), "doc_id", "left_anti"
    ).select("doc_id").where("doc_id is not null").distinct()
    no_search = saved(no_search)
    rows = classes.count()
    sets = _only(documents.where("doc_id is not null"), no_search, "left_anti")
    part_of = connected(sets, plan, rows)
    known = _labelled(classes, part_of, "class_id", "component_id")
    out = prints.join(known, ["fp1", "fp2", "n_shingles"], "left")
    return out.select(
        "doc_id",
        "n_shingles",
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )


def one_of_each(documents: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """The rows of `documents`, with all columns, that are the first of their component.

    Of rows that repeat a doc_id and its text one stays. Rows without doc_id all stay.
    """
    found = saved(jaccard_components(documents, plan))
    gone = saved(found.where("doc_id <> component_id").select("doc_id").distinct())
    kept = _only(documents, gone, "left_anti")
    again = saved(
        found.where("doc_id = component_id").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id")
    )
    if not again.take(1):
        return kept
    repeated = _only(kept, again, "left_semi").dropDuplicates(["doc_id", "text"])
    return _only(kept, again, "left_anti").unionByName(repeated)
