"""Near copies of embeddings, hard negatives and token alignment against brute force, and their odd inputs."""

import hashlib
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import database, differences
from wayfold.llm import embedding_dups, hard_negatives, queries, token_align

VECTORS = "vec_id long, embedding array<float>, label int, key string, node int, block int, row int"
MORE = ("mine", 1, 2, 3)


def _frame(spark, rows):
    """Rows (vec_id, vector, label) with extra columns that carry names used inside."""
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], l, *MORE) for i, v, l in rows], VECTORS)


def _usable(rows):
    return [
        (i, np.array(v, float), l)
        for i, v, l in rows
        if l is not None and i is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]


def _near(rows, threshold=0.98):
    """(vec_id, n_links, component_id, kept) of all rows, by comparing all with all."""
    use = [(n, i, np.float32(v).astype(float), l) for n, (i, v, l) in enumerate(rows) if _usable([(i, v, l)]) and any(v)]
    links = {n: set() for n, *_ in use}
    for n, _, v, l in use:
        for m, _, w, k in use:
            if n != m and l == k and len(v) == len(w) and v @ w / np.sqrt(v @ v) / np.sqrt(w @ w) >= threshold:
                links[n].add(m)
    out = Counter()
    for n, (i, _, _) in enumerate(rows):
        seen, todo = {n}, [n]
        while todo:
            for m in links.get(todo.pop(), ()):
                if m not in seen:
                    seen.add(m)
                    todo.append(m)
        root = min((rows[m][0] for m in seen if rows[m][0] is not None), default=None)
        out[(i, len(links.get(n, ())), root, root == i)] += 1
    return out


def _odd_vectors():
    rng = np.random.default_rng(5)
    base = rng.normal(size=8)
    rows = [
        (1, None, 1),
        (2, [], 1),
        (3, [0.0] * 8, 1),
        (4, [1.0, None] + [0.0] * 6, 1),
        (5, [float("nan")] + [1.0] * 7, 1),
        (6, [float("inf")] + [1.0] * 7, 1),
        (7, base, None),
        (8, base, 1),
        (9, base, 1),
        (9, base, 1),
        (10, base * 3, 1),
        (11, base, 2),
        (12, base[:4], 1),
        (13, base[:4] * 1e30, 1),
        (14, -base, 1),
        (15, base + 0.02 * rng.normal(size=8), 1),
        (16, base * 1e-20, 1),
        (17, base, 1),
        (None, base, 1),
    ]
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], l) for i, v, l in rows]


def _got(df):
    return Counter(tuple(r) for r in df.select("vec_id", "n_links", "component_id", "kept").collect())


def test_near_copies_of_odd_vectors(spark):
    rows = _odd_vectors()
    got = _got(embedding_dups.near_duplicates(_frame(spark, rows)))
    want = _near(rows)
    assert got == Counter({(i, n, c, c is None or k): m for (i, n, c, k), m in want.items()})


def test_near_copies_of_nothing(spark):
    assert embedding_dups.near_duplicates(_frame(spark, [])).count() == 0
    alone = embedding_dups.near_duplicates(_frame(spark, [(1, None, 1), (2, [1.0], None)]))
    assert _got(alone) == Counter({(1, 0, 1, True): 1, (2, 0, 2, True): 1})


def test_near_copies_in_large_groups_and_blocks(spark, monkeypatch):
    """A group of near copies over several blocks, a chain, copies, and strangers."""
    rng = np.random.default_rng(7)
    center, chain = rng.normal(size=16), rng.normal(size=(2, 16))
    rows = [(i, center + 0.11 * rng.normal(size=16), 0) for i in range(120)]
    rows += [(200 + i, np.cos(0.15 * i) * chain[0] / np.linalg.norm(chain[0]) + np.sin(0.15 * i) * chain[1] / np.linalg.norm(chain[1]), 0) for i in range(12)]
    rows += [(300 + i, center, 0) for i in range(40)]
    rows += [(400 + i, rng.normal(size=16), i % 2) for i in range(100)]
    rows = [(i, np.float32(v).tolist(), l) for i, v, l in rows]
    monkeypatch.setattr(embedding_dups, "BLOCK", 16)
    monkeypatch.setattr(embedding_dups, "ROWS", 50)
    got, want = _got(embedding_dups.near_duplicates(_frame(spark, rows))), _near(rows)
    # Hashing may miss a link at the threshold with one part in a thousand.
    assert sum((got & want).values()) >= 0.98 * len(rows)
    assert abs(sum(n * m for (_, n, _, _), m in got.items()) / sum(n * m for (_, n, _, _), m in want.items()) - 1) < 0.005


def test_recall_of_hashing_is_planned():
    for n in (10, 10_000, 10**8):
        plan = embedding_dups.hashing(n, 0.98)
        shared = (1 - math.acos(0.98) / math.pi) ** plan.bits
        assert 1 - (1 - shared) ** plan.tables >= embedding_dups.RECALL
        assert n / 2**plan.bits <= 1 / 8


@pytest.mark.parametrize("name", ["op11_embedding_dups", "op13_hard_negatives"])
def test_vector_queries_match_sql(spark, folder, name):
    assert differences(queries.QUERIES[name](spark, folder), database(folder), queries.ORACLES[name]) is None


def _mined(rows, step, plan):
    """Hard negatives by sorting all rows for each anchor."""
    use, out = _usable(rows), []
    whole = [(i, np.floor(plan.scale * np.float32(v).astype(float)), l) for i, v, l in use]
    anchors = {}
    for i, v, l in sorted(whole, key=lambda x: (x[0], x[2], x[1].tolist())):
        if i % step == 0:
            anchors.setdefault(i, (v, l))
    for i, (v, l) in anchors.items():
        scored = sorted(((-int(v @ w), j, k) for j, w, k in whole if len(v) == len(w)), key=lambda x: x[:2])
        for p, j, _ in [x for x in scored if x[2] == l and x[1] != i][: plan.positives]:
            fits = [(n, q) for n, q, k in scored if k != l and plan.low * -p <= plan.den * -n <= plan.high * -p]
            out += [(i, j, r + 1, q, -p, -n) for r, (n, q) in enumerate(fits[: plan.wanted])]
    return Counter(out)


def _negatives(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("parts", [1, 5])
def test_hard_negatives_with_ties_and_small_pieces(spark, monkeypatch, parts):
    """Few different scores, so ties and equal upper limits abound; blocks, pieces and strides are tiny."""
    rng = np.random.default_rng(3)
    for name, size in (("PIECE", 16), ("BLOCK", 4), ("AT_ONCE", 3)):
        monkeypatch.setattr(hard_negatives, name, size)
    rows = [(i, (rng.integers(-2, 4, size=3) / 4).tolist(), int(rng.integers(3))) for i in range(300)]
    plan = hard_negatives.Mining(positives=4, wanted=3)
    got = _negatives(hard_negatives.hard_negatives(_frame(spark, rows), F.col("vec_id") % 10 == 0, plan, parts=parts))
    assert got == _mined(rows, 10, plan) and sum(got.values()) > 100


def test_hard_negatives_of_odd_vectors(spark):
    rng = np.random.default_rng(11)
    rows = _odd_vectors()[:9] + [(i, rng.normal(size=8).tolist(), i % 2) for i in range(20, 60)] + [(30, [0.5] * 8, 0)]
    plan = hard_negatives.Mining()
    got = _negatives(hard_negatives.hard_negatives(_frame(spark, rows), F.col("vec_id") % 3 == 0))
    assert got == _mined(rows, 3, plan)
    assert hard_negatives.hard_negatives(_frame(spark, []), F.col("vec_id") % 3 == 0).count() == 0
    assert hard_negatives.hard_negatives(_frame(spark, rows), F.col("vec_id") % 997 == 0).count() == 0


def test_hard_negatives_of_large_components(spark):
    """Products beyond single precision, and beyond two bytes."""
    rng = np.random.default_rng(13)
    rows = [(i, (300 * rng.normal(size=6)).tolist(), i % 2) for i in range(60)]
    got = _negatives(hard_negatives.hard_negatives(_frame(spark, rows), F.col("vec_id") % 5 == 0))
    assert got == _mined(rows, 5, hard_negatives.Mining()) and sum(got.values()) > 20


TEXTS = [
    (1, None),
    (2, ""),
    (3, " "),
    (4, "a  b\n c \n  d"),
    (5, "x "),
    (6, "a▁b and more"),
    (7, "<|endoftext|> <s> <unk> </s>"),
    (8, "   lead and trail \t"),
    (9, "日本語テキスト なしスペース　全角 ﬁ é ́ 🙂🙂"),
    (10, "a\x00b \x07 \u0085 x\x1c y"),
    (11, "aaaa aaaaa" * 60),
    (11, "aaaa aaaaa" * 60),
    (12, "\n"),
    (13, "word\n"),
    (14, "tab\tx  \t y 1234567 it's we'll"),
    (None, "null id, extraordinarily counterintuitive tokenization"),
    (15, "It's extraordinarily long. " * 400),
]


def _plain_alignment(rows):
    """Whole texts through both libraries, tokens walked one by one."""
    from tokenizers import Tokenizer

    files = token_align.default_files()
    v = token_align.vocabularies(files)
    a_side = Tokenizer.from_file(files.a)
    a_side.encode_special_tokens = True
    found, counts = [], Counter()
    for i, text in rows:
        links, groups = [], []
        a = a_side.encode(" " + text, add_special_tokens=False).ids if text else []
        b = v.b.encode(text) if text else []
        raw = (" " + (text or "")).encode()
        if text and b"".join(v.bytes_a[x] for x in a) == raw == b"".join(v.bytes_b[x] for x in b):
            x = y = 0
            left, right = len(v.bytes_a[a[0]]), len(v.bytes_b[b[0]])
            group = ([a[0]], [b[0]])
            while True:
                links.append((a[x], b[y]))
                ends = left, right
                if ends[0] == ends[1]:
                    groups.append(group)
                    group = ([], [])
                if ends[0] <= ends[1]:
                    x += 1
                    if x < len(a):
                        left += len(v.bytes_a[a[x]])
                        group[0].append(a[x])
                if ends[1] <= ends[0]:
                    y += 1
                    if y < len(b):
                        right += len(v.bytes_b[b[y]])
                        group[1].append(b[y])
                if x == len(a) or y == len(b):
                    break
        else:
            a = b = []
        counts.update(links)
        found.append((i, a, b, links, groups))
    highest = {}
    for (_, b), n in counts.items():
        highest[b] = max(highest.get(b, 0), n)
    out = Counter()
    for i, a, b, links, groups in found:
        told = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        digest = hashlib.sha256(told.encode()).hexdigest() if a else ""
        best = sum(counts[x] == highest[x[1]] for x in links)
        out[(i, len(a), len(b), len(groups), len(links), best, sum(counts[x] for x in links), digest)] += 1
    return out


def _aligned(df):
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return Counter(tuple(r) for r in df.select(*names).collect())


@pytest.mark.parametrize("hot, piece, links", [(token_align.HOT_PAIRS, token_align.PIECE, 10**6), (0, 64, 50), (40, 1000, 400)])
def test_alignment_of_odd_texts(spark, monkeypatch, hot, piece, links):
    """Also with rare pairs only, with texts in many pieces and with tables that are emptied again and again."""
    monkeypatch.setattr(token_align, "PIECE", piece)
    monkeypatch.setattr(token_align, "TABLE_LINKS", links)
    df = spark.createDataFrame(TEXTS, "doc_id long, text string").withColumns({"row": F.lit(1), "pair": F.lit("x"), "n_a": F.lit(2)})
    files = token_align.default_files()
    assert _aligned(token_align.alignment(df, files, hot)) == _plain_alignment(TEXTS)
    v = token_align.vocabularies(files)
    for _, text in TEXTS:
        if text:
            assert " ".join(u for p in token_align.pieces(text, piece) for u in token_align.units(p)) == text
            table = token_align._Units(v)
            rows = table.rows(list(token_align.pieces(text, piece)))
            assert [u for p in token_align.pieces(text, piece) for u in token_align.units(p)] == [list(table.number)[i] for r in rows for i in r]


def test_alignment_of_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert _aligned(queries.op12_token_align(spark, folder)) == _plain_alignment(rows)
    assert queries.op12_token_align.__name__ in queries.QUERIES


def test_alignment_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert token_align.alignment(empty).count() == 0
    blank = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert _aligned(token_align.alignment(blank)) == Counter({(1, 0, 0, 0, 0, 0, 0, ""): 1, (2, 0, 0, 0, 0, 0, 0, ""): 1})


def test_identity_map_and_regular_groups():
    v = token_align.vocabularies(token_align.default_files())
    for a in range(0, len(v.bytes_a), 97):
        if v.same[a] >= 0:
            assert v.bytes_b[v.same[a]] == v.bytes_a[a]
    found = token_align.aligned(v, ["the", "house"], True)
    assert found.ok.all() and len(found.groups) == 2 and found.regular.any()
