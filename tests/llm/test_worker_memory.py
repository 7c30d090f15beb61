"""What a worker holds while it works on many texts, and between tasks."""

from __future__ import annotations

import random
import tracemalloc

import pyarrow as pa

from wayfold.llm import language_id, ngram_join, packing, tokens


def _texts(n, words, seed=3):
    draw = random.Random(seed)
    return [" ".join(f"w{draw.randrange(50_000)}" for _ in range(words)) for _ in range(n)]


def test_shingles_of_many_texts_take_little_beside_them():
    texts = _texts(800, 1_000)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    assert batch.nbytes > 4 << 20
    tracemalloc.start()
    try:
        sizes = [size for _, _, begin in ngram_join._sets(batch, 5) for size in (begin[1:] - begin[:-1]).tolist()]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    split = [t.split() for t in texts]
    assert sizes == [len({tuple(w[i : i + 5]) for i in range(996)}) for w in split]
    assert peak < 32 << 20


def test_hashes_do_not_depend_on_the_run():
    from wayfold.llm.words import runs

    column = pa.array([*_texts(20, 50), "", "Ab aB", None])
    found = [[h for run in runs(column, run_bytes=size) for h in run.hashes().tolist()] for size in (1, 500, 1 << 21)]
    assert found[0] == found[1] == found[2]
    assert found[0][-1] == found[0][-2] and len(set(found[0][:10])) > 1


def test_a_task_of_packing_leaves_no_large_table(monkeypatch):
    texts = _texts(40, 100)
    path = tokens.default_path()
    own = tokens.WordTokenizer(path)
    monkeypatch.setitem(tokens._tokenizers, path, own)
    monkeypatch.setattr(packing, "TaskContext", _Task)
    monkeypatch.setattr(tokens, "RESTING_WORDS", 200, raising=False)

    def rows(some):
        batch = pa.RecordBatch.from_arrays([pa.array(range(len(some))), pa.array(some)], ["doc_id", "text"])
        return [row for out in _Documents.of([batch]) for row in out.to_pylist()]

    packing.pieces(_Documents, path)
    small = rows(texts[:1])
    assert own.words  # a small table stays
    found = rows(texts)
    assert not own.words and not own.parts
    assert found[:1] == small == rows(texts)[:1]


class _Task:
    """The context of a task outside Spark."""

    @staticmethod
    def get():
        return _Task

    @staticmethod
    def partitionId():
        return 0


class _Documents:
    """Takes the function that tasks would run."""

    @classmethod
    def select(cls, *columns):
        return cls

    @classmethod
    def mapInArrow(cls, of, schema):
        cls.of = staticmethod(of)


def test_language_stage_sends_texts_to_python_once(spark, monkeypatch):
    import corpus_pipeline

    rows = [(i, t, ("en", "de", None)[i % 3], "web", len(t)) for i, t in enumerate(_texts(60, 30))] + [(60, None, "en", "web", 0), (61, "1 2", None, "web", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.select("source", "text", "doc_id", "lang", "n_chars")
    sent, predicted = [], language_id.predicted

    def seen(documents, model):
        sent.append(documents.schema.simpleString())
        return predicted(documents, model)

    monkeypatch.setattr(language_id, "predicted", seen)
    out = corpus_pipeline.language(spark, docs, "")
    assert [s.count("text:") for s in sent] == [1]
    assert out.schema.names == docs.schema.names and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
    got = {r["doc_id"]: r for r in out.collect()}
    assert set(got) == set(range(60))
    for i, text, lang, source, n in rows[:60]:
        r = got[i]
        assert (r["text"], r["source"], r["n_chars"]) == (text, source, n)
        assert r["lang"] == lang if lang else r["lang"] in ("en", "de")
