"""Token counts of documents in flat token files that have no index.

A flat file is one run of ids, documents one after the other, each closed by a separator id. Files
are worked on in blocks. A vectorised search finds the separators of a block; a prefix scan over the
blocks of a file carries the tokens after the last separator into the next block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import saved
from .tokens import default_path, tokenizer

# Ids of a block.
BLOCK = 1 << 16
# Fixed value: the end-of-document id of the vocabulary.
SEPARATOR = 49407


def read_flat_files(spark: SparkSession, path: str, kind: str = "<u2", block: int = BLOCK) -> DataFrame:
    """(stream, block, ids) of flat binary files of unsigned ids; each file is a stream."""
    step = block * np.dtype(kind).itemsize
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("stream"), "content")
    starts = F.sequence(F.lit(0), F.greatest(F.length("content") - 1, F.lit(0)), F.lit(step))
    return files.select("stream", "content", F.posexplode(starts).alias("block", "at")).select(
        "stream", "block", F.substring("content", F.col("at") + 1, F.lit(step)).alias("ids")
    )


def flat_streams(documents: DataFrame, path: str, block: int = BLOCK) -> DataFrame:
    """Documents as flat token streams, one per task, cut into blocks wherever they fall.

    (stream, block, ids, docs, left_out): ids of two bytes each, the numbers of the documents that end in the
    block, and how many ids of each were left out, as they equal the separator and would end the document.
    """

    def of(batches):
        ids_of = tokenizer(path).ids
        stream = str(TaskContext.get().partitionId())
        size, number = 2 * block, 0
        held, docs, left_out = bytearray(), [], []
        ends: list[int] = []  # where in `held` the documents of docs end

        def row(part: bytes, ended: int):
            nonlocal number
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array([stream]),
                    pa.array([number], pa.int32()),
                    pa.array([part], pa.binary()),
                    pa.array([docs[:ended]], pa.list_(pa.int64())),
                    pa.array([left_out[:ended]], pa.list_(pa.int64())),
                ],
                ["stream", "block", "ids", "docs", "left_out"],
            )
            number += 1
            return out

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = np.frombuffer(ids_of(text.as_py()), np.uint32)
                kept = ids[ids != SEPARATOR]
                held += kept.astype("<u2").tobytes() + SEPARATOR.to_bytes(2, "little")
                docs.append(doc)
                left_out.append(len(ids) - len(kept))
                ends.append(len(held))
                while len(held) >= size:
                    ended = int(np.searchsorted(ends, size, "right"))
                    yield row(bytes(held[:size]), ended)
                    del held[:size]
                    docs, left_out, ends = docs[ended:], left_out[ended:], [e - size for e in ends[ended:]]
        if held:
            yield row(bytes(held), len(docs))

    return documents.select("doc_id", "text").mapInArrow(of, "stream string, block int, ids binary, docs array<long>, left_out array<long>")


def found_separators(blocks: DataFrame, separator: int = SEPARATOR, kind: str = "<u2") -> DataFrame:
    """(stream, block, size, last, lengths): ids of the block, place after its last separator (0 if it has none),
    and the ids before each separator, back to the one before it or the block's start."""

    def of(batches):
        for batch in batches:
            size, last, lengths = [], [], []
            for value in batch.column("ids"):
                ids = np.frombuffer(value.as_py() or b"", kind)
                at = np.flatnonzero(ids == separator)
                size.append(len(ids))
                last.append(int(at[-1]) + 1 if len(at) else 0)
                lengths.append(np.diff(at, prepend=-1) - 1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("stream"),
                    batch.column("block"),
                    pa.array(size, pa.int64()),
                    pa.array(last, pa.int64()),
                    pa.array(lengths, pa.list_(pa.int64())),
                ],
                ["stream", "block", "size", "last", "lengths"],
            )

    schema = "stream string, block int, size long, last long, lengths array<long>"
    return blocks.select("stream", "block", "ids").mapInArrow(of, schema)


def token_counts(blocks: DataFrame, separator: int = SEPARATOR, kind: str = "<u2") -> DataFrame:
    """(stream, number, block, n_tokens) of each document of (stream, block, ids), without its separator.

    `number` counts the documents of a stream from 0, `block` is where the document ends. Ids after a
    stream's last separator are a document of their own; two separators in a row close an empty one.
    Null blocks are empty; an empty table gives an empty result; other columns are ignored.
    """
    found = saved(found_separators(blocks, separator, kind))
    before = Window.partitionBy("stream").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("stream").orderBy("block")
    after = Window.partitionBy("stream").orderBy(F.col("block").desc())
    scanned = (
        found.withColumn("start", F.coalesce(F.sum("size").over(before), F.lit(0)))
        .withColumn("closed", F.when(F.col("last") > 0, F.col("start") + F.col("last")))
        .withColumn("carried", F.col("start") - F.coalesce(F.max("closed").over(before), F.lit(0)))
        .withColumn("first", F.coalesce(F.sum(F.size("lengths")).over(before), F.lit(0)))
        .withColumn("open", F.col("start") + F.col("size") - F.coalesce(F.max("closed").over(upto), F.lit(0)))
        .withColumn("ending", (F.row_number().over(after) == 1) & (F.col("open") > 0))
    )
    lengths = F.when(F.col("ending"), F.concat("lengths", F.array("open"))).otherwise(F.col("lengths"))
    # What a block's first separator closes began in earlier blocks; `open` counts from there already.
    counts = F.transform(
        lengths,
        lambda n, i: n + F.when((i == 0) & (F.size("lengths") > 0), F.col("carried")).otherwise(0),
    )
    return scanned.select("stream", "block", "first", F.posexplode(counts).alias("at", "n_tokens")).select(
        "stream", (F.col("first") + F.col("at")).alias("number"), "block", F.col("at").alias("place"), "n_tokens"
    )


def document_token_counts(documents: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens) of each text: written as flat streams, then counted by a scan of those.

    Null and empty texts have no tokens. Repeated rows are counted each. Ids of a text that equal the
    separator count as its tokens.
    """
    writer = flat_streams(documents, path or default_path())
    streams = saved(writer)
    counts = token_counts(streams.select("stream", "block", "ids"))
    ended = streams.select("stream", "block", F.posexplode(F.arrays_zip("docs", "left_out")).alias("place", "doc"))
    found = ended.join(counts, ["stream", "block", "place"])
    return found.select(F.col("doc.docs").alias("doc_id"), (F.col("n_tokens") + F.col("doc.left_out")).alias("n_tokens"))
