"""Batch-by-batch extraction: new documents in a folder become rows of the stored tables.

The same flattening and checks as for whole folders run on a stream, so a large or
growing folder is taken in pieces. A batch is parsed once and kept while it is split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.validate import check_columns, split_rows
from ..schemas import Table
from ..sources.timeline_json import READERS, from_files, named, rejected_documents


def stream_documents(spark: SparkSession, folder: str, table: Table, files_per_batch: int = 1000) -> DataFrame:
    """A stream of the documents that arrive in `folder`, parsed for one table; unreadable ones are marked."""
    schema, _ = READERS[table]
    reader = from_files(spark.readStream, schema, strict=False).option("maxFilesPerTrigger", files_per_batch)
    return named(reader.json(folder))


def store_new_rows(documents: DataFrame, table: Table, path: str, checkpoint: str) -> StreamingQuery:
    """Append good rows to `path`/good, others with reasons to `path`/rejected, unreadable documents to `path`/unreadable.

    Takes what is there and stops; running it again takes what has come since. Folders carry the
    checkpoint's own id, so another checkpoint never replaces rows that are stored.
    """
    _, flatten = READERS[table]

    def store(batch: DataFrame, number: int) -> None:
        run = batch.sparkSession.read.json(f"{checkpoint}/metadata").first()["id"]
        # A batch that is run again after a failure replaces its own folder only.
        own = f"run={run}/batch={number}"
        batch = batch.persist()
        try:
            rows = flatten(batch, strict=False)
            check_columns(rows.drop("traj_id"), table)
            good, rejected = split_rows(rows, table)
            good.write.mode("overwrite").parquet(f"{path}/good/{own}")
            rejected.write.mode("overwrite").parquet(f"{path}/rejected/{own}")
            rejected_documents(batch).write.mode("overwrite").parquet(f"{path}/unreadable/{own}")
        finally:
            batch.unpersist()

    return (
        documents.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
