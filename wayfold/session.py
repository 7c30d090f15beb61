"""Session defaults for tests and the bench, and tables saved between stages."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: str = "*", name: str = "wayfold") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        # Tables are small here: let their files and shuffles keep all cores busy.
        .config("spark.sql.files.openCostInBytes", "131072")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir.

    Only a local session may fall back to a temporary folder; on a cluster its
    executors would not see the same files.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or context.getCheckpointDir()
    if folder:
        return folder
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    global _local_folder
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="wayfold-")
    return _local_folder


_local_folder: str | None = None

# Names of UTC as a session zone.
_UTC = {"UTC", "Etc/UTC", "UCT", "Etc/UCT", "GMT", "Etc/GMT", "Z", "Zulu", "Universal", "Etc/Universal", "+00:00"}


def require_utc(spark: SparkSession) -> None:
    """Times without a zone are read as UTC: another session zone would shift them."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in _UTC:
        raise ValueError(f"spark.sql.session.timeZone is {zone}: set it to UTC")


def shuffled(df: DataFrame) -> DataFrame:
    """Marks one side of a join whose rows grow with the input: the join sorts and merges it.

    Files pack such rows, so by their size Spark may broadcast what is many times larger in the driver's memory.
    """
    return df.hint("merge")


def saved(df: DataFrame, split_by: str | None = None) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Cuts the lineage, survives lost executors, and gives later joins true sizes. `split_by` names a text column
    of few values; readers of one of them open no files of the others.
    """
    spark = df.sparkSession
    path = os.path.join(shared_folder(spark), f"wayfold-{uuid.uuid4().hex}")
    (df.write.partitionBy(split_by) if split_by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
