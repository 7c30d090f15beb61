"""A training corpus from the documents table: language, quality, near copies, benchmark passages, packing.

Each stage takes the documents that its predecessor kept, with all their columns, and decides about
them: texts without a language go and a missing language is filled in, texts that fail a quality rule go, one document of each group of
near copies stays, benchmark passages go, and what is left is packed into sequences.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfold.llm import decontaminate, language_id, ngram_join, packing, quality_rules
from wayfold.session import saved

# Near copies: words of a shingle and similarity in percent, as for all stages on word shingles.
NEAR = ngram_join.Plan(words=5, num=80, den=100)

# No SQL has the models and the packing of these stages.
ORACLE_SQL = None


def _beside(docs: DataFrame) -> DataFrame:
    """The rows as one column beside the text, so that results cannot clash with their names."""
    return docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "text")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a language (null, or no letter) go; a null lang of the others is filled by the model.

    Where no document outside the held-out ones has text and lang there is no model, and lang stays null.
    """
    held_out = language_id.held_out(F.col("doc_id"))
    model = language_id.fit(docs.where(~held_out).select("doc_id", "text", "lang"))
    if model is None:
        return language_id.with_letters(docs)
    # Texts go to Python once: the other columns are beside them without the text.
    others = [c for c in docs.columns if c != "text"]
    found = language_id.predicted(docs.select(F.struct(*others).alias("row"), "text"), model)
    filled = F.coalesce(F.col("row.lang"), F.col("lang_pred"))
    found = found.where(F.col("lang_pred") != language_id.UNKNOWN).withColumn("row", F.col("row").withField("lang", filled))
    return found.select(*(F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that a quality rule rejects go."""
    return quality_rules.cascade(_beside(docs)).where("rejected_by is null").select("row.*")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest doc_id stays."""
    return ngram_join.one_of_each(docs, NEAR)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages go, and documents that mostly consist of them."""
    items = spark.read.parquet(os.path.join(sf_dir, "benchmark.parquet"))
    return decontaminate.clean(docs, items)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs)


STAGES = [
    ("language ID", language),
    ("quality rules", quality),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", benchmark),
    ("best-fit packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage; each stage's result is written and reread."""
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
