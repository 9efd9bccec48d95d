"""A corpus pipeline: toxic documents go, repeated lines go, one document of each near-duplicate group stays, documents with benchmark items go, the rest is packed."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, line_dedup, ngram_jaccard, packing, toxicity
from tidemark.llm._store import forget, kept


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go. It learns from all labelled documents."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("toxic").alias("label"))
    return toxicity.without_toxic(docs, toxicity.fit(docs, labels))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs are deleted; a document that was nothing else goes. n_chars follows the text."""
    out = line_dedup.without_repeated_lines(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group of near duplicates stays."""
    return ngram_jaccard.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.without_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of what is left."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard", one_of_each_group),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: Stages learn a model and tokenise, which SQL can't express; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over `documents`, each written as Parquet in the shared folder and read again."""
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    for _, stage in STAGES[:-1]:
        before, docs = docs, kept(stage(spark, docs, sf_dir))
        forget(before)
    return kept(STAGES[-1][1](spark, docs, sf_dir))
