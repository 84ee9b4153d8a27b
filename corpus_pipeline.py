"""From documents to training tokens: quality, repeated lines, near copies, benchmark leaks, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes every stage's result
to the shared folder as Parquet and gives what it reads back to the next one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factmill.llm import bpe, decontam, line_dedup, quality, simhash
from factmill.llm.common import cut, read, remove_folder, shared_dir


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Junk and abusive documents go. A null text counts as empty and stays; rows that repeat are decided alike; no rows give none."""
    model = quality.fit(docs, read(spark, sf_dir, "labels"))
    return quality.classify(docs, model).where("kept").select(docs.columns)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three-line passages, and then of passages of fifty words however they lie on lines, are cut out of the texts; no row goes.

    Null texts stay null; rows that agree in id and text are one document and are cut alike; rows
    without an id come first.
    """
    cleaned = line_dedup.drop_repeated_passages(cut(line_dedup.drop_repeated_lines(docs).select(docs.columns)))
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id (five-word shingles, similarity of 0.8).

    Null and empty texts are one group; rows that repeat whole are one document; rows without an id
    come after all others.
    """
    return simhash.drop_near_copies(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, up to its error budget, go. Null and empty texts hold none; rows that repeat go or stay together."""
    return decontam.clean(docs, read(spark, sf_dir, "benchmark"))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, with digests of the ids and of the decoded text; null counts as empty."""
    return bpe.encode(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_deduplication),
    ("simhash_near_dedup", near_deduplication),
    ("benchmark_decontamination", benchmark_decontamination),
    ("bpe_encoding", bpe_encoding),
]

#: The classifier is fitted and fingerprints are hashed, which SQL can't express; tests/llm/test_pipeline.py holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. What a stage wrote goes once the next one has read it; the last stage's folder stays, as its rows are read from it."""
    docs = read(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/pipeline/{uuid.uuid4().hex}"
    before = None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            remove_folder(spark, f"{folder}/{before}")
        before = name
    return docs
