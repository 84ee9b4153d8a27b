"""The queries opN_<name> of this package and, where SQL can express them, their oracles."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import functions as F

from . import bpe, decontam, exact_dedup, html_extract, line_dedup, lm_score, quality, sharding, simhash, token_counts
from .common import read, remove_folder, shared_dir


def op1_html_extract(spark, sf_dir):
    return html_extract.extract(read(spark, sf_dir, "pages"))


def op2_lm_score(spark, sf_dir):
    return lm_score.score(read(spark, sf_dir, "documents"))


def op3_simhash(spark, sf_dir):
    found = simhash.near_groups(read(spark, sf_dir, "documents"), width=3, radius=2)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op4_decontamination(spark, sf_dir):
    return decontam.matches(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op5_token_counts(spark, sf_dir):
    """With a cache of its own, so that each run encodes all distinct texts; it goes once the counts have been taken from it."""
    cache = f"{shared_dir(spark)}/token_counts/{uuid.uuid4().hex}"
    counted = token_counts.count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), cache)
    remove_folder(spark, cache)
    return counted


def op6_bpe(spark, sf_dir):
    return bpe.encode(read(spark, sf_dir, "documents"), keep_ids=False)


def op7_sharding(spark, sf_dir):
    return sharding.shard(read(spark, sf_dir, "documents"))


def op8_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_groups(read(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op9_quality(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    model = quality.fit(docs, read(spark, sf_dir, "labels"))
    return quality.classify(docs.select("doc_id", "text"), model).drop("text")


def op10_line_dedup(spark, sf_dir):
    return line_dedup.drop_repeated_lines(read(spark, sf_dir, "documents")).select("doc_id", "text", "lines_in", "lines_removed")


def queries():
    return {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}


def oracle_sql():
    return {"op8_exact_dedup": exact_dedup.SQL, "op10_line_dedup": line_dedup.SQL}
