"""Exact deduplication by deterministic block naming.

A normalised text is cut into blocks of a fixed number of bytes. Distinct blocks are sorted and
numbered; then adjacent numbers are paired, distinct pairs sorted and numbered, and so on until a
document has one number. Two documents have the same number at the same level if and only if their
texts are identical: a number stands for content that was compared, never for a digest alone.

Digests only route: blocks with different digests differ, so just the blocks whose digest occurs
more than once are compared byte by byte, and what moves is their content, not the whole corpus.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import as_bytes, bound_batches, broadcast_if_small, cut, in_order, slices, tidy

BLOCK_BYTES = 16384


def normalise(text: bytes) -> bytes:
    """Lower-case A-Z, nothing else (bytes.lower() leaves all other bytes alone)."""
    return text.lower()


def block_digest(block: bytes) -> int:
    """Where a block is compared; two blocks may share it."""
    return xxhash.xxh3_64_intdigest(block) - (1 << 63)


def _digests(block_bytes: int, digest):
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                sha, names = [], []
                for raw in as_bytes(part.column("text")):
                    b = normalise(raw)
                    sha.append(hashlib.sha256(b).hexdigest())
                    names.append([digest(b[i : i + block_bytes]) for i in range(0, max(1, len(b)), block_bytes)])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sha, pa.string()), pa.array(names, pa.list_(pa.int64()))], ["doc_id", "text_sha256", "hs"])

    return run


def _blocks(block_bytes: int, digest):
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                hs, content = [], []
                for raw in as_bytes(part.column("text")):
                    b = normalise(raw)
                    for i in range(0, max(1, len(b)), block_bytes):
                        hs.append(digest(b[i : i + block_bytes]))
                        content.append(b[i : i + block_bytes])
                yield pa.RecordBatch.from_arrays([pa.array(hs, pa.int64()), pa.array(content, pa.binary())], ["h", "content"])

    return run


def sorted_names(keys: DataFrame, columns: list[str]) -> DataFrame:
    """Number the distinct rows of keys 0, 1, 2, ... in their order; sorted range by range, so no task sees all."""
    return in_order(keys.select(*columns).distinct(), *columns).withColumnRenamed("place", "name")


def _first_names(docs: DataFrame, blocks: DataFrame, block_bytes: int, digest) -> DataFrame:
    """(h, content or null, name): a name for each distinct block; content is set only where different blocks share a digest."""
    repeated = cut(blocks.groupBy("h").count().where("count > 1").select("h"))
    contents = docs.select("text").mapInArrow(tidy(_blocks(block_bytes, digest)), "h bigint, content binary").join(broadcast_if_small(repeated, 24), "h", "left_semi")
    clashing = cut(contents.distinct().withColumn("ways", F.count("*").over(Window.partitionBy("h"))).where("ways > 1").select("h", "content"))
    if clashing.isEmpty():
        return sorted_names(blocks, ["h"]).withColumn("content", F.lit(None).cast("binary"))
    ranked = clashing.withColumn("r", F.row_number().over(Window.partitionBy("h").orderBy("content")))
    names = sorted_names(blocks.select("h", F.lit(0).alias("r")).join(clashing, "h", "left_anti").unionByName(ranked.select("h", "r")), ["h", "r"])
    return names.join(ranked, ["h", "r"], "left").select("h", "content", "name")


def _named_blocks(docs: DataFrame, rows: DataFrame, block_bytes: int, digest) -> DataFrame:
    """(uid, pos, name) for every block of every document."""
    blocks = rows.select("uid", F.posexplode("hs").alias("pos", "h"))
    names = _first_names(docs, blocks, block_bytes, digest)
    if names.where("content is not null").isEmpty():
        return blocks.join(names.select("h", "name"), "h").select("uid", "pos", "name")
    clashing = names.where("content is not null").select("h").distinct()
    plain = blocks.join(names.where("content is null").select("h", "name"), "h").select("uid", "pos", "name")
    # the few blocks of digests with different contents are named by content, carried by document
    carried = rows.select("uid", "row_key").join(_keyed_blocks(docs, block_bytes, digest), "row_key").join(clashing, "h", "left_semi")
    return plain.unionByName(carried.join(names, ["h", "content"]).select("uid", "pos", "name"))


def _keyed_blocks(docs: DataFrame, block_bytes: int, digest) -> DataFrame:
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                key, pos, hs, content = [], [], [], []
                for raw in as_bytes(part.column("text")):
                    b = normalise(raw)
                    k = hashlib.sha256(b).hexdigest()
                    for p, i in enumerate(range(0, max(1, len(b)), block_bytes)):
                        key.append(k), pos.append(p), content.append(b[i : i + block_bytes])
                        hs.append(digest(b[i : i + block_bytes]))
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(pos, pa.int32()), pa.array(hs, pa.int64()), pa.array(content, pa.binary())], ["row_key", "pos", "h", "content"])

    return docs.select("text").distinct().mapInArrow(tidy(run), "row_key string, pos int, h bigint, content binary").dropDuplicates(["row_key", "pos"])


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, digest=block_digest) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, level, name.

    Documents of one (level, name) have the same text after lower-casing A-Z; null counts as empty.
    The row with the largest doc_id stays (a null id is below every other); of rows that repeat
    whole, one stays. An empty table gives an empty result; other columns are ignored.
    """
    bound_batches(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    digests = docs.mapInArrow(tidy(_digests(block_bytes, digest)), "doc_id bigint, text_sha256 string, hs array<bigint>")
    rows = cut(digests.withColumn("uid", F.monotonically_increasing_id())).withColumn("row_key", F.col("text_sha256"))
    most = rows.agg(F.max(F.size("hs"))).first()[0] or 0
    level, done = 0, []
    names = cut(_named_blocks(docs, rows, block_bytes, digest)) if most else rows.select("uid", F.lit(0).alias("pos"), F.lit(0).cast("bigint").alias("name"))
    sizes = rows.select("uid", F.size("hs").alias("n"))
    work = names if most <= 1 else names.join(sizes, "uid")
    if most <= 1:
        done.append(work.select("uid", F.lit(0).alias("level"), "name"))
    while most > 1:
        done.append(work.where("n = 1").select("uid", F.lit(level).alias("level"), "name"))
        pairs = cut(
            work.where("n > 1")
            .groupBy("uid", F.floor(F.col("pos") / 2).cast("int").alias("pos"), F.floor((F.col("n") + 1) / 2).cast("int").alias("n"))
            .agg(F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"), F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b"))
        )
        work = pairs.join(sorted_names(pairs, ["a", "b"]), ["a", "b"]).select("uid", "pos", "n", "name")
        level, most = level + 1, (most + 1) // 2
        if most <= 1:
            done.append(work.select("uid", F.lit(level).alias("level"), "name"))
    identity = done[0]
    for d in done[1:]:
        identity = identity.unionByName(d)
    named = cut(rows.select("uid", "doc_id", "text_sha256").join(identity, "uid"))
    best = F.max(F.struct(F.col("doc_id"), F.col("uid"))).alias("best")
    # by itself, so that a hot group's partition of the join can be split
    groups = cut(named.groupBy("level", "name").agg(best, F.count("*").alias("group_size")).where("group_size > 1"))
    return named.join(groups, ["level", "name"], "left").select(
        "doc_id",
        F.when(F.col("best").isNull(), F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        F.coalesce(F.col("best.uid") == F.col("uid"), F.lit(True)).alias("kept"),
        "text_sha256", "level", "name",
    )


SQL = """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM documents),
g AS (SELECT *, max(doc_id) OVER (PARTITION BY k) AS keep_id, count(*) OVER (PARTITION BY k) AS group_size,
      row_number() OVER (PARTITION BY k ORDER BY doc_id DESC NULLS LAST) AS r FROM t)
SELECT doc_id, keep_id, group_size, r = 1 AS kept, sha256(k) AS text_sha256 FROM g
"""
