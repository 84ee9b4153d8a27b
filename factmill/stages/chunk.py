"""Chunks of blocks, and the index that is searched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ids
from ..operators import chunks, scd2, search
from ..sources import providers
from ..sources.snapshots import Store
from .common import KEY, chained, live, replaced, stamped

TABLE, INDEX, POSTINGS = "silver_chunks", "chunk_index", "postings"


def versions(store: Store, code: str) -> DataFrame:
    """One row for each document that has live blocks, with the version that its chunks are to have."""
    held = live(store, "silver_blocks").select(KEY, "file_name", "content_hash", F.col("version_id").alias("silver_version_id")).distinct()
    return chained(held, "silver_version_id", code)


def run(store: Store, code: str, now: Column, size: int = 512, overlap: int = 64, forced=None) -> int:
    """Cut the blocks of new versions into chunks, and close chunks whose version isn't valid any more."""
    valid = versions(store, code)
    pending = scd2.pending(valid, store.read(TABLE)) if store.exists(TABLE) else valid
    pending = store.staged(scd2.apply_force(valid, pending, forced, KEY))
    blocks = live(store, "silver_blocks").select(KEY, "block_index", "type", "section", "page", "text", "table_id", "figure_uri").join(pending.select(KEY), KEY, "left_semi")
    cut = chunks.chunks(chunks.units(blocks, size, overlap), KEY, size).join(pending.drop("silver_version_id"), KEY)
    rows = stamped(cut.withColumn("chunk_id", ids.safe_key(F.col(KEY), F.col("chunk_index"), F.col("version_id"))), now)
    done = store.commit(**{TABLE: replaced(store, TABLE, rows, pending, valid, now, "version_id")})
    store.clear()
    return done


def index(store: Store, embedding=providers.hashed_embedding, batch: int = 100) -> int:
    """The live chunks with vectors, and their inverted index: what isn't live is in neither, and unchanged chunks keep their vectors."""
    current = live(store, TABLE).select("chunk_id", KEY, "file_name", "chunk_index", "text", "section", "page", "block_type")
    if store.exists(INDEX):
        known = store.read(INDEX).select("chunk_id", "embedding")
        kept = current.join(known, "chunk_id")
        fresh = current.join(known, "chunk_id", "left_anti")
        rows = kept.unionByName(providers.embed(fresh, "text", embedding, batch))
    else:
        rows = providers.embed(current, "text", embedding, batch)
    return store.commit(**{INDEX: rows, POSTINGS: search.postings(current, "chunk_id", keep=[KEY])})
