"""What the stages share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ids
from ..operators import scd2
from ..sources.snapshots import Store

KEY = "relative_path"


def live(store: Store, table: str) -> DataFrame:
    return scd2.live(store.read(table))


def chained(df: DataFrame, parent: str, code: str) -> DataFrame:
    """df with code_hash and version_id, which follows from the path, the parent's version and the code."""
    return df.withColumn("code_hash", F.lit(code)).withColumn("version_id", ids.version_id(F.col(KEY), F.col(parent), F.col("code_hash")))


def stamped(df: DataFrame, now: Column) -> DataFrame:
    """df as rows that hold from now on."""
    return scd2.fresh(df.withColumn("valid_from", now))


def replaced(store: Store, table: str, rows: DataFrame, changed: DataFrame, active: DataFrame, now: Column, key: str = KEY) -> DataFrame:
    """The table with the rows of changed keys replaced, and what isn't active any more closed; rows alone on the first run."""
    if not store.exists(table):
        return rows
    if changed.isEmpty():  # no row of the table is joined to find that out
        return scd2.tombstone(scd2.evolve(store.read(table), rows), active, key, now)
    return scd2.tombstone(scd2.expire_and_append(store.read(table), rows, changed, KEY, now), active, key, now)
