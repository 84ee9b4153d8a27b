"""Streaming inventory: each micro-batch of files is folded into the history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import scd2
from ..sources.snapshots import Store

FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def start(spark: SparkSession, root: str, store: Store, table: str, build, key: str, checkpoint: str, **options):
    """Follow the files under root. build(files) gives rows with key, version_id and valid_from; a batch that is run again changes nothing."""
    files = spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("recursiveFileLookup", "true").options(**options).load(root)

    def fold(batch: DataFrame, _: int) -> None:
        rows = scd2.fresh(build(batch))
        if rows.isEmpty():
            return
        if store.exists(table):
            rows = scd2.merge(store.read(table), rows.drop(*["valid_to", "is_current", "doc_deleted"]), key)
        store.commit(**{table: rows})

    return files.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, every: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events by type in tumbling windows; rows later than the watermark are left out once the stream has passed it."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", every).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
